"""Word and shingle hashes agree with plain Python on which words and shingles are equal."""

import ctypes
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gapwise.llm import words
from gapwise.llm.words import shingle_sets, slices, text_buffers, word_hashes

TEXT = st.lists(st.text(alphabet="aAbBé \t\n\x0b\x0c\r\x1c\xa0", max_size=30), max_size=6)


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def plain_shingles(text):
    w = plain_words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_words_and_shingles_match_plain_python(texts):
    hashes, first = word_hashes(*text_buffers(pa.array(texts, pa.string())))
    expected = [plain_words(t) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat)) == len(set(zip(flat, hashes.tolist())))
    sets = list(shingle_sets(hashes, first))
    assert [len(s) for s in sets] == [len(plain_shingles(t)) for t in texts]
    names = {}
    for t, s in zip(texts, sets):
        assert names.setdefault(s.tobytes(), plain_shingles(t)) == plain_shingles(t)


def test_nulls_offsets_and_long_words():
    long_word = "x" * 70_000
    col = pa.array(["skip me", None, "", long_word.upper() + " b", long_word], pa.string()).slice(1)
    hashes, first = word_hashes(*text_buffers(col))
    assert first.tolist() == [0, 0, 0, 2, 3]
    assert hashes[0] == hashes[2] != hashes[1]


def test_word_hash_does_not_depend_on_its_block():
    words = [f"w{i % 977}" for i in range(400_000)]
    hashes, _ = word_hashes(*text_buffers(pa.array([" ".join(words)])))
    assert len(hashes) == len(words)
    assert (hashes == hashes[:977][np.arange(len(words)) % 977]).all()


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(["a" * 10, None, "b" * 100, "", "c"])], ["i", "t"])
    parts = list(slices(batch, 1, 20))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(5))


def _held() -> float:
    """MB of this process that no file backs."""
    return sum(map(int, re.findall(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text()))) / 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="not glibc")
def test_a_worker_gives_back_the_memory_of_a_batch():
    """A worker lives on between tasks: what it keeps adds to the memory of each later operator."""
    before = _held()
    texts = [bytes([k % 251]) * 4000 for k in range(50_000)]
    some = texts[::100]                                  # pieces in between and at the end that are still in use
    del texts
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None, "c"])], names=["text"])
    assert [b.num_rows for b in words.slices(batch, 0)] == [3]
    assert _held() - before < 60 and len(some) == 500
    assert words._POW.nbytes + words._INV.nbytes < 4 << 20


def test_hashes_do_not_depend_on_the_block(monkeypatch):
    texts = pa.array(["one two  three " * 400, "", None, "x" * 300 + " y", "two"])
    whole, first = words.word_hashes(*words.text_buffers(texts))
    monkeypatch.setattr(words, "_BLOCK", 64)
    parts, at = words.word_hashes(*words.text_buffers(texts))
    assert (whole == parts).all() and (first == at).all() and len(set(whole.tolist())) == 5

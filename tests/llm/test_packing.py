"""Packing: token ids as whole texts give them, gapless places, few sequences."""

import random
import sys
import zlib
from itertools import combinations as choose
from math import ceil

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_SMALL
from gapwise.llm import packing

TOK = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
PIECES = st.sampled_from(["a", "B", "é", "É", "ß", "İ", "Σς", "ſ", "1²", "٣", "…", "—", "'s", "'", ",", ".", "!?", "(", ")", " ", "  ", "\n",
                          "\t", "\x0b", "\x1c", "\x85", "\xa0", "　", "　", "<|startoftext|>", "<|STARTOFTEXT|>", "<", "|", ">", "_", "%", "é",
                          "̀", "‍", "漢字", "😀", "the ", "the, "])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=10).map("".join))
def test_ids_are_those_of_the_whole_text(text):
    got = np.frombuffer(packing.encoder().text(text.encode()), "<u4").tolist()
    assert got == TOK.encode(text, add_special_tokens=False).ids + [packing.END_ID]


LETTERS = "".join(c for c in map(chr, range(0x260)) if c.isalpha())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=LETTERS, min_size=1, max_size=12), st.sampled_from(["", ".", "!?", "<", "|", "7", "7,"]))
def test_letters_of_all_alphabets_used_alone(word, end):
    got = np.frombuffer(packing.WordEncoder.text(packing.encoder(), (word + end).encode()), "<u4").tolist()
    assert got == TOK.encode(word + end, add_special_tokens=False).ids + [packing.END_ID]


def test_a_new_word_of_letters_takes_few_steps():
    own, calls = packing.encoder(), []
    sys.setprofile(lambda frame, event, arg: calls.append(arg) if event == "c_call" else None)
    own.word(b"lesquequeeau")
    sys.setprofile(None)
    assert len(calls) <= 9


def test_cache_overflow_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED_WORDS", 5)
    text = "one two three four five six seven one two " + "x" * 200
    own = packing.WordEncoder(packing.TOKENIZER)
    for _ in range(3):
        assert np.frombuffer(own.text(text.encode()), "<u4").tolist()[:-1] == TOK.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8), st.integers(0, 40))
def test_fullest_reaches_the_best_sum(lengths, room):
    counts = {x: lengths.count(x) for x in lengths}
    got = packing.fullest(counts, room)
    assert all(0 < n <= counts[x] for x, n in got)
    sums = {sum(c) for k in range(len(lengths) + 1) for c in choose(lengths, k)}
    assert sum(x * n for x, n in got) == max(s for s in sums if s <= room)


def test_combinations_use_every_piece_once_and_few_bins():
    r = random.Random(2)
    counts = {}
    for _ in range(5000):
        x = min(4096, int(r.lognormvariate(6, 1)) + 1)
        counts[x] = counts.get(x, 0) + 1
    packed = packing.combinations(counts)
    used = {}
    for parts, bins in packed:
        assert sum(x * n for x, n in parts) <= 4096 and bins > 0
        for x, n in parts:
            used[x] = used.get(x, 0) + n * bins
    assert used == counts
    assert sum(b for _, b in packed) <= ceil(sum(x * n for x, n in counts.items()) / 4096) + 2


def check(rows, texts, capacity):
    """Every piece's ids, and that places are gapless from 0."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for doc_id, text in texts.items():
        ids = TOK.encode(text or "", add_special_tokens=False).ids + [1]
        parts = sorted(by_doc.pop(doc_id), key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(ceil(len(ids) / capacity)))
        for p in parts:
            own = np.array(ids[p["start"]: p["start"] + p["length"]], "<u4")
            assert p["start"] == p["piece"] * capacity and len(own) == p["length"] == min(capacity, len(ids) - p["start"])
            assert zlib.crc32(own.tobytes()) == p["ids_crc32"]
    assert not by_doc
    for parts in by_seq.values():
        parts.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in parts] == np.cumsum([0] + [p["length"] for p in parts])[:-1].tolist()
        assert sum(p["length"] for p in parts) <= capacity
    return len(by_seq)


def test_small_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for capacity in (4096, 64):
        rows = packing.pack(docs.repartition(5), capacity=capacity).collect()
        n = check(rows, texts, capacity)
        assert n <= ceil(sum(r["length"] for r in rows) / capacity) + 2


def test_edges_and_sequences(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "a b c " * 3000, 7), (4, "same text", 8), (5, "same text", 9)],
                                 "doc_id long, text string, length int")
    rows = packing.pack(docs).collect()
    check(rows, {1: None, 2: "", 3: "a b c " * 3000, 4: "same text", 5: "same text"}, 4096)
    whole = packing.sequences(packing.pack(docs), packing.token_pieces(docs, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(r["length"] for r in rows)
    twice = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "z")], "doc_id long, text string")
    assert packing.pack(twice).count() == 3
    assert packing.pack(docs.limit(0)).count() == 0

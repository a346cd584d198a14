"""Language identification by compression.

For every language a raw-content zstandard dictionary is cut from labelled
texts. A text is compressed in pieces with each dictionary in turn; the
language with the smallest total wins, unless the runner-up is too close.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.words import slices

SAMPLE_DOCS = 400          # labelled documents read for each language, about
SAMPLE_CHARS = 2000        # of one labelled document, from a hashed place, so that no text fills a dictionary
DICT_BYTES = 200_000
PIECE = 1024               # characters compressed at once
LEVEL = 7
MIN_MARGIN = 0.001         # of the smallest size; closer results are rejected
_HAS_LETTER = r"\p{L}"


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language from a bounded sample of the labelled rows.

    About SAMPLE_DOCS rows of each language are drawn by a hash of their id; of
    each SAMPLE_CHARS characters from a place that the id's hash names are used (all of a
    shorter text) and a language keeps DICT_BYTES bytes. Rows with a null language,
    null text or no letter in what was drawn teach nothing.
    """
    rows = labelled.select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    most = 1 << 30
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(most, most * SAMPLE_DOCS // n)))])
    place = F.pmod(F.xxhash64("h", F.lit(1)), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1)).cast("int") + 1
    drawn = (rows.where(F.pmod("h", F.lit(most)) < share[F.col("lang")])
             .select("lang", "h", F.lower(F.substring("text", place, F.lit(SAMPLE_CHARS))).alias("text")).where(F.col("text").rlike(_HAS_LETTER))
             .collect())
    out: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for lang, _, text in sorted(set(map(tuple, drawn)), key=lambda r: (r[0], r[1])):
        raw = text.encode()
        if raw not in out.setdefault(lang, []) and size.get(lang, 0) < DICT_BYTES:
            out[lang].append(raw)
            size[lang] = size.get(lang, 0) + len(raw) + 1
    return {lang: b"\n".join(parts)[:DICT_BYTES] for lang, parts in out.items()}


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text[:64])) or any(map(str.isalpha, text))


def sizes(text: str, coders: list[zstd.ZstdCompressor]) -> np.ndarray:
    """Compressed size of the text with each dictionary."""
    pieces = [text[i:i + PIECE].encode("utf-8", "replace") for i in range(0, len(text), PIECE)]
    return np.array([sum(len(c.compress(p)) for p in pieces) for c in coders], float)


def choose(size: np.ndarray) -> tuple[int, float, float]:
    """Index of the smallest size, a score from 0 to 1 and the margin to the runner-up."""
    best = int(size.argmin())
    rest = np.delete(size, best)
    margin = float((rest.min() - size[best]) / size[best]) if len(rest) else 1.0
    return best, float(1 / np.exp(-(size - size[best]) / (0.01 * size[best] + 1)).sum()), margin


def _coders(dictionaries: dict[str, bytes]) -> list[zstd.ZstdCompressor]:
    out = []
    for lang in sorted(dictionaries):
        d = zstd.ZstdCompressionDict(dictionaries[lang], dict_type=zstd.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                       write_dict_id=False))
    return out


def _classified(text: str | None, langs: list[str], coders: list[zstd.ZstdCompressor]) -> tuple[str, float, float]:
    """(language, score, margin) of one text."""
    if not langs or not text or not _has_letter(text):
        return "und", 0.0, 0.0
    best, score, margin = choose(sizes(text.lower(), coders))
    return langs[best], score, margin


def _predict(dictionaries: dict[str, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, coders = sorted(dictionaries), _coders(dictionaries)
        for whole in batches:
            for batch in slices(whole, 1):
                found = [_classified(x.as_py(), langs, coders) for x in batch.column(1)]
                cols = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "lang_pred", "score", "margin"])
    return run


def predict(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, lang_pred, score, margin, rejected.

    lang_pred is ``und`` for null texts and texts without a letter, with score
    0. rejected marks these and texts whose two best languages are closer than
    MIN_MARGIN of the smallest size. Ties go to the first language by name.
    Without any dictionary all is ``und``. Rows are kept as they are, repeated
    and null ids included; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _predict(dictionaries), "doc_id long, lang_pred string, score double, margin double")
    return rows.withColumn("rejected", (F.col("lang_pred") == "und") | (F.col("margin") < MIN_MARGIN))


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not rejected by :func:`predict`'s rule."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, coders = sorted(dictionaries), _coders(dictionaries)
        for whole in batches:
            for batch in slices(whole, at):
                found = [_classified(x.as_py(), langs, coders) for x in batch.column(at)]
                yield batch.filter(pa.array([lang != "und" and margin >= MIN_MARGIN for lang, _, margin in found], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)

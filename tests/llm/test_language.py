"""Language identification by compression: held-out accuracy and defined results at the edges."""

from conftest import SF_ORACLE
from gapwise.llm import language
from gapwise.llm.queries import op9_language


def test_held_out_accuracy(spark):
    got = op9_language(spark, SF_ORACLE)
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert got.where("rejected").count() <= 0.02 * docs.count() and got.count() == docs.count()


def test_edges(spark):
    texts = {"xx": "the quick brown fox jumps over the lazy dog and runs " * 5, "yy": "der schnelle braune fuchs springt über den faulen hund " * 5}
    docs = spark.createDataFrame([(k, texts[lang], lang, "s") for k, lang in enumerate(["xx", "yy"] * 6)] + [(50, None, "xx", "s"), (51, "hm", None, "s")],
                                 "doc_id long, text string, lang string, score string")
    known = language.learn(docs)
    assert sorted(known) == ["xx", "yy"]
    ask = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, texts["yy"] * 40), (4, texts["xx"]), (None, texts["xx"]), (5, "ÜBER DEN HUND springt")],
                                "doc_id long, text string")
    got = sorted(((r["doc_id"], r["lang_pred"], r["rejected"]) for r in language.predict(ask, known).collect()), key=str)
    assert got == sorted([(1, "und", True), (2, "und", True), (3, "und", True), (4, "yy", False), (4, "xx", False), (None, "xx", False),
                          (5, "yy", False)], key=str)
    assert language.accepted(ask, known).count() == 4 and language.accepted(ask, known).columns == ask.columns
    assert language.learn(docs.limit(0)) == {}
    assert {r["lang_pred"] for r in language.predict(ask, {}).collect()} == {"und"}
    assert language.predict(ask.limit(0), known).count() == 0
    alike = {"a": known["xx"], "b": known["xx"]}
    assert [r["rejected"] for r in language.predict(ask.where("doc_id = 5"), alike).collect()] == [True]


def test_whole_text_counts():
    import zstandard as zstd

    coder = [zstd.ZstdCompressor(level=1)]
    assert language.sizes("ab" * 3000, coder)[0] > language.sizes("ab" * 500, coder)[0]


def test_matches_plain_compression(spark):
    """The documented rule with a compressor for every piece: the smallest total of 1,024-character pieces wins."""
    import zstandard as zstd

    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").where("doc_id < 120")
    known = language.learn(docs)
    dicts = {lang: zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT) for lang, raw in known.items()}

    def total(text, lang):
        pieces = [text[i:i + 1024] for i in range(0, len(text), 1024)]
        return sum(len(zstd.ZstdCompressor(level=7, dict_data=dicts[lang], write_content_size=False, write_checksum=False,
                                          write_dict_id=False).compress(p.encode())) for p in pieces)
    got = {r["doc_id"]: (r["lang_pred"], r["margin"]) for r in language.predict(docs, known).collect()}
    for r in docs.collect():
        text = (r["text"] or "").lower()
        if not any(c.isalpha() for c in text):
            assert got[r["doc_id"]][0] == "und"
            continue
        sizes = {lang: total(text, lang) for lang in known}
        lang, margin = got[r["doc_id"]]
        assert lang == min(sizes, key=sizes.get) or margin < 0.002 and sizes[lang] <= 1.002 * min(sizes.values())


def test_windows_are_drawn_from_whole_texts(spark):
    text = "aaaa " * 1000 + "zzzz " * 1000
    docs = spark.createDataFrame([(k, f"{k} {text}", "xx") for k in range(60)], "doc_id long, text string, lang string")
    raw = language.learn(docs)["xx"]
    assert b"aaaa" in raw and b"zzzz" in raw

"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gapwise.llm import chat, decontaminate, embeddings, language, minhash, ngram, packing, pii, quality, ranking, repair, secrets, warc
from gapwise.llm.folds import in_fold, remainder
from gapwise.runtime import materialize, scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def _span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str, base: Callable[[Column], Column]) -> Column:
    return F.size(F.filter("spans", lambda s: (s["kind"] == kind) & base(s))).cast("long").alias(f"n_{kind}")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.dictionary(docs))

    def base(s: Column) -> Column:
        return s["kind"] != "guess"
    return found.select("doc_id", *[_count(k, base) for k in ("assign", "access", "hex")],
                        F.sha2(_span_text(F.filter("spans", base)), 256).alias("base_sha256"),
                        _span_text(F.col("spans")).alias("spans"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.learn(docs))

    def base(s: Column) -> Column:
        return s["base"]
    return found.select("doc_id", *[_count(k, base) for k in pii.KINDS],
                        F.sha2(_span_text(F.filter("spans", base)), 256).alias("base_sha256"),
                        _span_text(F.col("spans")).alias("spans"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = quality.score(docs, labels.where(remainder(5) != 0))
    return found.select("doc_id", in_fold(5, 0).alias("held_out"), "score",
                        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.page_captures(spark, path)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.predict(docs, language.learn(docs.where(remainder(3) != 1)))
    return found.select("doc_id", in_fold(3, 1).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model, _ = ngram.learn(docs.where(remainder(5) != 1))
    found = ngram.score(docs, model)
    return found.select("doc_id", in_fold(5, 1).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")


def op11_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, _ = ranking.build(_table(spark, sf_dir, "documents"))
    return ranking.search(index, _table(spark, sf_dir, "benchmark"))


CONTROLS = "\\### Assistant: </turn> ok"    # the text of conversation -7


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql("SELECT -7L AS conv_id, turn, role FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    log = chat.as_log(rows.unionByName(own.withColumn("text", F.lit(CONTROLS))))
    written, _ = materialize(chat.render(chat.reconstruct(log)), "chat")
    return chat.digest(chat.read_back(written))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by a checksum of their conversation and turn."""
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(place) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(copies).alias("copy")).drop("copy")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return repair.report(damaged(rows), rows)


_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x20\\x09-\\x0D]+')"""

_TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_embeddings": op2_embeddings,
    "op3_quality": op3_quality,
    "op4_secrets": op4_secrets,
    "op5_packing": op5_packing,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_pii": op8_pii,
    "op9_language": op9_language,
    "op10_lm": op10_lm,
    "op11_ranking": op11_ranking,
    "op12_chat": op12_chat,
    "op13_repair": op13_repair,
    "pipeline": corpus_pipeline.run,
}

def _repair_sql() -> str:
    """Costs and cheapest edits row by row from each conversation's end, as strings of a fixed-width cost and the edits."""
    after = {"n": "u", "s": "u", "u": "a", "a": "u"}
    kept = {"n": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def plus(edit: str, cost: str, best: str) -> str:
        return f"lpad(({best}[1:9]::INT + {cost})::VARCHAR, 9, '0') || '{edit}' || {best}[10:]"

    def row(q: str) -> str:
        keep = "".join(f"WHEN x = '{i}' THEN {plus('K', 'p', 'b' + to)} " for i, to in kept[q].items())
        return (f"least({plus('D', '2', 'b' + q)}, CASE WHEN gone THEN '~' ELSE {plus('R', 'p + 1', 'b' + after[q])} END, "
                f"CASE WHEN gone THEN '~' {keep}ELSE '~' END) AS b{q}")

    def inserted(source: str) -> str:
        return f"SELECT conv_id, i, {', '.join(f'least(b{q}, {plus("I", "5", "b" + after[q])}) AS b{q}' for q in after)} FROM ({source})"
    step = f"""SELECT r.conv_id, r.i, {', '.join(row(q) for q in after)}
    FROM b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1"""
    crc = ("list_reduce([4294967295] || list_transform(range(1, length(k) + 1), lambda j: ord(k[j])), lambda c, o: "
           "list_reduce([xor(c, o), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))")
    bare = "rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
f AS (SELECT *, xor({crc}, 4294967295) % 20 AS f FROM c),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE f WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE f <> 0)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
g AS (SELECT *, {bare} = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    right({bare}, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS x,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS xx FROM o),
r AS (SELECT *, blank OR again AS gone, CASE WHEN cut AND NOT blank AND NOT again THEN 5 ELSE 0 END AS p FROM g),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count_if(blank) AS blank, count_if(again AND NOT blank) AS duplicate, count_if(p > 0) AS truncated,
    count_if(xx NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
b AS (
  SELECT conv_id, n + 1 AS i, '000000000' AS bn, '000000010II' AS bs, '000000005I' AS bu, '000000000' AS ba FROM n
  UNION ALL ({inserted(inserted(inserted(step)))})),
a AS (SELECT conv_id, bn[1:9]::BIGINT AS cost, bn[10:] AS audit FROM b WHERE i = 1),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY t) AS j,
    1 + count(*) FILTER (WHERE letter <> 'I') OVER (PARTITION BY conv_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS i
  FROM (SELECT conv_id, t, audit[t] AS letter FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS t FROM a))),
k AS (SELECT e.*, r.role, r.text, r.x = 's' AND letter = 'K' AS sys, row_number() OVER (PARTITION BY e.conv_id ORDER BY t) AS z
  FROM e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.i = e.i WHERE letter <> 'D'),
w AS (SELECT *, z - count(*) FILTER (WHERE sys) OVER (PARTITION BY conv_id ORDER BY t) AS y FROM k),
h AS (SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN y % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
    || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY t) AS whole FROM w GROUP BY conv_id),
q AS (SELECT DISTINCT conv_id FROM conversations)
SELECT q.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM q LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM q.conv_id
  LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM q.conv_id"""


ORACLE: dict[str, str] = {
    "op1_minhash": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id
  GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
m AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op2_embeddings": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
e AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_cosine_similarity(p.x, q.x) >= 0.9),
r AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.vec_id),
m AS (SELECT vec_id, min(root) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM e GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM m LEFT JOIN n USING (vec_id)""",
    "op7_decontaminate": """
WITH w(d, id, ws) AS (
  SELECT true, doc_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') FROM documents
  UNION ALL
  SELECT false, item_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') FROM benchmark),
t AS (SELECT d, id, len(ws) AS n, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
h AS (SELECT x.id AS doc_id, y.id AS item_id, x.i - y.i AS shift FROM t x JOIN t y USING (word)
  WHERE x.d AND NOT y.d GROUP BY ALL HAVING count(*) * 13 >= 10 * least(13, any_value(y.n))),
e AS (
  SELECT h.doc_id, h.item_id, shift, least(13, len(y.ws)) AS size,
    list_transform(range(1, len(y.ws) + 1), lambda j: CASE WHEN j + shift >= 1 AND x.ws[j + shift] = y.ws[j] THEN 1 ELSE 0 END) AS eq
  FROM h JOIN w x ON x.d AND x.id = h.doc_id JOIN w y ON NOT y.d AND y.id = h.item_id),
v AS (
  SELECT doc_id, item_id, size, shift, a, list_sum(eq[a:a + size - 1]) AS matched
  FROM (SELECT *, unnest(range(1, len(eq) - size + 2)) AS a FROM e)),
m AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, shift + a) AS k FROM v
  WHERE matched * 13 >= 10 * size)
SELECT doc_id, item_id, matched::BIGINT AS matched, (shift + a - 1)::BIGINT AS doc_start FROM m WHERE k = 1""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, h, sha1(h) AS hx, max(page_id) OVER (PARTITION BY h) AS stored FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hx, (k // 4) * 5 + 1, 5))::BIGINT >> (5 * (3 - k % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = stored THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> stored THEN stored END AS refers_to
FROM g""",    "op11_ranking": f"""
WITH t AS (SELECT doc_id AS id, true AS d, row_number() OVER () AS row, text FROM documents
  UNION ALL SELECT item_id, false, row_number() OVER (), text FROM benchmark),
w AS (SELECT row, id, d, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '{_TERMS}') AS terms FROM t),
s AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n, greatest(sum(len(terms)), 1)::BIGINT AS total FROM w WHERE d),
p AS (SELECT row, id, len, term, count(*) AS tf FROM (SELECT row, id, len(terms) AS len, unnest(terms) AS term FROM w WHERE d) GROUP BY ALL),
i AS (SELECT row, id, term, count(*) AS times FROM (SELECT row, id, unnest(terms) AS term FROM w WHERE NOT d) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM p, s GROUP BY term),
r AS (SELECT i.row, i.id AS item_id, p.row AS doc, p.id AS doc_id,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len * n) // total))))::BIGINT AS score
  FROM i JOIN p USING (term) JOIN f USING (term), s GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10""",
    "op12_chat": """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM c),
l AS (SELECT *, length(x) + length(x) - length(replace(x, '\\', ''))
    + list_sum([0] || list_transform(regexp_extract_all(x, '#{3,}'), lambda r: length(r) - 2))
    + (length(x) - length(replace(x, '</turn>', ''))) // 7 AS size
  FROM (SELECT conv_id, k, unnest([role, text]) AS x, unnest([length(role) - length(replace(role, ': ', ' ')), 0]) AS colons FROM o)),
f AS (SELECT conv_id, sum(size + colons)::BIGINT AS n FROM l GROUP BY conv_id)
SELECT o.conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (any_value(n) + 14 * count(*))::BIGINT AS formatted_chars
FROM o JOIN f ON f.conv_id IS NOT DISTINCT FROM o.conv_id GROUP BY o.conv_id""",
    "op13_repair": _repair_sql(),
}

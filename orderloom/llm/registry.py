"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import bpe, collocations, digest_dedup, filter_audit, jaccard, language, license_notices, line_dedup, packing, pii, secrets, spans, topk, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """Documents that the language model must not learn from."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), added=packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))
    digest = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(spark, digest).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.train(language.training_rows(docs, "text", "lang", ~held_out(), F.col("doc_id")))
    found = language.predict(spark, docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_dedup.mark_duplicates(spark, _table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.document_classes(jaccard.similar(spark, _table(spark, sf_dir, "documents")))


def _span_digests(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return found.select(
        "doc_id",
        *(spans.counted("spans", kind).alias(f"n_{kind}") for kind in kinds),
        F.sha2(spans.listed("spans", base_only=True), 256).alias("base_sha256"),
        spans.listed("spans").alias("spans"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(spans.find_spans(_table(spark, sf_dir, "documents"), pii.find), pii.KINDS)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digests(spans.find_spans(_table(spark, sf_dir, "documents"), secrets.find), secrets.KINDS[:3])


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_repeated_lines(spark, _table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cleaned.select("doc_id", F.col("_lines_seen").alias("n_lines"), F.col("_lines_dropped").alias("n_dropped"), digest.alias("text_sha256"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, _table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, _table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices.summary(license_notices.scan(_table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_language_id": op2_language_id,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_warc": op4_warc,
        "op5_jaccard": op5_jaccard,
        "op6_pii": op6_pii,
        "op7_secrets": op7_secrets,
        "op8_bpe_round_trip": op8_bpe_round_trip,
        "op9_line_dedup": op9_line_dedup,
        "op10_top_k": op10_top_k,
        "op11_filter_audit": op11_filter_audit,
        "op12_collocations": op12_collocations,
        "op13_license_scan": op13_license_scan,
    }


_OP3 = """
WITH groups AS (
  SELECT coalesce(text, '') AS body, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.body) AS text_sha256
FROM documents d JOIN groups g ON coalesce(d.text, '') = g.body
"""

_OP4 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND payload_bytes >= 1000
"""

_OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP11 = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
flags AS (
  SELECT doc_id, part, CAST(len(w) < 100 AS INTEGER) AS a,
         CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INTEGER) AS b,
         CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS INTEGER) AS c,
         CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER) AS d,
         CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS e
  FROM words),
good AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n,
         count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM flags LEFT JOIN good USING (doc_id) GROUP BY 1, 2),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)),
steps AS (
  WITH RECURSIVE s(filter_order, taken, done) AS (
    SELECT letter, bit, 1 FROM letters
    UNION ALL SELECT filter_order || letter, taken + bit, done + 1 FROM s, letters WHERE taken & bit = 0)
  SELECT o.filter_order, CAST(x.done AS INTEGER) AS step, l.bit, x.taken - l.bit AS earlier, x.taken
  FROM s o, s x, letters l
  WHERE o.done = 5 AND starts_with(o.filter_order, x.filter_order) AND l.letter = right(x.filter_order, 1)),
counted AS (
  SELECT part, filter_order, step, bit,
         CAST(coalesce(sum(n) FILTER (mask & taken = 0), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & earlier <> 0), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & earlier = 0), 0) AS BIGINT) AS toxic_lost
  FROM masks, steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

_OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
spots AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM worded),
f AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS a
  FROM spots, (VALUES (1), (2), (3)) v(m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY 1),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.m, c.a, k, l.a AS l, r.a AS r,
         CAST(1000000 * c.a::HUGEINT * c.a::HUGEINT // (l.a::HUGEINT * r.a::HUGEINT) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(c.w, k + 1, c.m), ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(list_slice(w, i, i + 1), ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (1), (2)) v(i) WHERE m = 3 GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": _OP3, "op4_warc": _OP4, "op10_top_k": _OP10, "op11_filter_audit": _OP11, "op12_collocations": _OP12}

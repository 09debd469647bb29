"""The registered queries of hard-negative mining, secret scans and periodic runs."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hardneg, periods, secretscan
from .catalog import register
from .shared import read

OP11_SQL = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS mate, b.vec_id AS id,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE mate
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.mate
        AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@register("op11_hard_negatives", OP11_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every anchor and positive of all embeddings."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(vectors.withColumn("label", label))


def _kind(rule: secretscan.Rule, number: int) -> str:
    """The rule as a row of SQL: head in group 1, body in group 2."""
    head = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in rule.head.replace(r"\x20", " ")) \
        if rule.any_case else rule.head
    head = head.replace("(", "(?:").replace("'", "''")
    return f"({number}, '{rule.kind}', '({head})({rule.body + '+' if rule.body else ''})', {rule.least})"


OP12_SQL = rf"""
WITH rules(n, kind, pattern, least) AS (VALUES {', '.join(_kind(r, i) for i, r in enumerate(secretscan.RULES))}),
m AS (SELECT doc_id, n, kind, least, regexp_extract_all(text, pattern) AS whole, regexp_extract_all(text, pattern, 2) AS body,
             regexp_split_to_array(text, pattern) AS gaps
      FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents), rules),
s AS (SELECT doc_id, n, kind, least, unnest(range(1, len(whole) + 1)) AS j, whole, body, gaps FROM m),
p AS (SELECT doc_id, n, kind, length(whole[j]) AS size, length(body[j]) >= least AS ok,
             list_sum(list_transform(gaps[1:j], lambda g: length(g)))
               + coalesce(list_sum(list_transform(whole[1:j - 1], lambda g: length(g))), 0) AS p0 FROM s),
t AS (SELECT doc_id, n, p0, kind || ':' || CAST(p0 AS BIGINT) || ':' || CAST(p0 + size AS BIGINT) AS span FROM p WHERE ok),
a AS (SELECT doc_id, count(CASE WHEN n = 0 THEN 1 END) AS n_assign, count(CASE WHEN n = 1 THEN 1 END) AS n_access,
             count(CASE WHEN n = 2 THEN 1 END) AS n_hex,
             string_agg(CASE WHEN n < 3 THEN span END, ',' ORDER BY p0, n) AS base, string_agg(span, ',' ORDER BY p0, n) AS spans
      FROM t GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""


@register("op12_secret_scan", OP12_SQL)
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: counts, digest of the base kinds, all spans."""
    found = secretscan.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))))
    base = F.filter("spans", lambda s: s.kind.isin("assign", "access", "hex"))
    return found.select("doc_id", of("assign"), of("access"), of("hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w0,
         xor(4294967295, list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS h
  FROM documents),
g AS (SELECT *, len(w0) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
e AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: w0[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
        ELSE w0 END AS w FROM a),
k AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 4), lambda i: array_to_string(w[i:i + 5], ' '))) AS gram,
             unnest(range(0, len(w) - 5)) AS i FROM e WHERE len(w) >= 12),
q AS (SELECT x.doc_id, x.i, x.i - y.i AS lag FROM k x JOIN k y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i < x.i),
z AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM q),
s AS (SELECT doc_id, lag, min(i) - lag AS start, count(*) + 5 + lag AS length FROM z GROUP BY doc_id, lag, island),
r AS (SELECT doc_id, start, length, min(lag) AS period FROM s WHERE length >= 12 AND length >= 2 * lag GROUP BY doc_id, start, length),
t AS (SELECT doc_id, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256,
             first(struct_pack(start := start, length := length, period := period) ORDER BY length DESC, start, period) AS best
      FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM e),
c AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length,
       CAST(best.period AS BIGINT) AS period, CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
       coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def repeat_tail(doc_id, words: list) -> list:
    """Every tenth document (by a hash of its id) becomes periodic from some word on; one without
    an id stays as it is."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


@register("op13_periodic_runs", OP13_SQL)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents and the texts without their repeats."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = periods.detect(docs, edit=repeat_tail)
    best = F.array_sort(F.transform("runs", lambda r: F.struct((-r.length).alias("down"), r.start, r.length, r.period)))[0]
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))))
    out = out.withColumn("best", F.when(F.size("runs") > 0, best))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

"""The registered queries: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from . import chat, decontam, fingerprints, licenses, linededup, maxent, mixing, neardup, quality, toxicity
from .catalog import register
from .shared import read

OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size,
         (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\N') || '|' || coalesce(text, '')), 1, 13))::BIGINT::DOUBLE
          + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w,
              3.0::DOUBLE * source_size AS cap FROM s0),
s2 AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS full_,
              sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wrest,
              sum(source_size) OVER () AS total FROM s1),
s3 AS (SELECT *, (total - full_) / wrest AS lvl, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS place FROM s2),
s4 AS (SELECT *, (SELECT arg_min(lvl, place) FROM s3 WHERE lvl * w <= cap) AS level FROM s3),
s5 AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS r FROM s5),
j AS (SELECT d.*, s6.source_size, s6.target, floor(r) AS whole, r - floor(r) AS p,
             target - floor(r) * s6.source_size AS need
      FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source),
k AS (SELECT *, CASE WHEN p > 0 THEN 1.0 - 1.0 / (1.0 + (u / (1.0 - u)) / (p / (1.0 - p))) ELSE 1.0 END AS v FROM j),
o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY least(floor(v * 4096), 4095), v, doc_id, size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before_ FROM k)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN p > 0 AND before_ + size / 2.0 <= need THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""


@register("op4_mix_sources", OP4_SQL)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pareto order sampling of all documents to weights 1, 2, 3 by source."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *,
        regexp_replace(replace(text, '\', '\\'), '(<)(\||/?s>|/?<SYS>>|</SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g') AS etext,
        regexp_replace(replace(role, '\', '\\'), '(<)(\||/?s>|/?<SYS>>|</SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g') AS erole0
      FROM c),
f AS (SELECT *, replace(erole0, chr(10), '\' || chr(10)) AS erole FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(length(erole) + length(etext) + 24) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""


@register("op10_chat_formatting", OP10_SQL)
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations (rows by turn; each turn answers the one before) and conversation -7,
    as reply trees of one branch, formatted and read back."""
    conv = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    order = W.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    msgs = (conv.unionByName(extra).withColumn("node", F.row_number().over(order).cast("long"))
                .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)))
    out = chat.format_trees(msgs, tree="conv_id")
    turns = chat.read_back(F.col("formatted"))
    digest = F.sha2(F.concat_ws("", F.transform(turns, lambda t: F.concat(
        t.role, F.lit("\n"), t.text, F.lit("\n")))).cast("binary"), 256)
    loss = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    return out.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), digest.alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS ws
  FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM g),
u AS (SELECT doc_id, unnest(s) AS x FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * i >= 75 * (na.n_shingles + nb.n_shingles - i)),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a)
SELECT n.doc_id, n.n_shingles, m.c AS component_id, n.doc_id = m.c AS kept
FROM n JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON m.x = n.doc_id
"""


@register("op9_near_duplicates", OP9_SQL)
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (five-word shingles, similarity 0.75)."""
    return neardup.link(read(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that copy a benchmark item, exactly or edited."""
    return decontam.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL),
c AS (SELECT *, CAST(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS BIGINT) AS w FROM l),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM c WHERE w > 0),
p AS (SELECT a.doc_id, a.i, a.k, a.w, b.doc_id AS d0, a.k - b.k AS off FROM k a JOIN k b
      ON a.line = b.line AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.k < a.k))),
g AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, d0, off ORDER BY k) AS island FROM p),
r AS (SELECT *, sum(w) OVER (PARTITION BY doc_id, d0, off, island) AS words FROM g),
hit AS (SELECT DISTINCT doc_id, i FROM r WHERE words >= 50),
f AS (SELECT c.*, CASE WHEN c.w > 0 THEN hit.i IS NOT NULL END AS covered FROM c LEFT JOIN hit ON hit.doc_id = c.doc_id AND hit.i = c.i),
z AS (SELECT *, coalesce(last_value(covered IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS gone FROM f),
t AS (SELECT doc_id, count(*) AS lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS removed_lines,
             CAST(sum(CASE WHEN gone THEN w ELSE 0 END) AS BIGINT) AS removed_words,
             coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY i), '') AS text FROM z GROUP BY doc_id)
SELECT d.doc_id, t.text, coalesce(t.lines, 0) AS lines, coalesce(t.removed_lines, 0) AS removed_lines,
       coalesce(t.removed_words, 0) AS removed_words FROM documents d LEFT JOIN t USING (doc_id)
"""


@register("op2_line_dedup", OP2_SQL)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later repeats of runs of 50 words or more."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup(docs).select("doc_id", "text", "lines", "removed_lines", "removed_words")


@register("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of all documents and whether to keep each."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.score(docs, read(spark, sf_dir, "labels")).drop("text")


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out fold."""
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprint(read(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses that all documents carry."""
    return licenses.scan(read(spark, sf_dir, "documents"))


@register("op5_lm_scores")
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under the maximum-entropy model and the base."""
    return maxent.score(read(spark, sf_dir, "documents").select("doc_id", "text"))

"""A corpus pipeline of training-data operators over ``documents``.

quality classifier -> line dedup -> MinHash near-dedup -> benchmark decontamination ->
mixing sources to target weights.  Each stage takes (spark, docs, sf_dir) and returns a
DataFrame; between stages the rows are written as Parquet in the shared scratch folder, so a
lost executor re-reads the last stage instead of recomputing the earlier ones.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unifeed.llm import decontam, linededup, mixing, neardup, quality
from unifeed.llm.shared import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score(docs, labels).where("keep").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of 50 words or more are cut from the texts (``n_chars`` follows).
    A document of which nothing but white space is left by the cut goes: all it said stands
    elsewhere.  Documents without cuts stay as they are."""
    out = linededup.dedup(docs)
    cut = F.col("removed_lines") > 0
    return (out.where(~cut | (F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) != ""))
               .withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
               .select(*COLUMNS))


def _row_key() -> Column:
    """What tells rows apart whose ids are null or repeated: id and text hash."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the least id (null last),
    then least text hash; of rows equal in id and text, one.  Documents without words are no
    duplicates and all stay."""
    keyed = docs.withColumn("row_key", _row_key())
    links = table(neardup.link(keyed, id_col="row_key"))
    gone = links.where(~F.col("kept")).select(F.col("doc_id").alias("gone_key")).distinct()
    stay = keyed.join(gone, F.col("row_key").eqNullSafe(F.col("gone_key")), "left_anti")
    repeated = table(links.where("kept and n_shingles > 0").groupBy(F.col("doc_id").alias("again_key"))
                          .count().where("count > 1").select("again_key"))
    if repeated.isEmpty():
        return stay.select(*COLUMNS)
    on = F.col("row_key").eqNullSafe(F.col("again_key"))
    once = stay.join(repeated, on, "left_semi").dropDuplicates(["row_key"])
    return stay.join(repeated, on, "left_anti").unionByName(once).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that copies a benchmark item go; other rows that share their id,
    or also have none, stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.withColumn("row_key", _row_key())
    hit = decontam.find(keyed, items, id_col="row_key").select(F.col("doc_id").alias("hit_key")).distinct()
    return keyed.join(hit, F.col("row_key").eqNullSafe(F.col("hit_key")), "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents taken at least once with ``copies`` and the words taken."""
    return mixing.mix(docs).where("copies > 0")


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", dedup_lines),
    ("near-dedup", dedup_near),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: Alignment and model stages are beyond SQL; tests/llm compares each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

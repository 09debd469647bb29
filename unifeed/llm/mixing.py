"""Operator 4: mix sources to target weights by Pareto order sampling.

Every source gets a target number of words.  Expected copies of each of its rows are
``target / source_size`` (or go by a weight of the row): the whole part is granted as certain
copies, the fraction ``p`` is sampled.  Pareto order sampling ranks the rows of a source by
``odds(u) / odds(p)`` (``u`` a hash of the row, so reruns agree) and takes the smallest
ranks until the source's remaining words are reached -- a sample of fixed size in words.

The cut is found without sorting a source in one task: ranks are mapped to (0, 1) and
counted in ``bins`` equal bins per source (partial sums, at most sources x bins rows),
prefix sums name the bin holding the cut, and only the rows of that bin are ordered.
A source with a third of all rows therefore never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .shared import WORD, table, text_or_empty

BINS = 4096


def uniform(*cols: Column) -> Column:
    """A reproducible uniform number in (0, 1) from the text of ``cols`` (52 bits of MD5)."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double")
            + F.lit(0.5)) / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, source: str, size: str, weights: tuple[int, ...],
                   max_copies: int) -> DataFrame:
    """(source, source_size, target): weights are dealt to the sources in code point order
    (null last), targets share the words of all rows and stop at ``max_copies`` times the
    source's size; what is cut off is shared out again by weight until none is above.

    The fixed point is a water level: sources with the smallest ``cap / weight`` are full,
    the others get ``level * weight``.  Windows here run over one row per source."""
    per = sizes.groupBy(source).agg(F.sum(size).alias("source_size"))
    order = W.orderBy(F.col(source).asc_nulls_last())
    wts = F.array(*[F.lit(float(x)) for x in weights])
    per = (per.withColumn("w", F.element_at(wts, (F.row_number().over(order) - 1) % len(weights) + 1))
              .withColumn("cap", F.lit(float(max_copies)) * F.col("source_size")))
    ratio = [(F.col("cap") / F.col("w")), F.col(source).asc_nulls_last()]
    before = W.orderBy(*ratio).rowsBetween(W.unboundedPreceding, -1)
    onward = W.orderBy(*ratio).rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = (per.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("level", (F.sum("source_size").over(everything) - F.col("full"))
                          / F.sum("w").over(onward)))
    # the first source (by cap/weight; ties in order) whose share stays below its cap sets it
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(
        F.row_number().over(W.orderBy(*ratio)).alias("place"), F.col("level").alias("level")))
    per = per.withColumn("fits", fits)
    per = per.withColumn("fit", F.min("fits").over(everything))
    return per.select(source, "source_size", F.when(
        F.col("fit").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("fit.level") * F.col("w"))).alias("target"))


def _levels(light: DataFrame, per: DataFrame, src: str, size: str, weight: str, max_copies: int) -> DataFrame:
    """(source, source_size, target, level): rows of a source expect ``level * weight`` copies, at
    most ``max_copies``, so that their words add up to the target.  With equal weights this is
    target / source_size; else rows above the limit are set to it and the others share what
    is left, until no further row is above (each pass is one grouped sum)."""
    cell = F.col(weight) * F.col(size)
    sums = light.groupBy(src, weight).agg(F.sum(size).alias("words"), F.sum(cell).alias("mass"))
    sums = table(sums.withColumnRenamed(src, "__mix_k"))
    per = per.withColumn("level", F.lit(0.0))
    while True:
        on = F.col(src).eqNullSafe(F.col("__mix_k"))
        full = F.col("level") * F.col(weight) >= F.lit(float(max_copies))
        got = per.join(sums, on, "left").groupBy(src, "source_size", "target", F.col("level").alias("old")).agg(
            F.sum(F.when(full, F.col("words")).otherwise(0)).alias("full"),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("mass"))).alias("open"))
        level = F.coalesce((F.col("target") - F.lit(float(max_copies)) * F.col("full"))
                           / F.nullif(F.col("open"), F.lit(0.0)), F.col("old"))
        new = table(got.withColumn("level", F.greatest(level, F.col("old"))))
        per = new.select(src, "source_size", "target", "level")
        above = per.join(sums, on).where((F.col("level") * F.col(weight) > F.lit(float(max_copies))))
        before = new.where(F.col("level") > F.col("old"))
        if before.isEmpty() or above.isEmpty():
            return per


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3),
        max_copies: int = 3, bins: int = BINS, weight_col: str | None = None) -> DataFrame:
    """``docs`` plus ``size, source_size, target, copies, taken``.

    ``size``: words of the text (null text: 0); ``copies``: how often the mix repeats the
    row (0 .. ``max_copies``); ``taken = copies * size``.  ``weight_col`` makes inclusion unequal
    within a source: expected copies go by its value (null or negative: 0), a row stops at
    ``max_copies`` and the others share the rest; if all rows with a weight are at the limit
    the source falls short of its target.  Null sources form one source, last in order; null
    ids and texts take part.  Rows equal in id and text have the same rank; where the cut
    falls among them as many as needed are taken (they are interchangeable).  A source
    without words has target 0 and takes nothing.  An empty table gives an empty result.
    Columns of ``docs`` named like a result column are replaced; all others are kept."""
    out = ("size", "source_size", "target", "copies", "taken")
    base = docs.drop(*out)
    m = {k: f"__mix_{k}" for k in ("u", "src", "size", "w", "whole", "p", "v", "bin", "cut", "need", "run")}
    w = F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight_col else F.lit(1.0)
    rows = (base.withColumn(m["src"], F.col(source_col))
                .withColumn(m["size"], F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"))
                .withColumn(m["u"], uniform(F.col(id_col), text_or_empty(text_col))).withColumn(m["w"], w))
    light = table(rows.select(m["src"], m["size"], m["u"], m["w"]))
    per = table(source_targets(light, m["src"], m["size"], weights, max_copies))
    if weight_col:
        per = _levels(light, per, m["src"], m["size"], m["w"], max_copies)
    else:
        per = per.withColumn("level", F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0)))

    def ranked(df: DataFrame, src: DataFrame) -> DataFrame:
        j = df.join(src.withColumnRenamed(m["src"], "__mix_s"),
                    F.col(m["src"]).eqNullSafe(F.col("__mix_s"))).drop("__mix_s")
        expected = F.least(F.lit(float(max_copies)), F.col("level") * F.col(m["w"]))
        j = j.withColumn(m["whole"], F.floor(expected)).withColumn(m["p"], expected - F.floor(expected))
        odds, u = F.col(m["p"]) / (F.lit(1.0) - F.col(m["p"])), F.col(m["u"])
        q = (u / (F.lit(1.0) - u)) / odds
        v = F.when(F.col(m["p"]) > 0, F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + q)).otherwise(F.lit(1.0))
        return (j.withColumn(m["v"], v)
                 .withColumn(m["bin"], F.least(F.floor(F.col(m["v"]) * bins), F.lit(bins - 1))))

    # words by rank bin; those of certain copies come off the target, rows without a fraction
    # are not drawn.  Read once, so not written: that made a small file of every shuffle partition
    hist = ranked(light, per).groupBy(m["src"], m["bin"]).agg(
        F.sum(F.when(F.col(m["p"]) > 0, F.col(m["size"])).otherwise(0)).alias("words"),
        F.sum(F.col(m["whole"]) * F.col(m["size"])).alias("certain"), F.max("target").alias("target"))
    each = W.partitionBy(m["src"])
    cuts = (hist.withColumn(m["need"], F.col("target") - F.sum("certain").over(each))
                .withColumn("cum", F.sum("words").over(each.orderBy(m["bin"])))
                .withColumn("last", F.max(m["bin"]).over(each))
                .where((F.col("cum") >= F.col(m["need"])) | (F.col(m["bin"]) == F.col("last")))
                .groupBy(m["src"], m["need"]).agg(
                    F.min(F.struct(m["bin"], (F.col("cum") - F.col("words")).alias("run"))).alias("c"))
                .select(F.col(m["src"]).alias("__mix_cs"), m["need"], F.col(f"c.{m['bin']}").alias(m["cut"]),
                        F.col("c.run").alias(m["run"])))
    per = table(per.join(cuts, F.col(m["src"]).eqNullSafe(F.col("__mix_cs")), "left").drop("__mix_cs"))

    all_rows = ranked(rows, per)
    drawn, at_cut = F.col(m["p"]) > 0, F.col(m["bin"]) == F.col(m["cut"])
    order = W.partitionBy(m["src"]).orderBy(m["v"], F.col(id_col), m["size"])
    # words of the cut bin before this row, added to those of the earlier bins
    inside = all_rows.where(drawn & at_cut).withColumn(
        "__mix_before", F.col(m["run"]) + F.sum(m["size"]).over(
            order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col(m["size"]))
    extra_in = (F.col("__mix_before") + F.col(m["size"]) / 2.0 <= F.col(m["need"])).cast("int")
    outside = all_rows.where(~(drawn & at_cut)).withColumn("__mix_before", F.lit(None).cast("long"))
    extra_out = (drawn & (F.col(m["bin"]) < F.col(m["cut"]))).cast("int")

    def finish(df: DataFrame, extra: Column) -> DataFrame:
        n = (F.col(m["whole"]) + extra).cast("int")
        return df.select(*base.columns, F.col(m["size"]).alias("size"), "source_size", "target",
                         n.alias("copies"), (n * F.col(m["size"])).cast("long").alias("taken"))
    return finish(outside, extra_out).unionByName(finish(inside, extra_in))

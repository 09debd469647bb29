"""Operator 2 [native]: line dedup by winnowing over line hashes.

Lines are hashed (twice, 64 bits each).  A window is the shortest stretch of lines from a line
on that reaches ``min_words`` words; the place of its least line hash is selected, and that
hash is the fingerprint of the place.  Any run of at least ``min_words`` words that occurs
twice contains the same windows, hence selects the same places (the guarantee of winnowing).

1. Selected places are joined on their fingerprint; windows whose selected place has a
   fingerprint of its own are done.
2. Around a joined place the match is extended to the right: its window and those of the
   following lines are compared by content (128 bits) with the first place of that content.
3. From the windows that match, it is extended to the left by mirrored windows, the shortest
   stretch that ends at a line: a mirrored window holds the window that begins at its first
   line, so only those are looked at whose first line begins a match.

A line belongs to a repeated run of ``min_words`` words or more exactly if such a window covers
it: up to the end of the run's first window it is covered by that one, beyond it by the mirrored
window that ends at the line.  So extension needs no pairs of places, and a passage that a third
of all documents share costs one row per place.  Places that share a fingerprint or a content are
split by their document over ``SPLITS`` groups, each reduced to its first and last place before
these meet, so no key gathers its places in one task.

The first place (by id, text hash, line) stays; all later repeats are deleted.
Blank lines count no words and go with the line before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .shared import WORD, table

MIN_WORDS = 50
SPLITS = 64              # groups that the places of one fingerprint or content are dealt to


def _repeated(rows: DataFrame, keys: list[str], place: Column) -> DataFrame:
    """The rows whose key stands at more than one place, with the key's ``first`` place."""
    split = rows.withColumn("split", F.pmod(F.xxhash64("k", "h"), F.lit(SPLITS)).cast("int"))
    ends = split.groupBy(*keys, "split").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    of_key = W.partitionBy(*keys)                            # SPLITS rows at most
    ends = (ends.select(*keys, "split", F.min("lo").over(of_key).alias("first"), F.max("hi").over(of_key).alias("last"))
                .where(F.col("first") != F.col("last")).drop("last"))
    return split.join(ends, [*keys, "split"]).drop("split")


def _windows(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> tuple[DataFrame, DataFrame]:
    """(all lines, lines with words and their windows) as written tables."""
    parts = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("k"), F.xxhash64(text_col).alias("h"),
                        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("i", "line"))
    lines = parts.select("id", "k", "h", "i", F.xxhash64("line").alias("lh"), F.xxhash64(F.lit(1), "line").alias("lh2"),
                         F.regexp_count("line", F.lit(WORD)).cast("long").alias("w"))
    doc = W.partitionBy("k", "h")
    # equal rows give equal lines: one set of them is enough
    lines = table(lines.repartition("k", "h").dropDuplicates(["k", "h", "i"]))
    full = lines.where("w > 0").withColumn("upto", F.sum("w").over(doc.orderBy("i")))
    full = full.withColumn("before", F.col("upto") - F.col("w"))
    ahead = doc.orderBy("before").rangeBetween(0, min_words - 1)
    back = doc.orderBy("upto").rangeBetween(-(min_words - 1), 0)

    def content(column: str, over, seed: int) -> Column:
        return F.when(F.sum("w").over(over) >= min_words, F.xxhash64(F.lit(seed), F.collect_list(column).over(over)))

    full = full.select(
        "id", "k", "h", "i",
        F.min(F.struct("lh", "i")).over(ahead).alias("least"),         # the selected place
        content("lh", ahead, 0).alias("next"), content("lh2", ahead, 1).alias("next2"),
        F.max("i").over(ahead).alias("next_end"),
        content("lh", back, 0).alias("prev"), content("lh2", back, 1).alias("prev2"),
        F.min("i").over(back).alias("prev_start"))
    return lines, table(full.select("*", F.col("least.lh").alias("mark"), F.col("least.i").alias("at")).drop("least"))


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(k, h, i, w, repeated) for every line i of every distinct (id, text); k and h hash the id
    (null too) and the text, so plain equality joins and one partitioning serve throughout."""
    lines, full = _windows(docs, id_col, text_col, min_words)
    place = F.struct(F.col("id").isNull().alias("last"), "id", "h", "i")
    marked = _repeated(full.where(F.col("next").isNotNull()).select("id", "k", "h", "i", "next", "next2", "next_end", "mark", "at"),
                       ["mark"], F.struct("k", "h", "at"))
    right = table(_repeated(marked.drop("mark", "at", "first"), ["next", "next2"], place).select(
        "k", "h", "i", "next_end", (F.col("first") != place).alias("later")))
    begins = right.select("k", "h", F.col("i").alias("prev_start"))
    mirrored = (full.where(F.col("prev").isNotNull()).select("id", "k", "h", "i", "prev", "prev2", "prev_start")
                    .join(begins, ["k", "h", "prev_start"], "left_semi"))
    left = _repeated(mirrored, ["prev", "prev2"], place).where(F.col("first") != place)
    to = right.where("later").select("k", "h", "i", F.col("next_end").alias("to"), F.lit(None).cast("int").alias("from"))
    back_to = left.select("k", "h", "i", F.lit(None).cast("int").alias("to"), F.col("prev_start").alias("from"))
    hit = to.unionByName(back_to).groupBy("k", "h", "i").agg(F.max("to").alias("to"), F.min("from").alias("from"))
    found = lines.select("k", "h", "i", "w").join(hit, ["k", "h", "i"], "left")
    run = W.partitionBy("k", "h").orderBy("i")
    covered = (F.coalesce(F.max("to").over(run.rowsBetween(W.unboundedPreceding, 0)) >= F.col("i"), F.lit(False))
               | F.coalesce(F.min("from").over(run.rowsBetween(0, W.unboundedFollowing)) <= F.col("i"), F.lit(False)))
    flagged = found.withColumn("covered", F.when(F.col("w") > 0, covered))
    return flagged.select("k", "h", "i", "w", F.coalesce(
        F.last("covered", ignorenulls=True).over(run.rowsBetween(W.unboundedPreceding, 0)),
        F.lit(False)).alias("repeated"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs deleted from the text, plus ``lines, removed_lines,
    removed_words`` (columns of these names are replaced; all others stay).

    Null texts stay null with 0 lines, an empty text is one blank line.  Rows equal in id
    and text: the first stays, the others lose every line if the text has ``min_words``
    words.  Null ids come last in order.  A text that is one repeated run becomes empty; the
    row stays.  An empty table gives an empty result."""
    out = ("lines", "removed_lines", "removed_words")
    base = docs.drop(*out)
    flagged = repeated_lines(base, id_col, text_col, min_words)
    per = flagged.groupBy("k", "h").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("w").alias("words"),
        F.sum(F.col("repeated").cast("int")).alias("gone"),
        F.sum(F.when(F.col("repeated"), F.col("w")).otherwise(0)).alias("gone_words"),
        F.array_sort(F.collect_list(F.when(~F.col("repeated"), F.col("i")))).alias("stay"))
    per = per.select(F.col("k").alias("__ld_k"), F.col("h").alias("__ld_h"), F.struct(
        "lines", "words", "gone", "gone_words",
        F.when(F.col("gone") > 0, F.col("stay")).alias("stay")).alias("__ld"))
    same = W.partitionBy("__ld_k", "__ld_h").orderBy(F.lit(0))
    rows = base.withColumn("__ld_k", F.xxhash64(id_col)).withColumn("__ld_h", F.xxhash64(text_col))
    rows = rows.withColumn("__ld_copy", F.row_number().over(same)).join(per, ["__ld_k", "__ld_h"], "left")
    again = (F.col("__ld_copy") > 1) & (F.col("__ld.words") >= min_words)
    # the split text is bound once (a lambda's free expressions run for every element)
    kept = F.transform(F.array(F.split(F.col(text_col), "\n", -1)), lambda parts: F.array_join(
        F.transform("__ld.stay", lambda i: F.get(parts, i)), "\n"))[0]
    text = (F.when(again, F.lit("")).when(F.col("__ld.stay").isNotNull(), kept).otherwise(F.col(text_col)))
    others = [text.alias(c) if c == text_col else F.col(c) for c in base.columns]
    n = lambda c: F.coalesce(F.col(f"__ld.{c}"), F.lit(0)).cast("long")
    is_text = F.col(text_col).isNotNull()
    return rows.select(
        *others, F.when(is_text, n("lines")).otherwise(0).cast("long").alias("lines"),
        F.when(again, n("lines")).when(is_text, n("gone")).otherwise(0).cast("long").alias("removed_lines"),
        F.when(again, n("words")).when(is_text, n("gone_words")).otherwise(0).cast("long").alias("removed_words"))

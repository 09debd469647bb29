"""Reconciliation of dispatch rows against the manual log (JOI2, STR3-STR6,
OUT1, WIN2, AGG11).

For every dispatch row the reference scans the same-date log rows and
classifies: PRESENT (first row whose location matches), SPLIT_SUGGESTED
(first *combined* row with a partial match), CONFLICT (same-date rows exist,
none match) or MISSING (no same-date row).

A plain "join on date, test every pair" emits all pairs of a busy date and
degrades quadratically when one date holds a large share of the rows.  Here
every match condition is decomposed into *exact* equi-join signals whose log
side is pre-aggregated to ``min(row_idx)`` per key, so no step materialises
the pairs of a date:

* equal keys              -> join on (date, key)
* one key inside another  -> suffixes of the longer key blocked on their first
                             six characters, checked with ``startswith``
                             (keys under six characters: exact join on short
                             substrings) -- O(L) rows per key, not O(L^2)
* token Jaccard >= 0.5    -> prefix filtering on distinct token sets ordered by
                             global token frequency (any two sets with
                             Jaccard >= t share a token in their prefixes)
* shared token (partial)  -> join on (date, token)

Each signal yields ``min(row_idx)`` per dispatch row; the first match is the
minimum over signals, exactly the reference's first-by-row-order rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..functions import durations, places
from ..functions.people import officer_initial_form
from ..session import scratch_table

PRESENT, SPLIT, CONFLICT, MISSING = "PRESENT", "SPLIT_SUGGESTED", "CONFLICT", "MISSING"
CLASSES = (PRESENT, SPLIT, CONFLICT, MISSING)


def _prefix_len(size: Column) -> Column:
    # |x| - ceil(0.5 * |x|) + 1 tokens: a pair with Jaccard >= 0.5 shares one of them
    return size - F.ceil(size * F.lit(places.JACCARD_MIN)).cast("int") + 1


def _min_hit(left: DataFrame, right: DataFrame, on: list, name: str) -> DataFrame:
    """``cad_id -> min(row_idx)`` over an equi-join of dispatch signals and log signals."""
    return left.join(right, on, "inner").groupBy("cad_id").agg(F.min("row_idx").alias(name))


def _jaccard_hits(cad: DataFrame, log: DataFrame, name: str) -> DataFrame:
    """``cad_id -> min(row_idx)`` of same-date log rows with token Jaccard >= 0.5."""
    cset = cad.where(F.size("ctok") > 0).select("cad_id", "date", F.col("ctok").alias("toks"))
    lset = (log.where(F.size("ltok") > 0).groupBy("date", F.col("ltok").alias("toks"))
            .agg(F.min("row_idx").alias("row_idx")))
    cdist = cset.select("date", "toks").distinct()
    # global token frequency fixes one order for every set (rare tokens first)
    vocab = (cdist.select(F.explode("toks").alias("tok"))
             .unionByName(lset.select(F.explode("toks").alias("tok")))
             .groupBy("tok").agg(F.count(F.lit(1)).alias("freq")))

    def prefixed(df, extra):
        ex = df.select("date", "toks", *extra, F.explode("toks").alias("tok")).join(vocab, "tok")
        w = Window.partitionBy("date", "toks", *extra).orderBy("freq", "tok")
        r = ex.withColumn("pos", F.row_number().over(w))
        return r.where(F.col("pos") <= _prefix_len(F.size("toks"))).select("date", "toks", "tok", *extra)

    cp = prefixed(cdist, [])
    lp = prefixed(lset, ["row_idx"]).withColumnRenamed("toks", "ltoks")
    n, m = F.size("toks"), F.size("ltoks")            # sizes bound the similarity
    cand = (cp.join(lp, ["date", "tok"]).where(F.least(n, m) >= places.JACCARD_MIN * F.greatest(n, m))
              .select("date", "toks", "ltoks", "row_idx").distinct())
    inter = F.size(F.array_intersect("toks", "ltoks"))
    union = F.size(F.array_union("toks", "ltoks"))
    ok = cand.where(inter / union >= places.JACCARD_MIN) \
        .groupBy("date", "toks").agg(F.min("row_idx").alias(name))
    return cset.join(ok, ["date", "toks"]).select("cad_id", name)


PREFIX_LEN = 6  # q of the q-character prefix used to block containment tests


def suffixes(key: Column, min_len: int = 1) -> Column:
    """Every suffix of ``key`` with at least ``min_len`` characters (L per key)."""
    n = F.length(key)
    return F.when(n >= min_len, F.transform(F.sequence(F.lit(1), n - min_len + 1),
                                            lambda i: F.substring(key, i, n - i + 1))) \
        .otherwise(F.array().cast("array<string>"))


def short_substrings(key: Column, max_len: int = PREFIX_LEN - 1) -> Column:
    """Distinct substrings of ``key`` shorter than the blocking prefix (<= (q-1)L per key)."""
    n = F.length(key)

    def of_length(ln: int):
        # one-argument lambda: ``transform`` reads a second parameter as the index
        return lambda i: F.substring(key, i, ln)

    parts = [F.when(n >= ln, F.transform(F.sequence(F.lit(1), n - ln + 1), of_length(ln)))
             .otherwise(F.array().cast("array<string>")) for ln in range(1, max_len + 1)]
    return F.array_distinct(F.flatten(F.array(*parts)))


BLOCK_MAX = 1000         # keys of one block that are still tested with ``startswith``


def _contained(x: DataFrame, y_values: DataFrame, x_col: str, y_col: str, keep: list[str], block_max: int = BLOCK_MAX) -> DataFrame:
    """Rows of ``x`` joined to rows of ``y_values`` whose text contains ``x[x_col]``
    on the same date -- exact, with O(L) expansion per key:

    * keys shorter than the prefix: equi-join against ``y``'s short substrings;
    * longer keys: equi-join on (date, first ``PREFIX_LEN`` characters) against
      ``y``'s suffixes, then ``startswith(suffix, key)``;
    * keys of a block that holds more than ``block_max`` of them (a date whose places begin alike,
      counted from the data): the suffixes of the block are cut to each length its keys have and
      joined on the whole key, so only true matches come out, however many keys share a beginning.
    """
    short = x.where(F.length(x_col) < PREFIX_LEN)
    long_ = x.where(F.length(x_col) >= PREFIX_LEN).withColumn("_pre", F.substring(x_col, 1, PREFIX_LEN))
    ys = y_values.select("date", F.explode(short_substrings(F.col(y_col))).alias(x_col), *keep)
    ysuf = y_values.select("date", F.explode(suffixes(F.col(y_col), PREFIX_LEN)).alias("_suf"), *keep) \
        .withColumn("_pre", F.substring("_suf", 1, PREFIX_LEN))
    a = short.join(ys, ["date", x_col])
    blocks = long_.groupBy("date", "_pre").agg(F.count(F.lit(1)).alias("_n"), F.collect_set(F.length(x_col)).alias("_lens"))
    large = blocks.where(F.col("_n") > block_max).select("date", "_pre", "_lens")
    # the block's size goes with its keys, so every key takes exactly one of the two ways
    b = (long_.join(blocks.where(F.col("_n") <= block_max).select("date", "_pre"), ["date", "_pre"], "left_semi")
         .join(ysuf, ["date", "_pre"]).where(F.col("_suf").startswith(F.col(x_col))).drop("_pre", "_suf"))
    fits = F.filter("_lens", lambda n: n <= F.length("_suf"))
    cut = F.transform(fits, lambda n: F.substring(F.col("_suf"), F.lit(1), n))
    whole = ysuf.join(large, ["date", "_pre"]).select("date", F.explode(cut).alias(x_col), *keep).distinct()
    c = long_.drop("_pre").join(whole, ["date", x_col])
    return a.unionByName(b).unionByName(c)


def _containment_hits(cad: DataFrame, keyed_log: DataFrame, name: str) -> list[DataFrame]:
    """Equal keys, log key inside CAD key, CAD key inside log key (STR4 first half).

    The log side is always reduced to ``min(row_idx)`` per distinct (date, key)
    before it meets dispatch rows."""
    lk = keyed_log.where(F.col("lkey") != "").groupBy("date", "lkey").agg(F.min("row_idx").alias("row_idx"))
    c = cad.where(F.col("ckey") != "").select("cad_id", "date", "ckey")
    keys = c.select("date", "ckey").distinct()       # repeats of a key are matched once
    # log key is a substring of the CAD key (includes equality): x = log keys, y = CAD keys
    h1 = _contained(lk, keys, "lkey", "ckey", ["ckey"]).select("date", "ckey", "row_idx")
    # CAD key is a substring of the log key: x = CAD keys, y = distinct log keys
    h2 = _contained(keys, lk, "ckey", "lkey", ["row_idx"]).select("date", "ckey", "row_idx")
    hits = h1.unionByName(h2).groupBy("date", "ckey").agg(F.min("row_idx").alias(name))
    return [c.join(hits, ["date", "ckey"]).select("cad_id", name)]


def _least(frames: list[DataFrame], name: str) -> DataFrame:
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)
    return u.groupBy("cad_id").agg(F.min(name).alias(name))


def reconcile(cad: DataFrame, log: DataFrame, cad_id: str = "cad_id", cad_date: str = "date",
              cad_loc: str = "location", log_idx: str = "row_idx", log_date: str = "date",
              log_loc: str = "location") -> DataFrame:
    """JOI2: classify every dispatch row against same-date log rows.

    Returns the dispatch rows (all input columns) plus ``status``,
    ``matched_row`` (PRESENT / SPLIT), ``matched_loc`` and ``n_same_day``.
    Ids and log row indices must be unique; a NULL date is MISSING.  The keyed sides are written once to
    the shared scratch folder, so each input is read twice at most, whatever its size.
    """
    c = cad.select(F.col(cad_id).alias("cad_id"), F.col(cad_date).alias("date"),
                   places.location_key(F.col(cad_loc)).alias("ckey"),
                   places.location_tokens(F.col(cad_loc)).alias("ctok"))
    c = scratch_table(c.where(F.col("date").isNotNull()))           # keys and tokens once, for every signal
    lg = log.select(F.col(log_idx).alias("row_idx"), F.col(log_date).alias("date"),
                    F.col(log_loc).alias("lloc")).where(F.col("date").isNotNull())
    keyed = scratch_table(lg.select("row_idx", "date", "lloc", places.location_key("lloc").alias("lkey"),
                                    places.location_tokens("lloc").alias("ltok"),
                                    places.is_combined("lloc").alias("combined")))
    lg = keyed.select("row_idx", "date", "lloc")

    # ---- PRESENT: full location match, first row
    present = _least(_containment_hits(c, keyed, "present_row")
                     + [_jaccard_hits(c, keyed, "present_row")], "present_row")

    # ---- SPLIT: combined rows, a component matches or any token is shared
    comb = keyed.where("combined")
    parts = comb.select("row_idx", "date", F.explode(places.location_parts("lloc")).alias("part"))
    parts = parts.select("row_idx", "date", places.location_key("part").alias("lkey"))
    ctok = c.where(F.size("ctok") > 0)
    tok_log = (comb.select("date", F.explode("ltok").alias("tok"), "row_idx")
               .groupBy("date", "tok").agg(F.min("row_idx").alias("row_idx")))
    tok_hit = _min_hit(ctok.select("cad_id", "date", F.explode("ctok").alias("tok")), tok_log,
                       ["date", "tok"], "split_row")
    split = _least(_containment_hits(ctok, parts, "split_row") + [tok_hit], "split_row")

    # ---- same-day log rows (CONFLICT evidence): one row per date
    per_day = lg.groupBy("date").agg(F.count(F.lit(1)).alias("n_same_day"))
    days = c.select("cad_id", "date").join(per_day, "date").select("cad_id", "n_same_day")

    # ---- what was found of each dispatch row, one row per id; it meets the rows by id alone, so
    # rows without a date or a match share no key
    row_type = log.schema[log_idx].dataType
    signals = (("present_row", present, row_type), ("split_row", split, row_type), ("n_same_day", days, T.LongType()))
    found = None
    for name, frame, _ in signals:
        part = frame.select("cad_id", *[F.col(n).alias(n) if n == name else F.lit(None).cast(t).alias(n) for n, _, t in signals])
        found = part if found is None else found.unionByName(part)
    found = found.groupBy(F.col("cad_id").alias("_cid")).agg(*[F.max(n).alias(n) for n, _, _ in signals])
    found = found.withColumn("_row", F.coalesce("present_row", "split_row"))
    locs = lg.select(F.col("row_idx").alias("_row"), F.col("lloc").alias("matched_loc"))
    seen = found.where(F.col("_row").isNotNull()).join(locs, "_row").select(F.col("_cid").alias("_sid"), "matched_loc")
    j = cad.join(found, F.col(cad_id) == F.col("_cid"), "left").join(seen, F.col(cad_id) == F.col("_sid"), "left")
    n_day = F.coalesce(F.col("n_same_day"), F.lit(0)).cast("long")
    status = (F.when(F.col("present_row").isNotNull(), F.lit(PRESENT))
              .when(F.col("split_row").isNotNull(), F.lit(SPLIT))
              .when(n_day > 0, F.lit(CONFLICT)).otherwise(F.lit(MISSING)))
    return j.select(F.col("_row").alias("matched_row"), *[F.col(f"`{x}`") for x in cad.columns], status.alias("status"),
                    n_day.alias("n_same_day"), "matched_loc")


def conflict_candidates(result: DataFrame, log: DataFrame, date_col: str = "date",
                        log_idx: str = "row_idx", log_loc: str = "location") -> DataFrame:
    """The same-day log rows behind CONFLICT classifications, in long form
    ``(date, row_idx, location)`` -- one row per log row, never per pair."""
    days = result.where(F.col("status") == CONFLICT).select(F.col(date_col).alias("_d")).distinct()
    lg = log.select(F.col(date_col).alias("_d"), F.col(log_idx).alias("row_idx"),
                    F.col(log_loc).alias("location"))
    return lg.join(days, "_d", "left_semi").withColumnRenamed("_d", "date")


def class_counts(result: DataFrame) -> DataFrame:
    """AGG11: one row with the count of every class (zero-filled)."""
    s = F.col("status")
    return result.agg(*[F.count_if(s == k).alias(k.lower()) for k in CLASSES])


SEQUENCE_WIDTH = 4096   # consecutive integer keys of one bucket


def _order_bucket(df: DataFrame, name: str) -> Column:
    """A value that never decreases as the column grows: blocks of integers, days, prefixes of
    text.  It is a function of the row alone, so every use of it agrees."""
    dt, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(dt, T.IntegralType):
        return F.floor(c / F.lit(SEQUENCE_WIDTH))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("HOUR", c)
    if isinstance(dt, T.StringType):
        return F.substring(c, 1, 6)
    if isinstance(dt, T.DateType):
        return c
    return F.floor(c)


def group_sequence(df: DataFrame, group_cols: list[str], order_cols: list[str],
                   name: str = "seq") -> DataFrame:
    """WIN2 helper: 1-based sequence within each group under a total order,
    without sending a whole group to one task.

    Rows are numbered inside (group, bucket of the first order column); counts per bucket --
    a small table -- are summed up over the earlier buckets of the group and joined back.  The
    bucket is computed from the row, not from a partition, so both uses of it agree whatever
    the optimizer makes of the plan.  NULL groups and keys count as values (NULLs first)."""
    bucketed = df.withColumn("_bucket", _order_bucket(df, order_cols[0]))
    local = bucketed.withColumn("_local", F.row_number().over(
        Window.partitionBy(*group_cols, "_bucket").orderBy(*order_cols)))
    counts = bucketed.groupBy(*group_cols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(group_cols)], F.col("_bucket").alias("_gb"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group_cols)]
    out = local.join(offsets, [*on, F.col("_bucket").eqNullSafe(F.col("_gb"))])
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_off") + F.col("_local")).alias(name))


FREE_WIDTH = 64          # consecutive free numbers of one bucket


def taken_numbers(ids: DataFrame, id_col: str = "event_id") -> DataFrame:
    """(date, number): the distinct ids ``YYYYMMDD-NNN`` in use; other texts are no ids."""
    t = F.trim(F.col(id_col))
    fits = ids.where(t.rlike(r"^\d{8}-\d{3,9}$"))
    return fits.select(F.try_to_date(F.substring(t, 1, 8), "yyyyMMdd").alias("date"),
                       F.substring(t, 10, 9).cast("long").alias("number")) \
        .where(F.col("date").isNotNull() & (F.col("number") > 0)).distinct()


def free_numbers(seq: DataFrame, date_col: str, seq_col: str, taken: DataFrame, name: str) -> DataFrame:
    """WIN2 beside ids in use: the ``seq_col``-th number of the date (from 1) that is not taken.

    With the taken numbers t1 < t2 < ... of a date, t_j - j numbers are free below t_j, so the k-th
    free number is k + j for the last j with t_j - j < k: free numbers come in ranges that
    share a shift j.  Ranges are cut at buckets of ``FREE_WIDTH`` free numbers and meet the rows by
    (date, bucket), so a date with a third of all rows is spread over its buckets and a row meets
    ``FREE_WIDTH`` ranges at most.  Rows before the first taken number, and dates without any, keep
    their number."""
    last = seq.where(F.col(date_col).isNotNull()).groupBy(F.col(date_col).alias("_d")).agg(F.max(seq_col).alias("_max"))
    t = group_sequence(taken.select(F.col("date").alias("_d"), "number"), ["_d"], ["number"], "_j")
    # the last j of each count of free numbers below: the ones before it have empty ranges
    starts = t.groupBy("_d", (F.col("number") - F.col("_j")).alias("_lo")).agg(F.max("_j").alias("_shift"))
    numbered = group_sequence(starts, ["_d"], ["_lo"], "_i")
    nxt = numbered.select("_d", (F.col("_i") - 1).alias("_i"), F.col("_lo").alias("_hi"))
    ranges = (numbered.join(nxt, ["_d", "_i"], "left").join(last, "_d")
              .withColumn("_hi", F.least(F.coalesce("_hi", F.col("_max")), F.col("_max"))).where("_lo < _hi"))
    bucket = lambda c: F.floor((c - 1) / FREE_WIDTH)
    cells = ranges.select(F.col("_d"), "_lo", "_hi", "_shift",
                          F.explode(F.sequence(bucket(F.col("_lo") + 1), bucket(F.col("_hi")))).alias("_cell"))
    on = ((F.col(date_col) == F.col("_d")) & (bucket(F.col(seq_col)) == F.col("_cell"))
          & (F.col(seq_col) > F.col("_lo")) & (F.col(seq_col) <= F.col("_hi")))
    return seq.join(cells, on, "left").select(
        *[F.col(f"`{c}`") for c in seq.columns], (F.col(seq_col) + F.coalesce("_shift", F.lit(0))).alias(name))


def proposals(result: DataFrame, date_col: str = "date", call_seconds: str | None = "call_s",
              start_col: str = "start_time", case_col: str = "case_no", event_col: str = "event_name",
              loc_col: str = "location", officer_col: str = "attendee_names",
              id_col: str = "cad_id", taken: DataFrame | None = None) -> DataFrame:
    """OUT1: paste-ready log rows for MISSING and SPLIT_SUGGESTED dispatch rows.

    Start = time of call (else the out time); end = start + 30 min; 0.5 h; the
    event id is ``YYYYMMDD-NNN`` numbered within the date (the reference
    always writes ``-001``, which collides on a busy date).  ``taken``: a frame of the log's own ids
    (``event_id``); proposals get the free numbers of their date, the same ones in every run.
    """
    r = result.where(F.col("status").isin(MISSING, SPLIT))
    start_s = (F.coalesce(F.col(call_seconds), durations.clock_seconds(F.col(start_col)))
               if call_seconds else durations.clock_seconds(F.col(start_col)))
    r = r.withColumn("_start_s", start_s)
    seq = group_sequence(r, [date_col], [id_col], "_seq")
    if taken is not None:
        seq = free_numbers(seq, date_col, "_seq", taken_numbers(taken), "_free").drop("_seq").withColumnRenamed("_free", "_seq")
    reason = F.when(F.col("status") == MISSING, F.lit("MISSING -> new row")).otherwise(
        F.format_string("SPLIT row %s (%s) -> this half", F.col("matched_row").cast("string"),
                        F.col("matched_loc")))
    return seq.select(
        F.col(id_col),
        F.when(F.col(date_col).isNotNull(),
               F.format_string("%s-%03d", F.date_format(date_col, "yyyyMMdd"), F.col("_seq")))
        .otherwise(F.lit("")).alias("event_id"),
        F.col(date_col).alias("date"),
        F.coalesce(durations.hhmm(F.col("_start_s")), F.lit("")).alias("start_time"),
        F.coalesce(durations.hhmm(durations.add_minutes_of_day(F.col("_start_s"), 30)), F.lit(""))
        .alias("end_time"),
        F.lit(durations.IMPUTED_HOURS).alias("total_time"),
        F.col(case_col).alias("case_no"),
        F.col(event_col).alias("event_name"),
        F.col(loc_col).alias("location"),
        officer_initial_form(F.col(officer_col)).alias("attendees"),
        reason.alias("reason"))

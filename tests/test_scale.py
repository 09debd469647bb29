"""Plans and results that must hold at any size: hot blocks, scans per input, sketches, layout votes."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF01
from unifeed.operators import layouts, quality
from unifeed.operators import reconcile as R

DAY = dt.date(2026, 5, 1)


def test_large_blocks_give_the_same_matches(spark):
    rng = random.Random(7)
    begin = "sharedbeginn"
    words = [begin + "".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(150)] + ["other", "sharedx", "zzshared"]
    keys = sorted(set(words))
    texts = sorted({rng.choice(words) + rng.choice(["", "a", "center"]) for _ in range(200)} | {"pre" + w for w in words[:20]})
    x = spark.createDataFrame([(DAY, k) for k in keys] + [(None, begin)], "date date, k string")
    y = spark.createDataFrame([(DAY, t, i) for i, t in enumerate(texts)] + [(dt.date(2026, 5, 2), begin, 999)], "date date, t string, i int")
    want = sorted({(k, i) for k in keys for i, t in enumerate(texts) if k in t})
    for most in (0, 3, 10_000):
        out = R._contained(x, y, "k", "t", ["i"], block_max=most).select("k", "i").distinct().collect()
        assert sorted(map(tuple, out)) == want, most


def test_a_date_of_places_that_begin_alike_makes_no_pairs(spark):
    n = 20_000
    x = spark.range(n).select(F.lit(DAY).alias("date"), F.concat(F.lit("sharedbeginning"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"))
    y = x.select("date", F.col("k").alias("t"), F.xxhash64("k").alias("i"))
    out = R._contained(x, y, "k", "t", ["i"])
    assert out.count() == n                                # 4 * 10^8 pairs share the block


def test_inputs_are_read_twice_at_most(spark):
    from unifeed.plans.queries_match import recon_sides
    from unifeed.plans import queries_match
    plain = lambda s, d, t, **k: s.read.parquet(f"{d}/{t}.parquet")
    old, queries_match.table = queries_match.table, plain
    try:
        cad, log = recon_sides(spark, SF01)
        result = R.reconcile(cad, log)
        out = R.proposals(result)
    finally:
        queries_match.table = old
    for df in (result, out):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("part.parquet") <= 2
        assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan


def test_undated_rows_are_missing_and_keep_their_columns(spark):
    cad = spark.createDataFrame([(1, None, "Park", "x"), (2, DAY, "Park", "y"), (3, None, None, "z")], "cad_id long, date date, location string, note string")
    log = spark.createDataFrame([(7, DAY, "park"), (8, None, "park")], "row_idx long, date date, location string")
    out = {r.cad_id: (r.status, r.matched_row, r.n_same_day, r.note) for r in R.reconcile(cad, log).collect()}
    assert out == {1: ("MISSING", None, 0, "x"), 2: ("PRESENT", 7, 1, "y"), 3: ("MISSING", None, 0, "z")}


def test_sketch_is_one_pass_with_bounded_error(spark):
    df = spark.range(50_000).select((F.col("id") % 9973).alias("a"), (F.col("id") % 7).cast("string").alias("b"),
                                    F.when(F.col("id") % 10 < 7, "common").otherwise(F.col("id").cast("string")).alias("c"),
                                    F.lit(None).cast("string").alias("d"))
    sketch = quality.column_sketch(df)
    assert "Expand" not in sketch._jdf.queryExecution().executedPlan().toString()
    got = {r.column: r for r in sketch.collect()}
    assert abs(got["a"].distinct_estimate / 9973 - 1) < 3 * quality.DISTINCT_ERROR and got["b"].distinct_estimate == 7
    assert got["b"].numeric_text and not got["c"].numeric_text and got["c"].top_values[0] == "common"
    assert got["d"].non_null == 0 and got["d"].samples == [] and got["d"].top_values == []
    assert 1 <= len(got["a"].samples) <= quality.SAMPLES and all(0 <= int(v) < 9973 for v in got["a"].samples)
    again = {r.column: r.samples for r in quality.column_sketch(df.repartition(13)).collect()}
    assert again == {k: v.samples for k, v in got.items()}                  # the same in every run


def test_ambiguous_dates_follow_their_file(spark):
    rows = [("f1", "03/04/25"), ("f1", "25/12/2024"), ("f1", "2025-01-02"), ("f2", "03/04/2025"), ("f2", "12/25/24 10:00"),
            ("f3", "03/04/25"), ("f3", "05/05/25"), ("f4", "13/01/25"), ("f4", "01/13/25"), ("f4", "02/01/25"), (None, "31/01/2025"), (None, "01/02/2025"), ("f5", None)]
    df = spark.createDataFrame(rows, "file string, Date string")
    got = {(r.file, r.Date): r.parsed_date for r in layouts.parse_by_layout(df, ["file"], "Date").collect()}
    d = dt.date
    assert got == {("f1", "03/04/25"): d(2025, 4, 3), ("f1", "25/12/2024"): d(2024, 12, 25), ("f1", "2025-01-02"): d(2025, 1, 2),
                   ("f2", "03/04/2025"): d(2025, 3, 4), ("f2", "12/25/24 10:00"): d(2024, 12, 25), ("f3", "03/04/25"): None,
                   ("f3", "05/05/25"): d(2025, 5, 5), ("f4", "13/01/25"): d(2025, 1, 13), ("f4", "01/13/25"): d(2025, 1, 13),
                   ("f4", "02/01/25"): None, (None, "31/01/2025"): d(2025, 1, 31), (None, "01/02/2025"): d(2025, 2, 1), ("f5", None): None}
    votes = {r.file: (r.day_first, r.month_first, r.ambiguous, r.layout) for r in layouts.layout_votes(df, ["file"], ["Date"]).collect()}
    assert votes["f3"] == (0, 0, 1, "tied") and votes["f4"] == (1, 1, 1, "tied") and votes["f1"] == (1, 0, 1, "day first")

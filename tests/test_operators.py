"""Operator tests on small fixtures (FIXTURES.md §2-§3) and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from unifeed.functions.numbers import route_table
from unifeed.operators import quality, reconcile, report, reshape, standardize
from unifeed.operators.combine import gap_fill, remove_contamination, route_split


def test_contamination_filter(spark):
    rows = [("Arrests", "x"), ("arrests", "x"), ("X (monthly total)", "x"), ("BWC Review Q2", "x"),
            ("Outreach", " CSB "), ("Arrests ", "x"), ("Arrests made", "x"), (None, "x")]
    df = spark.createDataFrame(rows, "event_name string, office string")
    kept, removed = remove_contamination(df)
    assert sorted(r[0] or "" for r in removed.collect()) == sorted(
        ["Arrests", "arrests", "X (monthly total)", "BWC Review Q2", "Outreach"])
    assert kept.count() + removed.count() == df.count()


def test_gap_fill_blank_keys(spark):
    rec = spark.createDataFrame([(dt.date(2026, 5, 1), "M & M Center"), (None, None)],
                                "date date, location string")
    gap = spark.createDataFrame([(1, dt.date(2026, 5, 1), "MM center"), (2, dt.date(2026, 5, 2), "MM Center"),
                                 (3, None, "")], "id int, date date, location string")
    kept, dropped = gap_fill(rec, gap)
    assert sorted(r.id for r in kept.collect()) == [2]
    assert sorted(r.id for r in dropped.collect()) == [1, 3]
    kept2, dropped2 = gap_fill(rec, gap, blank_matches=False)
    assert sorted(r.id for r in kept2.collect()) == [2, 3]
    assert "LeftAnti" in kept._jdf.queryExecution().executedPlan().toString()


def _recon_fixture(spark):
    cad = spark.createDataFrame([
        (1, dt.date(2026, 5, 13), "Lincoln School", 17 * 3600 + 23 * 60, "C1", "Visit", "Lt. Anna Reyes 266"),
        (2, dt.date(2026, 5, 20), "M & M Center", 9 * 3600, "C2", "Visit", "Sgt. Bo Lane"),
        (3, dt.date(2026, 5, 28), "Jackson Avenue School", 10 * 3600 + 51 * 60, "C3", "Talk", "Det. Cy Moss 12"),
        (4, dt.date(2026, 5, 20), "Civic Center", 8 * 3600, "C4", "Walk", "Solo"),
        (5, None, "Anywhere", 8 * 3600, "C5", "Walk", "Solo"),
    ], "cad_id int, date date, location string, call_s int, case_no string, event_name string, "
       "attendee_names string")
    cad = cad.withColumn("start_time", F.lit(None).cast("string"))
    log = spark.createDataFrame([
        (5, dt.date(2026, 5, 20), "MM Center"), (6, dt.date(2026, 5, 20), "Main Library"),
        (9, dt.date(2026, 5, 20), "MM Centre"), (7, dt.date(2026, 5, 28), "Jackson and Fairmount"),
    ], "row_idx int, date date, location string")
    return cad, log


def test_reconcile_classes(spark):
    cad, log = _recon_fixture(spark)
    res = reconcile.reconcile(cad, log)
    got = {r.cad_id: (r.status, r.matched_row, r.n_same_day) for r in res.collect()}
    assert got == {1: ("MISSING", None, 0), 2: ("PRESENT", 5, 3), 3: ("SPLIT_SUGGESTED", 7, 1),
                   4: ("CONFLICT", None, 3), 5: ("MISSING", None, 0)}
    counts = reconcile.class_counts(res).first()
    assert (counts.present, counts.split_suggested, counts.conflict, counts.missing) == (1, 1, 1, 2)
    conf = reconcile.conflict_candidates(res, log).collect()
    assert sorted(r.row_idx for r in conf) == [5, 6, 9]
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_proposals(spark):
    cad, log = _recon_fixture(spark)
    res = reconcile.reconcile(cad, log)
    props = {r.cad_id: r for r in reconcile.proposals(res).collect()}
    assert sorted(props) == [1, 3, 5]
    assert (props[1].event_id, props[1].start_time, props[1].end_time, props[1].total_time) == \
        ("20260513-001", "17:23", "17:53", 0.5)
    assert (props[3].event_id, props[3].start_time, props[3].end_time) == ("20260528-001", "10:51", "11:21")
    assert props[1].attendees == "A. Reyes" and props[3].attendees == "C. Moss"
    assert props[3].reason == "SPLIT row 7 (Jackson and Fairmount) -> this half"
    assert props[5].event_id == ""


def test_group_sequence_busy_group(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), F.col("id"))
    seq = reconcile.group_sequence(df, ["g"], ["id"], "seq")
    bad = seq.groupBy("g").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("*").alias("n"),
                               F.count_distinct("seq").alias("d")).where("lo != 1 or hi != n or d != n")
    assert bad.count() == 0
    w = seq.where("g = 0 and id = 3").first()
    assert w.seq == 2


def test_group_sequence_returns_every_row_of_a_large_input(spark, tmp_path):
    df = spark.range(0, 400_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("busy")).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.col("id") * 7919 % 400_009).alias("k"), F.repeat(F.lit("payload "), 8).alias("payload"), "id")
    for key in ("k", "text_key"):
        out = str(tmp_path / key)
        src = df.withColumn("text_key", F.lpad(F.col("k").cast("string"), 9, "0"))
        reconcile.group_sequence(src, ["g"], [key], "seq").write.parquet(out)
        back = spark.read.parquet(out)
        assert back.count() == 400_000 and back.select("id").distinct().count() == 400_000
        bad = back.groupBy("g").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count("*").alias("n"),
                                    F.count_distinct("seq").alias("d")).where("lo != 1 or hi != n or d != n")
        assert bad.count() == 0


def test_quality_sample(spark):
    # the reference's synthetic quality sample (all cells as text)
    df = spark.createDataFrame([
        ("Meeting A", "2025-01-01", "2.0", "15", "Police", "STACP"),
        ("Event B", "2025-01-02", "1.5", "20", "Community", "Engagement"),
        ("Program C", "invalid_date", "-1.0", "1500", "Police", "Patrol"),
        ("", "2025-01-04", "25.0", "5", "Community", ""),
    ], "event_name string, date string, duration_hours string, attendee_count string, office string, "
       "division string")
    r = quality.quality_scores(df, as_of_year=2025).first()
    assert (r.completeness, r.consistency, r.accuracy, r.uniqueness, r.overall) == (100.0, 100.0, 72.7, 100.0, 93.2)
    assert r.label.startswith("Excellent")


def test_grid_unpivot_with_rejects(spark):
    grid = spark.createDataFrame([("26_02", "Walks", "3", None, "x", "5"), ("26_02", "  ", "1", "1", "1", "3")],
                                 "sheet string, activity string, `1` string, `2` string, `30` string, Total string")
    events, rejects = reshape.grid_to_events(grid, day_cols=("1", "2", "30"))
    ev = sorted((str(r.date), r.event_name, r.attendee_count) for r in events.collect())
    assert ev == [("2026-02-01", "Walks", 3), ("2026-02-01", "Walks (Monthly Total)", 5)]
    assert [(r.day_label, r.cell) for r in rejects.collect()] == [("30", "x")]


def test_routing_and_memorial_guard(spark):
    raw = spark.createDataFrame([
        ("24-1.0", "2026-05-01 10:00:00", "10:00:00", "10:01:00", "Visit", None, "251.0", "Elm St", "Sgt. A B 1", "STA"),
        ("24-2", "2026-05-01 11:00:00", "11:00:00", "12:30:00", "Visit", "Biz", None, None, "Ofc. C D 2", "A3"),
        ("24-3", "2026-05-01 12:00:00", "12:00:00", "12:30:00", "Visit", "Biz", None, None, "Ofc. C D 2", "CSB"),
        ("24-4", "2026-05-01 12:00:00", "12:00:00", None, "Visit", "Biz", None, None, None, None),
    ], "ReportNumberNew string, `Time of Call` string, `Time Out Display` string, `Time In Display` string, "
       "Incident string, `SelfJoinCADNumber::Business Name` string, `St Number` string, StreetName string, "
       "Officer string, Squad string")
    routed = standardize.dispatch_export(raw, route_table(spark))
    got = {r.case_no: (r.include, r.office, r.division, r.duration_hours, r.imputed, r.end_time, r.location)
           for r in routed.collect()}
    assert got["24-1"] == (True, "STA&CP", "STACP", 0.5, True, "10:30", "251 Elm St")
    assert got["24-2"] == (True, "Patrol", "Patrol", 1.5, False, "12:30", "Biz")
    assert got["24-3"][0] is False
    assert got["24-4"] == (True, "", "", None, False, None, "Biz")
    split = route_split(routed)
    assert split["unrouted"].count() == 1 and split["sta"].count() == 1


def test_office_summary_null_rules(spark):
    df = spark.createDataFrame([("A", "x", "e1", None, None), ("A", "x", "e2", 3, None), (None, "x", "e3", 1, 2.0)],
                               "office string, division string, event_name string, attendee_count long, "
                               "duration_hours double")
    r = report.office_summary(df).collect()
    assert len(r) == 1
    assert (r[0].n_events, r[0].total_attendees, r[0].total_hours, r[0].avg_hours) == (2, 3, 0.0, None)


def test_exact_quantiles_match_pandas(spark):
    import pandas as pd
    vals = [float(x % 17) for x in range(1001)] + [5.0] * 500
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v double")
    q = report.exact_quantiles(df, ["v"], (0.25, 0.5, 0.75, 0.9), tiebreak=["i"]).first()
    s = pd.Series(vals)
    assert [q.q0, q.q1, q.q2, q.q3] == [s.quantile(p) for p in (0.25, 0.5, 0.75, 0.9)]

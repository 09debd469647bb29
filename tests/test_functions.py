"""Table-driven checks of the scalar expressions (values from FIXTURES.md §2)."""

import pytest
from pyspark.sql import functions as F

from unifeed.functions import dates, durations, numbers, people, places
from unifeed.functions.text import blank_to_null, to_double


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_duration_text(spark):
    vals = ["0 days 01:00:00", "0 days 01:15:00", "0 days 02:30:00", "1 days 02:00:00",
            "1:30", "2.5", "1:30:36", "0", "-1", "", "nan", "junk", "5 Hrs. 00 Mins",
            "1 Hour ", None, "1_000", "2d"]
    got = one_col(spark, vals, durations.duration_hours)
    exp = [1.0, 1.25, 2.5, 26.0, 1.5, 2.5, 1.51, None, None, None, None, None, 5.0, 1.0,
           None, None, None]
    got = [None if g is None else round(g, 2) for g in got]
    assert got == exp


def test_clock_and_elapsed(spark):
    pairs = [("19:00", "21:00", 2.0), ("09:00", "17:00", 8.0), ("14:30", "16:15", 1.75),
             ("23:00", "01:00", 2.0), ("08:00", "08:30", 0.5), ("23:45", "01:15", 1.5),
             ("0900", "9:30", 0.5), (None, "10:00", None), ("invalid", "10:00", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string")
    out = df.orderBy("i").select(durations.elapsed_hours(durations.clock_seconds("a"),
                                                         durations.clock_seconds("b"))).collect()
    assert [r[0] for r in out] == [p[2] for p in pairs]
    # DUR3: missing side -> default 0.5
    df2 = df.select(durations.pick_duration(F.lit(None).cast("double"),
                                            durations.elapsed_hours(durations.clock_seconds("a"),
                                                                    durations.clock_seconds("b"))).alias("d"),
                    "i").orderBy("i")
    assert [r[0] for r in df2.collect()] == [2.0, 8.0, 1.75, 2.0, 0.5, 1.5, 0.5, 0.5, 0.5]


def test_memorial_guard(spark):
    rows = [("10:00", "10:01"), ("10:00", "10:02"), ("10:00", "10:03"), ("23:45", "23:45"), ("10:00", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a string, b string")
    dur, imp, end = durations.memorial_guard(durations.clock_seconds("a"), durations.clock_seconds("b"))
    got = df.orderBy("i").select(dur, imp, durations.hhmm(end)).collect()
    assert [tuple(r) for r in got] == [(0.5, True, "10:30"), (0.5, True, "10:30"), (0.05, False, "10:03"),
                                       (0.5, True, "00:15"), (None, False, None)]


def test_people(spark):
    vals = ["A, B", "A, B, C", "A/B", "A & B", "A,B,C,D", "A, B & C", "A", "", None, "A, , B",
            "  A  ,  B  "]
    got = one_col(spark, vals, lambda c: F.size(people.split_people(F.coalesce(c, F.lit("")))))
    assert got == [2, 3, 2, 2, 4, 3, 1, 0, 0, 2, 2]
    pf = one_col(spark, ["PO Rivers / Sgt. Stone and Lake", "P.Woods", "P.O. Woods", "Squad formation",
                         "123 456", "7", None], people.patrol_field)
    assert [(list(r["names"]), r["n"]) for r in pf] == [
        (["Rivers", "Stone", "Lake"], 3), (["P. Woods"], 1), (["P. O. Woods"], 1),
        (["Squad formation"], 0), (["123 456"], 1), ([], 7), ([], 0)]


def test_simple_split_and_roster(spark):
    got = one_col(spark, ["John,Jane/Bob&Mary", "A,B,C/D&E"], lambda c: people.simple_count(c))
    assert got == [4, 5]
    df = spark.createDataFrame([("Det. A. Hill, Det. B. Glen", None, "Moor", "Sgt. Vale / Fen")],
                               "p string, e1 string, e2 string, f string")
    r = df.select(people.roster_names("p", ["e1", "e2"], "f").alias("n")).first()
    assert list(r["n"]) == ["Det. A. Hill, Det. B. Glen", "Moor", "Sgt. Vale", "Fen"]


def test_officer_forms(spark):
    got = one_col(spark, ["Lt. Anna Reyes 266", "Sgt. Bo Lane", "Solo", None], people.officer_initial_form)
    assert got == ["A. Reyes", "B. Lane", "Solo", ""]
    got = one_col(spark, ["Lt. Anna Reyes 266", "266", None], people.officer_key)
    assert got == ["reyes", "", ""]


def test_head_counts(spark):
    assert one_col(spark, [None, "0", "2.0", "x", "7"], numbers.given_head_count) == [1, 1, 2, 1, 7]
    assert one_col(spark, [None, "0", "-3", "4"], numbers.clamp_presentation_count) == [1, 1, 1, 4]


def test_clamp_hours(spark):
    got = one_col(spark, [None, 0.0, -1.0, 24.0, 24.01, 1.005], durations.clamp_presentation_hours, "double")
    assert got == [0.5, 0.5, 0.5, 24.0, 8.0, 1.0]


def test_locations(spark):
    df = spark.createDataFrame([("M & M Center", "MM Center"), ("Jackson Avenue School", "Jackson and Fairmount"),
                                ("Civic Center", "Main Library"), ("", "Anything")], "a string, b string")
    k = df.select(places.location_match(places.location_key("a"), places.location_tokens("a"),
                                        places.location_key("b"), places.location_tokens("b")).alias("m"),
                  places.is_combined("b").alias("c"))
    assert [tuple(r) for r in k.collect()] == [(True, False), (False, True), (False, False), (False, False)]
    assert one_col(spark, [" 251.0 \n", "x"], places.case_number) == ["251", "x"]


def test_compose_location(spark):
    df = spark.createDataFrame([("Biz", "1", "Main"), (None, "251.0", "Elm St"), (None, "12B", "Oak"),
                                (None, None, None)], "b string, n string, s string")
    got = [r[0] for r in df.select(places.compose_location("b", "n", "s")).collect()]
    assert got == ["Biz", "251 Elm St", "12B Oak", ""]


def test_dates(spark):
    got = one_col(spark, ["10/01/2025", "10/01/25", "2025-10-01", "2025-10-01 10:00:00", "0900",
                          "02/30/2026", "", None], dates.parse_date)
    assert [None if g is None else g.isoformat() for g in got] == [
        "2025-10-01", "2025-10-01", "2025-10-01", "2025-10-01", None, None, None, None]
    got = one_col(spark, ["26_01", "_24_11", "25_Jan", "25_Apr", "Log"], dates.period_from_sheet_name)
    assert [None if g is None else g.isoformat() for g in got] == [
        "2026-01-01", "2024-11-01", "2025-01-01", "2025-04-01", None]


def test_numeric_gate(spark):
    got = one_col(spark, ["1.5", " 2 ", "1_000", "2d", "inf", ".5", "1e3"], to_double)
    assert got == [1.5, 2.0, None, None, None, 0.5, 1000.0]
    assert one_col(spark, ["  ", "\t x \n"], blank_to_null) == [None, "x"]

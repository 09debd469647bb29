"""Jobs: QA run, configured run, published tables, contracts, sheets by header, months, digests."""

import datetime as dt
import glob
import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from test_io import write_xlsx
from unifeed.operators import contract as C
from unifeed.operators import reconcile as R
from unifeed.operators import report
from unifeed.operators.combine import apply_alias_table
from unifeed.operators.schema import MissingColumnsError
from unifeed.operators.standardize import DISPATCH_COLUMNS
from unifeed.plans import qa_run, release, run_config
from unifeed.sources import sinks, workbook

MAY = dt.date(2026, 5, 1)


def new_dir():
    return tempfile.mkdtemp(prefix="unifeed-jobs-")


def export(spark, rows):
    """Dispatch rows from (id, squad, time of call, place)."""
    full = [(f"26{i}.0", call, "10:00:00", "11:00:00", "Talk", place, None, None, "Sgt. Ann Lane 12", squad, "D", i)
            for i, squad, call, place in rows]
    return spark.createDataFrame(full, ", ".join(f"`{c}` string" for c in DISPATCH_COLUMNS) + ", row_id long")


GOOD = [(1, "STA", "05/02/2026 09:15", "Library"), (2, "STA", "05/02/2026 10:00", "Town Hall"), (3, "STA", "05/03/2026 11:00", "Gym"),
        (4, "COMM ENG", "05/04/2026 12:00", "Park"), (5, "CSB", "05/04/2026 13:00", "Depot"), (6, "A2", "05/05/2026 14:00", "Park"),
        (7, "STA", "soon", "Library"), (8, "STA", None, "Library"), (4, "COMM ENG", "05/04/2026 12:00", "Park")]


def the_log(spark):
    return spark.createDataFrame([(2, dt.date(2026, 5, 2), "library"), (3, dt.date(2026, 5, 2), "Museum")],
                                 "row_idx long, date date, location string")


def test_qa_run_publishes_all_tables_together(spark):
    base = new_dir()
    taken = spark.createDataFrame([("20260503-001",), ("20260503-003",), ("bad",), (None,)], "event_id string")
    qa_run.qa_run(spark, export(spark, GOOD), the_log(spark), base, "row_id", MAY, taken, run_id="r1")
    get = lambda t: release.published(spark, base, t)
    assert {r.cad_id: r.status for r in get("reconciliation").collect()} == {1: "PRESENT", 2: "CONFLICT", 3: "MISSING"}
    assert [r.event_id for r in get("proposals").collect()] == ["20260503-002"]
    assert {(r.cad_id, tuple(r.reasons)) for r in get("rejects").collect()} == {(7, ("date:Time of Call",)), (8, ("blank:Time of Call",))}
    assert [r.cad_id for r in get("unrouted").collect()] == [5] and get("duplicates").first()["rows"] == 2
    assert {r.row_idx for r in get("conflict_candidates").collect()} == {2, 3} and get("preview").count() == 3
    assert all(r.ok for r in get("checks").collect()) and get("checks").count() == 6
    listed = release.manifest(spark, base).collect()
    assert {r.run_id for r in listed} == {"r1"} and all(get(r.table).count() == r.rows for r in listed)


def test_qa_run_with_a_failing_gate_publishes_nothing(spark):
    base = new_dir()
    qa_run.qa_run(spark, export(spark, GOOD), the_log(spark), base, "row_id", MAY, run_id="r1")
    late = [*GOOD, (9, "COMM ENG", "06/01/2026 09:00", "Park")]
    with pytest.raises(release.GateFailed, match="dates in the month \\(1 rows\\)"):
        qa_run.qa_run(spark, export(spark, late), the_log(spark), base, "row_id", MAY, run_id="r2")
    assert {r.run_id for r in release.manifest(spark, base).collect()} == {"r1"}
    assert release.published(spark, base, "preview").count() == 3                   # readers still see the first run
    qa_run.qa_run(spark, export(spark, GOOD[:4]), the_log(spark), base, "row_id", MAY, run_id="r3")
    assert release.published(spark, base, "preview").count() == 1
    assert release.published(spark, base, "preview", "r1").count() == 3
    with pytest.raises(LookupError):
        release.published(spark, base, "preview", "r2")


def test_qa_run_names_missing_columns_and_writes_nothing(spark):
    base = new_dir()
    with pytest.raises(MissingColumnsError, match="cad_ce.*Squad"):
        qa_run.qa_run(spark, export(spark, GOOD).drop("Squad"), the_log(spark), base, "row_id", MAY)
    assert os.listdir(base) == []


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


HEAD = "Community Event,Date of Event,Start Time,End Time,Event Location,Participating Member 1\n"


def test_configured_run_isolates_sources_and_accounts_for_every_row(spark):
    base, d = new_dir(), new_dir()
    a = write(f"{d}/a.csv", HEAD + "Fair,05/02/2026,10:00,11:00,Park,Ann\nWalk,nonsense,10:00,11:00,Park,Ann\n"
              "Short,05/02/2026\nLong,05/02/2026,1:00,2:00,Park,Ann,extra,cells\nArrests,05/03/2026,9:00,10:00,Hall,Bo\n")
    b = write(f"{d}/b.csv", HEAD.replace("Date of Event", "When") + "Fair,05/02/2026,10:00,11:00,Park,Ann\n")
    dispatch = export(spark, [(1, "COMM ENG", "05/02/2026 09:00", "Park"), (2, "COMM ENG", "05/02/2026 09:00", "Zoo"), (3, "CSB", "05/02/2026 09:00", "Zoo")])
    dispatch.write.parquet(f"{d}/cad")
    rules = C.Contract(not_blank=("Date of Event",), kinds={"Date of Event": "date"})
    config = {"sources": {
        "log": {"format": "csv", "path": a, "recipe": "community", "contract": rules},
        "other": {"format": "csv", "path": b, "recipe": "community", "contract": rules},
        "gone": {"format": "parquet", "path": f"{d}/none", "recipe": "patrol"},
        "off": {"disabled": True, "path": a}, "cad": {"path": f"{d}/cad", "recipe": "dispatch"}}}
    feed_path = f"{d}/feed"
    run_config.run_job(spark, config, base, dt.date(2026, 6, 1), gap_source="cad", run_id="r1", feed_path=feed_path)
    got = {r.source: r for r in release.published(spark, base, "run_summary").collect()}
    assert {k: v.status for k, v in got.items()} == {"log": "ok", "other": "failed", "gone": "failed", "off": "disabled", "cad": "ok"}
    assert "Date of Event" in got["other"].error and "other" in got["other"].error and got["gone"].error
    assert (got["log"].rows_read, got["log"].rows_rejected, got["log"].rows_kept) == (5, 3, 2)
    assert (got["cad"].rows_read, got["cad"].rows_rejected) == (3, 1) and got["log"].nulls["date"] == 0
    reasons = sorted((r.source, tuple(r.reasons)) for r in release.published(spark, base, "rejects").collect())
    assert reasons == [("cad", ("route",)), ("log", ("date:Date of Event",)), ("log", ("record",)), ("log", ("record",))]
    assert any("extra,cells" in r.record for r in release.published(spark, base, "rejects").collect())
    feed = release.published(spark, base, "feed").collect()
    assert sorted((r.data_source, r.event_name, r.location) for r in feed) == [("cad", "Talk", "Zoo"), ("log", "Fair", "Park")]
    assert release.published(spark, base, "removed_rows").count() == 1 and release.published(spark, base, "gap_dropped").count() == 1
    assert spark.read.parquet(feed_path).count() == 2
    with pytest.raises(release.GateFailed, match="no source could be read"):
        run_config.run_job(spark, {"sources": {"gone": config["sources"]["gone"]}}, base, dt.date(2026, 6, 1))


def test_contract_sums_hold(spark):
    raw = spark.range(1000).select(F.when(F.col("id") % 7 != 0, F.concat(F.lit("0"), (F.col("id") % 9 + 1).cast("string"), F.lit("/01/2026")))
                                   .otherwise("x").alias("Day "), F.when(F.col("id") % 5 != 0, "1").alias("n"), F.lit("c").alias("_x"))
    marked = C.with_reasons(raw, C.Contract(not_blank=("n",), kinds={"Day": "date", "n": "number"}))
    assert C.accepted(marked).count() + C.rejects(marked, "s").count() == 1000
    assert {r.reason: r["rows"] for r in C.reason_counts(marked).collect()} == {"date:Day": 143, "blank:n": 200}
    with pytest.raises(MissingColumnsError, match="s: missing required columns: \\['a', 'b'\\]"):
        C.with_reasons(raw, C.Contract(required=("a",), not_blank=("b",)), "s")


def test_sheets_are_read_by_their_own_headers(spark):
    d = new_dir()
    write_xlsx(f"{d}/a.xlsx", {"Log": [["Date ", "Event", "Place"], ["05/02/2026", "Fair", "Park"], [None, None, None], ["05/03/2026", "Walk", "Hall"]]})
    write_xlsx(f"{d}/b.xlsx", {"Log": [["Monthly log"], [None], ["Place", "Notes", "Event", "Date", "Event"], ["Gym", "n", "Talk", "05/04/2026", "Second"],
                                       ["Place", "Notes", "Event", "Date", "Event"], ["Zoo", None, "Trip", "05/05/2026", None]],
                               "Other": [["x"], ["y"]]})
    write_xlsx(f"{d}/c.xlsx", {"Log": [["Event", "Date"], ["Solo", "05/06/2026"]]})
    write_xlsx(f"{d}/d.xlsx", {"Log": [["Date", "Event", "Place"]]})
    rows = workbook.read_workbooks(spark, f"{d}/*.xlsx")
    cols = ["Date", "Event", "Place"]
    out = workbook.by_header(rows, cols).select(*cols).collect()
    assert sorted(map(tuple, out), key=repr) == sorted([
        ("05/02/2026", "Fair", "Park"), ("05/03/2026", "Walk", "Hall"), ("05/04/2026", "Talk", "Gym"),
        ("05/05/2026", "Trip", "Zoo"), ("05/06/2026", "Solo", None)], key=repr)
    second = workbook.by_header(rows, ["Event", "Event.1", "Date"]).where("`Event.1` IS NOT NULL").first()
    assert (second["Event"], second["Event.1"]) == ("Talk", "Second")
    drift = {(os.path.basename(r.file), r.sheet): (r.header_row, r.missing, r.unknown, r.moved)
             for r in workbook.header_drift(rows, cols).collect()}
    assert drift[("a.xlsx", "Log")] == (1, [], [], []) and drift[("c.xlsx", "Log")][1] == ["Place"]
    assert drift[("c.xlsx", "Log")][3] == ["Date", "Event"] and drift[("b.xlsx", "Log")][3] == ["Date", "Event", "Place"]
    assert drift[("b.xlsx", "Log")][0] == 3 and drift[("b.xlsx", "Log")][2] == ["Event.1", "Notes"]
    assert drift[("b.xlsx", "Other")] == (None, ["Date", "Event", "Place"], [], [])


def files_of(path):
    return {f: hashlib.sha256(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_only_touched_months_are_rewritten(spark):
    path = f"{new_dir()}/feed"
    rows = spark.range(300).select(F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("date"),
                                   F.col("id").cast("string").alias("event_name"))
    sinks.update_months(rows, path)
    before = files_of(path)
    sinks.update_months(rows.where("month(date) = 2").limit(5), path)
    after = files_of(path)
    other = {f: h for f, h in before.items() if "2026-02" not in f}
    assert other and {f: h for f, h in after.items() if "2026-02" not in f} == other
    assert spark.read.parquet(path).where("year_month = '2026-02'").count() == 5
    assert spark.read.parquet(path).count() == rows.where("month(date) <> 2").count() + 5


def test_sorted_output_is_in_one_order_over_its_files(spark):
    path = f"{new_dir()}/sorted"
    sinks.write_sorted(spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7), path, "k")
    import pyarrow.parquet as pq
    got = [k for f in sorted(glob.glob(f"{path}/*.parquet")) for k in pq.read_table(f).column("k").to_pylist()]
    assert got == list(range(5000))


def test_digest_tells_changed_doubled_and_swapped_rows(spark):
    rows = [(1, "a", None), (2, None, "b"), (2, None, "b"), (3, "", "c")]
    of = lambda rs: sinks.digest(spark.createDataFrame(rs, "k long, x string, y string")).first()
    same = of(rows)
    assert same == of(rows[::-1]) and same == sinks.digest(spark.createDataFrame(rows, "k long, x string, y string").repartition(5)).first()
    for other in ([(1, "a", None), (2, None, "b"), (3, "", "c"), (3, "", "c")], [(1, None, "a"), *rows[1:]], [(1, "a", ""), *rows[1:]],
                  [(2, "a", None), (1, None, "b"), *rows[2:]], rows[:3], [*rows, rows[0]]):
        assert of(other) != same
    out = sinks.checked_write(spark.createDataFrame(rows, "k long, x string, y string"), f"{new_dir()}/t")
    assert out["ok"] and out["rows_out"] == 4
    lossy = sinks.checked_write(spark.createDataFrame(rows, "k long, x string, y string"), f"{new_dir()}/t", "csv")
    assert not lossy["ok"] and not lossy["same_nulls"]                             # CSV has no blank beside NULL


def test_crosstab_tells_margins_from_values(spark):
    df = spark.createDataFrame([("All", "x"), ("All", "y"), ("a", "x"), (None, "x"), ("<null>", "All")], "r string, c string")
    m = {(r.r, r.c, r.margin): r.n for r in report.crosstab_margins(df, "r", "c").collect()}
    assert m[("All", "All", 3)] == 5 and m[("All", "x", 0)] == 1 and m[("All", "All", 1)] == 2 and m[("All", "All", 2)] == 1
    assert m[(None, "x", 0)] == 1 and m[("<null>", "All", 0)] == 1
    full = report.crosstab_full(df, "r", "c").collect()
    assert len(full) == 20 and len({(r.r, r.c, r.margin) for r in full}) == 20 and sum(r.n for r in full if r.margin == 0) == 5


def test_alias_table_keeps_repeated_ids_apart(spark):
    names = spark.createDataFrame([(1, ["Ann", "bo "], "p"), (1, ["Cy"], "q"), (1, ["Cy"], "q"), (2, None, "r"), (3, [], "s"), (None, ["BO", None], "t")],
                                  "id long, names array<string>, note string")
    alias = spark.createDataFrame([("BO", "Officer Bo"), ("bo", "Officer Bo"), ("cy", "Cyril")], "alias_key string, canonical string")
    out = sorted(map(tuple, apply_alias_table(names, alias, "id", "names").collect()), key=repr)
    assert out == sorted([(1, ["Ann", "Officer Bo"], "p"), (1, ["Cyril"], "q"), (1, ["Cyril"], "q"), (2, [], "r"), (3, [], "s"),
                          (None, ["Officer Bo", None], "t")], key=repr)


def test_change_set_counts_repeats_and_null_keys(spark):
    s = "d date, p string, v int"
    d = dt.date(2026, 5, 1)
    before = spark.createDataFrame([(d, "a", 1), (d, "a", 1), (d, "b", 2), (None, None, 3), (d, "c", 4)], s)
    after = spark.createDataFrame([(d, "a", 1), (d, "b", 5), (None, None, 3), (None, None, 3), (d, "e", 6)], s)
    ch = report.change_set(before, after, ["d", "p"])
    assert sorted((r.p, r.delta, r.change) for r in ch.where("p is not null").collect()) == [
        ("a", -1, "removed"), ("b", -1, "changed"), ("b", 1, "changed"), ("c", -1, "removed"), ("e", 1, "inserted")]
    assert report.change_counts(ch).first().asDict() == {"inserted": 2, "removed": 2, "changed": 1, "rows_delta": 0}
    assert report.change_counts(report.change_set(before, before, ["d", "p"])).first().asDict() == {
        "inserted": 0, "removed": 0, "changed": 0, "rows_delta": 0}
    # a feed that grows from 5 to 15 rows: 9 filled, 2 new, 1 dropped
    old = spark.range(5).select(F.col("id").alias("k"), F.lit("log").alias("src"))
    new = spark.range(1, 5).select(F.col("id").alias("k"), F.lit("log").alias("src")).unionByName(
        spark.range(5, 16).select(F.col("id").alias("k"), F.lit("cad").alias("src")))
    assert report.change_counts(report.change_set(old, new, ["k"])).first().asDict() == {
        "inserted": 11, "removed": 1, "changed": 0, "rows_delta": 10}


def test_free_numbers_skip_those_taken(spark):
    import random
    rng = random.Random(4)
    seq, taken, expected = [], [], {}
    for i, n in enumerate([0, 1, 5, 200, 900]):
        d = dt.date(2026, 1, 1 + i)
        used = sorted(rng.sample(range(1, 400), rng.choice([0, 3, 150, 300]))) if i else [1, 2]
        taken += [(f"{d:%Y%m%d}-{x:03d}",) for x in used] * 2
        free = [x for x in range(1, 2000) if x not in set(used)]
        seq += [(d, k) for k in range(1, n + 1)]
        expected |= {(d, k): free[k - 1] for k in range(1, n + 1)}
    seq.append((None, 1))
    ids = spark.createDataFrame([*taken, ("2026-01-01",), ("20261301-001",), ("20260103-000",)], "event_id string")
    df = spark.createDataFrame(seq, "d date, k long").repartition(4)
    out = R.free_numbers(df, "d", "k", R.taken_numbers(ids), "free").collect()
    assert {(r.d, r.k): r.free for r in out} == expected | {(None, 1): 1} and len(out) == len(seq)

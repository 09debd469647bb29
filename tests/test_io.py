"""Sources, sinks and streaming (SRC1-SRC9, SNK1-SNK6, QLT11, X1); files in fresh temp dirs."""

import datetime as dt
import os
import tempfile
import time
import zipfile

from pyspark.sql import functions as F

from unifeed.operators.schema import CANONICAL_COLUMNS
from unifeed.plans import run_config
from unifeed.sources import files, sinks, workbook
from unifeed.streaming.landing import start_landing_job

CT = ('<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/'
      'content-types"><Default Extension="xml" ContentType="application/xml"/></Types>')
WB = ('<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
      'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{}</sheets></workbook>')
RELS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
SHEET = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}'
         '</sheetData></worksheet>')


def write_xlsx(path, sheets):
    """Minimal OOXML workbook: ``sheets`` = {name: [[cell, ...], ...]} (strings inline, numbers as numbers)."""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml", CT)
        z.writestr("xl/workbook.xml", WB.format("".join(
            f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(sheets))))
        z.writestr("xl/_rels/workbook.xml.rels", RELS.format("".join(
            f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml" Type="ws"/>'
            for i in range(len(sheets)))))
        for i, rows in enumerate(sheets.values()):
            xml_rows = []
            for r, row in enumerate(rows, start=1):
                cells = []
                for c, v in enumerate(row):
                    if v is None:
                        continue
                    ref = f"{chr(65 + c)}{r}"
                    if isinstance(v, (int, float)):
                        cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
                xml_rows.append(f'<row r="{r}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", SHEET.format("".join(xml_rows)))


def test_workbook_scan_positional_and_inventory(spark):
    d = tempfile.mkdtemp(prefix="unifeed-xlsx-")
    write_xlsx(os.path.join(d, "a.xlsx"), {
        "Master_Outreach": [["Id", "Date", "c", "d", "e", "f", "CAD#", "Event", "Location"],
                            ["1", "05/13/2026", None, None, None, None, "26-1.0", "Visit", "MM Center"],
                            [None, None, None, None, None, None, None, None, None],
                            ["3", 46155, None, None, None, None, None, "Talk", "Library"]],
        "Notes": [["x"], ["y"]]})
    with open(os.path.join(d, "broken.xlsx"), "wb") as f:
        f.write(b"not a zip")
    rows = workbook.read_workbooks(spark, os.path.join(d, "*.xlsx"))
    errs = rows.where("error is not null").collect()
    assert len(errs) == 1 and errs[0].file.endswith("broken.xlsx")
    pos = workbook.positional(rows.where("sheet = 'Master_Outreach'"),
                              {"date": 1, "case_no": 6, "event": 7, "location": 8})
    got = sorted((r.row_no, r.date, r.case_no, r.event, r.location) for r in pos.collect())
    assert got == [(2, "05/13/2026", "26-1.0", "Visit", "MM Center"), (4, "46155", None, "Talk", "Library")]
    serial = pos.select(workbook.excel_serial_date("date").alias("d")).where("d is not null").first().d
    assert serial == dt.date(2026, 5, 13)
    inv = workbook.sheet_inventory(rows, required_sheets=["Master_Outreach", "Summary"])
    got = {(r.sheet, r.present, r.data_rows) for r in inv.collect()}
    assert ("Master_Outreach", True, 2) in got and ("Summary", False, 0) in got


def test_delimited_bom_and_newest_file(spark):
    d = tempfile.mkdtemp(prefix="unifeed-csv-")
    p1 = os.path.join(d, "2026_04_CE_export.csv")
    with open(p1, "w", encoding="utf-8") as f:
        f.write("﻿Office,Event Name\nA,\"x, y\"\n")
    time.sleep(1.1)
    p2 = os.path.join(d, "2026_05_CE_export.csv")
    with open(p2, "w", encoding="utf-8") as f:
        f.write("Office,Event Name\nB,z\n")
    df = files.read_delimited(spark, p1)
    assert df.columns == ["Office", "Event Name"] and df.first()["Event Name"] == "x, y"
    cat = files.list_files(spark, os.path.join(d, "*.csv"))
    assert files.newest_file(cat).first().path.endswith("2026_05_CE_export.csv")
    assert files.newest_file(cat, by="name").first().path.endswith("2026_05_CE_export.csv")
    per = files.with_source_file(files.read_delimited(spark, os.path.join(d, "*.csv")))
    assert {str(r.source_period) for r in per.collect()} == {"2026-04-01", "2026-05-01"}


def test_log_token_count(spark):
    d = tempfile.mkdtemp(prefix="unifeed-log-")
    with open(os.path.join(d, "a.log"), "w") as f:
        f.write("ok\nERROR one ERROR two\n")
    with open(os.path.join(d, "b.log"), "w") as f:
        f.write("ERROR three\n")
    r = files.count_tokens_in_logs(spark, os.path.join(d, "*.log"), alert_above=2).first()
    assert (r.token_hits, r.alert) == (3, True)


def test_sinks_and_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="unifeed-sink-")
    feed = spark.createDataFrame([(dt.date(2026, 5, 1), "a", 1.5, 2, "X", "Y"), (None, "b", None, 1, None, "Y")],
                                 "date date, event_name string, duration_hours double, attendee_count long, "
                                 "office string, division string")
    sinks.write_feed(feed, os.path.join(d, "feed"))
    back = spark.read.parquet(os.path.join(d, "feed"))
    assert back.count() == 2 and "year_month" in back.columns
    r = sinks.roundtrip_check(feed, os.path.join(d, "rt"), fmt="csv").first()
    assert r.ok and r.rows_out == r.rows_in == 2
    summary = sinks.run_summary(spark, feed, ["a", "b"], [], dt.datetime(2026, 5, 1)).first()
    assert summary.rows == 2 and summary.missing_critical == 2 and summary.quality_score == 75.0
    paths = sinks.write_tables({"office_summary": feed.groupBy("office").count()}, os.path.join(d, "t"))
    assert spark.read.parquet(paths["office_summary"]).count() == 2


def test_config_run_isolates_failures(spark):
    d = tempfile.mkdtemp(prefix="unifeed-run-")
    p = os.path.join(d, "community.tsv")
    with open(p, "w") as f:
        f.write("Date of Event\tStart Time\tEnd Time\tCommunity Event\tEvent Location\tMember Count\n"
                "10/01/2025\t10:00\t11:30\tFair\tPark\t3\n10/02/2025\t\t\tArrests\tPark\t\n")
    cfg = {"sources": {
        "outreach_log": {"format": "tsv", "path": p, "recipe": "community",
                                 "required": ["Date of Event", "Community Event"]},
        "missing_file": {"format": "tsv", "path": os.path.join(d, "nope.tsv"), "recipe": "community"},
        "wrong_columns": {"format": "tsv", "path": p, "recipe": "community", "required": ["Nope"]},
        "grid": {"disabled": True},
    }}
    feed, status = run_config.run(spark, cfg, dt.date(2025, 11, 1))
    st = {r.source: r.status for r in status.collect()}
    assert st == {"outreach_log": "ok", "missing_file": "failed", "wrong_columns": "failed",
                  "grid": "disabled"}
    rows = feed.collect()
    assert len(rows) == 1 and rows[0].duration_hours == 1.5 and rows[0].attendee_count == 3
    assert feed.columns == CANONICAL_COLUMNS


def test_landing_stream_available_now(spark):
    d = tempfile.mkdtemp(prefix="unifeed-stream-")
    land, out = os.path.join(d, "landing"), os.path.join(d, "out")
    os.makedirs(land)
    df = spark.createDataFrame([("Arrests", 1), ("Fair", 2)], "event_name string, n int")
    df.write.mode("overwrite").parquet(os.path.join(land, "batch1"))
    from unifeed.operators.combine import remove_contamination

    def transform(b):
        return remove_contamination(b.withColumn("office", F.lit("X")))[0]

    q = start_landing_job(spark, os.path.join(land, "*"), df.schema, transform, out,
                          checkpoint=os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(out).collect()
    assert [r.event_name for r in got] == ["Fair"]


def test_production_job_and_gates(spark):
    from unifeed.operators import quality
    from unifeed.plans.feed import run_production
    d = tempfile.mkdtemp(prefix="unifeed-prod-")
    paths = run_production(spark, "/root/testdata/sf0.001", d)
    feed = spark.read.parquet(paths["combined"])
    summary = spark.read.parquet(paths["office_summary"])
    assert feed.count() > 0 and summary.count() > 0
    assert summary.agg(F.sum("n_events")).first()[0] == feed.where("office is not null and division is not null") \
        .agg(F.count("event_name")).first()[0]
    q = quality.quality_gate(spark.read.parquet(paths["quality"]), "quality_score", 75.0).first()
    assert q.passed is True
    assert quality.event_header_columns(["Date of Event", "Squad", "Attendees"]) == ["Date of Event", "Attendees"]


def test_typed_cells_reach_the_feed(spark):
    """Dates, clocks and elapsed times of a workbook come out right through the recipe."""
    d = tempfile.mkdtemp(prefix="unifeed-typed-")
    styles = ('<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts count="2">'
              '<numFmt numFmtId="164" formatCode="[h]:mm:ss"/><numFmt numFmtId="165" formatCode="yyyy\\-mm\\-dd hh:mm"/>'
              '</numFmts><cellXfs count="5"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="20"/><xf numFmtId="164"/>'
              '<xf numFmtId="165"/></cellXfs></styleSheet>')
    head = ["Date of Event", "Start Time", "End Time", "Event Duration9", "Community Event", "Event Location", "Member Count"]
    write_xlsx(os.path.join(d, "typed.xlsx"), {"Log": [head, [None] * 7]})
    cells = [("A", 1, 45931), ("B", 2, 0.4166666667), ("C", 2, 0.5), ("D", 3, 0.0625), ("G", 0, 4)]
    row = "".join(f'<c r="{c}2" s="{s}"><v>{v}</v></c>' for c, s, v in cells)
    row += ('<c r="E2" t="inlineStr"><is><t>Fair</t></is></c><c r="F2" t="inlineStr"><is><t>Park</t></is></c>')
    heads = "".join(f'<c r="{chr(65 + i)}1" t="inlineStr"><is><t>{h}</t></is></c>' for i, h in enumerate(head))
    path = os.path.join(d, "styled.xlsx")
    with zipfile.ZipFile(os.path.join(d, "typed.xlsx")) as src, zipfile.ZipFile(path, "w") as z:
        for n in src.namelist():
            if "sheet1" not in n:
                z.writestr(n, src.read(n))
        z.writestr("xl/styles.xml", styles)
        z.writestr("xl/worksheets/sheet1.xml", SHEET.format(f'<row r="1">{heads}</row><row r="2">{row}</row>'))
    cfg = {"sources": {"book": {"format": "xlsx", "path": path, "columns": head, "recipe": "community"}}}
    feed, status = run_config.run(spark, cfg, dt.date(2025, 11, 1))
    assert [r.status for r in status.collect()] == ["ok"]
    r = feed.first()
    assert (r.date, r.start_time, r.end_time, r.duration_hours, r.attendee_count) == \
        (dt.date(2025, 10, 1), "10:00", "12:00", 1.5, 4)
    assert workbook._typed("45931.4375", "dt") == "2025-10-01 10:30:00" and workbook._format_kind('0.00 "days"') == ""


def test_unreadable_workbook_fails_its_source(spark):
    d = tempfile.mkdtemp(prefix="unifeed-broken-")
    write_xlsx(os.path.join(d, "a.xlsx"), {"Log": [["Date of Event"], ["10/01/2025"]]})
    with open(os.path.join(d, "bad.xlsx"), "wb") as f:
        f.write(b"not a zip")
    cfg = {"sources": {"book": {"format": "xlsx", "path": os.path.join(d, "*.xlsx"), "columns": ["Date of Event"]}}}
    _, status = run_config.run(spark, cfg, dt.date(2025, 11, 1))
    r = status.first()
    assert r.status == "failed" and "bad.xlsx" in r.error


def test_quoted_newlines_need_multi_line(spark):
    d = tempfile.mkdtemp(prefix="unifeed-ml-")
    p = os.path.join(d, "a.csv")
    with open(p, "w") as f:
        f.write('a,b\n1,"x\ny"\n')
    assert files.read_delimited(spark, p, multi_line=True).first()["b"] == "x\ny"

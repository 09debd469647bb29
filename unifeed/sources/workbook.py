"""Workbook scans (SRC1, SRC4, VAL2, SRC10).

Spark has no built-in spreadsheet format, so workbooks are read as a batch
job over *many* files: ``binaryFile`` lists and loads them (one row per file,
partitioned by Spark), and ``mapInPandas`` decodes each OOXML package with the
standard library (``zipfile`` + ``ElementTree``) into long rows
``(file, sheet, row_no, cells ARRAY<STRING>)``.  Numbers whose cell style shows a date, a
clock or elapsed time come out as ``yyyy-MM-dd[ HH:mm:ss]``, ``HH:mm:ss`` or ``H:mm:ss``.
Everything after decoding --
header mapping, positional columns, blank-row filtering, inventories -- is
ordinary DataFrame work.  A single workbook is necessarily decoded by one
task (a zip member is read sequentially); many workbooks spread over the
cluster.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from typing import Iterator, Sequence
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null

ROW_SCHEMA = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
])

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


# Built-in number formats that show dates, clocks and elapsed time.
_DATE_FORMATS = {14: "d", 15: "d", 16: "d", 17: "d", 18: "t", 19: "t", 20: "t", 21: "t", 22: "dt", 45: "t", 46: "e", 47: "t"}


def _format_kind(code: str) -> str:
    """"d", "t", "dt" or "e" (elapsed) for a custom number format, "" for any other."""
    if re.search(r"\[h+\]|\[m+\]|\[s+\]", code, re.I):
        return "e"
    bare = re.sub(r'"[^"]*"|\\\\.|\[[^\]]*\]', "", code.split(";")[0]).lower()
    day, clock = bool(re.search(r"[yd]", bare)), bool(re.search(r"[hs]", bare))
    return ("d" if day or (not clock and re.search(r"m", bare)) else "") + ("t" if clock else "")


def _style_kinds(z: zipfile.ZipFile, names: set[str]) -> list[str]:
    """The kind of each cell style."""
    if "xl/styles.xml" not in names:
        return []
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): _format_kind(f.get("formatCode", "")) for f in root.findall("m:numFmts/m:numFmt", _NS)}
    ids = [int(x.get("numFmtId", "0")) for x in root.findall("m:cellXfs/m:xf", _NS)]
    return [custom.get(i, _DATE_FORMATS.get(i, "")) for i in ids]


def _typed(value: str, kind: str) -> str:
    """A serial number shown as a date, a clock or elapsed time, as the text a person reads."""
    try:
        serial = float(value)
    except ValueError:
        return value
    seconds = round(serial * 86400)
    clock = f"{seconds // 3600 % 24:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"
    if kind == "e":
        return f"{seconds // 3600}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"
    if kind == "t" or serial < 1:
        return clock
    day = (_dt.date(1899, 12, 30) + _dt.timedelta(days=seconds // 86400)).isoformat()
    return f"{day} {clock}" if kind == "dt" and seconds % 86400 else day


def decode_workbook(path: str, content: bytes, sheets: Sequence[str] | None = None):
    """Yield ``(sheet, row_no, cells)`` for every non-empty row of a workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in root.findall("m:si", _NS)]
        rels = {}
        if "xl/_rels/workbook.xml.rels" in names:
            for rel in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).findall("pr:Relationship", _NS):
                target = rel.get("Target", "")
                rels[rel.get("Id")] = target.lstrip("/") if target.startswith("/xl/") else "xl/" + target
        kinds = _style_kinds(z, names)
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        for sh in wb.findall("m:sheets/m:sheet", _NS):
            name = sh.get("name")
            if sheets and name not in sheets:
                continue
            member = rels.get(sh.get(f"{{{_NS['r']}}}id"))
            if member not in names:
                continue
            root = ET.fromstring(z.read(member))
            for row in root.findall("m:sheetData/m:row", _NS):
                row_no = int(row.get("r", "0"))
                cells: dict[int, str] = {}
                for c in row.findall("m:c", _NS):
                    m = _REF.match(c.get("r", ""))
                    idx = _col_index(m.group(1)) if m else len(cells)
                    kind = c.get("t")
                    v = c.find("m:v", _NS)
                    if kind == "s" and v is not None:
                        val = shared[int(v.text)]
                    elif kind == "inlineStr":
                        is_ = c.find("m:is", _NS)
                        val = _text(is_) if is_ is not None else None
                    elif kind == "b" and v is not None:
                        val = "TRUE" if v.text == "1" else "FALSE"
                    else:
                        val = v.text if v is not None else None
                        style = int(c.get("s", "0"))
                        if val is not None and kind in (None, "n") and style < len(kinds) and kinds[style]:
                            val = _typed(val, kinds[style])
                    if val is not None:
                        cells[idx] = val
                if cells:
                    width = max(cells) + 1
                    yield name, row_no, [cells.get(i) for i in range(width)]


def read_workbooks(spark: SparkSession, pattern: str, sheets: Sequence[str] | None = None) -> DataFrame:
    """SRC1 (+SRC10: a source may list several sheets or many files): long rows
    ``(file, sheet, row_no, cells, error)``.  A file that cannot be decoded
    yields one row with ``error`` set instead of failing the job (per-source
    error isolation, SRC9)."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "content")
    wanted = list(sheets) if sheets else None

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):   # one batch out per file
                out = []
                try:
                    for sheet, row_no, cells in decode_workbook(path, bytes(content), wanted):
                        out.append((path, sheet, row_no, cells, None))
                except Exception as e:  # locked, empty or corrupt package: its rows are void
                    out = [(path, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(out, columns=["file", "sheet", "row_no", "cells", "error"])

    return files.mapInPandas(decode, ROW_SCHEMA)


def header_frame(rows: DataFrame, header_row: int = 1) -> DataFrame:
    """The header row of every (file, sheet): ``(file, sheet, header ARRAY<STRING>)``."""
    return rows.where(F.col("row_no") == header_row).select("file", "sheet", F.col("cells").alias("header"))


def sheet_inventory(rows: DataFrame, header_row: int = 1,
                    required_sheets: Sequence[str] = ()) -> DataFrame:
    """VAL2: sheet -> columns inventory with data-row counts, plus required
    sheets that are absent (``present = false``)."""
    data = rows.where(F.col("error").isNull())
    counts = data.groupBy("file", "sheet").agg(
        F.count_if(F.col("row_no") > header_row).alias("data_rows"))
    inv = counts.join(header_frame(data, header_row), ["file", "sheet"], "left") \
        .withColumn("present", F.lit(True))
    if not required_sheets:
        return inv
    wanted = F.explode(F.array(*[F.lit(s) for s in required_sheets])).alias("sheet")
    expected = data.select("file").distinct().select("file", wanted)
    missing = expected.join(inv.select("file", "sheet"), ["file", "sheet"], "left_anti")
    return inv.unionByName(missing.select("file", "sheet", F.lit(0).cast("long").alias("data_rows"),
                                          F.lit(None).cast("array<string>").alias("header"),
                                          F.lit(False).alias("present")))


def rows_to_frame(rows: DataFrame, columns: Sequence[str], header_row: int = 1) -> DataFrame:
    """Data rows as named text columns, by position of ``columns`` in the header
    (the caller supplies the header it expects -- e.g. from
    :func:`header_frame` of one sheet -- so no data reaches the driver)."""
    data = rows.where(F.col("error").isNull() & (F.col("row_no") > header_row))
    return data.select("file", "sheet", "row_no",
                       *[F.try_element_at("cells", F.lit(i + 1)).alias(c) for i, c in enumerate(columns)])


def _trimmed(cells) -> F.Column:
    """Header texts, right-trimmed; repeats after the first get ``.1``, ``.2`` ... appended."""
    names = F.transform(cells, lambda c: F.rtrim(F.regexp_replace(F.coalesce(c, F.lit("")), "\\s+$", "")))
    before = lambda i: F.size(F.filter(F.slice(names, 1, i), lambda x: x == F.get(names, i)))
    return F.transform(names, lambda n, i: F.when((n == "") | (before(i) == 0), n).otherwise(
        F.concat(n, F.lit("."), before(i).cast("string"))))


def header_index(rows: DataFrame, expected: Sequence[str], header_row: int | None = None) -> DataFrame:
    """(file, sheet, header_row, header, place map<name, position>): one row per sheet.

    ``header_row=None`` looks for it: the first row that holds at least half of the ``expected`` names
    (sheets have titles and blank rows above it, not always as many).  A sheet without such a row
    has none and gives no row here."""
    data = rows.where(F.col("error").isNull())
    wanted = F.array(*[F.lit(c.rstrip()) for c in expected])
    names = data.select("file", "sheet", "row_no", _trimmed(F.col("cells")).alias("header"))
    if header_row is not None:
        found = names.where(F.col("row_no") == header_row)
    else:
        hits = F.size(F.array_intersect("header", wanted))
        found = names.where(hits * 2 >= len(set(c.rstrip() for c in expected)))
        found = found.groupBy("file", "sheet").agg(F.min(F.struct("row_no", "header")).alias("h")).select("file", "sheet", "h.*")
    named = F.filter(F.transform("header", lambda n, i: F.struct(n.alias("n"), i.alias("i"))), lambda x: x.n != "")
    return found.select("file", "sheet", F.col("row_no").alias("header_row"), "header",
                        F.map_from_entries(named).alias("place"))


def by_header(rows: DataFrame, columns: Sequence[str], header_row: int | None = None) -> DataFrame:
    """SRC1 by the sheet's own header: data rows as named text columns, each cell taken from where
    *its* sheet has the column (columns may stand elsewhere in every file); NULL where a sheet lacks
    it.  Blank rows, and header rows that repeat further down, are skipped.

    The index of headers has one row per sheet and is joined to the rows by (file, sheet)."""
    index = header_index(rows, columns, header_row)
    nonblank = F.exists("cells", lambda x: blank_to_null(x).isNotNull())
    data = rows.where(F.col("error").isNull() & nonblank)
    both = data.join(index, ["file", "sheet"]).where(
        (F.col("row_no") > F.col("header_row")) & (_trimmed(F.col("cells")) != F.col("header")))
    return both.select("file", "sheet", "row_no", *[
        F.get("cells", F.try_element_at("place", F.lit(c.rstrip()))).alias(c) for c in columns])


def header_drift(rows: DataFrame, columns: Sequence[str], header_row: int | None = None) -> DataFrame:
    """(file, sheet, header_row, missing, unknown, moved): how each sheet differs from ``columns``;
    ``moved`` names columns that stand in another place than in most sheets.  Sheets without a
    header row are listed with all columns missing."""
    wanted = F.array(*[F.lit(c.rstrip()) for c in columns])
    index = header_index(rows, columns, header_row)
    spots = index.select("file", "sheet", F.explode("place").alias("name", "at")).where(F.array_contains(wanted, F.col("name")))
    usual = spots.groupBy("name", "at").agg(F.count(F.lit(1)).alias("k")).groupBy("name").agg(
        F.max(F.struct("k", (-F.col("at")).alias("neg"))).alias("m")).select("name", (-F.col("m.neg")).alias("usual"))
    moved = (spots.join(usual, "name").where(F.col("at") != F.col("usual")).groupBy("file", "sheet")
             .agg(F.sort_array(F.collect_list("name")).alias("moved")))
    sheets = rows.where(F.col("error").isNull()).select("file", "sheet").distinct()
    names = F.coalesce(F.map_keys("place"), F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    return sheets.join(index, ["file", "sheet"], "left").join(moved, ["file", "sheet"], "left").select(
        "file", "sheet", "header_row", F.sort_array(F.array_except(wanted, names)).alias("missing"),
        F.sort_array(F.array_except(names, wanted)).alias("unknown"), F.coalesce("moved", none).alias("moved"))


def positional(rows: DataFrame, positions: dict[str, int], header_rows: int = 1) -> DataFrame:
    """SRC4: fixed columns by position (0-based: B=1, G=6, H=7, I=8), the sheet
    row number kept, header and completely blank rows skipped (FLT8)."""
    nonblank = F.exists("cells", lambda x: blank_to_null(x).isNotNull())
    data = rows.where(F.col("error").isNull() & (F.col("row_no") > header_rows) & nonblank)
    return data.select("file", "sheet", "row_no",
                       *[F.try_element_at("cells", F.lit(i + 1)).alias(n) for n, i in positions.items()])


def excel_serial_date(c) -> F.Column:
    """Excel serial day number (1900 system) -> DATE; non-numeric text -> NULL."""
    from ..functions.text import to_double
    n = to_double(c)
    return F.when(n.isNotNull(), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(n).cast("int")))

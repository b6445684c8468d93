"""Excel workbooks (S4) as a Spark job.

``binaryFile`` lists the ``.xlsx`` files; ``mapInPandas`` parses each workbook
(first sheet) in an executor with the standard library (an ``.xlsx`` is a zip
of XML parts) and emits one row per non-empty cell. Spark then derives the
header and a type per column from the cells (one small aggregate: one row per
column) and pivots the data cells into rows (a shuffle keyed by
``(file, row)``). Many workbooks with the same header read as one table.

A workbook is not splittable, so one file is one task; the 500 MB intake limit
bounds it.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# SpreadsheetML namespaces, built-in date format ids, the 1900 and
# 1904 date epochs, and the name pattern of a column without a header.
NS_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
NS_PKG = "http://schemas.openxmlformats.org/package/2006/relationships"
DATE_FORMAT_IDS = set(range(14, 23)) | {45, 46, 47}
EPOCH_1900 = dt.datetime(1899, 12, 30)
EPOCH_1904 = dt.datetime(1904, 1, 1)
UNNAMED = "Unnamed: {}"

STRING, NUMBER, BOOL, DATE = "s", "n", "b", "d"
CELL_SCHEMA = "path STRING, row_no INT, col_no INT, kind STRING, text STRING"

_REF = re.compile(r"([A-Z]+)([0-9]+)")
_DATE_CODE = re.compile(r"[dmyhs]", re.IGNORECASE)


def _q(tag: str, ns: str = NS_MAIN) -> str:
    return f"{{{ns}}}{tag}"


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet_part(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find(f"{_q('sheets')}/{_q('sheet')}")
    rid = sheet.get(_q("id", NS_REL))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.findall(_q("Relationship", NS_PKG)):
        if rel.get("Id") == rid:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else "xl/" + target
    raise ValueError("workbook has no first sheet")


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    root = ET.fromstring(z.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in si.iter(_q("t"))) for si in root.findall(_q("si"))]


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = set()
    fmts = root.find(_q("numFmts"))
    if fmts is not None:
        for f in fmts.findall(_q("numFmt")):
            code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", ""))
            if _DATE_CODE.search(code):
                custom.add(int(f.get("numFmtId")))
    xfs = root.find(_q("cellXfs"))
    out = set()
    if xfs is not None:
        for i, xf in enumerate(xfs.findall(_q("xf"))):
            fid = int(xf.get("numFmtId", "0"))
            if fid in DATE_FORMAT_IDS or fid in custom:
                out.add(i)
    return out


def _epoch(z: zipfile.ZipFile) -> dt.datetime:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    pr = wb.find(_q("workbookPr"))
    return EPOCH_1904 if pr is not None and pr.get("date1904") in ("1", "true") else EPOCH_1900


def _number_text(value: str) -> str:
    return repr(float(value))


def workbook_cells(data: bytes) -> Iterator[tuple[int, int, str, str]]:
    """``(row_no, col_no, kind, text)`` for each non-empty cell of the first sheet
    (rows and columns 0-based)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        strings = _shared_strings(z)
        dates = _date_styles(z)
        epoch = _epoch(z)
        sheet = ET.fromstring(z.read(_first_sheet_part(z)))
    for row in sheet.iter(_q("row")):
        for pos, c in enumerate(row.findall(_q("c"))):
            ref = c.get("r")
            if ref:
                m = _REF.match(ref)
                col, r = _col_index(m.group(1)), int(m.group(2)) - 1
            else:
                col, r = pos, int(row.get("r")) - 1
            t = c.get("t", "n")
            v = c.find(_q("v"))
            if t == "inlineStr":
                node = c.find(_q("is"))
                text = "".join(x.text or "" for x in node.iter(_q("t"))) if node is not None else ""
                kind = STRING
            elif v is None or v.text is None:
                continue
            elif t == "s":
                text, kind = strings[int(v.text)], STRING
            elif t in ("str", "e"):
                text, kind = v.text, STRING
            elif t == "b":
                text, kind = ("true" if v.text == "1" else "false"), BOOL
            elif t == "d":
                text, kind = v.text.replace("T", " "), DATE
            elif int(c.get("s", "0")) in dates:
                stamp = epoch + dt.timedelta(days=float(v.text))
                text, kind = stamp.isoformat(sep=" "), DATE
            else:
                text, kind = _number_text(v.text), NUMBER
            if kind == STRING and text == "":
                continue
            yield r, col, kind, text


def _parse_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows = [(path, r, c, k, t) for r, c, k, t in workbook_cells(bytes(content))]
            yield pd.DataFrame(rows, columns=["path", "row_no", "col_no", "kind", "text"])


def excel_cells(spark: SparkSession, path: str) -> DataFrame:
    """Long form of every workbook under ``path``: ``(path, row_no, col_no, kind, text)``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return files.select("path", "content").mapInPandas(_parse_partition, CELL_SCHEMA)


def _column_type(kinds: dict[str, int], integral: bool) -> str:
    present = {k for k, n in kinds.items() if n}
    if present == {NUMBER}:
        return "bigint" if integral else "double"
    if present == {DATE}:
        return "timestamp"
    if present == {BOOL}:
        return "boolean"
    return "string"


def read_excel(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of each workbook; row 1 is the header.

    Column types: all numbers -> bigint (all integral) or double; all dates ->
    timestamp; all booleans -> boolean; otherwise string. Empty cells are NULL.
    A sheet without data rows is an error.
    """
    cells = excel_cells(spark, path)
    header_row = cells.groupBy("path").agg(F.min("row_no").alias("header_row"))
    # One row per workbook; AQE turns this into a broadcast join when the
    # measured size is small (no hint: the file count is not bounded here).
    tagged = cells.join(header_row, "path")
    data = tagged.filter(F.col("row_no") > F.col("header_row"))
    is_integral = (F.col("kind") != NUMBER) | (
        F.col("text").cast("double") == F.floor(F.col("text").cast("double"))
    )
    columns = (
        tagged.groupBy("col_no")
        .agg(
            F.min(F.when(F.col("row_no") == F.col("header_row"), F.col("text"))).alias("name"),
            *[
                F.count(F.when((F.col("row_no") > F.col("header_row")) & (F.col("kind") == k), 1)).alias(k)
                for k in (STRING, NUMBER, BOOL, DATE)
            ],
            F.min(F.when(F.col("row_no") > F.col("header_row"), is_integral.cast("int"))).alias("integral"),
        )
        .orderBy("col_no")
        .collect()
    )
    if not columns or not any(r[k] for r in columns for k in (STRING, NUMBER, BOOL, DATE)):
        raise ValueError("Excel sheet has no rows.")
    width = max(r["col_no"] for r in columns) + 1
    info = {r["col_no"]: r for r in columns}
    names, types = [], []
    for i in range(width):
        r = info.get(i)
        names.append(r["name"] if r is not None and r["name"] is not None else UNNAMED.format(i))
        kinds = {k: (r[k] if r is not None else 0) for k in (STRING, NUMBER, BOOL, DATE)}
        types.append(_column_type(kinds, bool(r is not None and r["integral"] in (1, None))))
    wide = (
        data.groupBy("path", "row_no")
        .pivot("col_no", list(range(width)))
        .agg(F.first("text"))
    )
    def typed(i: int, t: str):
        cell = F.col(f"`{i}`")
        return cell.cast("double").cast("bigint") if t == "bigint" else cell.cast(t)

    return wide.select(*[typed(i, t).alias(n) for i, (n, t) in enumerate(zip(names, types))])


# ---------------------------------------------------------------- writing


def _cell_xml(ref: str, value) -> str:
    if value is None or (isinstance(value, float) and value != value):
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    if isinstance(value, (dt.datetime, dt.date)):
        base = value if isinstance(value, dt.datetime) else dt.datetime(value.year, value.month, value.day)
        serial = (base - EPOCH_1900).total_seconds() / 86400
        return f'<c r="{ref}" s="1"><v>{serial!r}</v></c>'
    text = str(value).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return f'<c r="{ref}" t="inlineStr"><is><t>{text}</t></is></c>'


def _letters(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, rem = divmod(i - 1, 26)
        out = chr(65 + rem) + out
    return out


def workbook_bytes(header: list[str], rows: list[list]) -> bytes:
    """A minimal one-sheet ``.xlsx`` (inline strings, numbers, dates, booleans)."""
    lines = []
    for r, values in enumerate([header, *rows]):
        cells = "".join(_cell_xml(f"{_letters(c)}{r + 1}", v) for c, v in enumerate(values))
        lines.append(f'<row r="{r + 1}">{cells}</row>')
    sheet = (
        f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{NS_MAIN}"><sheetData>'
        + "".join(lines)
        + "</sheetData></worksheet>"
    )
    parts = {
        "[Content_Types].xml": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
            "</Types>"
        ),
        "_rels/.rels": (
            f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS_PKG}">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
            "</Relationships>"
        ),
        "xl/workbook.xml": (
            f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS_MAIN}" xmlns:r="{NS_REL}">'
            '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
        ),
        "xl/_rels/workbook.xml.rels": (
            f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS_PKG}">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'
            "</Relationships>"
        ),
        "xl/styles.xml": (
            f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{NS_MAIN}">'
            '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs>'
            "</styleSheet>"
        ),
        "xl/worksheets/sheet1.xml": sheet,
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return buf.getvalue()

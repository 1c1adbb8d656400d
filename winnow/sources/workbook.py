"""Workbooks: sheets of an .xlsx file read as rows, and tables written as one file of several tabs.

A sheet holds at most 1,048,576 rows by its format, so a workbook is a small, bounded
thing: it is read by one task a file and written by the driver, a tab at a time. Larger
tables go to CSV directories (:mod:`sinks`).
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from itertools import chain
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shaping import column_widths

MAX_ROWS = 1_048_575
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: characters that XML 1.0 cannot hold
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


def letters(i: int) -> str:
    """Name of a column counted from 0: A, B, .. Z, AA .."""
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def place(ref: str) -> int:
    """Column number of a cell's name."""
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheets(data: bytes) -> Iterator[tuple[str, list[list[str | None]]]]:
    """(name, rows of cell texts) of each sheet, in order."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        strings = []
        if "xl/sharedStrings.xml" in z.namelist():
            strings = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        target = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            path = target[sheet.get(_REL)].lstrip("/")
            rows = []
            for row in ElementTree.fromstring(z.read(path if path.startswith("xl/") else f"xl/{path}")).iter(f"{_MAIN}row"):
                cells: list[str | None] = []
                for c in row.iter(f"{_MAIN}c"):
                    at = place(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at - len(cells))
                    value = c.find(f"{_MAIN}v")
                    if c.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif value is None:
                        text = None
                    else:
                        text = strings[int(value.text)] if c.get("t") == "s" else value.text
                    cells.append(text)
                rows.append(cells)
            yield sheet.get("name"), rows


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, row, cells): the rows below the header, ``cells`` a map from header to text.

    A sheet with fewer than two rows has none. Files are read side by side.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b.path, b.content, strict=True):
                for sheet, rows in sheets(bytes(content)):
                    head = [h or "" for h in rows[0]] if rows else []
                    found = [(name, sheet, i, dict(zip(head, [*r, *[None] * len(head)]))) for i, r in enumerate(rows[1:])]
                    if found:
                        yield pd.DataFrame(found, columns=["file", "sheet", "row", "cells"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(each, "file string, sheet string, row long, cells map<string,string>")


def sheet_table(book: DataFrame, sheet: str, columns: list[str]) -> DataFrame:
    """One sheet of a read workbook as a table of text columns."""
    return book.where(F.col("sheet") == sheet).select(*[F.try_element_at("cells", F.lit(c)).alias(c) for c in columns])


def _sheet_xml(headers: list[str], widths: list[int], rows: Iterator[tuple]) -> bytes:
    out = io.StringIO()
    cols = "".join(f'<col min="{i}" max="{i}" width="{w}" customWidth="1"/>' for i, w in enumerate(widths, 1))
    out.write(f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{_MAIN[1:-1]}">{f"<cols>{cols}</cols>" if cols else ""}<sheetData>')
    names = [letters(i) for i in range(len(headers))]
    for n, row in enumerate(chain([headers], rows), 1):
        if n > MAX_ROWS + 1:
            raise ValueError(f"a sheet holds at most {MAX_ROWS} rows below its header; write such a table as CSV")
        cells = []
        for name, v in zip(names, row, strict=True):
            if v is None:
                continue
            if isinstance(v, (int, float)) and not isinstance(v, bool):
                cells.append(f'<c r="{name}{n}"><v>{v}</v></c>')
            else:
                text = str(v).lower() if isinstance(v, bool) else _BAD.sub("", str(v))
                cells.append(f'<c r="{name}{n}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
        out.write(f'<row r="{n}">{"".join(cells)}</row>')
    out.write("</sheetData></worksheet>")
    return out.getvalue().encode()


def workbook_bytes(tabs: list[tuple[str, list[str], list[int], Iterator[tuple]]]) -> bytes:
    """An .xlsx file of (name, headers, widths, rows) tabs."""
    out = io.BytesIO()
    kinds = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    office = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for i, (_, headers, widths, rows) in enumerate(tabs, 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", _sheet_xml(headers, widths, rows))
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{office}.worksheet+xml"/>' for i in range(1, len(tabs) + 1))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{office}.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{kinds}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name={quoteattr(name[:31])} sheetId="{i}" r:id="rId{i}"/>' for i, (name, *_) in enumerate(tabs, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{kinds}"><sheets>{names}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i}" Type="{kinds}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(tabs) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}/relationships">{rels}</Relationships>')
    return out.getvalue()


def write_workbook(tables: dict[str, DataFrame], path: str) -> None:
    """The tables as tabs of one workbook, put in place as a whole.

    An empty table becomes a tab with its header only, so no row of an earlier run stays;
    tabs of an existing workbook that have no table are kept. Tables beyond what a sheet
    holds are refused.
    """
    first = next(iter(tables.values()))
    spark = first.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tabs = []
    for name, df in tables.items():
        widths = [r.width for r in column_widths(df).collect()] if df.columns else []  # one row a column
        rows = map(tuple, df.limit(MAX_ROWS + 1).toLocalIterator())
        tabs.append((name, df.columns, widths, rows))
    if files.exists(target):
        old = bytes(spark.read.format("binaryFile").load(path).select("content").first().content)
        for name, rows in sheets(old):
            if name not in tables:
                head = [h or "" for h in (rows[0] if rows else [])]
                tabs.append((name, head, [], iter([tuple([*r, *[None] * len(head)][: len(head)]) for r in rows[1:]])))
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = files.create(fresh, True)
    out.write(bytearray(workbook_bytes(tabs)))
    out.close()
    files.delete(target, False)
    files.rename(fresh, target)

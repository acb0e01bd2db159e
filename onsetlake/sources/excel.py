"""Excel workbooks (``.xlsx``) as a DataFrame source.

Files are listed and read by Spark (``binaryFile``, any storage Spark can
read), one workbook per row; ``mapInPandas`` turns each workbook into rows
on the executors, so a folder of workbooks is parsed in parallel and no
workbook passes through the driver except the first one's header row.

An ``.xlsx`` file is a zip of XML parts: cell values live in
``xl/worksheets/sheetN.xml``, text cells point into ``xl/sharedStrings.xml``.
Every value is returned as text, as the delimited reader does; typing is the
job of :func:`onsetlake.operators.clean.cast_by_rules`.  Numbers that the
workbook's styles show as dates come back as ISO dates.  Columns are matched
by their names, workbook by workbook.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _date_styles(zf: zipfile.ZipFile) -> tuple[set[int], dt.date]:
    """Cell styles that show a number as a date, and the day that number 0 stands for."""
    base = dt.date(1899, 12, 30)
    if "xl/workbook.xml" in zf.namelist():
        props = ET.fromstring(zf.read("xl/workbook.xml")).find("m:workbookPr", _NS)
        if props is not None and props.get("date1904") in ("1", "true"):
            base = dt.date(1904, 1, 1)
    if "xl/styles.xml" not in zf.namelist():
        return set(), base
    root = ET.fromstring(zf.read("xl/styles.xml"))
    codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.findall("m:numFmts/m:numFmt", _NS)}
    shows = lambda i: i in _DATE_FORMATS or bool(re.search("[ymd]", _QUOTED.sub("", codes.get(i, "").lower())))
    return {k for k, xf in enumerate(root.findall("m:cellXfs/m:xf", _NS)) if shows(int(xf.get("numFmtId", "0")))}, base


# The built-in number formats that show dates.
_DATE_FORMATS = frozenset((14, 15, 16, 17, 22))
_QUOTED = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')


def workbook_rows(content: bytes, sheet: int = 1) -> list[list[str | None]]:
    """All rows of one sheet as lists of text (None for empty cells)."""
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in zf.namelist():
            root = ET.fromstring(zf.read("xl/sharedStrings.xml"))
            shared = [_text(si) for si in root.findall("m:si", _NS)]
        dates, base = _date_styles(zf)
        root = ET.fromstring(zf.read(f"xl/worksheets/sheet{sheet}.xml"))
    rows = []
    for row in root.iter(f"{{{_NS['m']}}}row"):
        cells: dict[int, str | None] = {}
        for pos, c in enumerate(row.findall("m:c", _NS)):
            ref = _CELL_REF.match(c.get("r", ""))
            idx = _col_index(ref.group(1)) if ref else pos
            kind = c.get("t")
            v = c.find("m:v", _NS)
            if kind == "s" and v is not None:
                cells[idx] = shared[int(v.text)]
            elif kind == "inlineStr":
                is_node = c.find("m:is", _NS)
                cells[idx] = _text(is_node) if is_node is not None else None
            elif kind == "b" and v is not None:
                cells[idx] = "true" if v.text == "1" else "false"
            elif v is not None and int(c.get("s", "0")) in dates and kind in (None, "n"):
                cells[idx] = (base + dt.timedelta(days=int(float(v.text)))).isoformat()
            else:
                cells[idx] = v.text if v is not None else None
        width = max(cells) + 1 if cells else 0
        rows.append([cells.get(i) for i in range(width)])
    return rows


def read_excel(spark: SparkSession, path: str, header: bool = True, sheet: int = 1,
               columns: list[str] | None = None) -> DataFrame:
    """SRC2/SRC7: every ``.xlsx`` under ``path`` as string columns."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    return read_workbooks(files, header, sheet, columns)


def read_workbooks(files: DataFrame, header: bool = True, sheet: int = 1, columns: list[str] | None = None) -> DataFrame:
    """Workbooks given as ``(path, content)`` rows, as string columns.

    With ``header`` the first row of each sheet names its columns; all names
    that occur (or ``columns``) make up the result, a workbook's missing ones
    are null, and names beyond ``columns`` fail the query.  Without, columns go
    by position and a row that is too wide fails.
    """
    if columns is None:
        def first_row(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                heads = [(workbook_rows(bytes(content), sheet) or [[]])[0] for content in batch["content"]]
                if not header:
                    heads = [[f"_c{i}" for i in range(len(h))] for h in heads]
                yield pd.DataFrame({"path": batch["path"], "head": [[h for h in head if h is not None] for head in heads]})

        heads = files.mapInPandas(first_row, "path string, head array<string>") \
            .groupBy("head").agg(F.min("path").alias("path")).orderBy("path").collect()
        columns = list(dict.fromkeys(name for r in heads for name in r["head"]))
    names = list(columns)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = workbook_rows(bytes(content), sheet)
                own = (rows[0] if rows else []) if header else names
                unknown = [n for n in own if n is not None and n not in names]
                if unknown:
                    raise ValueError(f"{path} has columns that are not expected: {unknown}")
                body = rows[1:] if header else rows
                if any(v is not None for r in body for v in r[len(own):]):
                    raise ValueError(f"{path} has cells beyond its last column")
                table = pd.DataFrame([(r + [None] * len(own))[:len(own)] for r in body], columns=own, dtype=object)
                yield table[[n for n in own if n is not None]].reindex(columns=names).astype(object).where(lambda t: t.notna(), None)

    return files.select("path", "content").mapInPandas(parse, schema)


def read_excel_typed(spark: SparkSession, path: str, dtypes: dict[str, T.DataType]) -> DataFrame:
    """SRC8: workbook read with a declared type per column (``try_cast``)."""
    raw = read_excel(spark, path)
    return raw.select(*[
        (F.col(f"`{c}`").try_cast(dtypes[c]) if c in dtypes else F.col(f"`{c}`")).alias(c) for c in raw.columns
    ])

"""Excel source: a minimal workbook written by hand, read and rule-cast."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import types as T

from onsetlake.operators import clean
from onsetlake.sources import excel

SHEET = """<?xml version="1.0" encoding="UTF-8"?>
<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c>
<c r="D1" t="s"><v>3</v></c><c r="E1" t="inlineStr"><is><t>reproduction_rate</t></is></c></row>
<row r="2"><c r="A2" t="s"><v>4</v></c><c r="B2" t="s"><v>5</v></c><c r="C2" t="s"><v>6</v></c>
<c r="D2"><v>83000000</v></c><c r="E2"><v>1.25</v></c></row>
<row r="3"><c r="A3" t="s"><v>7</v></c><c r="C3" t="s"><v>6</v></c><c r="E3"><v>0.5</v></c></row>
</sheetData></worksheet>"""

STRINGS = ["location", "continent", "date", "population", "Germany", "Europe", "2021-03-01", "World"]


def _write_xlsx(path: Path) -> None:
    sst = ('<?xml version="1.0" encoding="UTF-8"?><sst xmlns="http://schemas.openxmlformats.org/'
           'spreadsheetml/2006/main">' + "".join(f"<si><t>{s}</t></si>" for s in STRINGS) + "</sst>")
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/worksheets/sheet1.xml", SHEET)
        zf.writestr("xl/sharedStrings.xml", sst)


def test_read_and_rule_cast_workbooks(spark):
    d = Path(tempfile.mkdtemp(prefix="onsetlake-xlsx-"))
    _write_xlsx(d / "Data2_a.xlsx")
    _write_xlsx(d / "Data2_b.xlsx")
    raw = excel.read_excel(spark, str(d))
    assert raw.columns == ["location", "continent", "date", "population", "reproduction_rate"]
    typed = clean.cast_by_rules(raw)
    rows = sorted(typed.collect(), key=lambda r: (r.location, r.population or 0))
    assert len(rows) == 4
    ger = [r for r in rows if r.location == "Germany"][0]
    world = [r for r in rows if r.location == "World"][0]
    assert ger.population == 83000000 and ger.reproduction_rate == 1.25 and str(ger.date) == "2021-03-01"
    assert world.continent is None and world.population is None and world.reproduction_rate == 0.5
    typed2 = excel.read_excel_typed(spark, str(d), {"population": T.LongType()})
    assert dict(typed2.dtypes)["population"] == "bigint"


def _sheet(path: Path, rows: list[list[str]]) -> None:
    cells = lambda r, k: "".join(
        f'<c r="{chr(65 + i)}{k}" {v if v.startswith("s=") else "t=" + chr(34) + "inlineStr" + chr(34)}>'
        + (f"<v>{v.split('|')[1]}</v>" if v.startswith("s=") else f"<is><t>{v}</t></is>") + "</c>" for i, v in enumerate(r))
    fix = lambda text: text.replace('s="1"|44256', 's="1"')
    body = "".join(f'<row r="{k}">{cells(r, k)}</row>' for k, r in enumerate(rows, 1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as zf:
        zf.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{fix(body)}</sheetData></worksheet>")
        zf.writestr("xl/styles.xml", f'<styleSheet {ns}><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
                                     '<cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>')


def test_columns_by_name_and_true_dates(spark):
    import pytest

    d = Path(tempfile.mkdtemp(prefix="onsetlake-xlsx-"))
    _sheet(d / "a.xlsx", [["location", "date"], ["Peru", 's="1"|44256']])
    _sheet(d / "b.xlsx", [["date", "extra", "location"], ['s="1"|44256', "x", "Chile"]])
    rows = {r.location: (r.date, r.extra) for r in excel.read_excel(spark, str(d)).collect()}
    assert rows == {"Peru": ("2021-03-01", None), "Chile": ("2021-03-01", "x")}
    with pytest.raises(Exception, match="not expected"):
        excel.read_excel(spark, str(d), columns=["location", "date"]).collect()

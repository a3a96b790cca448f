import zipfile
from xml.sax.saxutils import escape

import pytest

from benefacta.plans import lifetime
from benefacta.sources import readers, registry, spreadsheet
from benefacta.sources.schemas import INFLATION_PERIOD, INFLATION_RATE

SPACE = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_book(path, sheets):
    """Sheets as rows of cells: texts are shared, numbers plain, None left out."""
    texts: list[str] = []

    def cell(column, row, value):
        reference = f"{chr(65 + column)}{row}"
        if isinstance(value, str):
            if value not in texts:
                texts.append(value)
            return f'<c r="{reference}" t="s"><v>{texts.index(value)}</v></c>'
        return f'<c r="{reference}"><v>{value}</v></c>'

    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook {SPACE} xmlns:r="{LINKS}"><sheets>{names}</sheets></workbook>')
        targets = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        for i, rows in enumerate(sheets.values(), 1):
            lines = "".join(f'<row r="{n}">' + "".join(cell(c, n, v) for c, v in enumerate(row) if v is not None) + "</row>" for n, row in rows)
            book.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {SPACE}><sheetData>{lines}</sheetData></worksheet>")
        shared = "".join(f"<si><r><t>{escape(t[:3])}</t></r><rPh><t>aid</t></rPh><r><t>{escape(t[3:])}</t></r></si>" if i % 2 else f"<si><t>{escape(t)}</t></si>"
                         for i, t in enumerate(texts))
        book.writestr("xl/sharedStrings.xml", f"<sst {SPACE}>{shared}</sst>")


INFLATION = {
    "Notas": [(1, ["nothing here"])],
    "Series": [(1, ["Inflación & meta"]), (3, [None, "Banco"]), (8, [INFLATION_PERIOD, "Meta", f" {INFLATION_RATE} "]),
               (9, [202102, 3, 3.5]), (10, ["202101", 3, "1,5"]), (11, [2.02012e5, None, 2.0]), (12, [202011, 1, None]),
               (14, ["Fuente: 202012 <DANE>"]), (20, ["Descargado", "hoy"])],
}


def test_inflation_round_trip(spark, tmp_path):
    path = str(tmp_path / "serie.xlsx")
    write_book(path, INFLATION)
    monthly = spreadsheet.read_inflation_sheet(spark, path, "Series")
    assert sorted(tuple(r) for r in monthly.collect()) == [("202011", None), ("202012", 2.0), ("202101", 1.5), ("202102", 3.5)]
    assert sorted(tuple(r) for r in spreadsheet.read_inflation_sheet(spark, f"file://{path}", "2").collect()) == sorted(map(tuple, monthly.collect()))
    export = tmp_path / "serie.csv"
    export.write_text("title\n\n202102;3,5\n202101;1,5\n202012;2\n202011;\nnote", encoding="latin-1")
    of = lambda m: sorted(tuple(r) for r in lifetime.inflation_yearly(m).collect())
    assert of(monthly) == of(readers.read_inflation_export(spark, str(export)))


def test_raw_rows_folders_and_named_sources(spark, tmp_path):
    for name in ("a", "b"):
        write_book(str(tmp_path / f"{name}.xlsx"), {"One": [(2, ["x", None, name]), (4, [1.25])]})
    (tmp_path / "other.txt").write_text("no sheet")
    spreadsheet.register(spark)
    rows = spark.read.format("sheet").load(str(tmp_path)).collect()
    assert sorted((r["file"][-6:], r["row"], r["cells"]) for r in rows) == [
        ("a.xlsx", 2, ["x", None, "a"]), ("a.xlsx", 4, ["1.25"]), ("b.xlsx", 2, ["x", None, "b"]), ("b.xlsx", 4, ["1.25"])]
    registry.register("sheets", registry.Source("a.xlsx", file_format="sheet"))
    assert registry.load(spark, "sheets", str(tmp_path)).count() == 2
    assert spark.sql("SELECT max(row) AS r FROM sheets").first()["r"] == 4


def test_missing_sheets_headers_and_files(spark, tmp_path):
    path = str(tmp_path / "serie.xlsx")
    write_book(path, INFLATION)
    with pytest.raises(Exception, match="no sheet 'Other'"):
        spreadsheet.read_inflation_sheet(spark, path, "Other").collect()
    with pytest.raises(Exception, match="no row holds the headers"):
        spreadsheet.read_inflation_sheet(spark, path).collect()
    with pytest.raises(Exception, match="missing.xlsx"):
        spreadsheet.read_inflation_sheet(spark, str(tmp_path / "missing.xlsx")).collect()


def test_inline_texts_and_cells_without_places(tmp_path):
    path = tmp_path / "x.xlsx"
    write_book(str(path), {"One": []})
    with zipfile.ZipFile(path) as book:
        parts = {n: book.read(n) for n in book.namelist()}
    parts["xl/worksheets/sheet1.xml"] = (f'<worksheet {SPACE}><sheetData><row><c t="inlineStr"><is><t>in</t></is></c><c t="b"><v>1</v></c>'
                                         f'<c t="str"><v>f</v></c><c/></row><row><c r="AB2"><v>3.0</v></c></row></sheetData></worksheet>').encode()
    with zipfile.ZipFile(path, "w") as book:
        for name, data in parts.items():
            book.writestr(name, data)
    assert list(spreadsheet.sheet_rows(str(path))) == [(1, ["in", "1", "f", None]), (2, [None] * 27 + ["3"])]

"""Workbooks: round trips of several sheets, headers that are sought, shared texts, damaged ends."""

import zipfile
from datetime import datetime

from pyspark.sql import functions as F

from tessera.sources import workbooks as wb


def test_round_trip_of_sheets(spark, tmp_path):
    odd = ["plain", " kept  spaces ", "line\nend\r\ntab\t", "a<b>&\"c\"", "\x00\x1f control", "_x0041_ as it is", "é العربية 😀", "", None]
    rows = [(k, t, f"S{k % 2}/x", k * 1.5 if k else None, k % 3 == 0, [k]) for k, t in enumerate(odd * 3)]
    df = spark.createDataFrame(rows, "id long, Texte string, feuille string, score double, ok boolean, l array<int>").repartition(2)
    path = (tmp_path / "books").as_uri()
    wb.write_workbook(df, path, sheet_column="feuille")
    back = wb.read_workbook(spark, path, "id long, texte string, score double, ok boolean, l string, _sheet string, _row int")
    assert back.rdd.getNumPartitions() == 4
    got = {r.id: (r.texte, r.score, r.ok, r.l, r._sheet) for r in back.collect()}
    assert got == {k: (t or None, s, o, f"[{k}]", f"S{k % 2}_x") for k, t, _, s, o, _ in rows}
    assert min(r._row for r in back.collect()) == 2
    one = wb.read_workbook(spark, path, "id long", sheet="S1_x")
    assert sorted(r.id for r in one.collect()) == [k for k in range(27) if k % 2]
    wb.write_workbook(df.limit(1), path)
    assert wb.read_workbook(spark, path, "id long").count() == 1


def book(path, rows, shared=(), cut=None):
    head = f'<worksheet xmlns="{wb._MAIN}"><sheetData>'
    sheet = head + "".join(rows) + "</sheetData></worksheet>"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{wb._MAIN}" xmlns:r="{wb._REL}"><sheets><sheet name="Export" sheetId="1" r:id="x"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{wb._PACKAGE}"><Relationship Id="x" Target="/xl/worksheets/one.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{wb._MAIN}">' + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/one.xml", sheet[:cut] if cut else sheet)


def test_header_on_a_later_row(spark, tmp_path):
    """A title above, French headings, cells left out, rich and shared texts, errors, day numbers, text where a number should be."""
    s = ["<t>Rapport</t>", "<t>Commentaire Client</t>", "<t> date </t>", "<r><t>tres </t></r><r><t>bien</t></r><rPh><t>aid</t></rPh>"]
    rows = ['<row r="1"><c r="A1" t="s"><v>0</v></c></row>', '<row r="2"><c r="B2" t="s"><v>1</v></c><c r="D2" t="s"><v>2</v></c><c r="AA2" t="inlineStr"><is><t>N</t></is></c></row>', "<row r='3'/>"]
    rows += ['<row r="4"><c r="B4" t="s"><v>3</v></c><c r="D4"><v>45292.5</v></c><c r="AA4"><v>3.0</v></c></row>', '<row r="6"><c r="B6" t="e"><v>#N/A</v></c><c r="AA6" t="str"><v>many</v></c></row>', '<row r="7"><c r="C7"><v>1</v></c></row>']
    book(tmp_path / "a.xlsx", rows, s)
    titles = {"texte": "commentaire client", "jour": "Date", "n": "n"}
    got = wb.read_workbook(spark, (tmp_path / "a.xlsx").as_uri(), "texte string, jour double, n int, absent string, _row int", titles)
    found = got.select("texte", wb.serial_date(F.col("jour")).alias("d"), "n", "absent", "_row").orderBy("_row").collect()
    assert [tuple(r) for r in found] == [("tres bien", datetime(2024, 1, 1, 12), 3, None, 4), (None, None, None, None, 6)]


def test_damaged_and_foreign_sheets(spark, tmp_path):
    cell = lambda v: f'<c t="inlineStr"><is><t>{v}</t></is></c>'
    rows = [f"<row>{cell('a')}{cell('b')}</row>"] + [f"<row>{cell(k)}{cell(k)}</row>" for k in range(50)]
    book(tmp_path / "cut.xlsx", rows, cut=2000)
    book(tmp_path / "none.xlsx", [f"<row>{cell('x')}</row>"] * 30)
    n = wb.read_workbook(spark, tmp_path.as_uri(), "a int, b int").collect()
    assert 10 < len(n) < 50 and [tuple(r) for r in sorted(n)] == [(k, k) for k in range(len(n))]


def test_names_of_sheets():
    assert wb._sheet_names(["a/b", "A_b", "x" * 40, "x" * 35, ""]) == ["a_b", "A_b~2", "x" * 31, "x" * 29 + "~2", "_"]

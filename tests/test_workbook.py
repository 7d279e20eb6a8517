import datetime as dt
import zipfile

import pytest
from pyspark.sql import types as T

from fundsift.sources import files, schemas, workbook

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def save(path, rows, strings=(), styles="", book="", other="<row><c t='inlineStr'><is><t>x</t></is></c></row>"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook {MAIN} xmlns:r="{LINK}">{book}<sheets><sheet name="Funds" sheetId="1" r:id="rId7"/>'
            '<sheet name="Other" sheetId="2" r:id="rId8"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId8" Target="/xl/worksheets/sheet2.xml"/><Relationship Id="rId7" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{''.join(f'<si>{s}</si>' for s in strings)}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{styles}</styleSheet>")
        for name, data in (("sheet1", rows), ("sheet2", other)):
            z.writestr(f"xl/worksheets/{name}.xml", f"<worksheet {MAIN}><sheetData>{data}</sheetData></worksheet>")


SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("days", T.DoubleType()),
        T.StructField("since", T.StringType()),
        T.StructField("absent", T.StringType()),
    ]
)
STYLES = (
    '<numFmts><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/><numFmt numFmtId="165" formatCode="0 &quot;days&quot;"/></numFmts>'
    '<cellStyleXfs><xf numFmtId="14"/></cellStyleXfs>'
    '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
)
STRINGS = ["<t>id</t>", "<t> name </t>", "<t>days</t>", "<t>since</t>", "<t>Ação &amp; Co</t>", "<r><t>Two </t></r><r><t>parts</t></r><rPh><t>no</t></rPh>"]
HEAD = "<row><c t='s'><v>0</v></c><c t='s'><v>1</v></c><c t='s'><v>2</v></c><c r='E1' t='s'><v>3</v></c></row>"


def test_cells_of_every_kind(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    body = (
        "<row/><row r='3'><c r='A3'><v>12345678000190</v></c><c r='B3' t='s'><v>4</v></c><c r='C3' s='3'><v>30</v></c><c r='E3' s='1'><v>45292</v></c></row>"
        "<row><c r='B4' t='s'><v>5</v></c><c r='A4'><v>1.5E1</v></c><c r='C4' t='e'><v>#N/A</v></c><c r='E4' s='2'><v>45292.5</v></c></row>"
        "<row><c t='n'><v>7.0</v></c><c t='inlineStr'><is><t>in line</t></is></c><c><f>1+1</f><v>2</v></c><c/><c t='str'><v>text</v></c></row>"
        "<row><c r='Z9'/></row>"
    )
    save(path, HEAD + body, STRINGS, STYLES)
    found = workbook.read_sheet(spark, path, SCHEMA).collect()
    assert [tuple(r) for r in found] == [
        (12345678000190, "Ação & Co", 30.0, "2024-01-01", None),
        (15, "Two parts", None, "2024-01-01 12:00:00", None),
        (7, "in line", 2.0, "text", None),
    ]
    assert workbook.read_sheet(spark, path, SCHEMA).schema == SCHEMA


def test_sheets_and_date_systems(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    one = T.StructType([T.StructField("day", T.DateType())])
    other = "<row><c t='inlineStr'><is><t>day</t></is></c></row><row><c s='1'><v>1</v></c></row>"
    save(path, HEAD, STRINGS, STYLES, '<workbookPr date1904="1"/>', other)
    assert workbook.read_sheet(spark, path, one, "Other").first().day == dt.date(1904, 1, 2)
    assert workbook.read_sheet(spark, path, SCHEMA).count() == 0
    with pytest.raises(Exception, match="no sheet Nowhere"):
        workbook.read_sheet(spark, path, one, "Nowhere").count()
    save(path, "")
    assert workbook.read_sheet(spark, path, SCHEMA).count() == 0


def test_wrong_types_fail_the_read(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    save(path, HEAD + "<row><c t='s'><v>4</v></c></row>", STRINGS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        workbook.read_sheet(spark, path, SCHEMA).collect()


def test_many_rows_in_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "book.xlsx")
    save(path, HEAD + "".join(f"<row><c><v>{k}</v></c></row>" for k in range(12_003)), STRINGS)
    assert sorted(r.id for r in workbook.read_sheet(spark, path, SCHEMA).select("id").collect()) == list(range(12_003))


def test_registry_from_a_workbook(spark, tmp_path):
    path = str(tmp_path / "registry.xlsx")
    names = schemas.REGISTRY.fieldNames()
    values = {"CNPJ do Fundo": "<v>11</v>", "Prazo Pagamento Resgate em dias": "<v>30</v>"}
    head = "".join(f"<c t='inlineStr'><is><t>{n}</t></is></c>" for n in names)
    row = "".join(f"<c>{values[n]}</c>" if n in values else f"<c t='inlineStr'><is><t>{n[:6]}</t></is></c>" for n in names)
    save(path, f"<row>{head}</row><row>{row}</row>")
    table = files.registry_source(spark, path, schemas.REGISTRY)
    assert table.schema == schemas.REGISTRY
    found = table.first()
    assert (found["CNPJ do Fundo"], found["Prazo Pagamento Resgate em dias"], found["Status"]) == (11, 30.0, "Status")

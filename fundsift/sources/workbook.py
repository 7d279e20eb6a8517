"""Sheets of Office Open XML workbooks as tables: the registry comes as one."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree.ElementTree import Element, iterparse, parse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an output batch.
BATCH = 5_000

# Fixed values of the format: built-in number formats that show a date or time.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_QUOTED = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')
_COLUMN = re.compile(r"[A-Z]+")
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _name(element: Element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _texts(element: Element) -> str:
    """Text of a string item, whose parts may be formatted apart; phonetic hints do not count."""
    if _name(element) == "rPh":
        return ""
    own = element.text or "" if _name(element) == "t" else ""
    return own + "".join(map(_texts, element))


def _column(reference: str) -> int:
    number = 0
    for letter in _COLUMN.match(reference).group():
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


class Workbook:
    """One workbook; strings and styles are held, rows of a sheet are read one by one."""

    def __init__(self, content: bytes):
        self.files = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.files.namelist())
        self.strings = [_texts(item) for item in self._parts("xl/sharedStrings.xml", "si")]
        self.dates = self._date_styles()
        book = parse(self.files.open("xl/workbook.xml")).getroot()
        properties = [e for e in book.iter() if _name(e) == "workbookPr"]
        late = bool(properties) and properties[0].get("date1904") in ("1", "true")
        self.first_day = dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)
        self.sheets = {e.get("name"): e.get(_RELATION) for e in book.iter() if _name(e) == "sheet"}

    def _parts(self, file: str, tag: str) -> Iterator[Element]:
        if file not in self.names:
            return
        for _, element in iterparse(self.files.open(file)):
            if _name(element) == tag:
                yield element
                element.clear()

    def _date_styles(self) -> set[int]:
        """Numbers of the cell styles that show dates."""
        if "xl/styles.xml" not in self.names:
            return set()
        root = parse(self.files.open("xl/styles.xml")).getroot()
        own = {int(e.get("numFmtId")): _QUOTED.sub("", e.get("formatCode", "")) for e in root.iter() if _name(e) == "numFmt"}
        shown = _DATE_FORMATS | {k for k, code in own.items() if re.search("[ymdhs]", code, re.IGNORECASE)}
        formats = next((e for e in root if _name(e) == "cellXfs"), [])
        return {k for k, e in enumerate(formats) if int(e.get("numFmtId", 0)) in shown}

    def _file_of(self, sheet: str | None) -> str:
        if sheet is not None and sheet not in self.sheets:
            raise ValueError(f"no sheet {sheet}; there are {', '.join(self.sheets)}")
        relation = self.sheets[sheet] if sheet is not None else next(iter(self.sheets.values()))
        links = parse(self.files.open("xl/_rels/workbook.xml.rels")).getroot()
        target = next(e.get("Target") for e in links if e.get("Id") == relation)
        return target.lstrip("/") if target.startswith("/") else f"xl/{target}"

    def _value(self, cell: Element) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            return "".join(_texts(e) for e in cell if _name(e) == "is")
        found = next((e.text for e in cell if _name(e) == "v"), None)
        if found is None or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(found)]
        if kind == "b":
            return "true" if found == "1" else "false"
        if kind == "n" and int(cell.get("s", 0)) in self.dates:
            moment = self.first_day + dt.timedelta(days=float(found))
            return moment.date().isoformat() if moment.time() == dt.time() else moment.isoformat(" ", "seconds")
        return found

    def rows(self, sheet: str | None = None) -> Iterator[dict[int, str]]:
        """Cells of each row by column from 0; empty cells and rows are left out."""
        for row in self._parts(self._file_of(sheet), "row"):
            cells, at = {}, -1
            for cell in row:
                at = _column(cell.get("r")) if cell.get("r") else at + 1
                if value := self._value(cell):
                    cells[at] = value
            if cells:
                yield cells


def _reader(columns: list[str], sheet: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows = Workbook(content.as_py()).rows(sheet)
                header = {name.strip(): k for k, name in next(rows, {}).items()}
                held: list[list[str | None]] = []
                for cells in rows:
                    held.append([cells.get(header[c]) if c in header else None for c in columns])
                    if len(held) == BATCH:
                        yield _record(held, columns)
                        held = []
                yield _record(held, columns)

    return run


def _record(rows: list[list[str | None]], columns: list[str]) -> pa.RecordBatch:
    parts = list(zip(*rows)) or [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(p, pa.string()) for p in parts], columns)


def read_sheet(spark: SparkSession, path: str, declared: T.StructType, sheet: str | None = None) -> DataFrame:
    """A sheet (the first unless named) of one workbook or of a folder of them, in the declared columns.

    The first row that is not empty has the names; declared columns that are not there are null, others are left
    out. Cells come as shown: dates as ISO dates, formulas by their last value, errors as null. A value
    that is not of the declared type fails the read. A workbook is read by one task, row by row.
    """
    books = spark.read.format("binaryFile").load(path).select("content")
    names = declared.fieldNames()
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = books.mapInArrow(_reader(names, sheet), text)
    # Whole numbers may be stored as 12.0 or 1.2E1.
    typed = {"bigint": lambda c: c.cast("decimal(38,10)").cast("bigint"), "int": lambda c: c.cast("decimal(38,10)").cast("int")}
    return rows.select(
        *[typed.get(f.dataType.simpleString(), lambda c, f=f: c.cast(f.dataType))(F.col(f"`{f.name}`")).alias(f.name) for f in declared.fields]
    )

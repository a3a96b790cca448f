"""Spreadsheets as a data source: sheet rows from the zipped XML of ``.xlsx`` files, one task per file.

``spark.read.format("sheet")`` gives ``file``, ``row`` (from 1) and ``cells`` (text). With ``columns``, headers one to a line, it gives these
columns as text instead: the header row is the first that holds all of them, so title lines above it do not matter, and with
``keep`` only rows whose first column matches that pattern are data, which drops footnotes wherever they begin. ``sheet``
names a sheet or its number; the first one is read otherwise. Paths are whatever ``pyarrow.fs`` opens: files, folders,
and URIs of shared stores. Rows are streamed; a task holds the file's table of texts.
"""

from __future__ import annotations

import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from .schemas import INFLATION_PERIOD, INFLATION_RATE

RAW = "file string, row int, cells array<string>"
PERIOD = "^[0-9]{6}$"


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


def _texts(book: zipfile.ZipFile) -> list[str]:
    """The table of shared texts; formatted runs are joined, reading aids left out."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as data:
        for _, element in ElementTree.iterparse(data):
            if _tag(element) == "si":
                out.append(_joined(element))
                element.clear()
    return out


def _joined(element) -> str:
    parts = []
    for child in element:
        if _tag(child) == "t":
            parts.append(child.text or "")
        elif _tag(child) == "r":
            parts += [t.text or "" for t in child if _tag(t) == "t"]
    return "".join(parts)


def _sheet_part(book: zipfile.ZipFile, wanted: str | None) -> str:
    """The part of the archive that holds a sheet, by name or number."""
    workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
    sheets = [e for e in workbook.iter() if _tag(e) == "sheet"]
    names = [s.get("name") for s in sheets]
    if wanted is None:
        at = 0
    elif wanted in names:
        at = names.index(wanted)
    elif wanted.isdigit() and 0 < int(wanted) <= len(sheets):
        at = int(wanted) - 1
    else:
        raise ValueError(f"no sheet {wanted!r}; there are {', '.join(map(repr, names))}")
    link = next(v for k, v in sheets[at].attrib.items() if k.rpartition("}")[2] == "id" and k != "sheetId")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(e.get("Target") for e in links if e.get("Id") == link)
    return target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))


def _column(reference: str) -> int:
    """0 for A, 25 for Z, 26 for AA."""
    n = 0
    for letter in reference.rstrip("0123456789"):
        n = n * 26 + ord(letter.upper()) - 64
    return n - 1


def _value(cell, texts: list[str]) -> str | None:
    held = {_tag(e): e for e in cell}
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _joined(held["is"]) if "is" in held else None
    text = held["v"].text if "v" in held else None
    if text is None:
        return None
    if kind == "s":
        return texts[int(text)]
    if kind == "n" and not re.fullmatch(r"-?[0-9]+", text) and float(text).is_integer():
        return str(int(float(text)))  # whole numbers written with a point or an exponent
    return text


def sheet_rows(data, sheet: str | None = None) -> Iterator[tuple[int, list[str | None]]]:
    """Number and cells of each row of one sheet; empty cells are null up to the last one held."""
    with zipfile.ZipFile(data) as book:
        texts = _texts(book)
        with book.open(_sheet_part(book, sheet)) as part:
            number = 0
            for _, element in ElementTree.iterparse(part):
                if _tag(element) != "row":
                    continue
                number = int(element.get("r", number + 1))
                cells: list[str | None] = []
                for cell in element:
                    if _tag(cell) == "c":
                        at = _column(cell.get("r")) if cell.get("r") else len(cells)
                        cells += [None] * (at + 1 - len(cells))
                        cells[at] = _value(cell, texts)
                yield number, cells
                element.clear()


def columns_of(rows: Iterator[tuple[int, list[str | None]]], columns: list[str], keep: str | None = None) -> Iterator[tuple]:
    """The named columns of the rows below the header row; with ``keep`` those whose first column matches."""
    places = None
    for _, cells in rows:
        stripped = [c.strip() if c is not None else None for c in cells]
        if places is None:
            if all(c in stripped for c in columns):
                places = [stripped.index(c) for c in columns]
            continue
        values = tuple(stripped[p] if p < len(stripped) else None for p in places)
        if (any(v is not None for v in values) if keep is None else values[0] is not None and re.search(keep, values[0])):
            yield values
    if places is None:
        raise ValueError(f"no row holds the headers {', '.join(map(repr, columns))}")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", path) else (fs.LocalFileSystem(), path)


class _File(InputPartition):
    def __init__(self, path: str, name: str):
        self.path, self.name = path, name


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.sheet = options.get("sheet")
        self.columns = options["columns"].split("\n") if "columns" in options else None
        self.keep = options.get("keep")

    def partitions(self):
        store, path = _open(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
        return [_File(self.path, i.path) for i in sorted(found, key=lambda i: i.path)
                if i.type == fs.FileType.File and (i is info or i.path.lower().endswith(".xlsx"))]

    def read(self, partition):
        store, _ = _open(partition.path)
        with store.open_input_file(partition.name) as data:
            rows = sheet_rows(data, self.sheet)
            if self.columns is None:
                yield from ((partition.name, number, cells) for number, cells in rows)
            else:
                yield from columns_of(rows, self.columns, self.keep)


class SheetSource(DataSource):
    """The format ``sheet``."""

    @classmethod
    def name(cls) -> str:
        return "sheet"

    def schema(self):
        if "columns" in self.options:
            return StructType([StructField(c, StringType()) for c in self.options["columns"].split("\n")])
        return RAW

    def reader(self, schema):
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SheetSource)


def read_inflation_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Monthly inflation (period ``yyyymm``, percent) from the statistics sheet itself."""
    register(spark)
    reader = spark.read.format("sheet").options(columns=f"{INFLATION_PERIOD}\n{INFLATION_RATE}", keep=PERIOD)
    lines = (reader.option("sheet", sheet) if sheet else reader).load(path)
    pct = F.replace(F.col(f"`{INFLATION_RATE}`"), F.lit(","), F.lit(".")).try_cast("double")
    return lines.select(F.col(f"`{INFLATION_PERIOD}`").alias("period"), pct.alias("pct"))

"""Metadata workbooks to the two dictionary tables."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arealis.operators.dictionary import STAT_COLUMNS, TABLE_COLUMNS
from arealis.operators.keys import assert_unique
from arealis.sources.files import discover_metadata

# First cell of the row above the data, per sheet.
SHEET_MARKERS = ("table number", "sequential")
CELL_SCHEMA = "file string, sheet int, row_no int, cells array<string>"
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _texts(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def sheet_rows(content: bytes, sheets: int) -> Iterator[tuple[int, int, list[str | None]]]:
    """``(sheet, row_no, cells)`` of the first sheets of one workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = [_texts(si) for si in root.findall("m:si", _NS)]
        pages = sorted(
            (n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)),
            key=lambda n: int(re.search(r"\d+", n).group()),
        )
        for sheet, page in enumerate(pages[:sheets]):
            for row in ElementTree.fromstring(book.read(page)).iterfind(".//m:row", _NS):
                cells: list[str | None] = []
                for cell in row.findall("m:c", _NS):
                    at = _column_index(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (at + 1 - len(cells)))
                    value = cell.find("m:v", _NS)
                    if cell.get("t") == "s" and value is not None:
                        cells[at] = shared[int(value.text)]
                    elif cell.get("t") == "inlineStr":
                        cells[at] = _texts(cell)
                    elif value is not None:
                        cells[at] = value.text
                yield sheet, int(row.get("r")), cells


def parse_workbooks(books: DataFrame) -> DataFrame:
    """Cells of ``path, content`` rows: one workbook at a time inside the tasks."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = [(path, *r) for r in sheet_rows(content, len(SHEET_MARKERS))]
                yield pd.DataFrame(rows, columns=["file", "sheet", "row_no", "cells"])

    return books.select("path", "content").mapInPandas(parse, CELL_SCHEMA)


def read_workbooks(spark: SparkSession, directory: str) -> DataFrame:
    """Cells of every metadata workbook under ``directory``."""
    paths = [r[0] for r in discover_metadata(spark, directory).select("path").collect()]
    if not paths:
        raise ValueError(f"no metadata workbooks under {directory}")
    return parse_workbooks(spark.read.format("binaryFile").load(paths))


def skip_preamble(cells: DataFrame, markers=SHEET_MARKERS) -> DataFrame:
    """Rows below each sheet's marker row. A sheet without its marker raises.

    A marker in a sheet's very first row is not seen.
    """
    marker = F.get(F.array(*[F.lit(m) for m in markers]), F.col("sheet"))
    is_marker = (F.lower(F.get("cells", F.lit(0))) == marker) & (F.col("row_no") > 1)
    # workbook sheets have at most 1,048,576 rows, so one sheet is a bounded group
    sheet = Window.partitionBy("file", "sheet")
    found = cells.withColumn("_marker", F.min(F.when(is_marker, F.col("row_no"))).over(sheet))
    missing = F.raise_error(
        F.concat(F.lit("no marker row in sheet "), F.col("sheet").cast("string"), F.lit(" of "), "file")
    ).cast("int")
    return (
        found.withColumn("_marker", F.coalesce("_marker", missing))
        .filter(F.col("row_no") > F.col("_marker"))
        .drop("_marker")
    )


def _named(cells: DataFrame, sheet: int, names, drop_excess: bool = False) -> DataFrame:
    width = len(names)
    size = F.size("cells")
    row = F.col("cells")
    if drop_excess:
        # the three columns after the named ones go together or not at all
        kept = F.concat(F.slice("cells", 1, width), F.slice("cells", width + 4, 16384))
        row = F.when(size >= width + 3, kept).otherwise(row)
    extra = F.exists(F.slice(row, width + 1, 16384), lambda c: F.nullif(F.trim(c), F.lit("")).isNotNull())
    checked = F.when(extra, F.raise_error(F.concat(F.lit("extra columns in "), "file")).cast("array<string>")).otherwise(row)
    picked = cells.filter(F.col("sheet") == sheet).select(checked.alias("c"))
    return picked.select(
        *[F.nullif(F.trim(F.get("c", F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(names)]
    )


def load_metadata(cells: DataFrame, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """All workbooks appended into (table list, data dictionary).

    Empty cells are NULL, tables without a number are deleted and both primary
    keys hold.
    """
    below = skip_preamble(cells)
    tables = _named(below, 0, TABLE_COLUMNS).filter(F.col("table_number").isNotNull())
    stats = _named(below, 1, STAT_COLUMNS, drop_excess=True)
    if check:
        assert_unique(tables, "table_number")
        assert_unique(stats, "sequential_id")
    return tables, stats

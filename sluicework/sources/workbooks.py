"""Excel forms: every sheet of every workbook as rows.

Only taking the cells out of the zipped sheets is Python, one workbook at a time inside a task. What
the cells mean is decided by Spark expressions on the resulting rows.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.functions import clock, text

# The parts of a workbook file and the day an Excel date counts from.
WORKBOOK, RELATIONS, STRINGS = "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml"
DAY_ZERO = "1899-12-30"

CELLS = "file STRING, sheet STRING, row_no INT, cells MAP<STRING, STRING>"
ROWS_PER_FRAME = 5000


def read_sheets(
    spark: SparkSession, pattern: str, skip_rows: int = 2, sheet: str | None = None
) -> DataFrame:
    """Rows below the header as (file, sheet, row_no, cells); the header names the cells.

    ``skip_rows`` rows stand above the header. Empty cells have no entry. A pattern without files
    gives no rows.
    """
    try:
        files = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CELLS)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                yield from _frames(path.rsplit("/", 1)[-1], content, skip_rows, sheet)

    return files.select("path", "content").mapInPandas(rows, CELLS)


def _frames(file: str, content: bytes, skip_rows: int, only: str | None) -> Iterator[pd.DataFrame]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        for name, part in _sheets(book):
            if only is not None and name != only:
                continue
            found = []
            for number, cells in _filled_rows(book, part, shared, skip_rows):
                found.append((file, name, number, cells))
                if len(found) == ROWS_PER_FRAME:
                    yield _frame(found)
                    found = []
            if found:
                yield _frame(found)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["file", "sheet", "row_no", "cells"])


def _sheets(book: zipfile.ZipFile) -> Iterator[tuple[str, str]]:
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read(RELATIONS))}
    for entry in ElementTree.fromstring(book.read(WORKBOOK)).iterfind("{*}sheets/{*}sheet"):
        relation = next(v for k, v in entry.attrib.items() if k.endswith("}id"))
        target = targets[relation]
        part = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
        yield entry.get("name"), part


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if STRINGS not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read(STRINGS))
    return ["".join(t.text or "" for t in item.iterfind(".//{*}t")) for item in root]


def _filled_rows(
    book: zipfile.ZipFile, part: str, shared: list[str], skip_rows: int
) -> Iterator[tuple[int, dict[str, str]]]:
    header: dict[str, str] = {}
    expected = skip_rows + 2
    with book.open(part) as sheet:
        for _, row in ElementTree.iterparse(sheet):
            if row.tag.rsplit("}", 1)[-1] != "row":
                continue
            number = int(row.get("r"))
            values = dict(_cells(row, shared))
            row.clear()
            if number == skip_rows + 1:
                header = {column: value.strip() for column, value in values.items()}
            elif number > skip_rows + 1:
                for blank in range(expected, number):
                    yield blank, {}
                expected = number + 1
                yield number, {header[c]: v for c, v in values.items() if c in header}


def _cells(row: ElementTree.Element, shared: list[str]) -> Iterator[tuple[str, str]]:
    for cell in row.iterfind("{*}c"):
        column = re.match("[A-Z]+", cell.get("r")).group()
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            value = "".join(t.text or "" for t in cell.iterfind(".//{*}t"))
        else:
            value = cell.findtext("{*}v")
            if kind == "s" and value is not None:
                value = shared[int(value)]
        if value:
            yield column, value


def is_number(cell: Column) -> Column:
    return cell.rlike(r"^-?\d+([.]\d+)?([eE][-+]?\d+)?$")


def day_of(cell: Column) -> Column:
    """A date cell: the serial day number of Excel or ISO text."""
    serial = F.floor(cell.try_cast("double")).cast("int")
    return F.when(is_number(cell), F.date_add(F.lit(DAY_ZERO).cast("date"), serial)).otherwise(
        F.to_date(clock.iso_timestamp(cell))
    )


def seconds_of(cell: Column) -> Column:
    """A time-of-day cell, a fraction of a day or ``HH:mm[:ss]``, in seconds."""
    fraction = cell.try_cast("double") - F.floor(cell.try_cast("double"))
    halves = F.split(cell, ":")
    typed = (
        F.get(halves, 0).try_cast("int") * 3600
        + F.get(halves, 1).try_cast("int") * 60
        + F.coalesce(F.get(halves, 2).try_cast("int"), F.lit(0))
    )
    return F.when(is_number(cell), F.round(fraction * 86400).cast("int")).otherwise(typed)


def read_timesheets(spark: SparkSession, pattern: str) -> DataFrame:
    """Timesheet forms: the file names the department, the sheet the person."""
    rows = read_sheets(spark, pattern).filter(F.size("cells") > 0)
    cell = F.col("cells")
    day = day_of(cell["date"])
    shaped = rows.select(
        text.file_stem(F.col("file")).alias("Department"),
        F.col("sheet").alias("Person"),
        clock.at_time(day, seconds_of(cell["time_from"])).alias("Start"),
        clock.at_time(day, seconds_of(cell["time_to"])).alias("End"),
        cell["project"].alias("Project"),
        cell["task"].alias("Task"),
    )
    return shaped

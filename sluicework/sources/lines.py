"""Line-oriented XML and JSON files as typed rows.

A line is read into texts by folded names first and converted to the target afterwards, so a name in
another case or a single bad value can never turn silently into NULLs.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.content import folded_json_object
from sluicework.functions.markup import attributes, folds_names, is_row, known_attributes
from sluicework.operators.matching import join_per_key
from sluicework.operators.shape import from_texts, source_names, stack
from sluicework.session import scratch_path

# How the line starts that tells a file's format.
XML_START, JSON_START = "<?xml", "{"


def xml_rows(
    lines: DataFrame, schema: T.StructType, column_map: Mapping[str, str] | None = None,
    strict: bool = True, column: str = "value", keep: Sequence[str] = (),
) -> DataFrame:
    """The row lines of XML text; every other line is passed over."""
    rows = lines.filter(is_row(F.col(column)))
    if not folds_names(lines.sparkSession):
        entries = rows.withColumn("_row", attributes(F.col(column), fold=True))
        return from_texts(entries, lambda name: F.col("_row")[name], schema, column_map, strict, keep)
    names = sorted(set(source_names(schema, column_map).values()))
    parsed = rows.withColumn("_row", known_attributes(F.col(column), names))
    return from_texts(
        parsed, lambda name: F.col("_row")[f"_{name}"], schema, column_map, strict, keep
    )


def json_rows(
    lines: DataFrame, schema: T.StructType, column_map: Mapping[str, str] | None = None,
    strict: bool = True, column: str = "value", keep: Sequence[str] = (),
) -> DataFrame:
    """The JSON objects of text lines; blank lines are passed over."""
    entries = lines.filter(F.trim(column) != "").withColumn(
        "_row", folded_json_object(F.col(column))
    )
    return from_texts(entries, lambda name: F.col("_row")[name], schema, column_map, strict, keep)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines with their file; Spark drops a byte order mark."""
    return spark.read.text(path if isinstance(path, str) else list(path)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def file_formats(lines: DataFrame) -> DataFrame:
    """Per file the ``format`` (``xml``, ``json`` or NULL) told by its first telling line, and ``late``.

    Other lines are passed over until one tells; ``late`` says that there were such lines.
    """
    # Blocks in order, and within a block lines keep their order: the smallest place wins and carries
    # the code of its line with it
    line = F.col("value")
    code = F.when(line.startswith(XML_START), 1).when(line.startswith(JSON_START), 2)
    place = F.struct(F.col("_block"), F.monotonically_increasing_id().alias("_id"), code.alias("code"))
    found = lines.select("file", place.alias("_at")).groupBy("file").agg(
        F.min(F.when(F.col("_at.code").isNotNull(), F.col("_at"))).alias("told"), F.min("_at").alias("first"))
    kind = F.col("told.code")
    return found.select(
        "file", F.when(kind == 1, "xml").when(kind == 2, "json").alias("format"),
        F.coalesce(F.col("told._id") != F.col("first._id"), F.lit(False)).alias("late"))


def after_telling(lines: DataFrame) -> DataFrame:
    """The lines of files that tell their format late, from the telling line on, with the ``format``.

    The place of the telling line is part of each file's state and decides for each line. The lines are
    written once with their places, so both passes see the same ones.
    """
    path = scratch_path(lines.sparkSession, "lines")
    lines.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    placed = lines.sparkSession.read.parquet(path).withColumn("_at", F.struct("_block", "_id"))
    line = F.col("value")
    code = F.when(line.startswith(XML_START), "xml").when(line.startswith(JSON_START), "json")
    told = placed.filter(code.isNotNull()).groupBy("file").agg(F.min(F.struct("_at", code.alias("format"))).alias("told"))
    # One row per file
    found = join_per_key(placed, told, ["file"], "inner").filter(F.col("_at") >= F.col("told._at"))
    return found.select("value", "file", "_block", F.col("told.format").alias("format"))


def _told(spark: SparkSession, path: str) -> dict[tuple[str, bool], list[str]]:
    """The files by (format, late); the driver holds the list of files anyway.

    Most files tell in their first block; only the others are looked through to their end.
    """
    starts = read_lines(spark, path).filter(F.col("_block") == 0)
    files: dict[tuple[str, bool], list[str]] = {}
    rows = file_formats(starts).collect()
    if silent := [_as_path(r["file"]) for r in rows if r["format"] is None]:
        rows += file_formats(read_lines(spark, silent)).collect()
        told = {r["file"] for r in rows if r["format"]}
        if left := sorted({r["file"] for r in rows} - told):
            raise ValueError(f"no line tells the format of {', '.join(left[:5])}")
    for row in rows:
        if row["format"]:
            files.setdefault((row["format"], row["late"]), []).append(_as_path(row["file"]))
    return files


def _as_path(file: str) -> str:
    """A file's address as a path that matches nothing else."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(file))


def import_files(
    spark: SparkSession, path: str, schema: T.StructType,
    column_map: Mapping[str, str] | None = None, strict: bool = True, keep_file: bool = False,
    format: str | None = None,
) -> DataFrame:
    """Typed rows of all files that match ``path``, each read in its own format.

    A file's format is told by its first line that starts as one; lines before it are passed over. A
    file with lines of which none tells is an error. ``format`` (``xml`` or ``json``) for all files
    saves the pass that looks for these lines.
    """
    kept = ["file"] if keep_file else []
    arguments = {"schema": schema, "column_map": column_map, "strict": strict, "keep": kept}
    readers = {"xml": xml_rows, "json": json_rows}
    if format is not None:
        return readers[format](read_lines(spark, path), **arguments)
    told, parts = _told(spark, path), []
    for name, reader in sorted(readers.items()):
        if files := told.get((name, False)):
            parts.append(reader(read_lines(spark, files), **arguments))
    if late := [file for (_, is_late), files in told.items() if is_late for file in files]:
        found = after_telling(read_lines(spark, late))
        for name, reader in sorted(readers.items()):
            if (name, True) in told:
                parts.append(reader(found.filter(F.col("format") == name), **arguments))
    if not parts:
        return xml_rows(read_lines(spark, path), **arguments)
    return stack(parts)

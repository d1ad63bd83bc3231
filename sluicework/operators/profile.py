"""Aggregate reports and profiles. All of them combine map-side, so one hot group stays small."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.functions import clock
from sluicework.functions.markup import attribute_names, is_row


def minutes_by(df: DataFrame, keys: Sequence[Column | str], start: str, end: str) -> DataFrame:
    """Total minutes per group, for rows that carry both ends of a span."""
    return df.groupBy(*keys).agg(
        F.sum(clock.minutes_between(F.col(start), F.col(end))).alias("minutes")
    )


def minutes_per_parent(
    parents: DataFrame, children: DataFrame, key: str, child_key: str, start: str, end: str,
) -> DataFrame:
    """Parents that have children, with ``minutes`` = the sum of (child end - parent start).

    The children are reduced to one row per key before the join: the sum of the differences is the
    sum of the ends less n times the start. ``n_children`` counts all children; those without an end
    add no minutes, and without any end ``minutes`` is NULL. A key that holds a third of the children is one row
    per map task in the shuffle, and one row in the join.
    """
    per_key = (
        children.groupBy(F.col(child_key).alias("_key"))
        .agg(F.count("*").alias("_n"), F.count(end).alias("_filled"),
             F.sum(clock.epoch_minutes(F.col(end))).alias("_ends"))
    )
    return (
        parents.join(per_key, F.col(key) == F.col("_key"))
        .withColumn("minutes", F.col("_ends") - F.col("_filled") * clock.epoch_minutes(F.col(start)))
        .drop("_key", "_ends", "_filled")
        .withColumnRenamed("_n", "n_children")
    )


def count_by(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def high_water_mark(df: DataFrame, key: str, changed: str | None = None) -> DataFrame:
    """The largest key, 0 when there is none, and the latest change time if asked."""
    marks = [F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("high_water")]
    if changed:
        marks.append(F.max(changed).alias("last_changed"))
    return df.agg(*marks)


def length_profile(df: DataFrame, column: str, over: int = 4000) -> DataFrame:
    size = F.length(column).cast("bigint")
    return df.agg(
        F.min(size).alias("shortest"),
        F.max(size).alias("longest"),
        F.count_if(size > over).alias("n_over"),
        F.count(column).alias("n_values"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its number of NULLs, from one pass over the rows."""
    names = list(columns or df.columns)
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[
            F.coalesce(F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)), F.lit(0)).alias(f"_{i}")
            for i, c in enumerate(names)
        ],
    )
    return unpivot_counts(counts, names, ["n_rows"], {"n_nulls": ""})


def all_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows have no value at all: after an import, the trace of names that did not match."""
    return df.agg(
        F.count_if(F.coalesce(*[F.col(c).cast("string") for c in columns or df.columns]).isNull())
        .alias("n_all_null"),
        F.count("*").alias("n_rows"),
    )


def unpivot_counts(
    counts: DataFrame, names: Sequence[str], keep: Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """One wide row of per-column counts (``_<measure prefix><position>``) as one row per column."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"_{prefix}{i}").cast("bigint").alias(m) for m, prefix in measures.items()],
        )
        for i, name in enumerate(names)
    ])
    return counts.select(*keep, F.inline(rows))


def attribute_presence(lines: DataFrame, column: str = "value") -> DataFrame:
    """How many rows of one-line XML carry each attribute, most common first."""
    names = lines.filter(is_row(F.col(column))).select(
        F.explode(F.array_distinct(attribute_names(F.col(column)))).alias("attribute")
    )
    return count_by(names, ["attribute"]).orderBy(F.desc("n"), "attribute")


def key_presence(df: DataFrame, entries: str) -> DataFrame:
    """How many rows carry each key of a map column, most common first."""
    names = df.select(F.explode(F.map_keys(entries)).alias("attribute"))
    return count_by(names, ["attribute"]).orderBy(F.desc("n"), "attribute")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return count_by(df, keys).filter(F.col("n") > 1)


def quantities(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A multiset as its distinct members with their quantity."""
    return df.groupBy(*keys).agg(F.count("*").alias("quantity"))


def table_information(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    if not tables:
        raise ValueError("no tables given")
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def stored_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The Parquet tables of a folder by name, as listed there: a file or folder ``name.parquet`` each."""
    rows = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .load(folder).select(F.regexp_extract("path", r"/([^/]+)\.parquet(/[^/]*)?$", 1).alias("name"))
        .distinct().orderBy("name").collect()
    )
    return {r["name"]: spark.read.parquet(f"{folder.rstrip('/')}/{r['name']}.parquet") for r in rows}


def full_information(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name``, ``n_rows``, ``n_files``, ``n_bytes``."""
    return table_information(tables).join(table_bytes(tables), "table_name")


def table_bytes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per file-backed table with its file count and size, from the listing of its files."""
    result = None
    for name, df in tables.items():
        # without the content this source reads the listing only
        files = df.sparkSession.read.format("binaryFile").load(df.inputFiles()).select("path", "length")
        part = files.agg(
            F.count("*").alias("n_files"),
            F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("n_bytes"),
        ).select(F.lit(name).alias("table_name"), "n_files", "n_bytes")
        result = part if result is None else result.unionAll(part)
    if result is None:
        raise ValueError("no tables given")
    return result

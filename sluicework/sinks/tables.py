"""Writing to tables: database tables over JDBC, and parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from sluicework.operators.shape import align, nan_to_null
from sluicework.sources.tables import read_query, read_table


def append(
    df: DataFrame, url: str, table: str, batch_size: int = 1000, truncate: bool = False,
    strict: bool = False, column_map: Mapping[str, str] | None = None, **options: str,
) -> None:
    """Rows into an existing table, in the columns and types the table has; NaN becomes NULL.

    ``truncate`` empties the table first and keeps its definition.
    """
    if not isinstance(df, DataFrame):
        raise TypeError("data must be a DataFrame")
    if df.isEmpty():
        raise ValueError("no rows to write, data is empty")
    _write(df, url, table, batch_size, truncate, strict, column_map, options)


def copy(
    spark: SparkSession, source_url: str, target_url: str, target_table: str,
    source_table: str | None = None, query: str | None = None,
    parameters: Mapping[str, object] | None = None, partition_column: str | None = None,
    parts: int | None = None, batch_size: int = 1000, truncate: bool = False,
    source_options: Mapping[str, str] | None = None, target_options: Mapping[str, str] | None = None,
) -> None:
    """A table or a query result of one system into a table of another.

    A source column that the target lacks is an error. An empty source is none.
    """
    if (source_table is None) == (query is None):
        raise ValueError("give either a source table or a query")
    given = dict(source_options or {})
    if source_table is not None:
        df = read_table(spark, source_url, source_table, partition_column, parts, **given)
    else:
        df = read_query(spark, source_url, query, parameters, **given)
    _write(df, target_url, target_table, batch_size, truncate, True, None, dict(target_options or {}))


def _write(df, url, table, batch_size, truncate, strict, column_map, options) -> None:
    schema = read_table(df.sparkSession, url, table, **options).schema
    (
        align(nan_to_null(df), schema, strict, column_map)
        .write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch_size), **options)
        .option("truncate", str(truncate).lower())
        .mode("overwrite" if truncate else "append")
        .save()
    )


def append_parquet(
    df: DataFrame, path: str, strict: bool = False, column_map: Mapping[str, str] | None = None
) -> None:
    """Rows into an existing parquet table, in the columns and types it has; NaN becomes NULL."""
    if df.isEmpty():
        raise ValueError("no rows to write, data is empty")
    target = df.sparkSession.read.parquet(path).schema
    align(nan_to_null(df), target, strict, column_map).write.mode("append").parquet(path)


def split_by(df: DataFrame, keys: Sequence[str], path: str) -> None:
    """One folder per key. Large keys are spread over several tasks and files, small ones share.

    The rebalance hint lets adaptive execution split a hot key, which a repartition by key cannot.
    """
    df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(path)


def write_reports(reports: Mapping[str, DataFrame], root: str) -> None:
    """Every report under its own name."""
    for name, df in reports.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")

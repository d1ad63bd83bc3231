"""Sorting, top rows, and row numbers over a whole table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.operators.profile import repeated_keys, table_bytes
from sluicework.session import scratch_path

LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition number above this bit


def top_rows(df: DataFrame, order: Sequence[Column | str], first: int, skip: int = 0) -> DataFrame:
    """``first`` rows after ``skip`` rows; the order must end in a unique key to be repeatable."""
    ordered = df.orderBy(*order)
    return (ordered.offset(skip) if skip else ordered).limit(first)


def pick_one(df: DataFrame, key: str, seed: int) -> DataFrame:
    """One row, arbitrary but the same for the same seed: that of the smallest checksum of key and seed."""
    mark = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(mark, F.col(key)).limit(1)


def runs_for(df: DataFrame, run_bytes: int = 128 << 20) -> int | None:
    """How many sorted runs of about ``run_bytes`` the files of a table make; None where it has no files.

    From the listing of the files alone. Compressed files unpack to more, so take fewer bytes for these.
    """
    if not df.inputFiles():
        return None
    return max(1, math.ceil(table_bytes({"table": df}).first()["n_bytes"] / run_bytes))


def number_rows(
    df: DataFrame, order: Sequence[Column | str], name: str = "rn", runs: int | None = None,
    unique: Sequence[str] = (),
) -> DataFrame:
    """Row numbers 1..n over the whole table; without an order as the rows lie.

    ``row_number()`` without a partition would sort everything in one task. Here the sorted runs of
    a range shuffle are written once, and each run's number is shifted by the sizes of the runs
    before it. The written table makes run and position the same in both passes. The driver sees one
    count per run, not rows. ``runs`` is the number of sorted runs, about the table's bytes / 128 MB as
    ``runs_for`` gives it (the session's shuffle partitions, where it is not given). Ties are numbered in
    no particular order; name the columns that make the order unique in ``unique``, and a repeated
    combination is an error. The written table stays until the ``session.scratch_scope`` around it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    parts = runs or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_runs = df.repartitionByRange(parts, *order).sortWithinPartitions(*order) if order else df
    sorted_runs.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path).withColumn("_run", F.shiftright("_at", LOCAL_BITS))
    if unique and not repeated_keys(numbered, list(unique)).isEmpty():
        raise ValueError(f"the order is not unique: {', '.join(unique)} repeat")
    sizes = {r["_run"]: r["n"] for r in numbered.groupBy("_run").agg(F.count("*").alias("n")).collect()}
    starts, before = [], 0
    for run in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(run, 0)
    # One constant array, looked up by position
    shifts = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    shift = F.get(shifts, F.col("_run").cast("int"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    number = (shift + inside + 1).alias(name)
    return numbered.select(*df.columns, number)

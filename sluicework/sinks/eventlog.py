"""Producing rows to an event log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.functions.content import row_json
from sluicework.operators.ranking import number_rows
from sluicework.sources.eventlog import RECORD

#: A compressed file is read by one task.
FILE_RECORDS = 4_000_000


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as (key, value): JSON with times and decimals as text."""
    text = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(text.alias("key"), row_json(df.schema).alias("value"))


def produce(encoded: DataFrame, options: dict[str, str], format: str = "kafka") -> None:
    """Sends (key, value) rows to a broker. The job fails if any row cannot be sent."""
    _refuse_empty(encoded)
    encoded.write.format(format).options(**options).save()


def partition_of(key: Column, otherwise: Column, parts: int) -> Column:
    """The log partition of a key, by its checksum; a record without a key goes by ``otherwise``."""
    digest = F.md5(F.coalesce(key, otherwise))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(parts)).cast("int")


def records(
    encoded: DataFrame, order: Sequence[Column | str], parts: int = 1, start: Mapping[int, int] | int = 0,
    stamp: Column | None = None,
) -> DataFrame:
    """(key, value) rows as log records: a key on one partition, offsets without gaps in ``order``.

    ``start`` is the first offset, by partition or for all. The rows are numbered by a range shuffle over
    partition and order, so a partition with most rows is many tasks.
    """
    placed = encoded.withColumn("partition", partition_of(F.col("key"), F.col("value"), parts))
    numbered = number_rows(placed, ["partition", *order], "_n")
    firsts = {r["partition"]: r["n"] for r in numbered.groupBy("partition").agg(F.min("_n").alias("n")).collect()}
    begin = {p: start if isinstance(start, int) else start.get(p, 0) for p in firsts}
    shift = F.lit(0)
    if firsts:
        shift = F.create_map(*[F.lit(x) for p, n in firsts.items() for x in (p, begin[p] - n)])[F.col("partition")]
    return numbered.select(
        "key", "value", "partition", (F.col("_n") + shift).cast("bigint").alias("offset"),
        (stamp if stamp is not None else F.localtimestamp()).alias("timestamp"),
    ).select(*RECORD.names)


def append_log(
    encoded: DataFrame, path: str, order: Sequence[Column | str], start: Mapping[int, int] | int = 0,
    stamp: Column | None = None, parts: int = 1,
) -> None:
    """Appends (key, value) rows to a directory log, with offsets from ``start`` on in ``order``."""
    _refuse_empty(encoded)
    records(encoded, order, parts, start, stamp).write.mode("append").json(path)


def write_log(log: DataFrame, path: str) -> None:
    """Adds records to a directory log as compressed JSON lines, in files of ``FILE_RECORDS`` at most."""
    log.write.mode("append").option("maxRecordsPerFile", FILE_RECORDS).json(path, compression="gzip")


def _refuse_empty(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("no messages to produce, data is empty")

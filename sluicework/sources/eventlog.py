"""Reading an event log: a message broker where its connector is deployed, or a directory log.

Both give (key, value, partition, offset, timestamp). A directory log holds them as JSON lines.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

#: Offsets counted together when a bite ends within a partition.
RANGE = 1 << 16

#: Files of a streamed log that are taken at once, where no number of files is given.
BITE_BYTES = 1 << 30


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The whole directory log as it is now."""
    return spark.read.schema(RECORD).option("mode", "FAILFAST").json(path)


def stream_log(spark: SparkSession, path: str, files_per_bite: int | None = None) -> DataFrame:
    """The directory log as a stream; where a reader stands is kept in its checkpoint.

    Without ``files_per_bite`` a bite ends after about ``BITE_BYTES`` of files, so that a long log is not one batch.
    """
    reader = spark.readStream.schema(RECORD).option("mode", "FAILFAST")
    if files_per_bite:
        reader = reader.option("maxFilesPerTrigger", files_per_bite)
    else:
        reader = reader.option("maxBytesPerTrigger", BITE_BYTES)
    return reader.json(path)


def broker_log(
    spark: SparkSession, options: dict[str, str], streaming: bool = False, format: str = "kafka"
) -> DataFrame:
    """The log of a broker, by the options of its connector (servers, topic, starting offsets)."""
    reader = spark.readStream if streaming else spark.read
    records = reader.format(format).options(**options).load()
    return records.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
    )


Positions = Mapping[int, int]


def _per_partition(values: Positions, partition: str, otherwise: int) -> Column:
    """The number of a row's log partition."""
    if not values:
        return F.lit(otherwise).cast("bigint")
    entries = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, F.col(partition).cast("int")), F.lit(otherwise)).cast("bigint")


def since(
    log: DataFrame, start: Positions | int, offset: str = "offset", partition: str = "partition",
) -> DataFrame:
    """The records from a reader's next offsets on; all of a partition in which it has none."""
    if isinstance(start, int):
        return log.filter(F.col(offset) >= start)
    # No least position of all: a partition without a position starts at 0
    return log.filter(F.col(offset) >= _per_partition(start, partition, 0))


def bite_ends(
    log: DataFrame, start: Positions | int, first: int, offset: str = "offset", partition: str = "partition",
) -> dict[int, int]:
    """Where a bite of exactly ``first`` records ends: the next offset by log partition.

    Records count in the order of partition and offset, whatever gaps the offsets have. Partitions are
    counted whole; the one in which the bite ends is counted by ranges of ``RANGE`` offsets, and one
    range is sorted. The driver sees a number per partition, never records. ``start`` is the next offset
    of the reader, by partition (0 where there is none) or for all. A log without ``partition`` has one.
    """
    if partition not in log.columns:
        log = log.withColumn(partition, F.lit(0))
    rows = since(log, start, offset, partition)
    totals = rows.groupBy(partition).agg(F.count("*").alias("n"), F.max(offset).alias("last")).orderBy(partition).collect()
    ends: dict[int, int] = {}
    left = first
    for row in totals:
        if left >= row["n"]:
            ends[row[partition]], left = row["last"] + 1, left - row["n"]
            continue
        if left > 0:
            ends[row[partition]] = _cut(rows.filter(F.col(partition) == row[partition]), left, offset)
        break
    return ends


def _cut(rows: DataFrame, left: int, offset: str) -> int:
    """One past the offset of record number ``left`` of one log partition, which has more than these."""
    ranged = rows.select(F.col(offset).alias("at"), F.floor(F.col(offset) / RANGE).cast("bigint").alias("range"))
    counts = ranged.groupBy("range").agg(F.count("*").alias("n"))
    # One row per range
    before = counts.select("range", "n", F.sum("n").over(Window.orderBy("range")).alias("upto"))
    found = before.filter(F.col("upto") >= left).orderBy("range").first()
    inside = left - (found["upto"] - found["n"])
    return ranged.filter(F.col("range") == found["range"]).orderBy("at").offset(inside - 1).limit(1).first()["at"] + 1


def bite(
    log: DataFrame, start: Positions | int, first: int, offset: str = "offset", partition: str = "partition",
) -> DataFrame:
    """The next ``first`` records in the order of partition and offset, all that are left if fewer.

    ``bite_ends`` gives where the reader stands afterwards.
    """
    ends = bite_ends(log, start, first, offset, partition)
    rows = since(log, start, offset, partition)
    if partition not in log.columns:
        return rows.filter(F.col(offset) < ends.get(0, 0))
    return replay(rows, ends, offset, partition)


def high_watermarks(log: DataFrame, offset: str = "offset", partition: str = "partition") -> dict[int, int]:
    """One past the last offset of every log partition now; a replay ends there, however the log grows."""
    rows = log.groupBy(partition).agg((F.max(offset) + 1).alias("end")).collect()
    return {r[partition]: r["end"] for r in rows}


def high_watermark(log: DataFrame, offset: str = "offset") -> int:
    """One past the last offset of a log of one partition."""
    return log.agg(F.coalesce(F.max(offset) + 1, F.lit(0)).alias("n")).first()["n"]


def replay(
    log: DataFrame, watermark: Positions | int, offset: str = "offset", partition: str = "partition",
) -> DataFrame:
    """The records before the watermark; a partition that had none when it was taken has none."""
    if isinstance(watermark, int):
        return log.filter(F.col(offset) < watermark)
    return log.filter(
        (F.col(offset) < max(watermark.values(), default=0)) & (F.col(offset) < _per_partition(watermark, partition, 0)))


def reader_lag(
    positions: DataFrame, watermark: Positions | int, position: str = "position", partition: str = "partition",
) -> DataFrame:
    """How far each reader is from the end of the log; ``position`` is its next offset in the partition."""
    end = F.lit(watermark).cast("bigint") if isinstance(watermark, int) else _per_partition(watermark, partition, 0)
    return positions.withColumn("lag", end - F.col(position))


def starting_offsets(topic: str, positions: Positions) -> str:
    """Positions as the option ``startingOffsets`` or ``endingOffsets`` of a broker's connector."""
    return json.dumps({topic: {str(p): o for p, o in sorted(positions.items())}})

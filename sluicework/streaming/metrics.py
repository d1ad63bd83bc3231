"""What a load did, as rows of a table."""

from __future__ import annotations

import datetime
import time
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "time TIMESTAMP_NTZ, load STRING, n_rows BIGINT, percent DOUBLE, seconds DOUBLE, rows_per_second DOUBLE"


class LoadMetrics:
    """Row count and rate of loads, measured while they are written, not by a second pass."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.rows: list[tuple] = []

    @contextmanager
    def observed(self, df: DataFrame, load: str, expected: int | None = None):
        """``with metrics.observed(df, "users") as counted: counted.write…``"""
        observation = Observation(load)
        started = time.monotonic()
        yield df.observe(observation, F.count(F.lit(1)).alias("n_rows"))
        self._add(load, observation.get["n_rows"], time.monotonic() - started, expected)

    def stream(self, query: StreamingQuery) -> None:
        """Takes over the progress reports a streaming query kept."""
        for p in query.recentProgress:
            self._add(query.name or str(query.id), p["numInputRows"],
                      p["durationMs"].get("triggerExecution", 0) / 1000, None)

    def _add(self, load: str, n_rows: int, seconds: float, expected: int | None) -> None:
        percent = 100.0 * n_rows / expected if expected else None
        rate = n_rows / seconds if seconds else 0.0
        now = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
        self.rows.append((now, load, n_rows, percent, seconds, rate))

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, SCHEMA)

    def append_to(self, path: str) -> None:
        """One row per load goes to the metrics table."""
        self.frame().coalesce(1).write.mode("append").parquet(path)


def recorded(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(*paths)

"""Binary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_binary(spark: SparkSession, pattern: str) -> DataFrame:
    """Files that match a pattern: (name, length, content)."""
    return spark.read.format("binaryFile").load(pattern).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content"
    )

"""Tables as JSON lines, and nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluicework.functions.content import row_json


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per row: null written out, times and decimals as text, binary refused."""
    df.select(row_json(df.schema).alias("value")).write.text(path)


def write_collection(
    documents: DataFrame, path: str, replace: bool = False, format: str = "json", **options: str
) -> None:
    """Nested documents, added to a collection or in place of it."""
    if documents.isEmpty():
        raise ValueError("no documents to write, data is empty")
    mode = "overwrite" if replace else "append"
    documents.write.format(format).options(**options).mode(mode).save(path)

"""SQL text with bound parameters."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

SHAPES = ("DataFrame", "dict", "list", "single_value")

# Text literals, quoted names and comments are passed over; only the last branch is a parameter
_AT_NAME = re.compile(
    r"""'(?:[^'\\]|\\.|'')*' | "(?:[^"\\]|\\.|"")*" | `[^`]*` | --[^\n]* | /\*.*?\*/
        | (?<!@)@(?P<name>[A-Za-z_]\w*)""",
    re.VERBOSE | re.DOTALL,
)


def with_colon_names(text: str) -> str:
    """``@name`` parameters as Spark's ``:name``."""
    return _AT_NAME.sub(lambda m: f":{m['name']}" if m["name"] else m[0], text)


def run(
    spark: SparkSession,
    text: str,
    parameters: Mapping | Sequence | None = None,
    shape: str = "DataFrame",
    **tables: DataFrame,
):
    """Runs SQL. ``:name``, ``@name`` and ``?`` are bound; ``{table}`` names a given DataFrame.

    ``shape``: ``DataFrame`` (lazy), ``single_value`` (None without rows), or ``dict`` or ``list``
    for a lazy iterator of rows, fetched one partition at a time.
    """
    if shape not in SHAPES:
        raise ValueError(f"unknown shape {shape!r}, use {', '.join(SHAPES)}")
    if parameters is None:
        args = None
    elif isinstance(parameters, Mapping):
        args = dict(parameters)
        text = with_colon_names(text)
    elif isinstance(parameters, (list, tuple)):
        args = list(parameters)
    else:
        raise TypeError("parameters must be a dict, list or tuple")
    result = spark.sql(text, args, **tables)
    if shape == "single_value":
        return single_value(result)
    return result if shape == "DataFrame" else _rows(result, shape)


def single_value(df: DataFrame):
    """First column of the first row, or None."""
    row = df.first()
    return None if row is None else row[0]


def _rows(df: DataFrame, shape: str) -> Iterator[dict | tuple]:
    for row in df.toLocalIterator():
        yield row.asDict(recursive=True) if shape == "dict" else tuple(row)

"""Tables and queries of database systems, read over JDBC."""

from __future__ import annotations

import datetime
import decimal
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# As in statements: what is quoted or commented is passed over; "::" is no parameter
_PARAMETER = re.compile(
    r"""'(?:[^']|'')*' | "[^"]*" | `[^`]*` | --[^\n]* | /\*.*?\*/
        | ::+ | @@+
        | [:@](?P<name>[A-Za-z_]\w*)""",
    re.VERBOSE | re.DOTALL,
)


def sql_literal(value: object) -> str:
    """A value as an SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return f"'{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no SQL literal for {type(value).__name__}")


def with_literals(query: str, parameters: Mapping[str, object] | None) -> str:
    """``:name`` and ``@name`` outside quotes replaced by literals; a missing name is an error.

    A JDBC source takes query text only, so values cannot travel beside it.
    """
    def put(match: re.Match) -> str:
        name = match["name"]
        if name is None:
            return match[0]
        if parameters is None or name not in parameters:
            raise KeyError(f"parameter {name} is not given")
        return sql_literal(parameters[name])

    return query if parameters is None else _PARAMETER.sub(put, query)


#: Rows of one range where the number of ranges is not given, and ranges counted by one query.
ROWS_PER_PART, BUCKETS = 1_000_000, 256

Bucket = tuple[int, int, int]


def _buckets(
    spark: SparkSession, url: str, table: str, column: str, low: int, high: int, rows: int, most: int,
    options: Mapping[str, str],
) -> list[Bucket]:
    """``(first, last, rows)`` of neighbouring buckets of the values, each of up to ``most`` rows or one value.

    The source counts them; only the buckets with too many rows are counted again, more finely.
    """
    done, crowded = [], [(low, high, rows)]
    while crowded:
        finer: list[Bucket] = []
        for first, last, n in crowded:
            if n <= most or first == last:
                done.append((first, last, n))
                continue
            width = (last - first) // BUCKETS + 1
            counted = read_query(spark, url, f"""
                SELECT MIN(v) AS lo, MAX(v) AS hi, COUNT(*) AS n
                FROM (SELECT {column} AS v, FLOOR({column} / {width}) AS bucket FROM {table}
                      WHERE {column} BETWEEN {first} AND {last}) b
                GROUP BY bucket""", **options)
            finer += [(int(lo), int(hi), int(n)) for lo, hi, n in counted.collect()]
        crowded = finer
    return sorted(done)


def equal_ranges(buckets: Sequence[Bucket], column: str, parts: int, n_null: int) -> list[str]:
    """Conditions that cut the values into up to ``parts`` ranges of similar numbers of rows.

    Together they hold for every row, also for one that came after the counting. Only a value that has more
    rows than half a range's share makes its range larger than one and a half shares. Many NULLs have a
    range of their own.
    """
    total, before, starts = sum(n for *_, n in buckets), 0, {}
    for first, _, n in buckets:
        # By the place of the bucket's middle row
        starts.setdefault((2 * before + n) * parts // (2 * total), first)
        before += n
    starts = list(starts.values())
    ranges = []
    for i, first in enumerate(starts):
        bounds = [f"{column} >= {first}"] if i else []
        bounds += [f"{column} < {starts[i + 1]}"] if i + 1 < len(starts) else []
        ranges.append(" AND ".join(bounds))
    if 2 * n_null * parts > total:
        return [r or f"{column} IS NOT NULL" for r in ranges] + [f"{column} IS NULL"]
    return [f"{ranges[0]} OR {column} IS NULL" if ranges[0] else "1 = 1", *ranges[1:]]


def read_table(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None,
    parts: int | None = None, quote: str = '"', **options: str,
) -> DataFrame:
    """A whole table. With a numeric or time ``partition_column`` it is read in parallel ranges.

    The ranges of a whole number hold similar numbers of rows, however the values lie: the source counts
    them first. Those of other types are equal steps from MIN to MAX. Ranges split the work and drop no
    row. Without ``parts`` there is one for each ``ROWS_PER_PART`` rows.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    if partition_column is None:
        return reader.option("dbtable", table).load()
    column = f"{quote}{partition_column}{quote}"
    low, high, filled, rows = read_query(
        spark, url,
        f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT({column}) AS filled, COUNT(*) AS n FROM {table}",
        **options,
    ).first()
    parts = parts or max(1, -(-int(rows) // ROWS_PER_PART))
    if low is None or parts == 1:
        return reader.option("dbtable", table).load()
    if isinstance(low, int):
        most = max(1, -(-int(filled) // parts) // 2)
        buckets = _buckets(spark, url, table, column, low, high, int(filled), most, options)
        return spark.read.options(**options).jdbc(
            url, table, predicates=equal_ranges(buckets, column, parts, int(rows - filled)))
    return reader.options(
        dbtable=table, partitionColumn=partition_column, lowerBound=str(low), upperBound=str(high),
        numPartitions=str(parts),
    ).load()


def read_query(
    spark: SparkSession, url: str, query: str, parameters: Mapping[str, object] | None = None,
    **options: str,
) -> DataFrame:
    """The result of a query that runs at the source, for example one that gives a geometry as text."""
    if not query:
        raise ValueError("no query given")
    return (
        spark.read.format("jdbc")
        .options(url=url, query=with_literals(query, parameters), **options)
        .load()
    )

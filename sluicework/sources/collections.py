"""Nested documents: reading a collection and finding in it."""

from __future__ import annotations

import datetime
import decimal
import functools
import operator
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.operators.ranking import number_rows


def read_collection(
    spark: SparkSession, path: str, schema: T.StructType | None = None, format: str = "json",
    **options: str,
) -> DataFrame:
    """Documents from nested JSON or Parquet, or from a document store whose connector is deployed.

    Documents with different keys have the union of the keys; what a document lacks is NULL.
    """
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif format == "parquet":
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


#: Up to so many rows sorting and skipping is a top-k; beyond it the rows are numbered in parallel.
TOP_ROWS = 10_000


def _family(of: object) -> str:
    """Numbers, texts, truth values and points in time compare among themselves only."""
    if isinstance(of, (bool, T.BooleanType)):
        return "truth"
    if isinstance(of, (int, float, decimal.Decimal, T.NumericType)):
        return "number"
    if isinstance(of, (str, T.StringType)):
        return "text"
    if isinstance(of, (datetime.date, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    return "binary" if isinstance(of, (bytes, bytearray, T.BinaryType)) else "other"


def _equals(column: Column, kind: T.DataType, value: object) -> Column:
    if value is None:
        return column.isNull()
    if isinstance(value, (list, tuple)):
        if not isinstance(kind, T.ArrayType):
            return F.lit(False)
        same = [_equals(F.get(column, F.lit(i)), kind.elementType, v) for i, v in enumerate(value)]
        return functools.reduce(operator.and_, same, F.size(column) == len(value))
    return (column == F.lit(value)) if _family(kind) == _family(value) else F.lit(False)


def _compares(compare: Callable[[Column, Column], Column]) -> Callable[..., Column]:
    return lambda column, kind, value: (
        compare(column, F.lit(value)) if _family(kind) == _family(value) != "other" else F.lit(False))


def _is_any(column: Column, kind: T.DataType, values: Sequence[object]) -> Column:
    plain = [v for v in values if _family(v) == _family(kind) != "other"]
    other = [_equals(column, kind, v) for v in values if v is None or isinstance(v, (list, tuple))]
    return functools.reduce(operator.or_, other, column.isin(plain) if plain else F.lit(False))


_LEAF: dict[str, Callable[[Column, T.DataType, object], Column]] = {
    "$eq": _equals,
    "$in": _is_any,
    "$gt": _compares(operator.gt), "$gte": _compares(operator.ge),
    "$lt": _compares(operator.lt), "$lte": _compares(operator.le),
    "$regex": lambda column, kind, value: column.rlike(value) if _family(kind) == "text" else F.lit(False),
}
_NEGATED = {"$ne": "$eq", "$nin": "$in"}


def _not(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def _reached(column: Column, kind: T.DataType, path: Sequence[str], leaf: Callable[[Column, T.DataType], Column],
             absent: bool = False) -> Column:
    """``leaf`` at the end of the path; on the way any element of an array will do.

    ``absent`` says what holds where the path ends early.
    """
    if not path:
        return leaf(column, kind)
    name, rest = path[0], path[1:]
    if isinstance(kind, T.StructType):
        by_name = {f.name: f for f in kind}
        if name not in by_name:
            return F.lit(absent)
        return _reached(column.getField(name), by_name[name].dataType, rest, leaf, absent)
    if isinstance(kind, T.MapType):
        return _reached(F.try_element_at(column, F.lit(name)), kind.valueType, rest, leaf, absent)
    if isinstance(kind, T.ArrayType):
        if name.isdigit():
            return _reached(F.get(column, F.lit(int(name))), kind.elementType, rest, leaf, absent)
        found = F.exists(column, lambda e: _reached(e, kind.elementType, path, leaf, absent))
        return (column.isNull() | found) if absent else found
    return F.lit(absent)


def _any_element(test: Callable[[Column, T.DataType, object], Column], value: object):
    """A test of a value, or of any element of an array (or of the whole array)."""
    def leaf(column: Column, kind: T.DataType) -> Column:
        whole = test(column, kind, value)
        if not isinstance(kind, T.ArrayType):
            return whole
        return whole | F.exists(column, lambda e: test(e, kind.elementType, value))

    return leaf


def _tests(column: Column, kind: T.DataType, path: Sequence[str], tests: Mapping[str, object]) -> Column:
    parts = []
    for name, value in tests.items():
        if name in _NEGATED:
            parts.append(_not(_tests(column, kind, path, {_NEGATED[name]: value})))
        elif name == "$not":
            parts.append(_not(_field(column, kind, path, value)))
        elif name == "$exists":
            there = _reached(column, kind, path, lambda c, k: c.isNotNull())
            parts.append(there if value else _not(there))
        elif name == "$size":
            parts.append(_reached(column, kind, path, lambda c, k, n=value: (
                (F.size(c) == n) if isinstance(k, T.ArrayType) else F.lit(False))))
        elif name == "$all":
            each = [_tests(column, kind, path, {"$eq": v}) for v in value]
            parts.append(functools.reduce(operator.and_, each) if each else F.lit(False))
        elif name == "$elemMatch":
            def element(c: Column, k: T.DataType, inner=value) -> Column:
                if not isinstance(k, T.ArrayType):
                    return F.lit(False)
                if all(n.startswith("$") and n not in _JOINS for n in inner):
                    return F.exists(c, lambda e: _tests(e, k.elementType, (), inner))
                return F.exists(c, lambda e: _matches(inner, lambda p: (e, k.elementType, p)))

            parts.append(_reached(column, kind, path, element))
        elif name in _LEAF:
            absent = (name == "$eq" and value is None) or (name == "$in" and None in value)
            parts.append(_reached(column, kind, path, _any_element(_LEAF[name], value), absent))
        else:
            raise ValueError(f"there is no operator {name}")
    return functools.reduce(operator.and_, parts, F.lit(True)) if len(parts) != 1 else parts[0]


def _field(column: Column, kind: T.DataType, path: Sequence[str], value: object) -> Column:
    tests = value if isinstance(value, Mapping) and any(k.startswith("$") for k in value) else {"$eq": value}
    return _tests(column, kind, path, tests)


_JOINS = {"$and": operator.and_, "$or": operator.or_, "$nor": operator.or_}


def _matches(filter: Mapping[str, object], at: Callable) -> Column:
    parts = []
    for name, value in filter.items():
        if name in _JOINS:
            if not value:
                raise ValueError(f"{name} needs at least one filter")
            joined = functools.reduce(_JOINS[name], [_matches(f, at) for f in value])
            parts.append(_not(joined) if name == "$nor" else joined)
        elif name.startswith("$"):
            raise ValueError(f"there is no operator {name}")
        else:
            parts.append(_field(*at(tuple(name.split("."))), value))
    return functools.reduce(operator.and_, parts) if parts else F.lit(True)


def matches(filter: Mapping[str, object], schema: T.StructType) -> Column:
    """A nested filter as one condition of Spark's own expressions; plain tests reach the scan.

    A field with a value, or with operators: ``$eq $ne $in $nin $gt $gte $lt $lte $regex $exists $not``,
    for arrays ``$size $all $elemMatch``; filters are joined by ``$and $or $nor``. A dotted name goes into
    documents, maps and arrays (any element, or the one of a number; several tests of a field may be met by
    several elements, those in ``$elemMatch`` by one). None matches what is NULL or not
    there, which a table cannot tell apart. Values of another kind (a number for a text) never match; a
    negation holds wherever the test does not. A field that no document has is not there.
    """
    by_name = {f.name: f.dataType for f in schema}

    def at(path: tuple[str, ...]):
        name = ".".join(path)
        if name in by_name:  # a column whose own name has dots
            return F.col(_quoted(name)), by_name[name], ()
        if path[0] not in by_name:
            return F.lit(None), T.NullType(), ()
        return F.col(_quoted(path[0])), by_name[path[0]], path[1:]

    return _matches(filter, at)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def find(
    documents: DataFrame,
    filter: Mapping[str, object] | None = None,
    project: Mapping[str, int] | Sequence[str] | None = None,
    sort: Sequence[tuple[str, int]] | None = None,
    skip: int | None = None,
    first: int | None = None,
) -> DataFrame:
    """Filter, sort, skip, first, project: in this order, whatever order they are given in.

    ``filter`` is what ``matches`` takes. ``project`` with 1 keeps fields, with 0 drops them. ``sort``
    pairs a field with 1 or -1; it should end in a unique field to be repeatable. Few rows (``skip`` and
    ``first`` together up to ``TOP_ROWS``) are a top-k; otherwise the rows are numbered by the sizes of
    sorted runs, and no task sees them all.
    """
    result = documents
    if filter:
        result = result.filter(matches(filter, documents.schema))
    order = [F.desc(f) if way < 0 else F.asc(f) for f, way in sort or ()]
    if skip and not (first and skip + first <= TOP_ROWS):
        number = "n"
        while number in result.columns:
            number += "_"
        result = number_rows(result, order, number).filter(F.col(number) > skip)
        if first:
            result = result.filter(F.col(number) <= skip + first)
        result = result.orderBy(number).drop(number) if order else result.drop(number)
    else:
        if order:
            result = result.orderBy(*order)
        if skip:
            result = result.offset(skip)
        if first:
            result = result.limit(first)
    if project is None:
        return result
    if not isinstance(project, Mapping):
        return result.select(*project)
    kept = [f for f, on in project.items() if on]
    return result.select(*kept) if kept else result.drop(*project)

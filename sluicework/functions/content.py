"""Fingerprints and JSON text of whole values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions import clock
from sluicework.functions.text import as_flag


def fingerprint(content: Column) -> list[Column]:
    """Length in bytes and MD5: two contents with both equal are taken as identical."""
    return [
        F.octet_length(content).cast("bigint").alias("n_bytes"),
        F.md5(content.cast("binary")).alias("md5"),
    ]


def json_ready(field: T.StructField) -> Column:
    """The column as JSON should carry it: times and decimals as text, binary refused."""
    if has_binary(field.dataType):
        raise TypeError(f"column {field.name} is binary and has no JSON form")
    return _json_form(F.col(f"`{field.name}`"), field.dataType).alias(field.name)


def _json_form(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("string")
    if not _has_text_form(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: _json_form(e, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: _json_form(v, kind.valueType))
    fields = F.struct(*[_json_form(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.when(value.isNotNull(), fields)


def _has_text_form(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_text_form(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_text_form(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_has_text_form(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType))


def has_binary(kind: T.DataType) -> bool:
    if isinstance(kind, T.BinaryType):
        return True
    if isinstance(kind, T.ArrayType):
        return has_binary(kind.elementType)
    if isinstance(kind, T.MapType):
        return has_binary(kind.keyType) or has_binary(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(has_binary(f.dataType) for f in kind.fields)
    return False


def row_json(schema: T.StructType, keep_nulls: bool = True) -> Column:
    """One JSON object per row; a NULL column is written as ``null``."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*[json_ready(f) for f in schema.fields]), options)


def folded_json_object(text: Column) -> Column:
    """A JSON object as a map of texts whose keys are lower case."""
    entries = F.from_json(text, "MAP<STRING,STRING>", {"mode": "FAILFAST"})
    return F.transform_keys(entries, lambda key, _: F.lower(key))


def converted(text: Column, kind: T.DataType, strict: bool = True, what: str = "value") -> Column:
    """Text to ``kind``. A text that does not convert is an error, or NULL when not strict.

    The outcome does not depend on ``spark.sql.ansi.enabled``. TIME needs ``spark.sql.timeType.enabled``.
    """
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        return as_flag(text)
    if isinstance(kind, T.DateType):
        value = clock.iso_date(text)
    elif isinstance(kind, T.TimeType):
        value = clock.iso_time(text).try_cast(kind)
    elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        value = clock.iso_timestamp(text).cast(kind)
    elif isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType,
                           T.DoubleType, T.FloatType, T.DecimalType)):
        value = text.try_cast(kind)
    else:
        raise TypeError(f"no conversion from text to {kind.simpleString()} for {what}")
    if not strict:
        return value
    message = F.concat(F.lit(f"{what}: cannot convert '"), text, F.lit(f"' to {kind.simpleString()}"))
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message).cast(kind)))

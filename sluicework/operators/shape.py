"""Fitting rows to a target schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.content import converted
from sluicework.functions.text import blank_to_null, is_heading


def folded(names: Sequence[str]) -> dict[str, str]:
    """Lower-case name to written name; two names that differ only in case are an error."""
    result: dict[str, str] = {}
    for name in names:
        if name.lower() in result:
            raise ValueError(f"columns {result[name.lower()]} and {name} differ only in case")
        result[name.lower()] = name
    return result


def source_names(schema: T.StructType, column_map: Mapping[str, str] | None) -> dict[str, str]:
    """Target column to the lower-case source name that feeds it."""
    given = {k.lower(): v.lower() for k, v in (column_map or {}).items()}
    unknown = set(given) - {f.name.lower() for f in schema.fields}
    if unknown:
        raise ValueError(f"column map names no target column: {', '.join(sorted(unknown))}")
    return {f.name: given.get(f.name.lower(), f.name.lower()) for f in schema.fields}


def align(
    df: DataFrame,
    schema: T.StructType,
    strict: bool = False,
    column_map: Mapping[str, str] | None = None,
) -> DataFrame:
    """The columns of ``schema``, by name and regardless of case, in its order and types.

    A target column without a source is NULL. A source column without a target is dropped, or is an
    error when ``strict``. Text is converted by the rules of ``converted``.
    """
    present = folded(df.columns)
    wanted = source_names(schema, column_map)
    extra = [name for low, name in present.items() if low not in wanted.values()]
    if strict and extra:
        raise ValueError(f"no target column for source column {', '.join(extra)}")
    types = {f.name: f.dataType for f in df.schema.fields}

    def fitted(field: T.StructField) -> Column:
        name = present.get(wanted[field.name])
        if name is None:
            column = F.lit(None).cast(field.dataType)
        elif isinstance(types[name], T.StringType):
            column = converted(F.col(f"`{name}`"), field.dataType, what=field.name)
        elif types[name] == field.dataType:
            column = F.col(f"`{name}`")
        else:
            column = F.col(f"`{name}`").cast(field.dataType)
        return column.alias(field.name)

    return df.select(*[fitted(f) for f in schema.fields])


def from_texts(
    df: DataFrame,
    text_of: Callable[[str], Column],
    schema: T.StructType,
    column_map: Mapping[str, str] | None = None,
    strict: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed columns out of texts that ``text_of`` finds by lower-case source name."""
    wanted = source_names(schema, column_map)
    columns = [
        converted(text_of(wanted[f.name]), f.dataType, strict, f.name).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*keep, *columns)


def convert(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Text columns to the types of ``schema``."""
    present = folded(df.columns)
    return df.select(
        *[
            converted(F.col(f"`{present[f.name.lower()]}`"), f.dataType, strict, f.name).alias(f.name)
            for f in schema.fields
        ]
    )


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def fold_names(df: DataFrame) -> DataFrame:
    return df.toDF(*folded(df.columns))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in any floating column becomes NULL."""
    floating = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Without the rows that hold nothing but NULL and empty text."""
    def filled(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        return (blank_to_null(column) if isinstance(field.dataType, T.StringType) else column).isNotNull()

    kept = F.lit(False)
    for field in df.schema.fields:
        kept = kept | filled(field)
    return df.filter(kept)


def skip_headings(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~is_heading(F.col(column)))


def stack(frames: Sequence[DataFrame], empty: DataFrame | None = None) -> DataFrame:
    """All rows of all frames, by name, with NULL for what a frame lacks."""
    if not frames:
        if empty is None:
            raise ValueError("no frames to stack")
        return empty
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def name_differences(
    left: Sequence[str], right: Sequence[str], fold: bool = True
) -> tuple[list[str], list[str]]:
    """Names only on the left and only on the right, compared exactly or folded."""
    key = str.lower if fold else str
    left_keys, right_keys = {key(n) for n in left}, {key(n) for n in right}
    return (
        sorted(n for n in left if key(n) not in right_keys),
        sorted(n for n in right if key(n) not in left_keys),
    )

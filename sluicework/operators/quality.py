"""Row rules: which rows may land, which go back, and why.

A rule passes on NULL, as a CHECK constraint does; only ``NotNull`` fails on it. Rows are text until
they are accepted, so a rejected row goes back as it came.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.content import converted
from sluicework.operators.matching import join_per_key
from sluicework.operators.shape import convert

REASONS = "reasons"


@dataclass(frozen=True)
class Rule:
    """A named condition on one row; ``fails`` gives the failing condition."""

    name: str
    fails: Callable[[], Column]


@dataclass(frozen=True)
class Unique:
    """Of the rows that pass everything else, the first by ``position`` keeps the key."""

    name: str
    keys: tuple[str, ...]
    position: str


def not_null(column: str, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_null", lambda: F.col(column).isNull())


def one_of(column: str, values: Sequence[str], name: str | None = None) -> Rule:
    return Rule(name or f"{column}_list", lambda: ~F.col(column).isin(list(values)))


def max_length(column: str, longest: int, name: str | None = None) -> Rule:
    return Rule(name or f"{column}_length", lambda: F.length(column) > longest)


def convertible(column: str, kind: T.DataType, name: str | None = None) -> Rule:
    return Rule(
        name or f"{column}_type",
        lambda: F.col(column).isNotNull() & converted(F.col(column), kind, strict=False).isNull(),
    )


def in_range(column: str, kind: T.DataType, low, high, name: str | None = None) -> Rule:
    def fails() -> Column:
        value = converted(F.col(column), kind, strict=False)
        return (value < F.lit(low)) | (value > F.lit(high))

    return Rule(name or f"{column}_range", fails)


def check(df: DataFrame, rules: Sequence[Rule | Unique]) -> DataFrame:
    """The rows with the sorted names of the rules they fail."""
    checks = sorted((r for r in rules if isinstance(r, Rule)), key=lambda r: r.name)
    none = F.lit("")
    names = [F.when(F.coalesce(r.fails(), F.lit(False)), F.lit(r.name)).otherwise(none) for r in checks]
    failed = F.array_remove(F.array(*names), "") if checks else F.array().cast("array<string>")
    result = df.withColumn(REASONS, failed)
    for rule in rules:
        if isinstance(rule, Unique):
            result = _check_unique(result, rule)
    return result


def _check_unique(checked: DataFrame, rule: Unique) -> DataFrame:
    # Counted first: only keys that repeat meet the rows again, and a hot key is one row there
    keys = list(rule.keys)
    firsts = (
        checked.filter(F.size(REASONS) == 0)
        .groupBy(*keys)
        .agg(F.min(rule.position).alias("_first"), F.count("*").alias("_n"))
        .filter(F.col("_n") > 1)
        .drop("_n")
    )
    late = (
        (F.size(REASONS) == 0)
        & F.col("_first").isNotNull()
        & (F.col(rule.position) != F.col("_first"))
    )
    joined = join_per_key(checked, firsts, keys)
    return joined.select(
        *[c for c in checked.columns if c != REASONS],
        F.when(late, F.array(F.lit(rule.name))).otherwise(F.col(REASONS)).alias(REASONS),
    )


def accepted(checked: DataFrame, schema: T.StructType) -> DataFrame:
    """The good rows, in the types of the target."""
    return convert(checked.filter(F.size(REASONS) == 0), schema)


def rejected(checked: DataFrame, error: str = "ImportError") -> DataFrame:
    """The bad rows as they came, with the reasons as text."""
    bad = checked.filter(F.size(REASONS) > 0)
    return bad.withColumn(error, F.array_join(REASONS, ", ")).drop(REASONS)


def all_or_nothing(checked: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows typed. One bad row fails the job that writes them, so nothing of the batch lands."""
    message = F.concat(F.lit("batch rejected: "), F.array_join(REASONS, ", "))
    guarded = checked.withColumn(
        REASONS, F.when(F.size(REASONS) > 0, F.raise_error(message).cast("array<string>")).otherwise(F.col(REASONS))
    )
    # The filter reads the guard, so that no plan can drop it
    return convert(guarded.filter(F.size(REASONS) == 0), schema)


def repair(
    df: DataFrame, rules: Sequence[Rule | Unique], rule: str, column: str, fix: Column
) -> DataFrame:
    """Checked rows after one retry of those whose only failure is ``rule``.

    ``fix`` replaces the value in the retry. A row that fails again goes back with its own value.
    """
    original = f"_{column}"
    first = check(df, [r for r in rules if isinstance(r, Rule)])
    retry = F.array(F.lit(rule)) == F.col(REASONS)
    retried = (
        first.withColumn(original, F.col(column))
        .withColumn(column, F.when(retry, fix).otherwise(F.col(column)))
        .drop(REASONS)
    )
    again = check(retried, rules)
    kept = F.when(F.size(REASONS) > 0, F.col(original)).otherwise(F.col(column))
    return again.withColumn(column, kept).drop(original)


def summary(checked: DataFrame) -> DataFrame:
    """How many rows each rule rejected."""
    return (
        checked.select(F.explode(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
    )


def write_split(checked: DataFrame, path: str) -> None:
    """Good and bad rows from one pass over the input, as ``accepted=true`` and ``accepted=false``."""
    (
        checked.withColumn("accepted", F.size(REASONS) == 0)
        .write.partitionBy("accepted").mode("errorifexists").parquet(path)
    )

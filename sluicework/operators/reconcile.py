"""Is the copy the same as the source, and where not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.functions.content import fingerprint
from sluicework.operators.profile import unpivot_counts


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``copies`` = copies left - copies right.

    One shuffle on all columns with map-side sums: equal rows cancel out, and a row repeated many
    times travels as one row with a count.
    """
    right = right.select(*left.columns)
    return (
        left.withColumn("copies", F.lit(1).cast("bigint"))
        .unionAll(right.withColumn("copies", F.lit(-1).cast("bigint")))
        .groupBy(*left.columns)
        .agg(F.sum("copies").alias("copies"))
        .filter(F.col("copies") != 0)
    )


def rows_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the rows of each side, the rows only on each side, and whether the bags are equal.

    ``equal`` also needs something to have been compared.
    """
    right = right.select(*left.columns)
    net = (
        left.select(*left.columns, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionAll(right.select(*left.columns, F.lit(0), F.lit(1)))
        .groupBy(*left.columns)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    )
    zero = F.lit(0).cast("bigint")
    sums = net.agg(
        F.coalesce(F.sum("_l"), zero).alias("n_left"),
        F.coalesce(F.sum("_r"), zero).alias("n_right"),
        F.coalesce(F.sum(F.greatest(F.col("_l") - F.col("_r"), zero)), zero).alias("n_only_left"),
        F.coalesce(F.sum(F.greatest(F.col("_r") - F.col("_l"), zero)), zero).alias("n_only_right"),
    )
    return sums.withColumn(
        "equal",
        (F.col("n_left") > 0) & (F.col("n_only_left") == 0) & (F.col("n_only_right") == 0),
    )


def paired(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key: the counts and the values of both sides (``_l``, ``_r`` structs).

    A grouping instead of a full outer join: a repeated key is counted, never multiplied out. The
    values are meaningful where both counts are at most 1.
    """
    def side(df: DataFrame, is_left: bool) -> DataFrame:
        values = F.struct(*columns)
        missing = F.lit(None).cast(df.select(values.alias("v")).schema["v"].dataType)
        return df.select(
            *keys,
            F.lit(1 if is_left else 0).alias("_nl"),
            F.lit(0 if is_left else 1).alias("_nr"),
            (values if is_left else missing).alias("_l"),
            (missing if is_left else values).alias("_r"),
        )

    return (
        side(left, True)
        .unionAll(side(right, False))
        .groupBy(*keys)
        .agg(
            F.sum("_nl").alias("_nl"),
            F.sum("_nr").alias("_nr"),
            F.any_value("_l", F.lit(True)).alias("_l"),
            F.any_value("_r", F.lit(True)).alias("_r"),
        )
    )


def diff_by_column(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per column: keys compared, differing values, and the values that were not NULL.

    Compared are the keys found exactly once on both sides. ``n_unmatched`` counts the keys of one
    side only, ``n_repeated`` the keys that cannot be compared because they repeat.
    """
    pairs = paired(left, right, keys, columns)
    once = (F.col("_nl") == 1) & (F.col("_nr") == 1)
    zero = F.lit(0).cast("bigint")

    def tally(condition: Column, name: str) -> Column:
        return F.coalesce(F.count_if(condition), zero).alias(name)

    counts = pairs.agg(
        tally(once, "n_compared"),
        tally((F.col("_nl") == 0) | (F.col("_nr") == 0), "n_unmatched"),
        tally((F.col("_nl") > 1) | (F.col("_nr") > 1), "n_repeated"),
        *[
            tally(once & ~F.col("_l")[c].eqNullSafe(F.col("_r")[c]), f"_d{i}")
            for i, c in enumerate(columns)
        ],
        *[tally(once & F.col("_l")[c].isNotNull(), f"_v{i}") for i, c in enumerate(columns)],
    )
    return unpivot_counts(
        counts, columns, ["n_compared", "n_unmatched", "n_repeated"],
        {"n_differing": "d", "n_not_null": "v"},
    )


def content_fingerprint(df: DataFrame, key: str, content: str) -> DataFrame:
    """Length and MD5 of every content, to be compared by key instead of the content itself."""
    return df.select(key, *fingerprint(F.col(content)))


def facts(counts: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """A one-row frame of counts as (fact, ok, detail) rows, one per check."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("fact"),
            F.coalesce(ok, F.lit(False)).alias("ok"),
            detail.cast("string").alias("detail"),
        )
        for name, ok, detail in checks
    ])
    return counts.select(F.inline(rows))

"""Matching rows by key.

No join here carries a broadcast hint: Spark broadcasts a side only below
``spark.sql.autoBroadcastJoinThreshold``, measured, and otherwise sorts and merges with adaptive
splitting of skewed partitions. Where the answer is about keys, both sides are reduced to one row
per key before they meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_per_key(
    left: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Rows joined with an aggregate that has one row per key; ``how`` keeps the left side.

    Adaptive execution splits a hot partition only where both sides come straight out of a shuffle.
    An aggregate is already placed by its key and would be joined in place, hot key and all. The
    hash as a second key makes Spark shuffle the aggregate once more, one row per key. With
    ``null_safe`` a NULL key matches NULL.
    """
    mark = F.xxhash64(*keys)
    marked = left.withColumn("_mark", mark)
    other = per_key.withColumn("_other_mark", mark).withColumnsRenamed({k: f"_other_{k}" for k in keys})
    condition = F.col("_mark") == F.col("_other_mark")
    for key in keys:
        mine, its = F.col(key), F.col(f"_other_{key}")
        condition = condition & (mine.eqNullSafe(its) if null_safe else mine == its)
    joined = marked.join(other, condition, how)
    return joined.drop("_mark", "_other_mark", *[f"_other_{k}" for k in keys])


def _per_key(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    renamed = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    return renamed.groupBy(*names).agg(F.count("*").alias("n_rows"))


def orphans_both_ways(
    left: DataFrame, left_keys: Sequence[str], right: DataFrame, right_keys: Sequence[str],
) -> DataFrame:
    """Keys found on one side only, with the side and the number of rows behind them.

    As with NOT EXISTS, a key with a NULL in it matches nothing and is an orphan.
    """
    names = list(left_keys)
    a, b = _per_key(left, left_keys, names), _per_key(right, right_keys, names)
    return (
        a.join(b, names, "left_anti").select(F.lit("left").alias("only_in"), *names, "n_rows")
        .unionAll(
            b.join(a, names, "left_anti").select(F.lit("right").alias("only_in"), *names, "n_rows")
        )
    )


def coverage(parents: DataFrame, key: str, children: DataFrame, child_key: str) -> DataFrame:
    """One row: distinct parents, distinct parents named by children, and the gaps both ways."""
    sides = (
        parents.select(F.col(key).alias("_key"), F.lit(1).alias("_p"), F.lit(0).alias("_c"))
        .unionAll(children.select(F.col(child_key), F.lit(0), F.lit(1)))
        .filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.max("_p").alias("_p"), F.max("_c").alias("_c"))
    )
    return sides.agg(
        F.count_if(F.col("_p") == 1).alias("n_parents"),
        F.count_if(F.col("_c") == 1).alias("n_parents_in_children"),
        F.count_if((F.col("_p") == 1) & (F.col("_c") == 0)).alias("n_without_children"),
        F.count_if((F.col("_p") == 0) & (F.col("_c") == 1)).alias("n_without_parent"),
    )

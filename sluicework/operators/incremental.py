"""Transferring only what is new or changed, and merging it into a target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.operators.matching import join_per_key
from sluicework.operators.reconcile import bag_difference

# Operation codes of a change feed.
DELETED, INSERTED, BEFORE, AFTER = 1, 2, 3, 4


def above(source: DataFrame, key: str, low: int) -> DataFrame:
    """Rows the target cannot have yet. Changes to older rows are not seen (see ``changed_since``)."""
    return source.filter(F.col(key) > low)


def between(source: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """Rows of one transfer, low < key <= high. The same bounds serve parents and children."""
    return source.filter((F.col(key) > low) & (F.col(key) <= high))


def transfer_pass(
    sources: Mapping[str, tuple[DataFrame, str]], low: int, high: int
) -> dict[str, DataFrame]:
    """One pass over tables that belong together, each given with its key column.

    All tables get the same two bounds, taken once before the pass, so a parent that arrives while
    the pass runs is left to the next one together with its children.
    """
    return {name: between(df, key, low, high) for name, (df, key) in sources.items()}


def changed_since(source: DataFrame, key: str, high: int, changed: str, since) -> DataFrame:
    """Rows the target has (key <= high) that changed after ``since``.

    ``since`` None (nothing in the target ever changed) takes every row that has a change time.
    """
    known = source.filter(F.col(key) <= high)
    if since is None:
        return known.filter(F.col(changed).isNotNull())
    return known.filter(F.col(changed) > since)


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row per key. ``order`` must be unique within a key."""
    others = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


def merge_delete_rewrite(target: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the keys of ``changed``, plus all rows of ``changed``."""
    gone = changed.select(*keys).distinct()
    kept = join_per_key(target, gone, keys, "left_anti").select(*target.columns)
    return kept.unionByName(changed)


def merge_update_columns(
    target: DataFrame, changed: DataFrame, keys: Sequence[str], columns: Sequence[str],
    order: Sequence[Column | str], keep_when_null: bool = False,
) -> DataFrame:
    """The target with ``columns`` taken from the last change of the same key.

    A change without a target row is ignored. A NULL in a change overwrites, or with
    ``keep_when_null`` leaves the old value.
    """
    change = changed.groupBy(*keys).agg(
        F.max_by(F.struct(*columns), F.struct(*order)).alias("_new")
    )
    joined = join_per_key(target, change, keys)

    def value(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        new = F.col("_new")[name]
        taken = new.isNotNull() if keep_when_null else F.col("_new").isNotNull()
        return F.when(taken, new).otherwise(F.col(name)).alias(name)

    return joined.select(*[value(c) for c in target.columns])


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns one snapshot into the other: ``op`` 1 deleted, 2 inserted, 3/4 before and after.

    Unchanged rows cancel out in the first shuffle, so only changed rows are matched by key. A key
    with exactly one old and one new row is an update; other keys (also repeated ones) give their
    rows as deletes and inserts, ``copies`` times each.
    """
    rows = bag_difference(new, old)
    kinds = rows.groupBy(*keys).agg(
        F.sum(F.when(F.col("copies") < 0, -F.col("copies")).otherwise(0)).alias("_out"),
        F.sum(F.when(F.col("copies") > 0, F.col("copies")).otherwise(0)).alias("_in"),
    )
    joined = join_per_key(rows, kinds, keys, "inner", null_safe=True)
    update = (F.col("_out") == 1) & (F.col("_in") == 1)
    op = (
        F.when(update, F.when(F.col("copies") < 0, BEFORE).otherwise(AFTER))
        .otherwise(F.when(F.col("copies") < 0, DELETED).otherwise(INSERTED))
    )
    return joined.select(op.alias("op"), F.abs("copies").alias("copies"), *old.columns)


def apply_change_feed(
    target: DataFrame, feed: DataFrame, keys: Sequence[str], position: Sequence[str], op: str = "op"
) -> DataFrame:
    """The target after the last operation of every key, in the order of ``position``.

    Before-images are not operations. A last delete removes the row. A feed with ``copies`` (see
    ``change_feed``) is the difference of two bags of rows: what it takes out is subtracted, what it
    brings in is added, as often as it says, so repeated keys and rows come out right too.
    """
    if "copies" in feed.columns:
        sign = F.when(F.col(op).isin(DELETED, BEFORE), -F.col("copies")).otherwise(F.col("copies"))
        rows = target.select("*", F.lit(1).cast("bigint").alias("_n")).unionByName(
            feed.select(*target.columns, sign.cast("bigint").alias("_n")))
        left = rows.groupBy(*target.columns).agg(F.sum("_n").alias("_n")).filter(F.col("_n") > 0)
        copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))
        return left.select(*target.columns, copies.alias("_copy")).drop("_copy")
    last = unique_by(
        feed.filter(F.col(op) != BEFORE).select(*target.columns, op, *position), keys, position
    )
    kept = join_per_key(target, last.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(last.filter(F.col(op) != DELETED).select(*target.columns))

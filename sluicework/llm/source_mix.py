"""Mixing sources to target weights by capped water-filling.

Targets share the total by weight; a source whose target would pass ``max_epochs`` times its size is
clamped there and the excess is shared again by weight, until none is above. With the sources sorted by
size over weight that is one pass of running sums. Each source is then taken in whole repetitions and
one fractional repetition: its documents in the order of a seeded hash, up to the words still missing,
the last one of them in part. So a source's words equal its rounded target.

The place in that order is found by two histograms over the hash (2^12 cells, then 2^12 cells within
one) and an exact ordering of the few documents in the last cell, so a source with a third of all rows
is never sorted in one task.

Defined results: a NULL text has size 0 and takes nothing; a NULL source is a source of its own, last
in order; a source of size 0 has target 0. Repeated rows share one place in the order and divide what
falls to them, rounded down. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.components import bounded, written
from sluicework.llm.texts import SPACE, WORD

MAX_EPOCHS, SEED = 3, "mix"
#: The order's hash has 52 bits: 12 for the first histogram, 12 for the second.
CELL, BELOW = 40, 28
#: Rows of the last cells up to this many are broadcast.
FEW = 100_000


def size_of(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place_of(doc_id: Column | str, seed: str = SEED) -> Column:
    """The document's place in the seeded order: 52 bits of a hash of its id."""
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows; one row per source is ranked."""
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    # The sources that reach their cap first have the smallest size for their weight
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    cap = (F.col("source_size") * max_epochs).cast("double")
    level = (F.col("total") - F.coalesce("capped", F.lit(0))).cast("double") / F.col("open_weight")
    ranked = (
        totals.withColumn("weight", weight)
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("capped", F.sum(F.col("source_size") * max_epochs).over(before))
        .withColumn("open_weight", F.sum("weight").over(rest))
        .withColumn("clamped", level * F.col("weight") >= cap)
        .withColumn("level", F.min(F.when(~F.col("clamped"), F.struct("capped", "source_size", level.alias("level")))).over(Window.partitionBy()))
    )
    target = F.when(F.col("clamped"), cap).otherwise(F.col("level.level") * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def _edge(rows: DataFrame, cell: Column) -> DataFrame:
    """For each source the cell in which its missing words run out, and the words before that cell."""
    cells = rows.groupBy("source", "rest", cell.alias("cell")).agg(F.sum("size").alias("held"))
    order = Window.partitionBy("source").orderBy("cell")
    running = cells.withColumn("upto", F.sum("held").over(order))
    return running.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("held") <= F.col("rest"))).select(
        F.col("source").alias("s"), F.col("cell").alias("edge"), (F.col("upto") - F.col("held")).alias("before"))


def _on_source(left: DataFrame, right: DataFrame, name: str = "s") -> DataFrame:
    return left.join(right, F.col("source").eqNullSafe(F.col(name)), "left").drop(name)


class Mix:
    """What a mix takes of each source: a plan by source and by the documents at the sources' edges."""

    def __init__(self, sizes: DataFrame, weights: Sequence[float], max_epochs: int = MAX_EPOCHS) -> None:
        """sizes: ``(doc_id, source, size, place)``, better a written table: it is read several times."""
        goals = targets(sizes, weights, max_epochs)
        goal = F.round("target").cast("long")
        full = F.col("source_size") > 0
        plan = written(goals.withColumns({
            "whole": F.when(full, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long"),
            "rest": F.when(full, goal - F.floor(goal / F.col("source_size")) * F.col("source_size")).otherwise(F.lit(0)).cast("long"),
        }), "plan")
        named = plan.withColumnRenamed("source", "s")
        rows = _on_source(sizes, named.select("s", "rest"))
        first = _edge(rows, F.shiftright("place", CELL)).withColumnRenamed("edge", "edge1").withColumnRenamed("before", "before1")
        inside = _on_source(rows, first).filter(F.shiftright("place", CELL) == F.col("edge1"))
        inside = inside.withColumn("rest", F.col("rest") - F.col("before1"))
        second = _edge(inside, F.shiftright("place", BELOW)).withColumnRenamed("edge", "edge2").drop("before")
        cells2 = inside.groupBy("source", F.shiftright("place", BELOW).alias("cell")).agg(F.sum("size").alias("held"))
        last = _on_source(inside, second).filter(F.shiftright("place", BELOW) == F.col("edge2"))
        earlier = _on_source(cells2, second).filter(F.col("cell") < F.col("edge2")).groupBy(
            F.col("source").alias("s")).agg(F.sum("held").alias("before2"))
        order = Window.partitionBy("source").orderBy("place", "doc_id", "size")
        alike = _on_source(last, earlier).groupBy("source", "doc_id", "place", "size", "rest", "before2").agg(F.count("*").alias("n"))
        held = F.col("size") * F.col("n")
        left = F.col("rest") - F.coalesce("before2", F.lit(0)) - (F.sum(held).over(order) - held)
        self.edge = bounded(written(alike.select(
            F.col("source").alias("s"), F.col("doc_id").alias("d"), F.col("place").alias("p"), F.col("size").alias("z"),
            F.floor(F.least(F.greatest(left, F.lit(0)), held) / F.col("n")).cast("long").alias("part"),
        ), "edge"), FEW)
        self.plan = written(_on_source(_on_source(plan, first), second), "plan")

    def taken(self, rows: DataFrame) -> DataFrame:
        """Rows ``(doc_id, source, size, place, …)`` with ``source_size``, ``target``, ``whole`` and ``part`` (words)."""
        plan = self.plan.withColumnRenamed("source", "s")
        found = _on_source(rows, plan).join(
            self.edge,
            F.col("source").eqNullSafe(F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d"))
            & (F.col("place") == F.col("p")) & (F.col("size") == F.col("z")), "left")
        cell, below = F.shiftright("place", CELL), F.shiftright("place", BELOW)
        part = (
            F.when(F.col("edge1").isNull(), F.lit(0))
            .when(cell != F.col("edge1"), F.when(cell < F.col("edge1"), F.col("size")).otherwise(F.lit(0)))
            .when(F.col("edge2").isNull() | (below < F.col("edge2")), F.col("size"))
            .when(below > F.col("edge2"), F.lit(0))
            .otherwise(F.coalesce("part", F.lit(0)))
        )
        return found.withColumn("part", part.cast("long")).drop(
            "s", "d", "p", "z", "rest", "edge1", "before1", "edge2")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", size_of("text").alias("size"), place_of("doc_id").alias("place"))


def shares(docs: DataFrame, weights: Sequence[float], max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` of every document."""
    sizes = written(sized(docs), "sizes")
    return Mix(sizes, weights, max_epochs).taken(sizes).select(
        "doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: Sequence[float], max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: each document as often as it is taken.

    The last repetition of a source may be part of a document: its text up to the end of the last taken
    word, white space as it is.
    """
    mix = Mix(written(sized(docs), "sizes"), weights, max_epochs)
    names = docs.columns
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), "doc_id", "source", size_of("text").alias("size"), place_of("doc_id").alias("place"))
    found = mix.taken(packed)
    whole = F.col("whole") + ((F.col("part") == F.col("size")) & (F.col("size") > 0)).cast("long")
    copies = F.array_repeat(F.lit(None).cast("long"), whole.cast("int"))
    some = F.when((F.col("part") > 0) & (F.col("part") < F.col("size")), F.array("part")).otherwise(F.array().cast("array<long>"))
    rows = found.select("_row", F.explode(F.concat(copies, some)).alias("_words"))
    # The words with the white space before them: the cut text is a beginning of the text
    words = F.regexp_extract_all("_row.text", F.lit(f"({SPACE}*{WORD})"))
    cut = F.when(F.col("_words").isNull(), F.col("_row.text")).otherwise(
        F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), ""))
    return rows.select(*(cut.alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in names))

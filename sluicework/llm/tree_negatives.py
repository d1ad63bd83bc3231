"""Hard negatives by score bounds along spanning trees of the anchors.

A score is the integer inner product of two vectors of whole components. Anchors are laid out so that
near ones are together and cut into blocks of ``ANCHORS``. In a block a minimum spanning tree joins them.
The score of a candidate c at an anchor lies within ``distance * |c|`` of its score at the anchor's
parent, so going down the tree every candidate has a lower and an upper bound at every anchor; only
candidates whose bounds overlap what the anchor still looks for are scored again, and these scores are
exact and narrow the bounds of the anchors below.

Two searches use it. The first finds each anchor's best rows of its own label: a candidate counts only
if its upper bound reaches the ``k``-th best so far. The second finds, for each score of a positive, the
best rows of other labels inside that positive's score window.

Work is cut into cells, a block of anchors and a part of about ``ROWS`` candidates, by a shuffle: the
anchors of a cell come first and are held, candidates stream past them. The cells' best are ranked by
Spark. Bounds prune what lies far from the block's tree; vectors without structure are all scored, so the
work grows with anchors times rows then, its memory and its output do not.

Defined results: rows with a NULL id, label or vector, with a NULL or non-finite component, or with
another length than most take no part. Rows that repeat an id count once, the one of smallest label and
vector. Ties go to the smaller id. Zero vectors take part. Scores are exact up to 64 bits; a larger one is
an error. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.components import written
from sluicework.operators.ranking import number_rows

#: Anchors in a block, candidates in a part, and candidates bounded at once.
ANCHORS, ROWS, BATCH = 256, 8192, 2048
POSITIVES, NEGATIVES = 5, 3
#: Score windows of negatives, in hundredths of the positive's score.
LOW, HIGH = 50, 95
SCALE = 256
PLANES = 24


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def whole(column: pa.Array, size: int) -> np.ndarray:
    """The vectors' components as whole numbers: ``floor(256 * x)`` in doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).reshape(len(column), size)


def inner(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit numbers."""
    largest = np.abs(rows).max(initial=0) * np.abs(vector).max(initial=0) * max(1, len(vector))
    if largest < 2**53:
        return (rows @ vector).astype(np.int64)
    exact = [[int(x) for x in row] for row in rows.tolist()]
    own = [int(x) for x in vector.tolist()]
    return np.array([sum(x * y for x, y in zip(row, own, strict=True)) for row in exact], dtype=np.int64)


def spanning_tree(points: np.ndarray) -> list[tuple[int, int, float]]:
    """``(node, parent, distance)`` of a minimum spanning tree, parents first; the root is its own parent."""
    count = len(points)
    near, parent = np.full(count, np.inf), np.zeros(count, dtype=np.int64)
    done = np.zeros(count, dtype=bool)
    node, out = 0, [(0, 0, 0.0)]
    for _ in range(count - 1):
        done[node] = True
        gap = np.sqrt(((points - points[node]) ** 2).sum(axis=1))
        closer = ~done & (gap < near)
        near[closer], parent[closer] = gap[closer], node
        node = int(np.argmin(np.where(done, np.inf, near)))
        out.append((node, int(parent[node]), float(near[node])))
    return out


class Bounds:
    """Scores of a batch of candidates at the anchors of a tree: exact where asked for, else bounded."""

    def __init__(self, anchors: np.ndarray, tree: list[tuple[int, int, float]], rows: np.ndarray) -> None:
        self.anchors, self.tree, self.rows = anchors, tree, rows
        self.norms = np.sqrt((rows**2).sum(axis=1))
        self.reach = np.sqrt((anchors**2).sum(axis=1))
        self.left = np.bincount([p for n, p, _ in tree if n != p], minlength=len(tree))
        self.low: dict[int, np.ndarray] = {}
        self.high: dict[int, np.ndarray] = {}
        self.rescored = 0

    def walk(self, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(anchor, places, scores)``: the candidates ``wanted(anchor, low, high)`` asks for, exactly scored."""
        for node, parent, gap in self.tree:
            if node == parent:
                high = self.reach[node] * self.norms * (1 + 1e-9) + 1
                low = -high
            else:
                # Rounding of the roots and products is far below the slack
                reach = gap * self.norms * (1 + 1e-9) + 1e-6 * (1 + np.abs(self.high[parent]))
                low, high = self.low[parent] - reach, self.high[parent] + reach
                self.left[parent] -= 1
                if not self.left[parent]:
                    del self.low[parent], self.high[parent]
            places = np.flatnonzero(wanted(node, low, high))
            part = self.rows if 2 * len(places) > len(self.rows) else self.rows[places]
            scores = inner(part, self.anchors[node])
            if len(part) > len(places):
                scores = scores[places]
            self.rescored += len(places)
            if self.left[node]:
                low[places] = high[places] = scores
                self.low[node], self.high[node] = low, high
            yield node, places, scores


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by score descending and id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


class Positives:
    """The best rows of an anchor's own label, over all batches of a cell."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, scores: list[list[int] | None], k: int) -> None:
        self.ids, self.labels, self.k = ids, labels, k
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]

    def meet(self, bounds: Bounds, ids: np.ndarray, labels: np.ndarray) -> None:
        def wanted(node: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            scores, _ = self.found[node]
            mine = (labels == self.labels[node]) & (ids != self.ids[node])
            return mine & (high >= scores[-1]) if len(scores) == self.k else mine

        for node, places, scores in bounds.walk(wanted):
            old_scores, old_ids = self.found[node]
            scores, found = np.r_[old_scores, scores], np.r_[old_ids, ids[places]]
            first = best(scores, found, self.k)
            self.found[node] = scores[first], found[first]

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for own, (scores, ids) in zip(self.ids.tolist(), self.found, strict=True):
            for score, vec_id in zip(scores.tolist(), ids.tolist(), strict=True):
                yield own, score, vec_id, score


class Negatives:
    """The best rows of other labels within the score window of each positive score of an anchor."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, scores: list[list[int] | None], k: int) -> None:
        self.ids, self.labels, self.k = ids, labels, k
        # From the least to the greatest whole score with LOW * positive <= 100 * score <= HIGH * positive
        self.windows = [[(s, -(-LOW * s // 100), HIGH * s // 100) for s in sorted(set(own or []))] for own in scores]
        self.found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in own] for own in self.windows]

    def _floors(self, node: int) -> list[tuple[int, int]]:
        """Where each window still looks: from its k-th best so far on."""
        return [
            (max(low, int(found[0][-1])) if len(found[0]) == self.k else low, high)
            for (_, low, high), found in zip(self.windows[node], self.found[node], strict=True)]

    def meet(self, bounds: Bounds, ids: np.ndarray, labels: np.ndarray) -> None:
        def wanted(node: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            near = np.zeros(len(ids), dtype=bool)
            for least, greatest in self._floors(node):
                if least <= greatest:
                    near |= (high >= least) & (low <= greatest)
            return near & (labels != self.labels[node])

        for node, places, scores in bounds.walk(wanted):
            for at, (least, greatest) in enumerate(self._floors(node)):
                inside = (scores >= least) & (scores <= greatest)
                if inside.any():
                    old_scores, old_ids = self.found[node][at]
                    all_scores, found = np.r_[old_scores, scores[inside]], np.r_[old_ids, ids[places[inside]]]
                    first = best(all_scores, found, self.k)
                    self.found[node][at] = all_scores[first], found[first]

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for own, windows, found in zip(self.ids.tolist(), self.windows, self.found, strict=True):
            for (positive, _, _), (scores, ids) in zip(windows, found, strict=True):
                for score, vec_id in zip(scores.tolist(), ids.tolist(), strict=True):
                    yield own, positive, vec_id, score


FOUND = ["anchor_id", "wanted", "vec_id", "score"]


def _cells(size: int, k: int, kind: type[Positives] | type[Negatives]):
    """What a cell finds; its anchors (side 0) come before its candidates (side 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, search, tree, anchors = None, [], None, None, None

        def close() -> Iterator[pa.RecordBatch]:
            if search is not None:
                rows = list(zip(*search.rows(), strict=True)) or [()] * len(FOUND)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in rows], names=FOUND)

        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column("block").to_numpy() << 32 | batch.column("part").to_numpy()
            side = batch.column("side").to_numpy()
            turn = np.flatnonzero((of[1:] != of[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip(np.r_[0, turn].tolist(), np.r_[turn, len(of)].tolist(), strict=True):
                if of[a] != cell:
                    yield from close()
                    cell, held, search = of[a], [], None
                rows = batch.slice(a, b - a)
                if side[a] == 0:
                    held.append(rows)
                    continue
                if not held:
                    continue
                if search is None:
                    table = pa.Table.from_batches(held).combine_chunks()
                    anchors = whole(table["vector"].combine_chunks(), size)
                    tree = spanning_tree(anchors)
                    search = kind(table["vec_id"].to_numpy(), table["label"].to_numpy(), table["scores"].to_pylist(), k)
                for start in range(0, rows.num_rows, BATCH):
                    some = rows.slice(start, BATCH)
                    bounds = Bounds(anchors, tree, whole(some.column("vector"), size))
                    search.meet(bounds, some.column("vec_id").to_numpy(), some.column("label").to_numpy())
        yield from close()

    return run


def _keys(size: int, seed: int):
    """The sides of random planes a vector lies on: near vectors share the first of them."""
    planes = np.random.default_rng(seed).normal(size=(size, PLANES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(PLANES, dtype=np.int64))[::-1]
        for batch in batches:
            key = (whole(batch.column("vector"), size) @ planes > 0) @ weights
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), *batch.columns], names=["key", *batch.schema.names])

    return run


def _search(anchors: DataFrame, rows: DataFrame, size: int, parts: int, blocks: int, k: int, kind: type) -> DataFrame:
    """``(anchor_id, wanted, vec_id, score)``: the first ``k`` of every anchor and wanted score over all cells."""
    columns = ["block", "part", "side", "vec_id", "label", "vector", "scores"]
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    candidates = rows.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), part.alias("part"), F.lit(1).alias("side"),
        "vec_id", "label", "vector", F.lit(None).cast("array<long>").alias("scores"))
    asking = anchors.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.lit(0).alias("side"))
    met = candidates.select(*columns).unionByName(asking.select(*columns))
    found = (
        met.repartition(F.col("block"), F.col("part")).sortWithinPartitions("block", "part", "side")
        .mapInArrow(_cells(size, k, kind), "anchor_id long, wanted long, vec_id long, score long")
    )
    keys = ["anchor_id"] if kind is Positives else ["anchor_id", "wanted"]
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, seed: int = 3,
) -> DataFrame:
    """The hard negatives of every anchor and positive.

    vectors: ``(vec_id, vector, label)``. A positive is one of the first rows of the anchor's label, a
    negative one of the first rows of another label with half to 0.95 of the positive's score. Columns
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.
    """
    known = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector"))
    rows = written(
        known.groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "vector")).alias("row"))
        .select("vec_id", "row.label", "row.vector").withColumn("anchor", F.coalesce(is_anchor, F.lit(False))), "rows")
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"))
    usual = sizes.orderBy(F.desc("n"), "size").first()
    if usual is None or not usual["anchors"]:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    size, parts, blocks = usual["size"], -(-usual["n"] // ROWS), -(-usual["anchors"] // ANCHORS)
    rows = rows.filter(F.size("vector") == size)

    kind = rows.schema["vector"].dataType.simpleString()
    keyed = rows.filter("anchor").select("vec_id", "label", "vector").mapInArrow(
        _keys(size, seed), f"key long, vec_id long, label long, vector {kind}")
    anchors = number_rows(keyed, ["key", "vec_id"], "rn").select(
        F.floor((F.col("rn") - 1) / ANCHORS).cast("long").alias("block"), "vec_id", "label", "vector")
    none = F.lit(None).cast("array<long>").alias("scores")
    near = written(
        _search(anchors.select("*", none), rows, size, parts, blocks, positives, Positives)
        .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = near.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores")).withColumnRenamed("anchor_id", "vec_id")
    found = _search(anchors.join(scores, "vec_id"), rows, size, parts, blocks, negatives, Negatives)
    return near.join(
        found.select("anchor_id", F.col("wanted").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
                     F.col("score").alias("negative_score")), ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

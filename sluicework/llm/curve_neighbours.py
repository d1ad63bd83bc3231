"""Approximate nearest neighbours by shifted space-filling curves.

Each of ``CURVES`` curves projects the vectors to ``AXES`` random directions, shifts them, and orders
them by their Hilbert index; Spark range-partitions the orders. A query looks at the rows up to
``window`` places before and after its own on every curve, in blocks of ``BLOCK`` rows; the blocks'
best are merged and ranked by the exact distance.

The window is measured, not fixed: for ``SAMPLE`` queries the true neighbours are found by a pass over
all rows, and the window is the distance on the nearest curve within which ``RECALL`` of them lie. On
data without structure that is a large part of the rows, and the search costs what comparing all costs.

Of equal vectors only the ``k + 1`` with the smallest ids can be among the nearest of any query, so
the others are no candidates (they are still queries). Defined results: vectors that are NULL, zero,
hold NULL or non-finite components, or have another length than most take no part. Rows with a NULL id
take no part. A query's own id is never its neighbour; repeated rows count once. With fewer than ``k``
candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.components import written
from sluicework.operators.matching import join_per_key
from sluicework.operators.ranking import number_rows

CURVES, AXES, LEVELS = 6, 8, 7
BLOCK = 2048
#: Queries compared with a block at once, on average.
QUERIES = 2048
SAMPLE, RECALL = 48, 0.96
K = 10


def usable(vector: str) -> Column:
    """Neither NULL nor zero, and all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of whole coordinates below ``2**bits``."""
    x = cells.astype(np.uint64).T.copy()
    axes = len(x)
    one = np.uint64(1)
    high = np.uint64(1 << (bits - 1))
    q = high
    while q > 1:
        p = q - one
        for i in range(axes):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], dtype=np.uint64)
    q = high
    while q > 1:
        t = np.where((x[axes - 1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    index = np.zeros(x.shape[1], dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            index = (index << one) | ((x[i] >> np.uint64(bit)) & one)
    return index.astype(np.int64)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _keys(size: int, spread: float, curves: int, seed: int):
    rng = np.random.default_rng(seed)
    turns = [np.linalg.qr(rng.normal(size=(size, size)))[0][:, :min(AXES, size)] for _ in range(curves)]
    shifts = [rng.uniform(0, 0.25, min(AXES, size)) for _ in range(curves)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"), size)
            for c, (turn, shift) in enumerate(zip(turns, shifts, strict=True)):
                inside = 0.375 * (1 + np.tanh(0.8 * (x @ turn) / spread)) + shift
                key = hilbert(np.minimum(inside * (1 << LEVELS), (1 << LEVELS) - 1).astype(np.int64), LEVELS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), c, dtype=np.int32)), pa.array(key), *batch.columns],
                    names=["curve", "key", *batch.schema.names])

    return run


def _nearest(queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int):
    """For each query its ``k`` nearest rows by (distance, id): place of the row and exact distance."""
    square = (rows**2).sum(axis=1)
    for q, own in zip(queries, ids, strict=True):
        rough = square - 2 * (rows @ q)
        rough = np.where(row_ids == own, np.inf, rough)
        if len(rough) > k:
            edge = np.partition(rough, k - 1)[k - 1]
            near = np.flatnonzero(rough <= edge + 1e-9 * (1 + abs(edge) + q @ q))
        else:
            near = np.arange(len(rough))
        near = near[row_ids[near] != own]
        exact = np.sqrt(((rows[near] - q) ** 2).sum(axis=1))
        order = np.lexsort((row_ids[near], exact))[:k]
        yield near[order], exact[order]


def _search(size: int, k: int):
    """Best rows of a block for every query that looks at it; a group is one block of one curve and a part of its queries."""

    def settle(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        side = table["side"].to_numpy()
        x = _matrix(table["vector"].combine_chunks(), size)
        ids = table["vec_id"].to_numpy()
        row, query = side == 0, side == 1
        out: tuple[list, list, list] = ([], [], [])
        found = _nearest(x[query], ids[query], x[row], ids[row], k)
        for own, (near, exact) in zip(ids[query], found, strict=True):
            out[0].append(np.full(len(near), own))
            out[1].append(ids[row][near])
            out[2].append(exact)
        joined = [np.concatenate(o) if o else np.zeros(0) for o in out]
        return pa.RecordBatch.from_arrays([
            pa.array(joined[0].astype(np.int64)), pa.array(joined[1].astype(np.int64)), pa.array(joined[2].astype(np.float64)),
        ], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("curve", "block", "part")], axis=1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if tuple(at[a]) != group and parts:
                    yield settle(parts)
                    parts = []
                group = tuple(at[a])
                parts.append(batch.slice(a, b - a))
        if parts:
            yield settle(parts)

    return run


def _scan(sample: dict[int, np.ndarray], size: int, k: int):
    """The best rows of a batch for each sampled query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.array(list(sample), dtype=np.int64)
        queries = np.array(list(sample.values()))
        for batch in batches:
            if batch.num_rows and len(ids):
                rows, row_ids = _matrix(batch.column("vector"), size), batch.column("vec_id").to_numpy()
                for own, (near, exact) in zip(ids, _nearest(queries, ids, rows, row_ids, k), strict=True):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(near), own)), pa.array(row_ids[near]), pa.array(exact)],
                        names=["query_id", "vec_id", "score"])

    return run


FOUND = "query_id long, vec_id long, score double"


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest of what was found; at most k rows per block met."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, is_query: Column, k: int = K, curves: int = CURVES, recall: float = RECALL, seed: int = 5) -> DataFrame:
    """The ``k`` nearest of every query row among all other rows: ``(query_id, rank, vec_id, score)``.

    vectors: ``(vec_id, vector)``.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable("vector")).select(
        F.col("vec_id").cast("long").alias("vec_id"), "vector")
    facts = rows.groupBy(F.size("vector").alias("size")).agg(
        F.count("*").alias("n"), F.avg(F.aggregate("vector", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x)).alias("square"))
    usual = facts.orderBy(F.desc("n"), "size").first()
    if usual is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, spread = usual["size"], float(np.sqrt(usual["square"] / usual["size"]))
    rows = rows.filter(F.size("vector") == size)

    # Of equal vectors the k + 1 smallest ids, first within salted parts so that no group is one task
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    few = rows.distinct().withColumn("salt", salt)
    for keys in (["vector", "salt"], ["vector"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
        few = few.withColumn("nth", place).filter(F.col("nth") <= k + 1).drop("nth")
    both = written(
        few.select("vec_id", "vector", F.lit(0).alias("side")).unionByName(
            rows.filter(is_query).distinct().select("vec_id", "vector", F.lit(1).alias("side"))), "vectors")

    kind = both.schema["vector"].dataType.simpleString()
    keyed = both.mapInArrow(
        _keys(size, spread, curves, seed), f"curve int, key long, vec_id long, vector {kind}, side int")
    numbered = number_rows(keyed, ["curve", "key", "side", "vec_id"], "rn")
    offsets = {r["curve"]: r["first"] for r in numbered.groupBy("curve").agg(F.min("rn").alias("first")).collect()}
    first = F.get(F.array(*(F.lit(offsets.get(c, 0)) for c in range(curves))), F.col("curve"))
    placed = numbered.withColumn("rn", F.col("rn") - first).withColumn("block", F.floor(F.col("rn") / BLOCK).cast("long"))

    window = _window(both, placed, size, k, recall)
    last = placed.agg(F.max("block")).first()[0] or 0
    low = F.greatest(F.lit(0), F.floor((F.col("rn") - window) / BLOCK)).cast("long")
    high = F.least(F.lit(last), F.floor((F.col("rn") + window) / BLOCK)).cast("long")
    columns = ["curve", "block", "part", "side", "vec_id", "vector"]
    asked = placed.filter("side = 1").withColumn("block", F.explode(F.sequence(low, high)))
    # A block that many queries look at is repeated for parts of them
    keys = ["curve", "block"]
    parts = written(asked.groupBy(*keys).agg(F.ceil(F.count("*") / QUERIES).cast("long").alias("parts")), "parts")
    asked = join_per_key(asked, parts, keys, "inner").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    rows_met = join_per_key(placed.filter("side = 0"), parts, keys, "inner").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    met = rows_met.select(*columns).unionByName(asked.select(*columns))
    found = (
        met.repartition(*(F.col(c) for c in (*keys, "part"))).sortWithinPartitions(*keys, "part")
        .mapInArrow(_search(size, k), FOUND)
    )
    return ranked(found, k)


def _window(both: DataFrame, placed: DataFrame, size: int, k: int, recall: float) -> int:
    """Places on the nearest curve that hold ``recall`` of a sample's true neighbours; bounded by the sample."""
    chosen = both.filter("side = 1").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sample = {r["vec_id"]: np.array(r["vector"], dtype=np.float64) for r in chosen}
    true = written(ranked(both.filter("side = 0").mapInArrow(_scan(sample, size, k), FOUND), k), "true")
    at = placed.select("curve", "rn", "side", F.col("vec_id").alias("id"))
    asked = at.filter("side = 1").select("curve", F.col("id").alias("query_id"), F.col("rn").alias("from"))
    near = true.join(at.filter("side = 0"), F.col("vec_id") == F.col("id")).join(asked, ["curve", "query_id"])
    gaps = near.groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("rn") - F.col("from"))).alias("gap")).collect()
    return int(np.quantile([r["gap"] for r in gaps], recall, method="higher")) if gaps else 0

"""Sharding by extendible hashing.

A document's bucket is named by the leading bits of a hash of its key. The directory starts with one
bucket; only a bucket over the byte limit is split, on one more bit, until every shard fits. Both
halves of a split exist from then on, so a shard's bytes and the directory depend on the data alone.

The directory is found without moving documents: byte sums by ``STEP`` more bits (a partial aggregate,
so a hot key is one row per task) give the sums of all shorter prefixes above them, and only prefixes
that are still too large are summed again by the next bits.

Defined results: a NULL text has no bytes. Rows with the same key (repeated ids) share all bits; a
bucket of them alone that is over the limit cannot be split and is marked ``indivisible``, as is a
single document over the limit. An empty table has no shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.components import bounded, written

LIMIT = 16 << 20
BITS, STEP = 60, 10
#: Shards up to this many are broadcast to name the rows' shards.
FEW_SHARDS = 100_000


def bits_of(key: str) -> Column:
    """60 bits of a hash of the key."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def directory(sizes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``(depth, prefix, n_rows, n_bytes, indivisible)`` of every shard, from ``(bits, bytes)`` rows."""
    leaves, open_, top = [], sizes, 0
    while True:
        deep = min(top + STEP, BITS)
        cells = open_.groupBy(F.shiftright("bits", BITS - deep).alias("cell")).agg(
            F.count("*").alias("n"), F.sum("bytes").alias("held"), F.min("bits").alias("least"), F.max("bits").alias("most"))
        # Every cell counts for the prefixes above it
        depths = F.explode(F.sequence(F.lit(top), F.lit(deep))).alias("depth")
        nodes = written(
            cells.select("cell", "n", "held", "least", "most", depths)
            .groupBy("depth", F.expr(f"shiftright(cell, {deep} - depth)").alias("prefix"))
            .agg(F.sum("n").alias("n_rows"), F.sum("held").alias("n_bytes"), F.min("least").alias("least"), F.max("most").alias("most"))
            .withColumn("fits", (F.col("n_bytes") <= limit) | (F.col("least") == F.col("most"))), "nodes")
        # A shard is the shortest prefix that fits: its parent does not
        over = nodes.filter(~F.col("fits"))
        parents = over.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        fitting = nodes.filter("fits").withColumn("parent", F.shiftright("prefix", 1))
        found = fitting.join(parents, ["depth", "parent"], "left_semi")
        if top == 0:
            found = found.unionByName(fitting.filter("depth = 0"))
        leaves.append(found.select("depth", "prefix", "n_rows", "n_bytes", (F.col("n_bytes") > limit).alias("indivisible")))
        over = over.filter(F.col("depth") == deep).select(F.col("prefix").alias("cell"))
        if deep == BITS or over.isEmpty():
            break
        open_ = open_.join(over, F.shiftright("bits", BITS - deep) == F.col("cell"), "left_semi")
        top = deep
    return written(reduce(DataFrame.unionByName, leaves), "directory")


def assigned(docs: DataFrame, key: str = "doc_id", limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """The rows with ``shard`` (``depth-prefix``) and the directory."""
    narrow = docs.select(bits_of(key).alias("bits"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    shards = directory(narrow, limit)
    names, least = docs.columns, shards.agg(F.min("depth")).first()[0] or 0
    # All shards are at least that deep, so equal leading bits bring a row to the few that may hold it
    named = shards.select(
        F.expr(f"shiftright(prefix, depth - {least})").alias("_cell"), F.col("depth").alias("_depth"),
        F.col("prefix").alias("_prefix"), F.concat_ws("-", "depth", "prefix").alias("shard"))
    holds = F.expr(f"shiftright(_bits, {BITS} - _depth) = _prefix")
    looked = docs.withColumn("_bits", bits_of(key)).join(
        bounded(named, FEW_SHARDS), (F.shiftright("_bits", BITS - least) == F.col("_cell")) & holds)
    return looked.select(*names, "shard"), shards


def write_shards(docs: DataFrame, folder: str, key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """Writes one folder ``shard=…`` per shard and gives the directory."""
    rows, shards = assigned(docs, key, limit)
    rows.repartition("shard").write.partitionBy("shard").parquet(folder)
    return shards

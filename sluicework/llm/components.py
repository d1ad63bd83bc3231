"""Connected components of a graph of links, as joins over written tables.

Every node hooks to its smallest neighbour, chains of hooks are shortened by pointer jumping, and the
links are rewritten to the trees' roots until none is left between two trees. A node with a third of
all links is one row after the map-side minimum, and the joins have the many links on the splittable
left side. Each round is written to the shared scratch folder, so a lost executor repeats one step, and
the tables of the round before are removed once the new ones stand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.session import scratch_path
from sluicework.sinks import files


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Named tables in the shared scratch folder, removed when nothing reads them any more.

    A name that is written again loses its former table once the new one stands, so the new one may be made
    of the former. Whoever drops a name must have no lazy rows of it left.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                files.delete(self.spark, self.paths.pop(name))

    def drop_all(self) -> None:
        self.drop(*list(self.paths))


def _mapped(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    to = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    found = df.join(to, F.col(column) == F.col("_node"), "left")
    return found.withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def _jumped(roots: DataFrame) -> DataFrame:
    """``(node, root, moved)``: every node with its root's root."""
    on = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return roots.join(on, F.col("root") == F.col("_node"), "left").select(
        "node", F.coalesce("_root", "root").alias("root"), F.col("_node").isNotNull().alias("moved"))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)`` but the roots themselves.

    The root is the smallest node of its component. Links from a node to itself and links with a NULL
    end say nothing. An empty table of links gives an empty result.
    """
    spark: SparkSession = links.sparkSession
    tables = Scratch(spark)
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = links.filter(F.col("a") != F.col("b"))
    links = tables.written(links.select(low.alias("lo"), high.alias("hi")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        roots = tables.written(links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), "roots")
        while True:
            # Two jumps a table: the chains are short, and every job costs the driver a plan
            jumped = tables.written(_jumped(_jumped(roots).select("node", "root")), "roots")
            roots = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        moved = _mapped(_mapped(links, "lo", roots), "hi", roots).filter(F.col("lo") != F.col("hi"))
        links = tables.written(
            moved.select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi")).distinct(), "links")
        labels = tables.written(
            roots if labels is None else _mapped(labels, "root", roots).unionByName(roots), "labels")
    tables.drop("links", "roots")
    if labels is None:
        kind = links.schema["lo"].dataType
        return spark.createDataFrame([], f"node {kind.simpleString()}, root {kind.simpleString()}")
    return labels


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """The table with a broadcast hint if it has at most ``rows`` rows; beyond that Spark shuffles it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

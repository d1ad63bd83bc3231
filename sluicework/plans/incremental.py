"""Incremental transfer, merges, change feeds, reconciliation, publishing."""

from pyspark.sql import functions as F

from sluicework.functions import content
from sluicework.operators import incremental as inc
from sluicework.operators import reconcile
from sluicework.plans.registry import query
from sluicework.session import scratch_path
from sluicework.sinks.batches import BatchStore
from sluicework.sources import lines

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
OLD = f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-01 00:00:00'"
NEW = """SELECT o_orderkey, o_custkey,
                CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL
                     ELSE o_totalprice END AS o_totalprice,
                o_orderdate
         FROM orders WHERE o_orderstatus <> 'F' OR o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'"""
# What one transfer brings of it
CHANGED = f"SELECT * FROM ({NEW}) WHERE o_orderstatus = 'X'"


def at(text):
    return F.to_timestamp_ntz(F.lit(text))


def old_copy(t):
    """The orders as an earlier snapshot: the latest have not been written yet."""
    return t.orders.select(*ORDER_COLUMNS).filter(F.col("o_orderdate") < at("2000-06-01 00:00:00"))


def new_copy(t):
    """The orders as a later snapshot: old finished ones are gone, urgent ones have changed."""
    status, urgent = F.col("o_orderstatus"), F.col("o_orderpriority") == "1-URGENT"
    return t.orders.filter((status != "F") | (F.col("o_orderdate") >= at("1996-01-01 00:00:00"))).select(
        "o_orderkey", "o_custkey",
        F.when(urgent, "X").otherwise(status).alias("o_orderstatus"),
        F.when(~(urgent & (status == "P")), F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
    )


def changed_rows(t):
    return new_copy(t).filter(F.col("o_orderstatus") == "X")


def half(t):
    """Where the target stands: half of the largest key, read as one number."""
    return t.orders.agg(F.expr("coalesce(max(o_orderkey), 0) div 2").alias("n")).first()["n"]


HALF = "(SELECT coalesce(max(o_orderkey), 0) // 2 FROM orders)"


@query(
    "inc_high_water",
    f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > {HALF}",
)
def inc_high_water(t):
    return inc.above(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", half(t))


@query(
    "inc_bounded",
    f"""SELECT 'header' AS part, o_orderkey AS order_id, count(*) AS n_rows FROM orders
        WHERE o_orderkey > {HALF} AND o_orderkey <= {HALF} + {HALF} // 2 GROUP BY o_orderkey
        UNION ALL
        SELECT 'detail', l_orderkey, count(*) FROM lineitem
        WHERE l_orderkey > {HALF} AND l_orderkey <= {HALF} + {HALF} // 2 GROUP BY l_orderkey""",
)
def inc_bounded(t):
    """Parents and children of one transfer, between the same two literal bounds."""
    low = half(t)
    high = low + low // 2

    picked = inc.transfer_pass({
        "header": (t.orders.select(F.col("o_orderkey").alias("order_id")), "order_id"),
        "detail": (t.lineitem.select(F.col("l_orderkey").alias("order_id")), "order_id"),
    }, low, high)
    headers, details = [
        df.groupBy("order_id").agg(F.count("*").alias("n_rows"))
        .select(F.lit(part).alias("part"), "order_id", "n_rows")
        for part, df in picked.items()
    ]
    return headers.unionAll(details)


@query(
    "inc_changed",
    f"""SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderkey <= {HALF} AND o_orderdate > TIMESTAMP '1999-06-01 00:00:00'""",
)
def inc_changed(t):
    return inc.changed_since(
        t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey", half(t), "o_orderdate", at("1999-06-01 00:00:00")
    )


@query(
    "merge_delete_rewrite",
    f"""WITH old AS ({OLD}), new AS ({CHANGED})
        SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.o_orderkey = old.o_orderkey)
        UNION ALL SELECT * FROM new""",
)
def merge_delete_rewrite(t):
    return inc.merge_delete_rewrite(old_copy(t), changed_rows(t), ["o_orderkey"])


@query(
    "merge_update_columns",
    f"""WITH old AS ({OLD}),
             new AS (SELECT *, 1 AS hit FROM ({CHANGED}))
        SELECT old.o_orderkey, old.o_custkey,
               CASE WHEN hit = 1 THEN new.o_orderstatus ELSE old.o_orderstatus END AS o_orderstatus,
               CASE WHEN hit = 1 THEN new.o_totalprice ELSE old.o_totalprice END AS o_totalprice,
               old.o_orderdate
        FROM old LEFT JOIN new ON old.o_orderkey = new.o_orderkey""",
)
def merge_update_columns(t):
    return inc.merge_update_columns(
        old_copy(t), changed_rows(t), ["o_orderkey"], ["o_orderstatus", "o_totalprice"], ["o_orderdate"]
    )


FEED = f"""old AS ({OLD}), new AS ({NEW}),
    gone AS (SELECT * FROM old EXCEPT ALL SELECT * FROM new),
    come AS (SELECT * FROM new EXCEPT ALL SELECT * FROM old)"""


@query(
    "change_feed",
    f"""WITH {FEED}
        SELECT CAST(CASE WHEN o_orderkey IN (SELECT o_orderkey FROM come) THEN 3 ELSE 1 END AS INTEGER) AS op,
               CAST(1 AS BIGINT) AS copies, * FROM gone
        UNION ALL
        SELECT CAST(CASE WHEN o_orderkey IN (SELECT o_orderkey FROM gone) THEN 4 ELSE 2 END AS INTEGER),
               CAST(1 AS BIGINT), * FROM come""",
)
def change_feed(t):
    return inc.change_feed(old_copy(t), new_copy(t), ["o_orderkey"])


@query("apply_change_feed", NEW)
def apply_change_feed(t):
    """The old snapshot plus its change feed is the new snapshot."""
    old = old_copy(t)
    feed = inc.change_feed(old, new_copy(t), ["o_orderkey"]).withColumn("lsn", F.col("op"))
    return inc.apply_change_feed(old, feed, ["o_orderkey"], ["lsn"])


@query(
    "diff_by_column",
    f"""WITH l AS ({OLD}), r AS ({NEW}),
             b AS (SELECT l.*, r.o_custkey AS c2, r.o_orderstatus AS s2, r.o_totalprice AS t2,
                          r.o_orderdate AS d2 FROM l JOIN r ON l.o_orderkey = r.o_orderkey),
             u AS (SELECT count(*) AS n_unmatched FROM l FULL JOIN r ON l.o_orderkey = r.o_orderkey
                   WHERE l.o_orderkey IS NULL OR r.o_orderkey IS NULL)
        """ + " UNION ALL ".join(
        f"""SELECT (SELECT count(*) FROM b) AS n_compared, (SELECT n_unmatched FROM u) AS n_unmatched,
                   CAST(0 AS BIGINT) AS n_repeated, '{name}' AS column_name,
                   (SELECT count(*) FROM b WHERE {name} IS DISTINCT FROM {other}) AS n_differing,
                   (SELECT count({name}) FROM b) AS n_not_null"""
        for name, other in (("o_custkey", "c2"), ("o_orderstatus", "s2"),
                            ("o_totalprice", "t2"), ("o_orderdate", "d2"))
    ),
)
def diff_by_column(t):
    return reconcile.diff_by_column(
        old_copy(t), new_copy(t), ["o_orderkey"], ORDER_COLUMNS[1:]
    )


@query(
    "rows_equal",
    f"""WITH old AS ({OLD}), new AS ({NEW})
        SELECT (SELECT count(*) FROM old) AS n_left, (SELECT count(*) FROM new) AS n_right,
               (SELECT count(*) FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)) AS n_only_left,
               (SELECT count(*) FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)) AS n_only_right,
               (SELECT count(*) FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)) = 0
               AND (SELECT count(*) FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)) = 0 AS equal""",
)
def rows_equal(t):
    return reconcile.rows_equal(old_copy(t), new_copy(t))


@query(
    "facts",
    f"""WITH old AS ({OLD}), new AS ({NEW}),
             c AS (SELECT (SELECT count(*) FROM old) AS l, (SELECT count(*) FROM new) AS r,
                          (SELECT count(*) FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new)) AS o)
        SELECT 'something was compared' AS fact, l > 0 AND r > 0 AS ok,
               l::VARCHAR || ' and ' || r::VARCHAR || ' rows' AS detail FROM c
        UNION ALL SELECT 'the counts agree', l = r, (l - r)::VARCHAR FROM c
        UNION ALL SELECT 'no row is missing', o = 0, o::VARCHAR FROM c""",
)
def facts(t):
    counts = reconcile.rows_equal(old_copy(t), new_copy(t))
    left, right, missing = F.col("n_left"), F.col("n_right"), F.col("n_only_left")
    return reconcile.facts(counts, [
        ("something was compared", (left > 0) & (right > 0),
         F.concat(left.cast("string"), F.lit(" and "), right.cast("string"), F.lit(" rows"))),
        ("the counts agree", left == right, left - right),
        ("no row is missing", missing == 0, missing),
    ])


@query(
    "publish_batch",
    """SELECT 'orders' AS table_name, year(o_orderdate) AS batch_id, o_orderkey AS order_id, count(*) AS n_rows
       FROM orders WHERE year(o_orderdate) IN (1996, 1998) GROUP BY 2, 3
       UNION ALL
       SELECT 'lineitem', year(l_shipdate), l_orderkey, count(*)
       FROM lineitem WHERE year(l_shipdate) IN (1996, 1998) GROUP BY 2, 3""",
)
def publish_batch(t):
    """Two tables are written in batches by year and two batches published; a reader sees those."""
    store = BatchStore(t.spark, scratch_path(t.spark, "batches"))
    store.write_all({
        "orders": t.orders.select(
            F.year("o_orderdate").alias("batch_id"), F.col("o_orderkey").alias("order_id")
        ),
        "lineitem": t.lineitem.select(
            F.year("l_shipdate").alias("batch_id"), F.col("l_orderkey").alias("order_id")
        ),
    })
    store.publish([1996, 1998])
    seen = store.published()
    orders, details = [
        store.read(name, seen).groupBy("batch_id", "order_id").agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("table_name"), F.col("batch_id").cast("bigint").alias("batch_id"),
                "order_id", "n_rows")
        for name in ("orders", "lineitem")
    ]
    return orders.unionAll(details)


@query(
    "snapshot_read",
    """SELECT v.version, year(o_orderdate) AS batch_id, o_orderpriority, count(*) AS n_rows,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
       FROM orders JOIN (VALUES (1, 1996), (1, 1998), (2, 1997), (2, 1998)) v(version, shown)
       ON year(o_orderdate) = v.shown GROUP BY 1, 2, 3""",
)
def snapshot_read(t):
    """Orders in batches by year: 1996 and 1998 are published, then 1997 in place of 1996. Both versions
    are read after that."""
    store = BatchStore(t.spark, scratch_path(t.spark, "versions"))
    store.write_all({"orders": t.orders.select(
        F.year("o_orderdate").alias("batch_id"), "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"))})
    versions = [store.publish([1996, 1998]), store.publish([1997], without=[1996])]
    first, second = [
        store.read("orders", version=v).groupBy("batch_id", "o_orderpriority")
        .agg(F.count("*").alias("n_rows"), F.sum("price").alias("total"))
        .select(F.lit(v).alias("version"), F.col("batch_id").cast("bigint").alias("batch_id"),
                "o_orderpriority", "n_rows", "total")
        for v in versions
    ]
    return first.unionAll(second)


@query(
    "export_json",
    """SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate,
              CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS o_orderstatus
       FROM orders""",
)
def export_json(t):
    """Orders as JSON lines, with null written out, and read back by the same schema."""
    source = t.orders.select(
        "o_orderkey", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), "o_orderdate",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    text = source.select(content.row_json(source.schema).alias("value"))
    return lines.json_rows(text, source.schema)

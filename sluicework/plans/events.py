"""Event logs: reading, lag, folding, replay; JSON round trips."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.content import row_json
from sluicework.operators import nested, profile
from sluicework.plans.registry import query
from sluicework.session import scratch_path
from sluicework.sinks import eventlog as producing
from sluicework.sources import eventlog
from sluicework.streaming import envelope, fold
from sluicework.streaming.replay import OrderTables

KINDS = ["click", "error", "purchase", "signup", "view"]


PARTITIONS = 4
# Where the reader of signups stands in every partition
STANDS = """SELECT user_id % 4 AS partition, max(event_id) + 1 AS stands FROM events
            WHERE event_type = 'signup' GROUP BY 1"""


def partitioned(t):
    """The events as a log of four partitions; every user is on one, and offsets have gaps."""
    return t.events.withColumn("partition", (F.col("user_id") % PARTITIONS).cast("int"))


@query(
    "log_read_first_n",
    f"""SELECT CAST(e.user_id % 4 AS INT) AS partition, event_id, event_type FROM events e
        JOIN ({STANDS}) s ON s.partition = e.user_id % 4
        WHERE event_id >= stands - 500
        QUALIFY row_number() OVER (ORDER BY e.user_id % 4, event_id) <= 300""",
)
def log_read_first_n(t):
    """A bite of exactly 300 records, from 500 offsets before where the reader of signups stands."""
    log = partitioned(t)
    stands = eventlog.high_watermarks(log.filter(F.col("event_type") == "signup"), "event_id")
    start = {p: at - 500 for p, at in stands.items()}
    log = log.filter(F.col("partition").isin(list(start)))
    return eventlog.bite(log, start, 300, "event_id").select("partition", "event_id", "event_type")


@query(
    "replay_to_watermark",
    f"""SELECT CAST(e.user_id % 4 AS INT) AS partition, event_type, count(*) AS n, min(event_id) AS first_offset,
               max(event_id) AS last_offset
        FROM events e JOIN ({STANDS}) s ON s.partition = e.user_id % 4 AND event_id < stands
        GROUP BY 1, 2""",
)
def replay_to_watermark(t):
    """A replay that ends where the log ended at its last signup, partition by partition."""
    log = partitioned(t)
    ends = eventlog.high_watermarks(log.filter(F.col("event_type") == "signup"), "event_id")
    return eventlog.replay(log, ends, "event_id").groupBy("partition", "event_type").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_offset"),
        F.max("event_id").alias("last_offset"),
    )


@query(
    "reader_lag",
    """SELECT user_id, CAST(user_id % 4 AS INT) AS partition, max(event_id) + 1 AS position,
              (SELECT max(event_id) + 1 FROM events f WHERE f.user_id % 4 = e.user_id % 4) - (max(event_id) + 1) AS lag
       FROM events e GROUP BY user_id""",
)
def reader_lag(t):
    """Every user as a reader of one partition who stands after the last event of their own."""
    log = partitioned(t)
    positions = log.groupBy("user_id", "partition").agg((F.max("event_id") + 1).alias("position"))
    return eventlog.reader_lag(positions, eventlog.high_watermarks(log, "event_id"))


@query(
    "fold_events",
    "SELECT user_id, " + ", ".join(
        f"""arg_max(value, event_id) FILTER (WHERE event_type = '{k}' AND value IS NOT NULL) AS last_{k}"""
        for k in KINDS
    ) + ", arg_max(ts, event_id) AS last_ts FROM events GROUP BY user_id",
)
def fold_events(t):
    values = {f"last_{k}": (F.col("value"), F.col("event_type") == k) for k in KINDS}
    values["last_ts"] = (F.col("ts"), F.lit(True))
    return fold.latest_values(t.events, ["user_id"], F.col("event_id"), values)


@query(
    "duplicate_keys",
    """SELECT user_id, event_type, count(*) AS n FROM events
       GROUP BY user_id, event_type HAVING count(*) > 1""",
)
def duplicate_keys(t):
    return profile.repeated_keys(t.events, ["user_id", "event_type"])


@query(
    "json_roundtrip",
    """SELECT event_id, ts, user_id, event_type, value, CAST(props ->> '$.k' AS BIGINT) AS k,
              props ->> '$.k' AS k_text
       FROM events""",
)
def json_roundtrip(t):
    """Rows with a nested value to JSON and back by the same schema."""
    nested_rows = t.events.withColumn("props", F.from_json("props", "k BIGINT"))
    text = nested_rows.select(row_json(nested_rows.schema).alias("value"))
    back = text.select(F.from_json("value", nested_rows.schema, {"mode": "FAILFAST"}).alias("r"))
    return back.select(
        "r.event_id", "r.ts", "r.user_id", "r.event_type", "r.value",
        F.col("r.props.k").alias("k"), F.col("r.props.k").cast("string").alias("k_text"),
    )


@query(
    "log_encode",
    """SELECT CAST(user_id AS VARCHAR) AS key, p AS partition,
              row_number() OVER (PARTITION BY p ORDER BY event_id) - 1 AS "offset",
              event_id, ts, event_type, value, props
       FROM (SELECT *, CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 15))::BIGINT % 4 AS INT) AS p FROM events)""",
)
def log_encode(t):
    """Events as keyed records on four partitions, numbered there, and the fields found in the values."""
    encoded = producing.encode(t.events, key="user_id").withColumn("_id", F.get_json_object("value", "$.event_id").cast("bigint"))
    body = T.StructType([f for f in t.events.schema.fields if f.name != "user_id"])
    log = producing.records(encoded, ["_id"], PARTITIONS)
    return log.select(
        "key", "partition", "offset", F.from_json("value", body, {"mode": "FAILFAST"}).alias("r"),
    ).select("key", "partition", "offset", "r.event_id", "r.ts", "r.event_type", "r.value", "r.props")


def order_log(t):
    """The orders as the event log of a shop: (key, value, partition, offset, timestamp).

    Four partitions, an order on one of them, offsets with gaps. Orders of priority 4 have no header on the log, those of priority 5 are paid before their header.
    """
    key, status, level = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.col("o_orderdate")

    def uuid(salt):
        return F.upper(F.md5(F.concat(F.lit(salt), key.cast("string"))))

    def body(*columns):
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    none = F.lit(None).cast("string")
    header = body(
        key.alias("id"), F.col("o_custkey").alias("customer_id"),
        day.cast("string").alias("created_at"), none.alias("updated_at"),
        none.alias("payment_uuid"), none.alias("shipment_uuid"),
    )
    payment = body(
        key.alias("order_id"), uuid("p").alias("payment_uuid"),
        (day + F.expr("INTERVAL 1 DAY")).cast("string").alias("updated_at"),
    )
    shipment = body(
        key.alias("order_id"), uuid("s").alias("shipment_uuid"),
        (day + F.expr("INTERVAL 2 DAY")).cast("string").alias("updated_at"),
    )
    kept = [key.cast("string").alias("key"), day.alias("timestamp")]
    headers = t.orders.filter(level != "4-NOT SPECIFIED").select(
        (key * 4 + 1).alias("offset"), F.lit("Added order header").alias("m"), header.alias("d"), *kept
    )
    paid_at = F.when(level == "5-LOW", key * 4).otherwise(key * 4 + 2)
    payments = t.orders.filter(status != "O").select(
        paid_at.alias("offset"), F.lit("Added payment").alias("m"), payment.alias("d"), *kept
    )
    shipments = t.orders.filter(status == "F").select(
        (key * 4 + 3).alias("offset"), F.lit("Added shipment").alias("m"), shipment.alias("d"), *kept
    )
    rows = headers.unionAll(payments).unionAll(shipments)
    encoded = envelope.encode(rows, F.col("m"), F.col("d"), F.col("timestamp"))
    partition = (F.col("key").cast("bigint") % PARTITIONS).cast("int").alias("partition")
    return encoded.select("key", "value", partition, "offset", "timestamp")


FOLDED = """SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderdate AS created_at,
                   CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 2 DAY
                        WHEN o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW'
                        THEN o_orderdate + INTERVAL 1 DAY END AS updated_at,
                   CASE WHEN o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW'
                        THEN md5('p' || CAST(o_orderkey AS VARCHAR)) END AS payment_uuid,
                   CASE WHEN o_orderstatus = 'F' THEN md5('s' || CAST(o_orderkey AS VARCHAR)) END
                       AS shipment_uuid
            FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'"""


@query("fold_orders", FOLDED)
def fold_orders(t):
    return fold.order_headers(envelope.decode(order_log(t)))


@query("replay_stream", FOLDED)
def replay_stream(t):
    """The same log on disk, applied as a stream in bites, and the table that comes of it."""
    root = scratch_path(t.spark, "replay")
    order_log(t).repartitionByRange("offset").write.json(f"{root}/log")
    tables = OrderTables(t.spark, f"{root}/tables")
    log = eventlog.stream_log(t.spark, f"{root}/log", files_per_bite=4)
    tables.follow(log, f"{root}/reader").awaitTermination()
    return tables.order_headers()


@query("replay_twice", FOLDED)
def replay_twice(t):
    """The log in parts, out of order, applied by two readers with a compaction between them.

    The first reader sees what comes on time and some records twice in a batch. Then everything is
    compacted, what was late comes, headers and changes alike, and a new reader reads it all again.
    """
    root = scratch_path(t.spark, "twice")
    log = order_log(t)
    late = F.pmod(F.xxhash64("partition", "offset"), F.lit(3)) == 0
    again = F.pmod(F.xxhash64("offset"), F.lit(5)) == 0
    on_time = log.filter(~late)
    producing.write_log(on_time.unionAll(on_time.filter(again)), f"{root}/log")
    tables = OrderTables(t.spark, f"{root}/tables")
    stream = eventlog.stream_log(t.spark, f"{root}/log", files_per_bite=8)
    tables.follow(stream, f"{root}/first").awaitTermination()
    tables.compact()
    tables.remove_unused()
    producing.write_log(log.filter(late), f"{root}/log")
    tables.follow(eventlog.stream_log(t.spark, f"{root}/log"), f"{root}/second").awaitTermination()
    tables.compact()
    tables.remove_unused()
    tables.follow(stream, f"{root}/first").awaitTermination()
    return tables.order_headers()


@query("replay_bites", FOLDED)
def replay_bites(t):
    """The log in bites of a fifth of its records, by a reader that is started anew for every bite."""
    root = scratch_path(t.spark, "bites")
    order_log(t).write.json(f"{root}/log")
    log = eventlog.read_log(t.spark, f"{root}/log")
    first = log.count() // 5 + 1
    while OrderTables(t.spark, f"{root}/tables").apply_bite(log, first):
        pass
    return OrderTables(t.spark, f"{root}/tables").order_headers()


@query(
    "event_lines",
    """SELECT l_orderkey AS order_id, l_partkey AS photo_id, count(*) AS quantity,
              CAST(sum(CAST(l_quantity AS DECIMAL(7,2))) AS DECIMAL(7,2)) AS price
       FROM lineitem GROUP BY 1, 2""",
)
def event_lines(t):
    """Order details as list-valued events on the log, decoded and unnested."""
    entries = t.lineitem.groupBy(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("photo_id")
    ).agg(
        F.count("*").alias("quantity"),
        F.sum(F.col("l_quantity").cast("decimal(7,2)")).cast("string").alias("price"),
    )
    lists = nested.paged_lists(
        entries.withColumn("o", F.col("order_id")), "o", ["order_id", "photo_id", "quantity", "price"], 10_000
    )
    events = envelope.encode(
        lists, F.lit("Added order details"), F.to_json("entries"), F.lit("2024-01-01 00:00:00")
    )
    log = events.select("value", F.lit(0).alias("partition"), F.col("o").alias("offset"))
    return fold.order_lines(envelope.decode(log))

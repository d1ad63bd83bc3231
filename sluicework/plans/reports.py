"""Aggregate reports, profiles, joins and nested documents."""

from pyspark.sql import functions as F

from sluicework.functions import clock, text
from sluicework.operators import matching, nested, profile, ranking
from sluicework.operators.reconcile import content_fingerprint
from sluicework.plans.registry import query

# Bytes of line files whose entries of an order one task sums and joins
ENTRY_BYTES = 8 << 20
MINUTES = "date_diff('minute', o_orderdate, l_shipdate)"


def order_minutes(t):
    return profile.minutes_per_parent(
        t.orders, t.lineitem, "o_orderkey", "l_orderkey", "o_orderdate", "l_shipdate"
    )


@query(
    "report_by_group",
    f"""SELECT o_orderpriority, CAST(sum({MINUTES}) AS BIGINT) AS minutes, count(*) AS n_lines
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority""",
)
def report_by_group(t):
    return order_minutes(t).groupBy("o_orderpriority").agg(
        F.sum("minutes").alias("minutes"), F.sum("n_children").alias("n_lines")
    )


@query(
    "report_by_date",
    f"""SELECT CAST(o_orderdate AS DATE) AS day, CAST(sum({MINUTES}) AS BIGINT) AS minutes
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1 ORDER BY 1""",
)
def report_by_date(t):
    return (
        order_minutes(t)
        .groupBy(F.to_date("o_orderdate").alias("day"))
        .agg(F.sum("minutes").alias("minutes"))
        .orderBy("day")
    )


@query(
    "total_minutes",
    f"""SELECT CAST(coalesce(sum({MINUTES}), 0) AS BIGINT) AS minutes, count(*) AS n_lines
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def total_minutes(t):
    zero = F.lit(0).cast("bigint")
    return order_minutes(t).agg(
        F.coalesce(F.sum("minutes"), zero).alias("minutes"),
        F.coalesce(F.sum("n_children"), zero).alias("n_lines"),
    )


@query("count_by_category", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_by_category(t):
    return profile.count_by(t.events, ["event_type"])


@query("distinct_values", "SELECT DISTINCT lang FROM documents ORDER BY lang")
def distinct_values(t):
    return profile.distinct_values(t.documents, "lang")


@query(
    "length_profile",
    """SELECT min(length(text)) AS shortest, max(length(text)) AS longest,
              count(*) FILTER (WHERE length(text) > 4000) AS n_over, count(text) AS n_values
       FROM documents""",
)
def length_profile(t):
    return profile.length_profile(t.documents, "text")


@query(
    "null_profile",
    """WITH d AS (SELECT d.doc_id, text, lang, source, n_chars, quality, toxic
                  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
       """ + " UNION ALL ".join(
        f"""SELECT count(*) AS n_rows, '{c}' AS column_name,
                   CAST(coalesce(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_nulls
            FROM d"""
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
)
def null_profile(t):
    joined = t.documents.join(t.labels, "doc_id", "left")
    return profile.null_profile(joined, ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"])


@query(
    "quantity_of",
    """SELECT l_orderkey, l_partkey, count(*) AS quantity FROM lineitem
       GROUP BY l_orderkey, l_partkey""",
)
def quantity_of(t):
    return profile.quantities(t.lineitem, ["l_orderkey", "l_partkey"])


def order_entries(t):
    """One row per order and part: how often it was ordered and what it costs."""
    return t.lineitem.groupBy(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("photo_id")
    ).agg(
        F.count("*").alias("quantity"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
    )


def order_documents_of(t, page_size=10_000):
    return nested.order_documents(
        t.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_custkey").alias("customer_id"),
        ),
        t.customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("city"),
        ),
        order_entries(t).drop("price"),
        t.part.select(
            F.col("p_partkey").alias("photo_id"), F.col("p_name").alias("name"),
            F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        ),
        page_size,
    )


@query(
    "order_documents",
    """WITH e AS (SELECT l_orderkey, l_partkey, count(*) AS q,
                         sum(CAST(p_retailprice AS DECIMAL(18,2))) AS price
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
       SELECT o_orderkey AS order_id, min(o_orderdate) AS created_at, min(c_name) AS customer,
              count(l_partkey) AS n_photos, CAST(coalesce(sum(q), 0) AS BIGINT) AS n_drawn,
              CAST(coalesce(sum(price), 0) AS DECIMAL(28,2)) AS price,
              min(l_partkey) AS first_photo, max(l_partkey) AS last_photo
       FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN e ON l_orderkey = o_orderkey
       GROUP BY o_orderkey""",
)
def order_documents(t):
    """Documents flattened again; the pages of a large order add up, each with the order's price."""
    photos = F.col("Photos")
    ids = F.transform(photos, lambda p: p["Photo"]["photo_id"])
    drawn = F.aggregate(photos, F.lit(0).cast("bigint"), lambda s, p: s + p["Quantity"])
    return (
        order_documents_of(t)
        .select(
            F.col("OrderId").alias("order_id"), F.col("CreatedAt").alias("created_at"),
            F.col("Customer.name").alias("customer"),
            F.size(photos).cast("bigint").alias("n_photos"), drawn.alias("n_drawn"),
            F.col("Price").alias("price"),
            F.array_min(ids).alias("first_photo"), F.array_max(ids).alias("last_photo"),
        )
        .groupBy("order_id")
        .agg(
            F.min("created_at").alias("created_at"), F.min("customer").alias("customer"),
            F.sum("n_photos").alias("n_photos"), F.sum("n_drawn").alias("n_drawn"),
            F.max("price").alias("price"),
            F.min("first_photo").alias("first_photo"), F.max("last_photo").alias("last_photo"),
        )
    )


@query(
    "nest_document",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation,
              CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer""",
)
def nest_document(t):
    documents = nested.nest(
        t.customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)")),
        {"_id": "c_custkey", "Name": "c_name",
         "Account": {"Balance": "c_acctbal", "Place": {"Nation": "c_nationkey"}}},
    )
    return documents.select(
        F.col("_id").alias("id"), F.col("Name").alias("name"),
        F.col("Account.Place.Nation").alias("nation"), F.col("Account.Balance").alias("balance"),
    )


@query(
    "explode_lines",
    """SELECT l_orderkey AS order_id, l_partkey AS photo_id, count(*) AS quantity,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS price
       FROM lineitem GROUP BY 1, 2""",
)
def explode_lines(t):
    """Order entries packed into list-valued bodies, as events carry them, and unpacked again."""
    packed = nested.paged_lists(order_entries(t), "order_id", ["photo_id", "quantity", "price"], 10_000)
    bodies = packed.select(
        F.col("order_id"), F.to_json("entries").alias("body")
    )
    return nested.explode_list(
        bodies, "body", "STRUCT<photo_id: BIGINT, quantity: BIGINT, price: DECIMAL(18,2)>", ["order_id"]
    )


@query(
    "three_way_join",
    """SELECT o_orderpriority, p_brand, count(*) AS n_lines,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
       FROM orders, lineitem, part
       WHERE o_orderkey = l_orderkey AND l_partkey = p_partkey
       GROUP BY o_orderpriority, p_brand""",
)
def three_way_join(t):
    """Lines are summed per part and order before each join, so hot parts and orders arrive small.

    Entries of an order meet once, for the second sum and the join, in parts that follow the bytes of the lines.
    """
    entries = order_entries(t)
    parts = max(ranking.runs_for(t.lineitem, ENTRY_BYTES) or 1, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    branded = (
        entries.join(t.part, F.col("photo_id") == F.col("p_partkey"))
        .repartition(parts, "order_id")
        .groupBy("order_id", "p_brand")
        .agg(F.sum("quantity").alias("n"), F.sum("price").alias("total"))
    )
    return (
        branded.join(t.orders, F.col("order_id") == F.col("o_orderkey"))
        .groupBy("o_orderpriority", "p_brand")
        .agg(F.sum("n").alias("n_lines"), F.sum("total").cast("decimal(28,2)").alias("total"))
    )


def gapped(t):
    """Orders and lines that are not complete on either side."""
    orders = t.orders.filter(F.col("o_orderstatus") != "P")
    lines = t.lineitem.filter(F.col("l_returnflag") != "R")
    return orders, lines


GAPPED = """o AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
            l AS (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')"""


@query(
    "orphans_both_ways",
    f"""WITH {GAPPED}
        SELECT 'left' AS only_in, o_orderkey, o_orderkey % 3 AS part, count(*) AS n_rows FROM o
        WHERE NOT EXISTS (SELECT 1 FROM l WHERE l_orderkey = o_orderkey) GROUP BY o_orderkey
        UNION ALL
        SELECT 'right', l_orderkey, l_orderkey % 3, count(*) FROM l
        WHERE NOT EXISTS (SELECT 1 FROM o WHERE o_orderkey = l_orderkey) GROUP BY l_orderkey""",
)
def orphans_both_ways(t):
    orders, lines = gapped(t)
    return matching.orphans_both_ways(
        orders.withColumn("part", F.col("o_orderkey") % 3), ["o_orderkey", "part"],
        lines.withColumn("l_part", F.col("l_orderkey") % 3), ["l_orderkey", "l_part"],
    )


@query(
    "header_detail_counts",
    f"""WITH {GAPPED}
        SELECT (SELECT count(DISTINCT o_orderkey) FROM o) AS n_parents,
               (SELECT count(DISTINCT l_orderkey) FROM l) AS n_parents_in_children,
               (SELECT count(DISTINCT o_orderkey) FROM o
                WHERE o_orderkey NOT IN (SELECT l_orderkey FROM l)) AS n_without_children,
               (SELECT count(DISTINCT l_orderkey) FROM l
                WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)) AS n_without_parent""",
)
def header_detail_counts(t):
    orders, lines = gapped(t)
    return matching.coverage(orders, "o_orderkey", lines, "l_orderkey")


@query(
    "text_predicates",
    """SELECT p_partkey, starts_with(p_name, 'small') AS starts, ends_with(p_name, 'ring') AS ends,
              contains(p_name, 'ed') AS has, length(p_name) - length(replace(p_name, 'e', '')) AS n_e,
              p_name LIKE '% ring' AS matches
       FROM part""",
)
def text_predicates(t):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        name.startswith("small").alias("starts"), name.endswith("ring").alias("ends"),
        name.contains("ed").alias("has"),
        text.occurrences(name, "e").cast("bigint").alias("n_e"), name.like("% ring").alias("matches"),
    )


@query(
    "build_email",
    """SELECT c_custkey, split_part(c_name, '#', 1) || '.' || split_part(c_name, '#', 2) || '@bad' ||
              replace(replace(replace(translate(lower(c_mktsegment), 'aou', 'äöü'),
                      'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue') || '.de' AS email
       FROM customer""",
)
def build_email(t):
    halves = F.split("c_name", "#")
    city = F.concat(F.lit("Bad "), F.translate(F.lower("c_mktsegment"), "aou", "äöü"))
    return t.customer.select(
        "c_custkey", text.mail_address(halves[0], halves[1], city).alias("email")
    )


@query(
    "ms_precision",
    """SELECT event_id, date_trunc('milliseconds', ts) AS ts_ms,
              date_part('microsecond', ts) % 1000 <> 0 AS below_ms,
              strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%g') AS text_ms
       FROM events""",
)
def ms_precision(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", clock.to_millis(ts).alias("ts_ms"),
        (clock.sub_milli_micros(ts) != 0).alias("below_ms"), clock.millis_text(ts).alias("text_ms"),
    )


@query(
    "content_fingerprint",
    """SELECT doc_id, octet_length(encode(text)) AS n_bytes, md5(text) AS md5 FROM documents""",
)
def content_fingerprints(t):
    return content_fingerprint(t.documents, "doc_id", "text")


@query(
    "unpaid_orders",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'""",
)
def unpaid_orders(t):
    key = F.col("o_orderkey")
    orders = t.orders.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") != "O", key).alias("payment"),
        F.when(F.col("o_orderpriority") == "1-URGENT", key).alias("shipment"),
    )
    return orders.filter(F.col("payment").isNull() & F.col("shipment").isNotNull()).select(
        "o_orderkey", "o_custkey"
    )

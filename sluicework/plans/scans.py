"""Scans, bound statements, line formats, alignment, conversion."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions import clock, markup
from sluicework.functions.content import row_json
from sluicework.operators import profile, ranking, shape
from sluicework.plans.registry import TABLES, query
from sluicework.session import scratch_path
from sluicework.sources import lines, statements
from sluicework.sources.collections import find


@query("scan_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_table(t):
    return t.nation


@query(
    "scan_query",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 100000",
)
def scan_query(t):
    return statements.run(
        t.spark,
        "SELECT o_orderkey, o_orderstatus, o_totalprice FROM {orders} WHERE o_totalprice > 100000",
        orders=t.orders,
    )


@query("project_columns", "SELECT o_orderpriority, o_orderkey FROM orders")
def project_columns(t):
    return t.orders.select("o_orderpriority", "o_orderkey")


@query(
    "single_value",
    "SELECT max(o_totalprice) AS highest, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F'",
)
def single_value(t):
    return statements.run(
        t.spark,
        "SELECT max(o_totalprice) AS highest, count(*) AS n_orders FROM {orders} WHERE o_orderstatus = :s",
        {"s": "F"}, orders=t.orders,
    )


@query(
    "high_water_mark",
    """SELECT 'all' AS target, coalesce(max(o_orderkey), 0) AS high_water,
              max(o_orderdate) AS last_changed FROM orders
       UNION ALL
       SELECT 'empty', coalesce(max(o_orderkey), 0), max(o_orderdate) FROM orders WHERE o_orderkey < 0""",
)
def high_water_mark(t):
    def mark(name, df):
        return profile.high_water_mark(df, "o_orderkey", "o_orderdate").select(
            F.lit(name).alias("target"), "high_water", "last_changed"
        )

    return mark("all", t.orders).unionAll(mark("empty", t.orders.filter("o_orderkey < 0")))


@query(
    "param_named",
    """SELECT o_orderkey, o_custkey, 'a:b @c' AS tag FROM orders
       WHERE o_totalprice >= 50000 AND o_totalprice < 250000 AND o_orderpriority <> 'x@hi'""",
)
def param_named(t):
    return statements.run(
        t.spark,
        """SELECT o_orderkey, o_custkey, 'a:b @c' AS tag FROM {orders}
           WHERE o_totalprice >= :lo AND o_totalprice < @hi::double AND o_orderpriority <> 'x@hi'""",
        {"lo": 50000.0, "hi": 250000.0}, orders=t.orders,
    )


@query(
    "param_positional",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice >= 50000 AND o_orderstatus = 'O'",
)
def param_positional(t):
    return statements.run(
        t.spark,
        "SELECT o_orderkey, o_custkey FROM {orders} WHERE o_totalprice >= ? AND o_orderstatus = ?",
        [50000.0, "O"], orders=t.orders,
    )


CUSTOMER = T.StructType([
    T.StructField("ID", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("NationKey", T.IntegerType()),
    T.StructField("AcctBal", T.DecimalType(18, 2)),
    T.StructField("Location", T.StringType()),
    T.StructField("EmailHash", T.StringType()),
])


def customer_lines(t):
    """Customers as row lines; some lack an attribute and some texts need escaping."""
    c = t.customer
    location = F.when(
        F.col("c_mktsegment") != "HOUSEHOLD", F.concat(F.col("c_mktsegment"), F.lit(' <"&">\tᵀᴹ'))
    )
    return c.select(
        markup.row_line(
            Id=F.col("c_custkey"),
            Name=F.col("c_name"),
            NationKey=F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")),
            acctbal=F.col("c_acctbal").cast("decimal(18,2)"),
            Location=location,
        ).alias("value")
    )


CUSTOMER_SQL = """SELECT c_custkey AS id, c_name AS name,
              CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nationkey,
              CAST(c_acctbal AS DECIMAL(18,2)) AS acctbal,
              CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment || ' <"&">' || chr(9) || 'ᵀᴹ' END AS location,
              CAST(NULL AS VARCHAR) AS emailhash
       FROM customer"""


@query("xml_rows", CUSTOMER_SQL)
def xml_rows(t):
    return shape.fold_names(lines.xml_rows(customer_lines(t), CUSTOMER))


@query("import_files", CUSTOMER_SQL)
def import_files(t):
    """The same lines as text files, between lines that are no rows."""
    path = scratch_path(t.spark, "import")
    other = t.region.select(F.concat(F.lit("<rows name='"), "r_name", F.lit("'>")).alias("value"))
    customer_lines(t).unionAll(other).write.text(path)
    return shape.fold_names(lines.import_files(t.spark, path, CUSTOMER, format="xml"))


@query(
    "detect_formats",
    """SELECT c_custkey AS id FROM customer UNION ALL SELECT o_orderkey FROM orders
       UNION ALL SELECT -o_orderkey FROM orders""",
)
def detect_formats(t):
    """XML and JSON files side by side, told apart by their lines; every second JSON object is indented.

    A blank line comes first in each but the files of plain orders.
    """
    root = scratch_path(t.spark, "formats")
    row = F.concat(F.lit('\n<?xml version="1.0"?>\n<row Id="'), F.col("c_custkey").cast("string"), F.lit('" />'))
    t.customer.select(row.alias("value")).write.text(f"{root}/x")
    key = F.col("o_orderkey").cast("string")
    document = F.concat(F.lit('{"Id": '), key, F.lit('}\n\t {"Id": -'), key, F.lit("}"))
    leads = F.col("o_orderkey") % 3 == 0
    t.orders.filter(leads).select(F.concat(F.lit("\n"), document).alias("value")).write.text(f"{root}/j")
    t.orders.filter(~leads).select(document.alias("value")).write.text(f"{root}/p")
    schema = T.StructType([T.StructField("id", T.LongType())])
    return lines.import_files(t.spark, f"{root}/*/*.txt", schema)


@query(
    "attribute_presence",
    """SELECT 'Id' AS attribute, count(*) AS n FROM customer
       UNION ALL SELECT 'Name', count(*) FROM customer
       UNION ALL SELECT 'NationKey', count(*) FROM customer WHERE c_acctbal >= 0
       UNION ALL SELECT 'acctbal', count(*) FROM customer
       UNION ALL SELECT 'Location', count(*) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
)
def attribute_presence(t):
    return profile.attribute_presence(customer_lines(t))


ORDER = T.StructType([
    T.StructField("orderkey", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("total", T.DecimalType(18, 2)),
    T.StructField("CreationDate", T.TimestampNTZType()),
    T.StructField("urgent", T.BooleanType()),
])


@query(
    "jsonl_rows",
    """SELECT o_orderkey AS orderkey, o_orderstatus AS status,
              CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderdate AS creationdate,
              o_orderpriority = '1-URGENT' AS urgent
       FROM orders""",
)
def jsonl_rows(t):
    shaped = t.orders.select(
        F.col("o_orderkey").alias("OrderKey"),
        F.col("o_orderstatus").alias("STATUS"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("Total"),
        F.col("o_orderdate").alias("Date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "1").otherwise("0").alias("Urgent"),
    )
    text = shaped.select(row_json(shaped.schema).alias("value"))
    return shape.fold_names(lines.json_rows(text, ORDER, column_map={"creationdate": "date"}))


LINE = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DecimalType(18, 2)),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


@query(
    "typed_convert",
    """SELECT l_orderkey, l_linenumber, l_quantity,
              CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, l_returnflag, l_shipdate
       FROM lineitem""",
)
def typed_convert(t):
    decimal = F.col("l_extendedprice").cast("decimal(18,2)")
    picked = t.lineitem.withColumn("l_extendedprice", decimal).select(*LINE.names)
    return shape.convert(shape.as_text(picked), LINE)


SUPPLIER = T.StructType([
    T.StructField("S_SuppKey", T.LongType()),
    T.StructField("S_Name", T.StringType()),
    T.StructField("Balance", T.DecimalType(18, 2)),
    T.StructField("Website", T.StringType()),
])


def _named(df, *names):
    return df.toDF(*[n.lower() for n in names])


@query(
    "align_lenient",
    """SELECT s_suppkey, s_name, CAST(NULL AS DECIMAL(18,2)) AS balance,
              CAST(NULL AS VARCHAR) AS website FROM supplier""",
)
def align_lenient(t):
    return shape.fold_names(shape.align(t.supplier, SUPPLIER))


@query(
    "align_strict",
    """SELECT s_suppkey, s_name, CAST(NULL AS DECIMAL(18,2)) AS balance,
              CAST(NULL AS VARCHAR) AS website FROM supplier""",
)
def align_strict(t):
    return shape.fold_names(shape.align(t.supplier.select("S_NAME", "S_SUPPKEY"), SUPPLIER, strict=True))


@query(
    "column_map",
    """SELECT s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(18,2)) AS balance,
              CAST(NULL AS VARCHAR) AS website FROM supplier""",
)
def column_map(t):
    return shape.fold_names(shape.align(t.supplier, SUPPLIER, column_map={"balance": "S_AcctBal"}))


@query(
    "doc_find",
    """SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
       ORDER BY c_acctbal DESC, c_custkey LIMIT 10 OFFSET 5""",
)
def doc_find(t):
    return find(
        t.customer,
        filter={"c_mktsegment": "BUILDING"},
        project={"c_custkey": 1, "c_name": 1, "c_acctbal": 1},
        sort=[("c_acctbal", -1), ("c_custkey", 1)],
        skip=5, first=10,
    )


@query(
    "doc_skip",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
       ORDER BY o_totalprice DESC, o_orderkey OFFSET 1000""",
)
def doc_skip(t):
    """All orders but the thousand dearest."""
    return find(
        t.orders,
        filter={"o_orderstatus": {"$ne": "P"}},
        project=["o_orderkey", "o_custkey", "o_totalprice"],
        sort=[("o_totalprice", -1), ("o_orderkey", 1)],
        skip=1000,
    )


@query(
    "doc_filter",
    """SELECT o_orderkey, o_custkey, count(*) AS n_lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey
       WHERE (o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_totalprice >= 250000) AND o_orderstatus <> 'P'
       GROUP BY 1, 2
       HAVING count(*) FILTER (l_quantity >= 30 AND l_returnflag = 'R') > 0
          AND count(*) FILTER (l_returnflag = 'A') = 0 AND count(*) <> 2""",
)
def doc_filter(t):
    """Order documents by conditions on the order and on the elements of its list of lines."""
    lists = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"))).alias("lines"))
    documents = (
        t.orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("o_orderkey", "o_custkey", "lines",
                F.struct("o_orderpriority", "o_totalprice", "o_orderstatus").alias("head"))
    )
    found = find(documents, {
        "$or": [
            {"head.o_orderpriority": {"$in": ["1-URGENT", "2-HIGH"]}},
            {"head.o_totalprice": {"$gte": 250000}},
        ],
        "head.o_orderstatus": {"$ne": "P"},
        "lines": {"$elemMatch": {"quantity": {"$gte": 30}, "flag": "R"}, "$not": {"$size": 2}},
        "lines.flag": {"$nin": ["A"]},
    })
    return found.select("o_orderkey", "o_custkey", F.size("lines").cast("bigint").alias("n_lines"))


@query(
    "derive_columns",
    """SELECT event_id, 'events' AS department, event_type AS person,
              CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 SECOND * (event_id % 86400) AS starts,
              CAST(ts AS DATE) AS day
       FROM events""",
)
def derive_columns(t):
    day = F.to_date("ts")
    return t.events.select(
        "event_id",
        F.lit("events").alias("department"),
        F.col("event_type").alias("person"),
        clock.at_time(day, F.col("event_id") % 86400).alias("starts"),
        day.alias("day"),
    )


@query(
    "hours_worked",
    """SELECT l_orderkey, l_linenumber, l_shipdate,
              date_diff('microsecond', o_orderdate, l_shipdate) / 3600000000.0::DOUBLE AS hours
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def hours_worked(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        clock.hours_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("hours"),
    )


@query(
    "nan_to_null",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events""",
)
def nan_to_null(t):
    holes = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )
    return shape.nan_to_null(holes)


@query(
    "row_number",
    """SELECT o_orderkey, o_totalprice,
              row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders""",
)
def row_number(t):
    picked = t.orders.select("o_orderkey", "o_totalprice")
    return ranking.number_rows(picked, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("sort_multi", "SELECT o_orderstatus, o_orderdate, o_orderkey FROM orders ORDER BY 1, 2, 3")
def sort_multi(t):
    return t.orders.select("o_orderstatus", "o_orderdate", "o_orderkey").orderBy(
        "o_orderstatus", "o_orderdate", "o_orderkey"
    )


@query(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_k(t):
    return ranking.top_rows(
        t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 10
    )


@query(
    "pick_one",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
       ORDER BY md5(o_orderkey::VARCHAR || ':7'), o_orderkey LIMIT 1""",
)
def pick_one(t):
    unpaid = t.orders.filter(F.col("o_orderstatus") == "O")
    return ranking.pick_one(unpaid.select("o_orderkey", "o_orderstatus"), "o_orderkey", seed=7)


@query(
    "table_information",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}"
        for name in TABLES
    ),
)
def table_information(t):
    return profile.table_information({name: getattr(t, name) for name in TABLES})


@query(
    "union_by_name",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS acctbal, CAST(NULL AS VARCHAR) AS segment
       FROM supplier
       UNION ALL
       SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""",
)
def union_by_name(t):
    suppliers = t.supplier.select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal")
    )
    customers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"),
    )
    return shape.stack([suppliers, customers])


PART_FORM = """SELECT CASE WHEN p_size < 5 THEN CASE WHEN p_type = 'ECONOMY' THEN '' END
                           WHEN p_size < 9 THEN upper(p_name) || ':' ELSE p_name END AS title,
                      CASE WHEN p_size >= 5 THEN p_brand END AS brand,
                      CASE WHEN p_size >= 9 THEN p_size END AS size
               FROM part"""


def part_form(t):
    """Parts as a hand-filled form: blank rows (NULL or empty text) and heading rows in between."""
    size = F.col("p_size")
    title = (
        F.when(size < 5, F.when(F.col("p_type") == "ECONOMY", F.lit("")))
        .when(size < 9, F.concat(F.upper("p_name"), F.lit(":")))
        .otherwise(F.col("p_name"))
    )
    return t.part.select(
        title.alias("title"),
        F.when(size >= 5, F.col("p_brand")).alias("brand"),
        F.when(size >= 9, size).alias("size"),
    )


@query(
    "drop_blank_rows",
    f"""SELECT title, brand, size FROM ({PART_FORM})
        WHERE (title IS NOT NULL AND trim(title) <> '') OR (brand IS NOT NULL AND trim(brand) <> '')
           OR size IS NOT NULL""",
)
def drop_blank_rows(t):
    return shape.drop_blank_rows(part_form(t))


@query(
    "skip_headings",
    f"SELECT title, brand, size FROM ({PART_FORM}) WHERE title IS NULL OR title NOT LIKE '%:'",
)
def skip_headings(t):
    return shape.skip_headings(part_form(t), "title")

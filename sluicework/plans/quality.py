"""Rules, accept and reject, repair, hand-back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.functions.text import clamp
from sluicework.operators import quality as dq
from sluicework.plans.registry import query

TARGET = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("color", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("percent", T.IntegerType()),
    T.StructField("due", T.TimestampNTZType()),
    T.StructField("row_id", T.LongType()),
])

COLORS = ["Green", "Yellow", "Red"]

RULES = [
    dq.not_null("title", "title_null"),
    dq.one_of("color", COLORS, "color_list"),
    dq.max_length("status", 50, "status_length"),
    dq.convertible("percent", T.IntegerType(), "percent_type"),
    dq.in_range("percent", T.IntegerType(), 0, 100, "percent_range"),
    dq.convertible("due", T.TimestampNTZType(), "due_type"),
    dq.Unique("title_key", ("title",), "position"),
]

# Every fault below is made from the order key, so that all of the table takes part
FORM = """form AS (
    SELECT o_orderkey AS position,
           CASE WHEN o_orderkey % 97 = 0 THEN NULL
                WHEN o_orderkey % 19 = 0 THEN 'P' || CAST(o_orderkey // 2 AS VARCHAR)
                ELSE 'P' || CAST(o_orderkey AS VARCHAR) END AS title,
           CASE WHEN o_orderkey % 13 = 0 THEN 'DarkRed' WHEN o_orderkey % 3 = 0 THEN 'Green'
                WHEN o_orderkey % 3 = 1 THEN 'Yellow' END AS color,
           CASE WHEN o_orderkey % 17 = 0 THEN repeat('late ', 12) ELSE o_orderpriority END AS status,
           CASE WHEN o_orderkey % 23 = 0 THEN 'unknown'
                ELSE CAST(o_orderkey % 104 AS VARCHAR) END AS percent,
           CASE WHEN o_orderkey % 29 = 0 THEN 'Late july 2026'
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS due
    FROM orders)"""


def checked_sql(color: str, name: str) -> str:
    """The rules as SQL over a colour expression; uniqueness counts the rows that pass the rest."""
    return f"""{name}_rows AS (
        SELECT form.* REPLACE ({color} AS color), color AS given,
               list_sort(
                   CASE WHEN title IS NULL THEN ['title_null'] ELSE [] END
                   || CASE WHEN ({color}) NOT IN ('Green', 'Yellow', 'Red')
                           THEN ['color_list'] ELSE [] END
                   || CASE WHEN length(status) > 50 THEN ['status_length'] ELSE [] END
                   || CASE WHEN percent = 'unknown' THEN ['percent_type'] ELSE [] END
                   || CASE WHEN TRY_CAST(percent AS INTEGER) NOT BETWEEN 0 AND 100
                           THEN ['percent_range'] ELSE [] END
                   || CASE WHEN due LIKE 'Late%' THEN ['due_type'] ELSE [] END) AS r
        FROM form),
    {name} AS (
        SELECT position, title, color, status, percent, due, given,
               CASE WHEN len(r) = 0 AND position <> min(position) FILTER (WHERE len(r) = 0)
                                                  OVER (PARTITION BY title)
                    THEN ['title_key'] ELSE r END AS r
        FROM {name}_rows)"""


REPAIRED = """CASE WHEN color = 'DarkRed' AND title IS NOT NULL AND length(status) <= 50
                    AND percent <> 'unknown' AND TRY_CAST(percent AS INTEGER) BETWEEN 0 AND 100
                    AND due NOT LIKE 'Late%' THEN 'Red' ELSE color END"""
ACCEPTED = """SELECT title, color, status, CAST(percent AS INTEGER) AS percent,
                     CAST(due AS TIMESTAMP) AS due, position AS row_id"""


def form(t):
    """Orders as a hand-filled form, everything text but the row position."""
    key = F.col("o_orderkey")
    return t.orders.select(
        key.alias("position"),
        F.when(key % 97 == 0, None)
        .when(key % 19 == 0, F.concat(F.lit("P"), F.expr("o_orderkey div 2").cast("string")))
        .otherwise(F.concat(F.lit("P"), key.cast("string"))).alias("title"),
        F.when(key % 13 == 0, "DarkRed").when(key % 3 == 0, "Green").when(key % 3 == 1, "Yellow")
        .alias("color"),
        F.when(key % 17 == 0, F.repeat(F.lit("late "), 12)).otherwise(F.col("o_orderpriority"))
        .alias("status"),
        F.when(key % 23 == 0, "unknown").otherwise((key % 104).cast("string")).alias("percent"),
        F.when(key % 29 == 0, "Late july 2026").otherwise(F.to_date("o_orderdate").cast("string"))
        .alias("due"),
        key.cast("string").alias("row_id"),
    )


def checked(t):
    return dq.check(form(t), RULES)


def repaired(t):
    return dq.repair(form(t), RULES, "color_list", "color", F.lit("Red"))


@query(
    "dq_reasons",
    f"""WITH {FORM}, {checked_sql("color", "c")}
        SELECT position, array_to_string(r, ',') AS reasons FROM c""",
)
def dq_reasons(t):
    return checked(t).select("position", F.array_join("reasons", ",").alias("reasons"))


@query("dq_accept", f"WITH {FORM}, {checked_sql('color', 'c')} {ACCEPTED} FROM c WHERE len(r) = 0")
def dq_accept(t):
    return dq.accepted(checked(t), TARGET)


@query(
    "dq_quarantine",
    f"""WITH {FORM}, {checked_sql("color", "c")}
        SELECT position, title, color, status, percent, due, CAST(position AS VARCHAR) AS row_id,
               array_to_string(r, ', ') AS import_error
        FROM c WHERE len(r) > 0""",
)
def dq_quarantine(t):
    return dq.rejected(checked(t), "import_error")


@query(
    "dq_repair",
    f"""WITH {FORM}, {checked_sql(REPAIRED, "c")}
        SELECT position, CASE WHEN len(r) = 0 THEN color ELSE given END AS color,
               CASE WHEN TRY_CAST(percent AS INTEGER) IS NOT NULL
                    THEN least(greatest(TRY_CAST(percent AS INTEGER), 0), 100) END AS clamped,
               array_to_string(r, ',') AS reasons
        FROM c""",
)
def dq_repair(t):
    return repaired(t).select(
        "position", "color", clamp(F.col("percent").try_cast("int"), 0, 100).alias("clamped"),
        F.array_join("reasons", ",").alias("reasons"),
    )


@query(
    "dq_summary",
    f"""WITH {FORM}, {checked_sql("color", "c")}
        SELECT reason, count(*) AS n FROM (SELECT unnest(r) AS reason FROM c) GROUP BY reason""",
)
def dq_summary(t):
    return dq.summary(checked(t))

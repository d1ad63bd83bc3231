import datetime
import decimal
import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.operators import profile, reconcile
from sluicework.sinks import eventlog as producing
from sluicework.sinks import jsonlines, tables
from sluicework.sources import collections, eventlog, lines
from sluicework.sources.tables import read_query, read_table
from sluicework.streaming.metrics import LoadMetrics, recorded

GRID = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("amount", T.DecimalType(10, 2)),
])
D, N = datetime.datetime, decimal.Decimal
ROWS = [
    (1, "Größe ᵀᴹ", D(2025, 3, 30, 2, 30, 0, 7000), N("1.50")),
    (2, "it's \"quoted\"", D(2024, 2, 29, 23, 0, 1, 640000), N("-7.25")),
    (3, "tab\tnew\nline\\", D(1999, 12, 31, 12, 0, 0, 998000), N("0.00")),
    (4, "", D(2031, 7, 4, 18, 45, 30, 20000), N("48151.62")),
    (5, None, None, None),
]


@pytest.fixture
def grid(spark):
    return spark.createDataFrame(ROWS, GRID)


@pytest.fixture
def database(spark):
    url = f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true"
    for name, columns in {
        "GRID": "ID INT, NAME STRING, TS TIMESTAMP_NTZ, AMOUNT DECIMAL(10,2), EXTRA INT",
        "NARROW": "ID INT, NAME STRING",
    }.items():
        spark.createDataFrame([], columns).write.jdbc(url, name)
    return url


NTZ = {"preferTimestampNTZ": "true"}


def test_append_fits_the_rows_to_the_table(spark, grid, database):
    extra = {"unknown": F.lit(1), "Extra": F.lit(float("nan"))}
    tables.append(grid.withColumns(extra), database, "GRID", **NTZ)
    back = read_table(spark, database, "GRID", **NTZ)
    assert back.count() == 5 and back.filter("EXTRA is not null").count() == 0
    result = reconcile.rows_equal(back.select(*[F.col(c).alias(c.lower()) for c in ("ID", "NAME", "TS", "AMOUNT")]), grid)
    assert result.first()["equal"]
    tables.append(grid.limit(2), database, "GRID", truncate=True, **NTZ)
    assert read_table(spark, database, "GRID", **NTZ).schema["EXTRA"].dataType == T.IntegerType()
    assert read_table(spark, database, "GRID", **NTZ).count() == 2


def test_append_refuses_nothing(spark, grid, database):
    with pytest.raises(ValueError, match="empty"):
        tables.append(grid.limit(0), database, "GRID")
    with pytest.raises(TypeError):
        tables.append([1, 2], database, "GRID")


def test_copy_between_tables(spark, grid, database):
    tables.append(grid, database, "GRID", **NTZ)
    with pytest.raises(ValueError, match="no target column for source column TS, AMOUNT, EXTRA"):
        tables.copy(spark, database, database, "NARROW", "GRID", source_options=NTZ)
    tables.copy(spark, database, database, "NARROW", query="SELECT ID, NAME FROM GRID WHERE CAST(NAME AS VARCHAR(100)) <> :skip AND ID > @low",
                parameters={"skip": "it's \"quoted\"", "low": 0})
    assert sorted(r["ID"] for r in read_table(spark, database, "NARROW").collect()) == [1, 3, 4]
    with pytest.raises(ValueError, match="either"):
        tables.copy(spark, database, database, "NARROW")
    with pytest.raises(ValueError, match="no query"):
        read_query(spark, database, "")


def test_partitioned_read_drops_no_row_and_pushes_filters(spark, grid, database):
    tables.append(grid, database, "GRID", **NTZ)
    df = read_table(spark, database, "GRID", partition_column="ID", parts=3)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 5
    plan = df.filter("ID > 2").select("NAME")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ID,2)" in plan and "AMOUNT" not in plan
    empty = read_table(spark, database, "NARROW", partition_column="ID")
    assert empty.count() == 0


def test_export_and_import_give_the_same_rows(spark, grid, tmp_path):
    path = str(tmp_path / "grid")
    jsonlines.export_json(grid, path)
    texts = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    first = next(t for t in texts if t["id"] == 1)
    assert first["amount"] == "1.50" and first["ts"] == "2025-03-30 02:30:00.007"
    assert next(t for t in texts if t["id"] == 5) == {"id": 5, "name": None, "ts": None, "amount": None}
    back = lines.import_files(spark, path, GRID)
    differences = reconcile.diff_by_column(back, grid, ["id"], ["name", "ts", "amount"]).collect()
    assert [(r["n_compared"], r["n_differing"], r["n_not_null"]) for r in differences] == [(5, 0, 4)] * 3


def test_binary_is_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, bytearray(b"\x89PNG"))], "id int, blob_column binary")
    with pytest.raises(TypeError, match="blob_column is binary"):
        jsonlines.export_json(df, str(tmp_path / "x"))
    nested = df.select(F.array(F.struct("blob_column")).alias("a"))
    with pytest.raises(TypeError, match="a is binary"):
        jsonlines.export_json(nested, str(tmp_path / "y"))


def test_nested_values_survive(spark, tmp_path):
    schema = T.StructType([
        T.StructField("Seq", T.IntegerType()), T.StructField("Text", T.StringType()),
        T.StructField("Nested", T.StructType([
            T.StructField("When", T.TimestampNTZType()),
            T.StructField("List", T.ArrayType(T.StructType([T.StructField("Amount", T.DecimalType(10, 2))]))),
        ])),
    ])
    df = spark.createDataFrame(
        [(1, "tab\tnew\nline\\", (D(2026, 1, 1, 0, 0, 0, 123456), [(N("1.50"),), (None,)])), (2, None, None)], schema)
    path = str(tmp_path / "docs")
    jsonlines.export_json(df, path)
    assert '"1.50"' in spark.read.text(path).filter("value like '%:1,%'").first()["value"]
    back = spark.read.schema(schema).json(path)
    assert reconcile.rows_equal(back, df).first()["equal"]


def test_collections_are_added_to_or_replaced(spark, tmp_path):
    path = str(tmp_path / "orders")
    docs = spark.createDataFrame([(1, ("x", [1, 2]))], "_id int, body struct<a string, b array<int>>")
    jsonlines.write_collection(docs, path)
    jsonlines.write_collection(docs, path)
    assert collections.read_collection(spark, path).count() == 2
    jsonlines.write_collection(docs, path, replace=True)
    assert collections.read_collection(spark, path).first()["body"]["b"] == [1, 2]
    with pytest.raises(ValueError):
        jsonlines.write_collection(docs.limit(0), path)


def test_parquet_append_keeps_the_columns(spark, grid, tmp_path):
    path = str(tmp_path / "t")
    grid.write.parquet(path)
    tables.append_parquet(grid.select(F.col("id").cast("string").alias("ID"), F.lit(1).alias("junk")), path)
    back = spark.read.parquet(path)
    assert back.schema == grid.schema and back.count() == 10


def test_reports_side_by_side(spark, tmp_path):
    spans = spark.createDataFrame(
        [("a", D(2025, 1, 1, 8), D(2025, 1, 1, 9)), ("a", D(2025, 1, 2, 8), D(2025, 1, 2, 8, 30)), ("b", D(2025, 1, 1, 8), D(2025, 1, 1, 8, 1))],
        "Project string, Start timestamp_ntz, End timestamp_ntz")
    tables.write_reports({
        "by_project": profile.minutes_by(spans, ["Project"], "Start", "End"),
        "by_date": profile.minutes_by(spans, [F.to_date("Start").alias("day")], "Start", "End"),
    }, str(tmp_path))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "by_project")).collect()} == {("a", 90), ("b", 1)}
    assert spark.read.parquet(str(tmp_path / "by_date")).agg(F.sum("minutes")).first()[0] == 91


def test_log_records(spark, grid, tmp_path):
    path = str(tmp_path / "log")
    producing.append_log(producing.encode(grid, "id"), path, ["key"])
    producing.append_log(producing.encode(grid.filter("id < 3")), path, ["value"], start=5)
    log = eventlog.read_log(spark, path)
    assert sorted(r["offset"] for r in log.collect()) == list(range(7))
    assert eventlog.high_watermark(log) == 7 and eventlog.bite(log, 2, 3).count() == 3
    assert {r["key"] for r in log.filter("offset < 5").collect()} == set("12345")
    assert log.filter("offset >= 5 and key is null").count() == 2
    back = lines.json_rows(log.filter("offset < 5"), GRID)
    assert reconcile.rows_equal(back, grid).first()["equal"]
    with pytest.raises(ValueError, match="empty"):
        producing.append_log(producing.encode(grid.limit(0)), path, ["key"])


def test_load_metrics(spark, tmp_path):
    metrics = LoadMetrics(spark)
    with metrics.observed(spark.range(1000), "numbers", expected=2000) as counted:
        counted.write.parquet(str(tmp_path / "numbers"))
    row = metrics.frame().first()
    assert (row["load"], row["n_rows"], row["percent"]) == ("numbers", 1000, 50.0) and row["rows_per_second"] > 0
    for _ in range(2):
        metrics.append_to(str(tmp_path / "metrics"))
    kept = recorded(spark, [str(tmp_path / "metrics")])
    assert kept.filter(F.col("load").like("num%")).count() == 2


def test_load_stamp_is_one_per_query(spark):
    stamped = spark.range(1000, numPartitions=4).withColumn("transfered_at", F.current_timestamp())
    assert stamped.select("transfered_at").distinct().count() == 1


def test_ranges_have_similar_numbers_of_rows(spark):
    url = f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true"
    # Nine tenths of the keys lie close together, the others far apart, some below zero; some are NULL
    keys = F.when(F.col("id") < 3600, F.col("id") % 3000 + 10).otherwise((F.col("id") - 3800) * F.lit(10**15))
    source = spark.range(4000).select(F.when(F.col("id") % 100 != 7, keys).alias("K"), F.col("id").alias("V"))
    source.write.jdbc(url, "SKEWED")
    df = read_table(spark, url, "SKEWED", partition_column="K", parts=8)
    sizes = [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert 6 <= len(sizes) <= 9 and sum(sizes) == 4000 and max(sizes) < 2 * 4000 / len(sizes)
    assert rows_of(df) == rows_of(source)
    assert read_table(spark, url, "SKEWED", partition_column="K").rdd.getNumPartitions() == 1
    # One key and NULL with a third each: they have ranges of their own, nothing is lost or doubled
    hot = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id")).cast("int").alias("K"), F.col("id").alias("V"))
    hot.write.jdbc(url, "HOT")
    df = read_table(spark, url, "HOT", partition_column="K", parts=6)
    sizes = sorted(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
    assert sum(sizes) == 900 and sizes[-1] <= 305 and len(sizes) >= 5
    assert rows_of(df) == rows_of(hot)


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())

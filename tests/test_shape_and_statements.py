import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.operators import profile, ranking, shape
from sluicework.sources import statements
from sluicework.sources.tables import sql_literal, with_literals

TARGET = T.StructType([
    T.StructField("Id", T.IntegerType()),
    T.StructField("CreationDate", T.TimestampNTZType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Age", T.IntegerType()),
])


def test_align_is_by_folded_name_and_order_and_type(spark):
    df = spark.createDataFrame([("x", "7", 1)], "NAME string, iD string, extra int")
    result = shape.align(df, TARGET)
    assert result.schema == TARGET or [f.dataType for f in result.schema] == [f.dataType for f in TARGET]
    assert result.columns == TARGET.names and result.first()[:] == (7, None, "x", None)


def test_strict_alignment_refuses_extra_columns(spark):
    df = spark.createDataFrame([("x", 1)], "name string, extra int")
    with pytest.raises(ValueError, match="no target column for source column extra"):
        shape.align(df, TARGET, strict=True)


def test_names_that_differ_only_in_case_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "id int, ID int")
    with pytest.raises(ValueError, match="differ only in case"):
        shape.align(df, TARGET)


def test_column_map_feeds_a_target_from_another_name(spark):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:00.001")], "id int, Date string")
    row = shape.align(df, TARGET, column_map={"creationdate": "DATE"}).first()
    assert row["CreationDate"].microsecond == 1000
    with pytest.raises(ValueError, match="names no target column"):
        shape.align(df, TARGET, column_map={"Nothing": "Date"})


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, "b"), (None, "c")], "x double, s string")
    assert [r["x"] for r in shape.nan_to_null(df).collect()] == [1.0, None, None]


def test_blank_rows_and_headings(spark):
    rows = [("A", 1), ("", None), (None, None), ("NEW:", None), (None, 3), ("  ", None)]
    df = spark.createDataFrame(rows, "title string, n int")
    kept = shape.skip_headings(shape.drop_blank_rows(df), "title")
    assert {tuple(r) for r in kept.collect()} == {("A", 1), (None, 3)}


def test_stack_fills_missing_columns_and_needs_a_schema_when_empty(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "b")], "x int, y string")
    assert {tuple(r) for r in shape.stack([a, b]).collect()} == {(1, None), (2, "b")}
    empty = spark.createDataFrame([], "x int")
    assert shape.stack([], empty).columns == ["x"]
    with pytest.raises(ValueError):
        shape.stack([])


def test_name_differences():
    assert shape.name_differences(["Id", "Age"], ["id", "Name"]) == (["Age"], ["Name"])
    assert shape.name_differences(["Id"], ["id"], fold=False) == (["Id"], ["id"])


def test_at_names_become_colon_names_outside_quotes():
    text = "SELECT '@a', \"@b\", `@c`, @@rows, x::int -- @d\n, @e /* @f */"
    assert statements.with_colon_names(text) == (
        "SELECT '@a', \"@b\", `@c`, @@rows, x::int -- @d\n, :e /* @f */"
    )


def test_run_shapes_and_errors(spark):
    df = spark.range(3)
    assert statements.run(spark, "SELECT max(id) FROM {t}", shape="single_value", t=df) == 2
    assert statements.run(spark, "SELECT id FROM {t} WHERE id > @x", {"x": 9}, "single_value", t=df) is None
    rows = statements.run(spark, "SELECT id FROM {t} ORDER BY id", shape="dict", t=df)
    assert next(rows) == {"id": 0} and list(rows) == [{"id": 1}, {"id": 2}]
    assert list(statements.run(spark, "SELECT id, 'x' AS x FROM {t}", shape="list", t=df.limit(1))) == [(0, "x")]
    assert statements.run(spark, "SELECT ? + ? AS s", [1, 2]).first()["s"] == 3
    assert statements.run(spark, "SELECT :a::int + 1 AS s, ':a' AS t", {"a": "4"}).first()[:] == (5, ":a")
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        statements.run(spark, "SELECT :missing", {"other": 1})
    with pytest.raises(ValueError, match="unknown shape"):
        statements.run(spark, "SELECT 1", shape="frame")
    with pytest.raises(TypeError):
        statements.run(spark, "SELECT 1", "text")


def test_literals_for_a_remote_query():
    query = "SELECT ':x', a::int, @y FROM t WHERE n = :x"
    assert with_literals(query, {"x": "O'Brien", "y": 1}) == (
        "SELECT ':x', a::int, 1 FROM t WHERE n = 'O''Brien'"
    )
    assert sql_literal(None) == "NULL"
    with pytest.raises(KeyError, match="x"):
        with_literals(query, {"y": 1})


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "x int, s string")
    assert {(r["column_name"], r["n_nulls"]) for r in profile.null_profile(df).collect()} == {("x", 1), ("s", 2)}
    assert profile.all_null_rows(df).first()[:] == (1, 3)
    empty = df.filter("x > 9")
    assert profile.high_water_mark(empty, "x").first()["high_water"] == 0
    assert {r["n_nulls"] for r in profile.null_profile(empty).collect()} == {0}
    entries = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('a', 3)")
    assert [tuple(r) for r in profile.key_presence(entries, "m").collect()] == [("a", 2), ("b", 1)]


def test_table_information(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "a"))
    tables = {"a": spark.read.parquet(str(tmp_path / "a"))}
    assert profile.table_information(tables).first()[:] == ("a", 100)
    size = profile.table_bytes(tables).first()
    on_disk = sum(f.stat().st_size for f in (tmp_path / "a").glob("*.parquet"))
    assert size["n_files"] == 3 and size["n_bytes"] == on_disk
    with pytest.raises(ValueError):
        profile.table_information({})


def test_top_rows_and_pick(spark):
    df = spark.range(100)
    assert [r["id"] for r in ranking.top_rows(df, [F.desc("id")], 3, skip=2).collect()] == [97, 96, 95]
    assert ranking.pick_one(df, "id", 1).first() == ranking.pick_one(df, "id", 1).first()
    picks = {ranking.pick_one(df, "id", seed).first()["id"] for seed in range(8)}
    assert len(picks) > 3
    assert ranking.number_rows(df.filter("id > 1000"), ["id"]).count() == 0

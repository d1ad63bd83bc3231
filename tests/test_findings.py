"""Cases in which an earlier version gave a wrong answer."""

import pytest
from pyspark.sql import functions as F

from sluicework.functions import wkt
from sluicework.operators import incremental as inc
from sluicework.operators import profile
from sluicework.plans import reports
from sluicework.plans.registry import Tables
from sluicework.plans.reports import order_documents_of
from sluicework.sinks import tables

FOLDER = "/root/testdata/sf0.001"


def test_children_without_an_end_are_counted(spark):
    parents = spark.sql("SELECT 1 AS k, timestamp_ntz'2024-01-01 08:00:00' AS s UNION ALL SELECT 2, timestamp_ntz'2024-01-01 08:00:00'")
    children = spark.sql(
        "SELECT 1 AS c, timestamp_ntz'2024-01-01 09:00:00' AS e UNION ALL SELECT 1, NULL UNION ALL SELECT 2, NULL")
    rows = profile.minutes_per_parent(parents, children, "k", "c", "s", "e").orderBy("k").collect()
    assert [(r["k"], r["n_children"], r["minutes"]) for r in rows] == [(1, 2, 60), (2, 1, None)]


@pytest.mark.parametrize("old, new", [
    ([(1, "a")], [(1, "a"), (2, "b"), (2, "b")]),
    ([(2, "a"), (2, "b")], [(2, "a"), (2, "c")]),
    ([(1, "a"), (1, "a"), (None, "x")], [(1, "a"), (None, None)]),
    ([(1, "a")], []),
])
def test_a_feed_turns_one_bag_into_the_other(spark, old, new):
    old, new = (spark.createDataFrame(x, "k int, v string") for x in (old, new))
    feed = inc.change_feed(old, new, ["k"])
    got = inc.apply_change_feed(old, feed, ["k"], [])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, new.collect()))


def test_every_page_has_the_price_of_its_order(spark):
    t = Tables(spark, FOLDER)
    whole = {r["OrderId"]: r["Price"] for r in order_documents_of(t).collect()}
    pages = order_documents_of(t, page_size=2).collect()
    assert max(r["Pages"] for r in pages) > 1
    assert all(r["Price"] == whole[r["OrderId"]] for r in pages)


@pytest.mark.parametrize("text", [
    "LINESTRING (1 2, 3 4", "garbage", "POINT Z (1 2 3)", "POINT (a b)",
    "GEOMETRYCOLLECTION (POINT (1 2), POINT (3 4))", "POINT (1 2 3)", "POLYGON (1 2, 3 4)", "POINT (1 2), (3 4)",
    "MULTILINESTRING ((1 2), , (3 4))",
])
def test_text_that_is_no_wkt_is_an_error(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="not WKT"):
        df.select(wkt.parse_wkt(F.col("t"))).collect()
    assert df.select(wkt.parse_wkt(F.col("t"), strict=False).isNull().alias("x")).first()["x"]


@pytest.mark.parametrize("text, back", [
    ("MULTIPOINT ((1 2), (3 4))", "MULTIPOINT (1 2, 3 4)"), ("MULTIPOINT (1 2, 3 4)", "MULTIPOINT (1 2, 3 4)"),
    ("point(1 -2.5e3)", "POINT (1 -2.5e3)"), ("POLYGON EMPTY", "POLYGON EMPTY"),
    ("MULTIPOLYGON (((0 0, 1 0, 0 0)), ((5 5, 6 5, 5 5), (5 5, 5 6, 5 5)))",) * 2,
])
def test_wkt_round_trip(spark, text, back):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(wkt.to_wkt(wkt.parse_wkt(F.col("t"))).alias("x")).first()["x"] == back


def test_appending_to_files_is_as_strict_as_to_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2.0)], "a int, b double").write.parquet(path)
    with pytest.raises(ValueError, match="empty"):
        tables.append_parquet(spark.createDataFrame([], "a int, b double"), path)
    tables.append_parquet(spark.createDataFrame([(2, float("nan"))], "a int, b double"), path)
    assert spark.read.parquet(path).filter("a = 2").first()["b"] is None


def test_information_on_all_tables_of_a_folder(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "b.parquet"))
    found = profile.stored_tables(spark, str(tmp_path))
    assert list(found) == ["a", "b"]
    rows = {r["table_name"]: r for r in profile.full_information(found).collect()}
    for name, n in (("a", 10), ("b", 3)):
        files = list((tmp_path / f"{name}.parquet").glob("*.parquet"))
        assert rows[name][1:] == (n, len(files), sum(f.stat().st_size for f in files))


def test_entries_of_an_order_are_summed_and_joined_by_the_bytes_of_the_lines(spark, tmp_path, monkeypatch, capsys):
    spark.range(4000).selectExpr("id l_orderkey", "id % 7 l_partkey", "CAST(1.5 AS DOUBLE) l_extendedprice").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.range(7).selectExpr("id p_partkey", "concat('b', id % 2) p_brand").write.parquet(str(tmp_path / "part.parquet"))
    spark.range(4000).selectExpr("id o_orderkey", "'1-URGENT' o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(reports, "ENTRY_BYTES", 1000, raising=False)
    got = reports.three_way_join(Tables(spark, str(tmp_path)))
    got.explain()
    assert "REPARTITION_BY_NUM" in capsys.readouterr().out
    want = {f"b{b}": sum(1 for i in range(4000) if i % 7 % 2 == b) for b in (0, 1)}
    assert {r["p_brand"]: (r["n_lines"], float(r["total"])) for r in got.collect()} == {b: (n, n * 1.5) for b, n in want.items()}

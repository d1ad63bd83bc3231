"""Finding in documents: nested filters by a plain evaluation, and skipping without one task for all."""

import re

import pytest
from pyspark.sql import functions as F

from sluicework.sources import collections

SCHEMA = """id int, name string, n int, place struct<city:string, zip:int>, tags array<string>,
            parts array<struct<sku:string, qty:int>>, more map<string, int>, `a.b` int"""
DOCS = [
    (1, "ann", 5, ("Ulm", 89), ["x", "y"], [("s1", 3), ("s2", 9)], {"k": 1}, 7),
    (2, "bob", None, ("Bonn", None), [], [("s1", 9)], {}, None),
    (3, None, 7, None, None, None, None, 7),
    (4, "ann", 9, (None, 10), ["y", None], [], {"k": 2}, 1),
    (5, "", 5, ("Ulm", 10), ["x"], [("s2", None), None, ("s3", 4)], {"j": 1}, 2),
]

CASES = [
    ({}, {1, 2, 3, 4, 5}),
    ({"name": "ann", "n": 5}, {1}),
    ({"name": None}, {3}),
    ({"n": {"$ne": 5}}, {2, 3, 4}),
    ({"n": {"$ne": None}}, {1, 3, 4, 5}),
    ({"n": {"$gt": 5, "$lte": 9}}, {3, 4}),
    ({"n": {"$in": [5, None]}}, {1, 2, 5}),
    ({"n": {"$nin": [5, None]}}, {3, 4}),
    ({"n": "5"}, set()),
    ({"name": {"$gt": 1}}, set()),
    ({"n": {"$not": {"$gt": 5}}}, {1, 2, 5}),
    ({"name": {"$regex": "^a"}}, {1, 4}),
    ({"place.city": "Ulm"}, {1, 5}),
    ({"place.city": None}, {3, 4}),
    ({"place.zip": {"$exists": True}}, {1, 4, 5}),
    ({"place.zip": {"$exists": False}}, {2, 3}),
    ({"tags": "x"}, {1, 5}),
    ({"tags": ["x", "y"]}, {1}),
    ({"tags": []}, {2}),
    ({"tags": {"$all": ["x", "y"]}}, {1}),
    ({"tags": {"$size": 1}}, {5}),
    ({"tags": {"$ne": "x"}}, {2, 3, 4}),
    ({"tags.0": "y"}, {4}),
    ({"tags": {"$elemMatch": {"$gte": "y"}}}, {1, 4}),
    ({"parts.sku": "s1"}, {1, 2}),
    ({"parts.sku": "s2", "parts.qty": 3}, {1}),
    ({"parts": {"$elemMatch": {"sku": "s2", "qty": 9}}}, {1}),
    ({"parts": {"$elemMatch": {"$or": [{"sku": "s3"}, {"qty": 9}]}}}, {1, 2, 5}),
    ({"parts.qty": {"$gt": 3, "$lt": 9}}, {1, 5}),  # in 1 by two elements
    ({"parts": {"$elemMatch": {"qty": {"$gt": 3, "$lt": 9}}}}, {5}),
    ({"parts.0.qty": 9}, {2}),
    ({"more.k": {"$gte": 1}}, {1, 4}),
    ({"more.k": None}, {2, 3, 5}),
    ({"a.b": 7}, {1, 3}),
    ({"nothing.there": 1}, set()),
    ({"nothing.there": None}, {1, 2, 3, 4, 5}),
    ({"nothing": {"$exists": False}}, {1, 2, 3, 4, 5}),
    ({"$or": [{"n": 9}, {"name": "bob"}]}, {2, 4}),
    ({"$nor": [{"n": 9}, {"name": "bob"}]}, {1, 3, 5}),
    ({"$and": [{"n": {"$gte": 5}}, {"$or": [{"tags": "y"}, {"a.b": 2}]}]}, {1, 4, 5}),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).cache()


@pytest.mark.parametrize(("filter", "ids"), CASES, ids=[str(f) for f, _ in CASES])
def test_filter(docs, filter, ids):
    assert {r["id"] for r in collections.find(docs, filter).select("id").collect()} == ids


@pytest.mark.parametrize("filter", [{"n": {"$near": 1}}, {"$xor": [{"n": 1}]}, {"$or": []}])
def test_unknown_operators_are_errors(docs, filter):
    with pytest.raises(ValueError, match=re.escape(next(k for k in ("$near", "$xor", "$or") if k in str(filter)))):
        collections.find(docs, filter)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_plain_tests_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.struct(F.col("id").alias("x")).alias("s")).write.parquet(path)
    found = collections.find(spark.read.parquet(path), {"id": {"$gte": 3, "$lt": 9}, "s.x": {"$in": [4, 5]}})
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan(found), re.DOTALL)[1]
    assert "GreaterThanOrEqual(id,3)" in pushed and "LessThan(id,9)" in pushed and "In(s.x" in pushed
    assert sorted(r["id"] for r in found.collect()) == [4, 5]


@pytest.mark.parametrize("first", [None, 50, 20_000])
def test_skipped_rows_are_numbered_in_parallel(spark, first):
    docs = spark.range(0, 30_000, 1, 6).select("id", (F.col("id") % 7).alias("n"))
    found = collections.find(docs, {"n": {"$ne": 3}}, sort=[("n", -1), ("id", 1)], skip=9_990, first=first)
    assert "CollectLimit" not in plan(found) and "GlobalLimit" not in plan(found)
    expected = sorted(((i, i % 7) for i in range(30_000) if i % 7 != 3), key=lambda r: (-r[1], r[0]))[9_990:]
    assert [tuple(r) for r in found.collect()] == expected[:first]
    assert collections.find(docs, skip=29_000).count() == 1_000
    assert collections.find(docs, skip=40_000).count() == 0


def test_few_rows_are_a_top_k(spark):
    found = collections.find(spark.range(1000), sort=[("id", -1)], skip=5, first=3)
    assert "TakeOrderedAndProject" in plan(found)
    assert [r["id"] for r in found.collect()] == [994, 993, 992]

"""One key holds a third of all rows: results stay whole, and no task gets the key."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import duck_rows, spark_rows
from sluicework.operators import incremental, matching, nested, profile, quality, ranking, reconcile
from sluicework.plans.registry import TABLES, Tables
from sluicework.plans.reports import order_documents_of
from sluicework.session import scratch_root, scratch_scope
from sluicework.sinks import files
from sluicework.sinks import tables as table_sinks

SOURCE = "/root/testdata/sf0.001"
HOT = {  # table: the columns whose every third row gets one value
    "lineitem": {"l_orderkey": 7, "l_partkey": 11},
    "events": {"user_id": 3, "event_type": "'click'"},
    "orders": {"o_custkey": 5},
    "customer": {"c_mktsegment": "'BUILDING'"},
    "documents": {"lang": "'en'"},
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for table in TABLES:
        changes = ", ".join(
            f"CASE WHEN n % 3 = {i} THEN {value} ELSE {column} END AS {column}"
            for i, (column, value) in enumerate(HOT.get(table, {}).items())
        )
        replaced = f"* EXCLUDE n REPLACE ({changes})" if changes else "* EXCLUDE n"
        con.sql(f"""COPY (SELECT {replaced} FROM (SELECT *, row_number() OVER () AS n
                          FROM '{SOURCE}/{table}.parquet')) TO '{root}/{table}.parquet'""")
    return str(root)


# Row-by-row queries and plain scans are not touched by skew
ROWWISE = set("""align_lenient align_strict build_email column_map content_fingerprint derive_columns
    doc_find drop_blank_rows export_json inc_changed inc_high_water json_roundtrip jsonl_rows
    log_encode log_read_first_n ms_precision nan_to_null nest_document param_named param_positional
    project_columns replay_stream scan_query scan_table single_value skip_headings table_information
    text_predicates top_k typed_convert union_by_name unpaid_orders wkt_build wkt_parse wkt_points
    xml_rows""".split())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - ROWWISE))
def test_query_equals_sql_on_skewed_tables(spark, folder, name):
    columns, rows = spark_rows(entry.queries()[name](spark, folder))
    expected_columns, expected = duck_rows(folder, entry.oracle_sql()[name])
    assert (columns, rows) == (expected_columns, expected)


def test_the_tables_are_skewed(spark, folder):
    t = Tables(spark, folder)
    n = t.lineitem.count()
    assert t.lineitem.filter("l_orderkey = 7").count() > n / 3.2


def test_documents_of_a_hot_order_are_paged_and_whole(spark, folder):
    t = Tables(spark, folder)
    documents = order_documents_of(t, page_size=20).persist()
    hot = documents.filter("OrderId = 7")
    pages = [r["n"] for r in hot.select(F.size("Photos").alias("n")).collect()]
    entries = profile.quantities(t.lineitem.filter("l_orderkey = 7"), ["l_partkey"]).count()
    assert len(pages) > 1 and sum(pages) == entries
    assert max(pages) <= 45, "pages spread the entries"
    assert documents.count() > t.orders.count()
    assert documents.filter("OrderId <> 7 AND Page > 0").count() == 0
    documents.unpersist()


def test_paged_lists_keep_every_entry(spark):
    entries = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("v")).union(
        spark.range(3).select(F.lit(2), F.col("id"))
    )
    pages = nested.paged_lists(entries, "k", ["v"], page_size=100)
    back = pages.select("k", F.inline("entries"))
    assert reconcile.rows_equal(back, entries).first()["equal"]
    assert pages.filter("k = 1").count() == 10 and pages.filter("k = 2").count() == 1


def test_a_hot_null_key_is_paged_too(spark):
    entries = spark.range(1000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    pages = nested.paged_lists(entries, "k", ["v"], page_size=50)
    assert pages.filter("k IS NULL").count() == 7
    assert reconcile.rows_equal(pages.select("k", F.inline("entries")), entries).first()["equal"]


def test_a_hot_key_is_one_row_per_map_task_before_the_join(spark):
    parents = spark.range(10).select(
        F.col("id").alias("k"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("a")
    )
    children = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 10).alias("ck"),
        F.to_timestamp_ntz(F.lit("2024-01-01 01:00:00")).alias("b"),
    )
    result = profile.minutes_per_parent(parents, children, "k", "ck", "a", "b")
    assert result.agg(F.sum("minutes"), F.sum("n_children")).first()[:] == (540000, 9000)


@pytest.fixture
def small_thresholds(spark):
    """Skew handling at the size of a test: no broadcast, 20 KB is a large partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=200000):
    """n rows (k, v, w); key 1 holds a third of them."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"), F.lit("old").alias("w"),
    )


def splits(df):
    """Runs it and tells whether a skewed partition was split."""
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_a_row_join_splits_the_hot_key(spark, small_thresholds):
    rows = hot_rows(spark)
    names = spark.range(0, 200000, 1, 8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("n"))
    for how, expected in (("inner", 200000), ("left", 200000), ("left_semi", 200000), ("left_anti", 0)):
        joined = rows.join(names, "k", how)
        assert splits(joined), how
        assert joined.count() == expected


def test_an_aggregate_joined_in_place_would_not_split(spark, small_thresholds):
    rows = hot_rows(spark)
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert not splits(rows.join(per_key, "k", "left"))
    joined = matching.join_per_key(rows, per_key, ["k"])
    assert splits(joined) and joined.agg(F.sum(F.lit(1))).first()[0] == 200000
    assert joined.columns == ["k", "v", "w", "n"]


def test_merges_split_the_hot_key(spark, small_thresholds):
    target = hot_rows(spark)
    changed = spark.range(0, 50000, 1, 8).select(
        (F.col("id") * 3 + 5).alias("k"), (-F.col("id")).alias("v"), F.lit("new").alias("w")
    )
    gone = target.join(changed, "k", "left_semi").count()
    rewritten = incremental.merge_delete_rewrite(target, changed, ["k"])
    assert splits(rewritten) and rewritten.count() == 200000 - gone + 50000
    updated = incremental.merge_update_columns(target, changed, ["k"], ["w"], ["v"])
    assert splits(updated) and updated.count() == 200000
    assert updated.filter("w = 'new'").count() == gone
    feed = changed.withColumns({"op": F.lit(4), "lsn": F.col("v")})
    applied = incremental.apply_change_feed(target, feed, ["k"], ["lsn"])
    assert splits(applied) and applied.count() == 200000 - gone + 50000


def test_a_change_feed_splits_the_hot_key(spark, small_thresholds):
    old = hot_rows(spark, 100000)
    new = old.withColumn("w", F.lit("new"))
    feed = incremental.change_feed(old, new, ["k"])
    assert splits(feed)
    counts = {r["op"]: r["n"] for r in feed.groupBy("op").agg(F.sum("copies").alias("n")).collect()}
    single = old.groupBy("k").count().filter("count = 1").count()
    assert counts == {3: single, 4: single, 1: 100000 - single, 2: 100000 - single}


def test_uniqueness_and_paging_split_the_hot_key(spark, small_thresholds):
    rows = hot_rows(spark)
    checked = quality.check(rows, [quality.Unique("key", ("k",), "v")])
    assert splits(checked)
    assert quality.summary(checked).first()["n"] == 200000 - rows.select("k").distinct().count()
    pages = nested.paged_lists(rows, "k", ["v"], page_size=1000)
    assert splits(pages)
    assert pages.agg(F.sum(F.size("entries"))).first()[0] == 200000
    assert pages.agg(F.max(F.size("entries"))).first()[0] < 1300
    assert pages.filter("k = 1").count() == 67


def test_row_numbers_with_a_hot_sort_value(spark):
    df = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("v"), "id"
    )
    numbered = ranking.number_rows(df, [F.desc("v"), F.asc("id")])
    wrong = numbered.selectExpr("rn", "row_number() OVER (ORDER BY v DESC, id) AS expected").filter(
        "rn <> expected"
    )
    assert numbered.count() == 30000 and wrong.count() == 0


def test_row_numbers_are_spread_over_tasks(spark):
    df = spark.range(0, 20000, 1, 6).select(F.lit(1).alias("same"), "id")
    numbered = ranking.number_rows(df, ["same", "id"])
    sizes = [r["count"] for r in numbered.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 10000


def test_row_numbers_leave_nothing_behind_their_scope(spark, tmp_path):
    df, kept = spark.range(0, 5000, 1, 4).select((F.col("id") % 50).alias("v"), "id"), str(tmp_path / "kept")
    root = f"{scratch_root(spark)}/sluicework"
    before = files.names(spark, root)
    with scratch_scope(spark):
        ranking.number_rows(df, ["v", "id"], unique=["v", "id"]).write.parquet(kept)
        assert len(files.names(spark, root)) == len(before) + 1
    with pytest.raises(ValueError, match="not unique: v"), scratch_scope(spark):
        ranking.number_rows(df, ["v"], unique=["v"])
    assert files.names(spark, root) == before
    assert spark.read.parquet(kept).agg(F.count_distinct("rn"), F.max("rn")).first()[:] == (5000, 5000)


def test_runs_follow_the_bytes_of_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 40_000, 1, 4).write.parquet(path)
    df = spark.read.parquet(path)
    n_bytes = profile.table_bytes({"t": df}).first()["n_bytes"]
    assert ranking.runs_for(df) == 1 and ranking.runs_for(df, n_bytes // 3) in (3, 4)
    assert ranking.runs_for(spark.range(5)) is None
    numbered = ranking.number_rows(df, ["id"], runs=ranking.runs_for(df, n_bytes // 3))
    assert numbered.filter("rn <> id + 1").isEmpty() and numbered.select(F.input_file_name()).distinct().count() >= 3


def test_split_by_key_keeps_every_row(spark, tmp_path):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("p"), F.col("id") % 5)).alias("Department"),
        (F.col("id") % 2).cast("string").alias("Person"), "id",
    )
    path = str(tmp_path / "split")
    table_sinks.split_by(df, ["Department", "Person"], path)
    back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    assert reconcile.rows_equal(back, df).first()["equal"]
    one = spark.read.parquet(f"{path}/Department=a/Person=0")
    assert one.count() == df.filter("Department = 'a' AND Person = '0'").count()


def test_orphans_with_a_hot_key(spark):
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("a"))
    right = spark.range(300).select(F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id")).alias("b"))
    result = matching.orphans_both_ways(left, ["a"], right, ["b"])
    assert result.count() == 0
    only = matching.orphans_both_ways(left, ["a"], right.filter("b <> 1"), ["b"]).collect()
    assert [(r["only_in"], r["a"], r["n_rows"]) for r in only] == [("left", 1, 101)]

"""What a replay leaves and keeps on disk: logs, shuffles, replaced batches; and that nothing is lost by it."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_log_partitions import ENTRIES, records
from test_streaming import folded

from sluicework.plans import events
from sluicework.plans.registry import Tables
from sluicework.session import FREE_SHUFFLES
from sluicework.sinks import eventlog as producing
from sluicework.sources import eventlog
from sluicework.streaming import envelope, fold, replay
from sluicework.streaming.replay import OrderTables


def names_under(folder):
    return [os.path.join(at, name) for at, _, found in os.walk(folder) for name in found]


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in blocks.localDirsString() for f in map(os.path.basename, names_under(d)) if f.startswith("shuffle_")}


def test_a_written_batch_leaves_no_shuffle_files(spark, tmp_path):
    whole = records(spark, ENTRIES)
    tables = OrderTables(spark, str(tmp_path / "tables"))
    before = shuffle_files(spark)
    whole.repartition(3, "offset").write.parquet(str(tmp_path / "plain"))
    plain = shuffle_files(spark)
    assert plain - before, "what a write leaves otherwise"
    tables.store.write(0, {
        tables.EVENTS: envelope.decode(whole.repartition(3, "offset")), tables.APPLIED: replay.ranges_of(whole),
        tables.STATES: fold.order_states(envelope.decode(whole))})
    # Others may go meanwhile, with the garbage of earlier tests
    assert not shuffle_files(spark) - plain - before
    assert spark.conf.get(FREE_SHUFFLES, None) is None


def test_a_batch_is_not_kept_in_blocks_and_what_was_taken_goes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(records(spark, ENTRIES)), "persist", lambda df, *level: pytest.fail("texts in blocks of the executors"))
    tables = OrderTables(spark, str(tmp_path / "tables"))
    for batch in (0, 1):
        tables.apply(records(spark, ENTRIES[:10 + 10 * batch]), batch)
        assert not names_under(tmp_path / "tables" / tables.TAKEN)
    assert tables.store.published() == [0, 1]
    with pytest.raises(Exception, match="[Mm]alformed"):
        tables.apply(records(spark, [(9, 0, *ENTRIES[0][2:])]).withColumn("value", F.lit("nonsense")), 2)
    assert tables.store.published() == [0, 1] and not names_under(tmp_path / "tables" / tables.TAKEN)


def test_a_batch_with_nothing_new_passes_no_text_by(spark, tmp_path, monkeypatch):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    tables.apply(records(spark, ENTRIES), 0)
    monkeypatch.setattr(replay, "decode", lambda log: pytest.fail("no row is new"))
    tables.apply(records(spark, ENTRIES[5:]), 1)
    assert tables.store.published() == [0]


def test_replaced_batches_go_and_the_orders_stay(spark, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    for batch in range(3):
        tables.apply(records(spark, ENTRIES[batch::3]), batch)
    before = folded(tables.order_headers())
    tables.compact()
    assert sorted(tables.remove_unused()) == [0, 1, 2]
    for table in (tables.EVENTS, tables.APPLIED, tables.STATES):
        assert os.listdir(tmp_path / "tables" / table) == ["batch_id=-3"]
    assert folded(tables.order_headers()) == before and tables.customers().count() == 2
    tables.apply(records(spark, ENTRIES), 0)
    assert tables.store.published() == [-3] and folded(tables.order_headers()) == before


def test_within_against_plain_loops(spark):
    rng, width = random.Random(3), eventlog.RANGE
    ranges = [(p, a, a + rng.choice([0, 2, 40, 2 * width])) for p in (0, 1) for a in rng.sample(range(5 * width), 60)]
    tries = [(p, o + d) for p, a, b in ranges for o in (a, b) for d in (-1, 0, 1)] + [(None, None), (0, None), (2, 7)]
    want = {(p, o) for p, o in tries if o is None or any(q == p and a <= o <= b for q, a, b in ranges)}
    stored = spark.createDataFrame(ranges, "partition int, first bigint, last bigint")
    log = spark.createDataFrame([(p, o, f"{p}:{o}") for p, o in tries * 2], "partition int, offset bigint, value string")
    got = replay.within(log, stored)
    assert got.columns == log.columns
    rows = [tuple(r) for r in got.collect()]
    assert sorted(map(str, rows)) == sorted(str((p, o, f"{p}:{o}")) for p, o in want)


def test_a_written_log_is_compressed_and_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(producing, "FILE_RECORDS", 4)
    log, path = records(spark, ENTRIES), str(tmp_path / "log")
    producing.write_log(log.coalesce(1), path)
    producing.write_log(log.limit(3), path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert all(f.endswith(".gz") for f in files) and len(files) >= -(-len(ENTRIES) // 4)
    got = eventlog.read_log(spark, path).select("partition", "offset", "value")
    want = log.select("partition", "offset", "value")
    assert sorted(got.collect()) == sorted(want.collect() + want.limit(3).collect())


def test_a_long_log_is_several_batches(spark, tmp_path, monkeypatch):
    log, path = records(spark, ENTRIES), str(tmp_path / "log")
    producing.write_log(log.repartition(4), path)
    monkeypatch.setattr(eventlog, "BITE_BYTES", 1)
    tables = OrderTables(spark, str(tmp_path / "tables"))
    tables.follow(eventlog.stream_log(spark, path), str(tmp_path / "reader")).awaitTermination()
    assert len(tables.store.published()) == 4
    assert folded(tables.order_headers()) == folded(fold.order_headers(envelope.decode(log)))


def test_states_of_events_merge_to_those_of_orders(spark):
    decoded = envelope.decode(records(spark, ENTRIES))
    by_event = fold.event_states(decoded)
    assert by_event.columns == fold.order_states(decoded).columns and by_event.count() > fold.order_states(decoded).count()
    assert sorted(map(str, fold.merged_states(by_event).collect())) == sorted(map(str, fold.order_states(decoded).collect()))
    counted = {r["id"]: r["n_changes"] for r in fold.order_states(decoded).collect()}
    assert counted[99] == 1 and counted[1] == 2 and counted[3] == 2


def test_replay_twice_keeps_a_compressed_log_and_one_batch(spark, tmp_path, monkeypatch):
    spark.range(1, 61).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"),
        F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.expr("timestamp_ntz'2024-01-01 10:00:00'").alias("o_orderdate"),
        F.when(F.col("id") % 5 == 0, "4-NOT SPECIFIED").when(F.col("id") % 5 == 1, "5-LOW").otherwise("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(str(tmp_path / "in" / "orders.parquet"))
    monkeypatch.setattr(events, "scratch_path", lambda spark, name: str(tmp_path / name))
    t = Tables(spark, str(tmp_path / "in"))
    assert sorted(map(str, events.replay_twice(t).collect())) == sorted(map(str, events.fold_orders(t).collect()))
    log = [f for f in os.listdir(tmp_path / "twice" / "log") if f.startswith("part-")]
    assert log and all(f.endswith(".json.gz") for f in log)
    held = {f.split(os.sep)[-2] for t in ("events", "states") for f in names_under(tmp_path / "twice" / "tables" / t)}
    assert len(held) == 1 and all(int(b.removeprefix("batch_id=")) < 0 for b in held)

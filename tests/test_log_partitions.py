"""Logs of several partitions: positions, bites, keyed producing, and replays out of order."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import HISTORY, change, event, folded, header

from sluicework.sinks import eventlog as producing
from sluicework.sources import eventlog, lines
from sluicework.streaming import envelope, fold, replay
from sluicework.streaming.replay import OrderTables

LOG = "partition int, offset bigint, value string"


@pytest.fixture(scope="module")
def gaps(spark):
    """Three partitions of very different length, with gaps, out of order."""
    rng = random.Random(4)
    rows = [(p, o, f"{p}:{o}") for p, n in ((0, 6), (2, 300), (5, 40)) for o in rng.sample(range(n * 40), n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, LOG).repartition(5), sorted(rows)


@pytest.mark.parametrize("width", [16, 1 << 16])
def test_a_bite_is_exact_whatever_the_gaps(spark, gaps, monkeypatch, width):
    monkeypatch.setattr(eventlog, "RANGE", width)
    log, rows = gaps
    starts = [{}, {0: 100, 2: 5000, 5: 400}, {2: 11_000, 7: 3}]
    for start in starts:
        left = [r for r in rows if r[1] >= start.get(r[0], 0)]
        for first in (1, 5, 6, 7, 150, 330, 1000):
            got = sorted(map(tuple, eventlog.bite(log, start, first).collect()))
            assert got == left[:first]
    assert eventlog.bite(log.limit(0), {}, 5).count() == 0 and eventlog.bite(log, {}, 0).count() == 0


def test_bites_follow_each_other_to_the_end(gaps):
    log, rows = gaps
    at, seen = {}, []
    while ends := eventlog.bite_ends(log, at, 97):
        seen += map(tuple, eventlog.replay(log, ends).filter(F.col("offset") >= eventlog._per_partition(at, "partition", 0)).collect())
        at |= ends
    assert sorted(seen) == rows and at == eventlog.high_watermarks(log)


def test_watermark_replay_and_lag_go_by_partition(spark, gaps):
    log, rows = gaps
    ends = eventlog.high_watermarks(log)
    assert ends == {p: max(o for q, o, _ in rows if q == p) + 1 for p in (0, 2, 5)}
    later = log.unionAll(spark.createDataFrame([(0, ends[0], "x"), (9, 0, "y"), (5, ends[5] + 3, "z")], LOG))
    assert sorted(map(tuple, eventlog.replay(later, ends).collect())) == rows
    readers = spark.createDataFrame([("a", 0, 1), ("a", 2, ends[2]), ("b", 9, 0)], "reader string, partition int, position bigint")
    assert {(r["reader"], r["partition"]): r["lag"] for r in eventlog.reader_lag(readers, ends).collect()} == {
        ("a", 0): ends[0] - 1, ("a", 2): 0, ("b", 9): 0}
    assert json.loads(eventlog.starting_offsets("t", {2: 5, 0: 1})) == {"t": {"0": 1, "2": 5}}


def test_a_bite_is_no_sort_of_the_log(gaps, capsys):
    log, _ = gaps
    eventlog.bite(log, {}, 200).explain()
    plan = capsys.readouterr().out
    assert "Sort [" not in plan and "Window [" not in plan and "TakeOrdered" not in plan


def test_keyed_records_are_dense_per_partition(spark, tmp_path):
    path = str(tmp_path / "log")
    ends = {}
    for start, count in ((0, 500), (500, 230)):
        rows = spark.range(start, start + count).select(
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, (F.col("id") % 40).cast("string")).alias("k"), "id")
        encoded = producing.encode(rows, "k").withColumn("_id", F.get_json_object("value", "$.id").cast("int"))
        producing.append_log(encoded, path, ["_id"], start=ends, parts=4)
        log = eventlog.read_log(spark, path)
        ends = eventlog.high_watermarks(log)
    assert sum(ends.values()) == 730 and len(ends) == 4
    places = log.groupBy("partition").agg(F.count_distinct("offset").alias("n"), F.count("*").alias("m"), F.min("offset").alias("low")).collect()
    assert all(r["n"] == r["m"] == ends[r["partition"]] and r["low"] == 0 for r in places)
    assert log.filter("key is not null").groupBy("key").agg(F.count_distinct("partition").alias("n")).filter("n > 1").isEmpty()
    ordered = log.orderBy("partition", "offset").select("partition", F.get_json_object("value", "$.id").cast("int").alias("id")).collect()
    assert all(a["id"] < b["id"] for a, b in zip(ordered, ordered[1:]) if a["partition"] == b["partition"])


def records(spark, entries):
    """``entries``: (partition, offset, message, body)."""
    rows = [(e["key"], e["value"], p, o) for p, o, m, d in entries for e in [event(o, m, d)]]
    return spark.createDataFrame(rows, "key string, value string, partition int, offset bigint").withColumn(
        "timestamp", F.lit(None).cast("timestamp_ntz"))


ENTRIES = [(i % 2, i // 2, m, d) for i, (m, d) in enumerate(HISTORY)] + [
    (0, 20, "Added order header", header(4)), (0, 24, "Added payment", change("payment", 4, 30)),
    (0, 22, "Added shipment", change("shipment", 4, 31)), (0, 30, "Added order header", header(5)),
    (0, 31, "Added payment", change("payment", 5, 33)), (0, 35, "Added order header", header(5)),
]


@pytest.mark.parametrize("seed", range(4))
def test_any_order_of_batches_and_compactions_gives_the_fold(spark, tmp_path, seed):
    rng = random.Random(seed)
    whole = records(spark, ENTRIES)
    want = folded(fold.order_headers(envelope.decode(whole)))
    entries = ENTRIES + rng.sample(ENTRIES, 8)
    rng.shuffle(entries)
    tables = OrderTables(spark, str(tmp_path / "tables"))
    for batch in range(4):
        part = entries[batch::4]
        tables.apply(records(spark, part + part[:2]), rng.choice([0, batch, 7]))
        if rng.random() < 0.6:
            tables.compact()
    assert folded(tables.order_headers()) == want
    assert sorted(r["id"] for r in tables.customers().collect()) == [1, 2] and tables.order_lines().count() == 4
    tables.apply(whole, 0)
    assert folded(tables.order_headers()) == want and tables.customers().count() == 2


def test_a_header_that_comes_after_the_compaction_finds_its_change(spark, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    tables.apply(records(spark, [(0, 6, "Added payment", change("payment", 2, 9)), (0, 9, "Added order header", header(7))]), 0)
    tables.apply(records(spark, [(0, 3, "Added customer", HISTORY[0][1])]), 1)
    tables.compact()
    assert set(folded(tables.order_headers())) == {7}
    tables.apply(records(spark, [(0, 1, "Added order header", header(2)), (0, 8, "Added shipment", change("shipment", 2, 11))]), 2)
    assert folded(tables.order_headers())[2] == (11, "payment-2-9", "shipment-2-11")


def test_a_record_twice_in_one_batch_is_stored_once(spark, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    one = records(spark, [(0, 0, *HISTORY[0])])
    tables.apply(one.unionAll(one), 0)
    assert tables.customers().count() == 1


def test_applied_offsets_are_kept_as_ranges(spark):
    offsets = [*range(10), *range(12, 20), 25]
    log = spark.createDataFrame([(p, o) for p in (0, 3) for o in offsets] + [(0, 4)], "partition int, offset bigint")
    ranges = replay.ranges_of(log)
    assert sorted(tuple(r) for r in ranges.collect()) == [(p, a, b) for p in (0, 3) for a, b in ((0, 9), (12, 19), (25, 25))]
    more = ranges.unionAll(spark.createDataFrame([(0, 10, 11), (0, 30, 40), (0, 2, 3), (3, 20, 24)], ranges.schema))
    merged = sorted(tuple(r) for r in replay.merged_ranges(more).collect())
    assert merged == [(0, 0, 19), (0, 25, 25), (0, 30, 40), (3, 0, 9), (3, 12, 25)]
    tries = spark.createDataFrame([(p, o, "v") for p in (0, 1, 3) for o in range(45)], "partition int, offset bigint, value string")
    fresh = replay.not_within(tries, replay.merged_ranges(more))
    inside = {(p, o) for p, a, b in merged for o in range(a, b + 1)}
    assert fresh.columns == tries.columns
    assert {(r["partition"], r["offset"]) for r in fresh.collect()} == {(p, o) for p in (0, 1, 3) for o in range(45)} - inside


ID = T.StructType([T.StructField("id", T.LongType())])


def test_indented_objects_count_from_the_telling_line_on(spark, tmp_path):
    (tmp_path / "a.txt").write_text('# c\n  {"Id": 0}\n<row Id="7" />\n{"Id": 1}\n  {"Id": 2}\n{"Id": 3}\n')
    (tmp_path / "b.txt").write_text('{"Id": 4}\n  {"Id": 5}\n')
    (tmp_path / "c.txt").write_text('\n{"Id": 9}\n<?xml version="1.0"?>\n<row Id="8" />\n{"Id": 10}\n'.replace("<", " <"))
    (tmp_path / "d.txt").write_text('{"Id": 0}\n'.replace("{", " {") + '<?xml version="1.0"?>\n<row Id="11" />\n\t<row Id="12" />\n')
    for name, want in (("a", [1, 2, 3]), ("b", [4, 5]), ("d", [11, 12])):
        assert sorted(r["id"] for r in lines.import_files(spark, str(tmp_path / f"{name}.txt"), ID).collect()) == want
    together = lines.import_files(spark, str(tmp_path / "[abd].txt"), ID)
    assert sorted(r["id"] for r in together.collect()) == [1, 2, 3, 4, 5, 11, 12]
    with pytest.raises(Exception, match="[Mm]alformed|MALFORMED|row"):
        lines.import_files(spark, str(tmp_path / "c.txt"), ID).collect()


def test_a_partition_without_a_position_is_read_from_its_start(spark):
    log = spark.createDataFrame([(0, 5, "a"), (0, 90, "b"), (1, 0, "c"), (1, 7, "d")], LOG)
    assert sorted(r["value"] for r in eventlog.since(log, {0: 50}).collect()) == ["b", "c", "d"]
    assert sorted(r["value"] for r in eventlog.bite(log, {0: 50}, 2).collect()) == ["b", "c"]


@pytest.mark.parametrize("first", [1, 4, 7, 100])
def test_bites_are_exact_and_a_new_reader_goes_on(spark, tmp_path, first):
    log = records(spark, ENTRIES)
    want, at = folded(fold.order_headers(envelope.decode(log))), str(tmp_path / "tables")
    sizes, stored = [], 0
    while OrderTables(spark, at).apply_bite(log, first):
        tables = OrderTables(spark, at)
        now = tables.store.read(tables.APPLIED).agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0]
        sizes.append(now - stored)
        stored = now
        if len(sizes) == 3:
            tables.compact()
    assert all(n == first for n in sizes[:-1]) and 0 < sizes[-1] <= first and stored == len(ENTRIES)
    assert folded(OrderTables(spark, at).order_headers()) == want
    assert OrderTables(spark, at).positions() == eventlog.high_watermarks(log)


def test_bites_end_at_the_watermark_and_pass_over_what_is_no_event(spark, tmp_path):
    log = records(spark, ENTRIES)
    odd = spark.createDataFrame([(None, "{}", 3, 0), (None, "{}", 3, 9)], "key string, value string, partition int, offset bigint")
    grown = log.unionByName(odd, allowMissingColumns=True)
    tables = OrderTables(spark, str(tmp_path / "tables"))
    assert tables.apply_bites(grown, 10, eventlog.high_watermarks(log)) == -(-len(ENTRIES) // 10)
    assert 3 not in tables.positions()
    assert tables.apply_bites(grown, 1) == 2 and tables.positions()[3] == 10 and tables.apply_bites(grown, 5) == 0
    assert OrderTables(spark, str(tmp_path / "none")).apply_bites(log.limit(0), 5) == 0
    with pytest.raises(ValueError):
        tables.apply_bite(log, 0)


def test_many_ranges_over_many_blocks_against_plain_loops(spark):
    rng = random.Random(7)
    width = eventlog.RANGE
    ranges = []
    for p in (0, 1):
        at = rng.randrange(width)
        for _ in range(300):
            size = rng.choice([1, 1, 3, 500, width // 2, 3 * width])
            ranges.append((p, at, at + size - 1))
            # Next to it, within it, or after a gap
            at = max(at + rng.choice([size, size, size // 2, size + 1, size + 5, size + 2 * width]), 0)
    ranges += [(1, width, width), (1, 0, 4 * width), (2, width - 1, width - 1), (2, width, width)]
    want = []
    for p, a, b in sorted(ranges):
        if want and want[-1][0] == p and a <= want[-1][2] + 1:
            want[-1][2] = max(want[-1][2], b)
        else:
            want.append([p, a, b])
    stored = spark.createDataFrame(ranges, "partition int, first bigint, last bigint")
    assert sorted(map(list, replay.merged_ranges(stored).collect())) == want
    tries = sorted({(p, o + d) for p, a, b in ranges for o in (a, b) for d in (-1, 0, 1)} | {(3, 5), (0, 10**9)})
    fresh = [(p, o) for p, o in tries if not any(q == p and a <= o <= b for q, a, b in want)]
    log = spark.createDataFrame([(p, o, "v") for p, o in tries], "partition int, offset bigint, value string")
    assert sorted((r["partition"], r["offset"]) for r in replay.not_within(log, stored).collect()) == fresh
    twice = replay.not_within(log.unionAll(log), stored, once=True)
    assert sorted((r["partition"], r["offset"]) for r in twice.collect()) == fresh
    singles = spark.createDataFrame([(0, width - 2), (0, width - 1), (0, width), (0, width), (0, width + 2)], "partition int, offset bigint")
    assert sorted(tuple(r) for r in replay.ranges_of(singles).collect()) == [(0, width - 2, width), (0, width + 2, width + 2)]


def test_a_log_partition_is_many_tasks(spark):
    log = spark.range(20 * eventlog.RANGE).filter("id % 1000 = 0").select(F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("v").alias("value"))
    ranges = log.filter("offset % 3000 = 0").select("partition", F.col("offset").alias("first"), F.col("offset").alias("last"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = replay.not_within(log, ranges).groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) > 1 and max(r["n"] for r in per_task) < sum(r["n"] for r in per_task)


def test_a_batch_reads_the_ranges_near_it(spark, tmp_path, monkeypatch):
    tables, read = OrderTables(spark, str(tmp_path / "tables")), []
    plain = replay.not_within

    def counting(records, ranges, once=False):
        read.append(ranges.count())
        return plain(records, ranges, once)

    monkeypatch.setattr(replay, "not_within", counting)
    for batch, offsets in enumerate([(0, 2, 4), (10, 12), (4, 10, 20), (30,)]):
        tables.apply(records(spark, [(p, o, *HISTORY[0]) for p in (0, 1) for o in offsets]), batch)
    # 4 and 10 lie in it, nothing else from 4 to 20 but 12
    assert read == [0, 6, 0]
    assert tables.events().count() == 14
    odd = spark.createDataFrame([(None, 1, 2), (0, 5, 6), (1, 5, 6), (2, 5, 6)], "partition int, first bigint, last bigint")
    near = replay.ranges_near(odd, {0: (6, 9), 1: (7, 9), None: (0, 3)})
    assert sorted(map(str, (r["partition"] for r in near.collect()))) == ["0", "None"]

"""A shop's event log: replayed whole, followed in bites, restarted, and folded."""

import json

import pytest
from pyspark.sql import functions as F

from sluicework.operators import profile, reconcile
from sluicework.sources import eventlog
from sluicework.streaming import envelope, fold
from sluicework.streaming.metrics import LoadMetrics
from sluicework.streaming.replay import OrderTables, lag, until_quiet

AT = "2025-05-05T10:20:{:02d}.123000"


def event(offset, message, details, key=None):
    value = {"Timestamp": "2025-05-05T10:20:30.123456", "Hostname": "h", "Appname": "shop", "Component": "Order",
             "Level": "INFO", "Message": message, "Details": details}
    return {"key": key, "value": json.dumps(value), "partition": 0, "offset": offset,
            "timestamp": "2025-05-05T10:20:30.123456"}


def header(i, customer=1):
    return {"id": i, "customer_id": customer, "created_at": AT.format(i), "updated_at": None,
            "payment_uuid": None, "shipment_uuid": None}


def change(kind, order, second):
    return {"order_id": order, f"{kind}_uuid": f"{kind.upper()}-{order}-{second}", "updated_at": AT.format(second)}


HISTORY = [
    ("Added customer", {"id": 1, "firstname": "Jörg", "surname": "O'Brien", "city": "Ulm", "email": "j@ulm.de"}),
    ("Scheduled next customer", None),
    ("Added order header", header(1)),
    ("Added order details", [{"order_id": 1, "photo_id": p, "quantity": p, "price": "1.50"} for p in (1, 2, 3)]),
    ("Added payment", change("payment", 2, 20)),          # before its header: never lands
    ("Added order header", header(2)),
    ("Added order details", [{"order_id": 2, "photo_id": 9, "quantity": 1, "price": "0.10"}]),
    ("Added shipment", change("shipment", 1, 21)),        # shipment before payment
    ("Added payment", change("payment", 1, 22)),
    ("Added payment", change("payment", 99, 23)),         # an order nobody knows
    ("Added customer", {"id": 2, "firstname": "A", "surname": "B", "city": "C", "email": "d"}),
    ("Added order header", header(3, 2)),
    ("Added payment", change("payment", 3, 24)),
    ("Added payment", change("payment", 3, 25)),          # paid again: the last one counts
]
EXPECTED = {
    1: (22, "payment-1-22", "shipment-1-21"),
    2: (None, None, None),
    3: (25, "payment-3-25", None),
}


def write_log(folder, history, bite=3, start=0):
    folder.mkdir(exist_ok=True)
    for first in range(0, len(history), bite):
        lines = [json.dumps(event(start + first + i, *e)) for i, e in enumerate(history[first:first + bite])]
        (folder / f"{start + first:06d}.json").write_text("\n".join(lines) + "\n", encoding="utf-8")


def folded(headers):
    return {
        r["id"]: (r["updated_at"].second if r["updated_at"] else None, r["payment_uuid"], r["shipment_uuid"])
        for r in headers.collect()
    }


@pytest.fixture
def log(tmp_path):
    write_log(tmp_path / "log", HISTORY)
    return tmp_path / "log"


def test_fold_of_the_whole_history(spark, log):
    events = envelope.decode(eventlog.read_log(spark, str(log)))
    assert events.count() == len(HISTORY) - 1
    assert folded(fold.order_headers(events)) == EXPECTED
    assert fold.ignored_changes(events).first()[:] == (1, 1)
    assert {r["firstname"] for r in fold.customers(events).collect()} == {"Jörg", "A"}
    lines = fold.order_lines(events)
    assert lines.count() == 4 and lines.agg(F.sum("price")).first()[0] * 100 == 460


def test_a_repeated_header_starts_the_order_again(spark, tmp_path):
    again = HISTORY + [("Added order header", header(1)), ("Added shipment", change("shipment", 1, 30))]
    write_log(tmp_path / "log", again)
    events = envelope.decode(eventlog.read_log(spark, str(tmp_path / "log")))
    assert folded(fold.order_headers(events))[1] == (30, None, "shipment-1-30")


def test_a_second_generation_is_detected(spark, tmp_path):
    write_log(tmp_path / "log", HISTORY + HISTORY[:1])
    events = envelope.decode(eventlog.read_log(spark, str(tmp_path / "log")))
    assert [tuple(r) for r in profile.repeated_keys(fold.customers(events), ["id"]).collect()] == [(1, 2)]
    assert profile.repeated_keys(fold.customers(events.filter("offset < 14")), ["id"]).isEmpty()


def test_following_the_log_equals_the_fold(spark, log, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    query = tables.follow(eventlog.stream_log(spark, str(log), files_per_bite=1), str(tmp_path / "reader"))
    query.awaitTermination()
    assert query.exception() is None
    assert len(tables.store.published()) == 5, "one batch per file"
    assert folded(tables.order_headers()) == EXPECTED
    assert tables.order_lines().count() == 4 and tables.customers().count() == 2
    whole = envelope.decode(eventlog.read_log(spark, str(log)))
    result = reconcile.rows_equal(tables.order_headers(), fold.order_headers(whole)).first()
    assert result["equal"] and result["n_left"] == 3


def test_a_reader_resumes_and_a_new_reader_replays(spark, log, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    stream = eventlog.stream_log(spark, str(log), files_per_bite=2)
    tables.follow(stream, str(tmp_path / "reader")).awaitTermination()
    seen = tables.store.published()
    tables.follow(stream, str(tmp_path / "reader")).awaitTermination()
    assert tables.store.published() == seen, "nothing new, nothing applied"
    write_log(tmp_path / "log", [("Added shipment", change("shipment", 2, 40))], start=50)
    query = tables.follow(stream, str(tmp_path / "reader"))
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    assert folded(tables.order_headers())[2] == (40, None, "shipment-2-40")
    other = OrderTables(spark, str(tmp_path / "other"))
    other.follow(stream, str(tmp_path / "new reader")).awaitTermination()
    assert folded(other.order_headers()) == folded(tables.order_headers())


def test_a_reader_that_waits_stops_when_it_is_quiet(spark, log, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    query = tables.follow(eventlog.stream_log(spark, str(log)), str(tmp_path / "r"), processingTime="100 milliseconds")
    until_quiet(query, 3)
    assert not query.isActive and query.exception() is None
    assert folded(tables.order_headers()) == EXPECTED


def test_a_batch_applied_twice_counts_once(spark, log, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    whole = eventlog.read_log(spark, str(log))
    for _ in range(2):
        tables.apply(whole.filter("offset < 7"), 0)
        tables.apply(whole.filter("offset >= 7"), 1)
    assert folded(tables.order_headers()) == EXPECTED
    assert tables.order_lines().count() == 4 and tables.customers().count() == 2


@pytest.mark.parametrize("bite", [2, 5])
def test_bites_of_any_size_equal_the_whole(spark, log, tmp_path, bite):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    whole = eventlog.read_log(spark, str(log))
    end, position, batch = eventlog.high_watermark(whole), 0, 0
    while position < end:
        tables.apply(eventlog.bite(whole, position, bite), batch)
        position, batch = position + bite, batch + 1
    assert folded(tables.order_headers()) == EXPECTED
    assert tables.order_lines().count() == 4


def test_compaction_changes_nothing_a_reader_sees(spark, log, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    whole = eventlog.read_log(spark, str(log))
    for batch, (low, high) in enumerate([(0, 5), (5, 9), (9, 13)]):
        tables.apply(whole.filter(f"offset >= {low} AND offset < {high}"), batch)
    before = folded(tables.order_headers())
    tables.compact()
    assert tables.store.published() == [-3]
    assert folded(tables.order_headers()) == before
    assert tables.order_lines().count() == 4 and tables.customers().count() == 2
    assert tables.events().filter("kind = 'change'").isEmpty()
    tables.apply(whole.filter("offset >= 9 AND offset < 13"), 2)
    assert tables.store.published() == [-3], "a batch inside the compacted one is not applied again"
    tables.apply(whole.filter("offset >= 13"), 3)
    assert folded(tables.order_headers()) == EXPECTED
    tables.compact()
    assert folded(tables.order_headers()) == EXPECTED and tables.store.published() == [-4]


def test_a_new_reader_after_compaction_loses_and_doubles_nothing(spark, log, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    stream = eventlog.stream_log(spark, str(log), files_per_bite=1)
    tables.follow(stream, str(tmp_path / "reader")).awaitTermination()
    bites = eventlog.stream_log(spark, str(log), files_per_bite=2)
    tables.follow(bites, str(tmp_path / "second")).awaitTermination()
    assert tables.order_lines().count() == 4 and tables.customers().count() == 2
    tables.compact()
    late = {"id": 3, "firstname": "B", "surname": "C", "city": "D", "email": "e"}
    write_log(tmp_path / "log", [("Added customer", late)], start=70)
    for reader in ("third", "reader"):
        tables.follow(bites, str(tmp_path / reader)).awaitTermination()
    assert tables.order_lines().count() == 4
    assert sorted(r["id"] for r in tables.customers().collect()) == [1, 2, 3]
    assert folded(tables.order_headers()) == EXPECTED


def test_replay_ends_at_the_watermark_fixed_at_the_start(spark, log, tmp_path):
    whole = eventlog.read_log(spark, str(log))
    end = eventlog.high_watermark(whole)
    write_log(log, [("Added order header", header(7))], start=60)
    assert eventlog.replay(eventlog.read_log(spark, str(log)), end).count() == len(HISTORY)
    assert eventlog.high_watermark(whole.limit(0)) == 0


def test_lag(spark):
    positions = spark.createDataFrame([("a", 5), ("b", 14)], "reader string, position bigint")
    assert {(r["reader"], r["lag"]) for r in eventlog.reader_lag(positions, 14).collect()} == {("a", 9), ("b", 0)}
    progress = {"sources": [{"description": "t", "endOffset": {"t": {"0": 5, "1": 7}},
                             "latestOffset": {"t": {"0": 9, "1": 7}}}]}
    assert lag(progress) == {"t": 4}


def test_order_is_by_partition_and_offset_not_by_time(spark):
    rows = [("k", 1, 5, "late"), ("k", 1, 9, "last"), ("k", 0, 100, "other partition"), ("k", 1, 7, None)]
    df = spark.createDataFrame(rows, "k string, partition int, offset bigint, v string")
    got = fold.latest_values(df, ["k"], envelope.position(), {"v": (F.col("v"), F.lit(True))}).first()
    assert got["v"] == "last"


def test_a_value_that_is_not_json_is_an_error(spark):
    df = spark.createDataFrame([("k", "nonsense", 0, 1)], "key string, value string, partition int, offset bigint")
    with pytest.raises(Exception, match="[Mm]alformed"):
        envelope.decode(df).collect()


def test_encoded_events_decode(spark):
    df = spark.createDataFrame([(1, '{"id": 4, "customer_id": 2}')], "offset bigint, d string")
    rows = envelope.encode(df, F.lit("Added order header"), F.col("d"), F.lit("2026-01-01 00:00:00"))
    got = envelope.decode(rows.withColumn("partition", F.lit(0))).first()
    assert got["kind"] == "header" and got["header"]["id"] == 4 and got["lines"] is None


def test_progress_rows_become_a_table(spark, log, tmp_path):
    tables = OrderTables(spark, str(tmp_path / "tables"))
    query = tables.follow(eventlog.stream_log(spark, str(log)), str(tmp_path / "reader"))
    query.awaitTermination()
    metrics = LoadMetrics(spark)
    metrics.stream(query)
    assert metrics.frame().agg(F.sum("n_rows")).first()[0] == len(HISTORY)

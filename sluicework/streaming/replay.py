"""Applying an event log as a stream, and reading the tables it builds."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluicework.sinks.batches import BatchStore
from sluicework.sources import eventlog
from sluicework.streaming import fold
from sluicework.streaming.envelope import decode


#: Offsets from one multiple of ``eventlog.RANGE`` to the next are a block, the unit in which a log partition is looked at.
BLOCK_BITS = eventlog.RANGE.bit_length() - 1


def _block(offset: Column | str) -> Column:
    return F.shiftright(offset, BLOCK_BITS).cast("bigint")


def ranges_of(records: DataFrame) -> DataFrame:
    """``(partition, first, last)``: the offsets of every log partition as ranges without gaps."""
    return merged_ranges(records.select("partition", F.col("offset").alias("first"), F.col("offset").alias("last")))


def _merged_in_blocks(ranges: DataFrame) -> DataFrame:
    """Merges the ranges that have the same ``_block``."""
    order = Window.partitionBy("partition", "_block").orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reached.isNull() | (F.col("first") > reached + 1), 1).otherwise(0)
    runs = ranges.withColumn("_new", starts).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy("partition", "_block", "_run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_run")


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """The same offsets in as few ranges as they have gaps.

    First the ranges that begin in one block of offsets are merged. Every block then gets the range that is
    open where it begins, found from one row per block, and merges it with its own.
    """
    inside = _merged_in_blocks(ranges.select("partition", _block("first").alias("_block"), "first", "last"))
    before = Window.partitionBy("partition").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col("_reached").isNull() | (F.col("_top") > F.col("_reached") + 1), F.col("_top"))
    open_ = (
        inside.groupBy("partition", "_block").agg(F.max("last").alias("_last"), F.max("first").alias("_top"))
        .withColumn("_reached", F.max("_last").over(before))
        .withColumn("_opened", opened)
        .withColumn("first", F.max("_opened").over(before))
        .filter(F.col("_reached") + 1 >= F.col("_block") * eventlog.RANGE)
        .select("partition", "_block", "first", F.col("_reached").alias("last"))
    )
    return _merged_in_blocks(inside.unionByName(open_)).groupBy("partition", "first").agg(F.max("last").alias("last"))


def _reached(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Records and ranges together, with ``_reached``: where the ranges end that begin at a row's offset or before.

    Columns ``partition``, ``_block``, ``offset``, ``_row`` (a record's other columns), ``_last`` (the end of a range,
    NULL for a record) and ``_reached``.

    Ranges and records pass by in the order of their offsets, block by block, so there is no comparison of
    all with all, however many ranges there are, and no task has more than its blocks. A range counts in
    every block it reaches: one more row for each ``eventlog.RANGE`` offsets in it.
    """
    names = [c for c in records.columns if c not in ("partition", "offset")]
    rows = records.select(
        "partition", _block("offset").alias("_block"), "offset", F.struct(*map(F.col, names)).alias("_row"),
        F.lit(None).cast("bigint").alias("_last"))
    blocks = ranges.withColumn("_block", F.explode(F.sequence(_block("first"), _block("last"))))
    known = blocks.select(
        F.col("partition").cast(records.schema["partition"].dataType), "_block",
        F.greatest(F.col("first"), F.col("_block") * eventlog.RANGE).alias("offset"),
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), F.col("last").alias("_last"))
    # At one offset a range's start comes before a record
    order = Window.partitionBy("partition", "_block").orderBy("offset", F.col("_last").isNull())
    reached = F.max("_last").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.unionByName(known).withColumn("_reached", reached)


def _first_of_each() -> Column:
    same = Window.partitionBy("partition", "_block", "offset").orderBy(F.col("_last").isNull())
    return F.row_number().over(same)


def not_within(records: DataFrame, ranges: DataFrame, once: bool = False) -> DataFrame:
    """The records whose offset lies in no range of their partition; with ``once`` one of each offset."""
    marked = _reached(records, ranges)
    if once:
        marked = marked.withColumn("_nth", _first_of_each()).filter(F.col("_last").isNotNull() | (F.col("_nth") == 1))
    fresh = marked.filter(F.col("_last").isNull() & (F.col("_reached").isNull() | (F.col("_reached") < F.col("offset"))))
    return fresh.select("partition", "offset", "_row.*").select(*records.columns)


def within(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """One record of each offset that lies in a range of its partition, and one without an offset."""
    inside = F.col("offset").isNull() | (F.col("_reached") >= F.col("offset"))
    marked = _reached(records, ranges).filter(F.col("_last").isNull() & inside)
    once = marked.withColumn("_nth", _first_of_each()).filter("_nth = 1")
    return once.select("partition", "offset", "_row.*").select(*records.columns)


Bounds = Mapping[int | None, tuple[int, int]]


def bounds_of(records: DataFrame) -> Bounds:
    """The least and the last offset by log partition: two numbers per partition."""
    rows = records.groupBy("partition").agg(F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
    return {r["partition"]: (r["low"], r["high"]) for r in rows if r["low"] is not None}


def ranges_near(ranges: DataFrame, bounds: Bounds) -> DataFrame:
    """The ranges that meet the bounds of their partition; the files' statistics pass over the others."""
    if not bounds:
        return ranges.limit(0)
    kind = ranges.schema["partition"].dataType
    known = {p: b for p, b in bounds.items() if p is not None}

    def at(side: int) -> Column:
        entries = F.create_map(*[c for p, b in known.items() for c in (F.lit(p).cast(kind), F.lit(b[side]).cast("bigint"))])
        return F.try_element_at(entries, F.col("partition"))

    near = F.lit(False)
    if known:
        near = F.coalesce((F.col("first") <= at(1)) & (F.col("last") >= at(0)), F.lit(False))
    if None in bounds:
        near = near | F.col("partition").isNull()
    lows, highs = zip(*bounds.values(), strict=True)
    return ranges.filter((F.col("first") <= max(highs)) & (F.col("last") >= min(lows))).filter(near)


class OrderTables:
    """Customer, order_header and order_detail, kept as decoded events in published batches.

    A batch stores its events, and the offsets it brought as ranges; of what is stored it reads the ranges
    near its own offsets only, which ``compact`` merges. An event is known by its partition and offset: whatever reader brings
    it again, under whatever batch id, or twice in one batch, it is stored once. The fold happens on reading.

    ``compact`` replaces the events of an order by its state, in which every field has the position that
    set it. States merge with each other and with later events, so a change or a header that comes late
    counts as if it had come in time. Changes to an order without a header wait for it.
    """

    EVENTS, APPLIED, STATES = "events", "applied", "states"
    #: A batch as it came, while it is applied
    TAKEN = "taken"

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.store = BatchStore(spark, root)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: the function for ``foreachBatch``."""
        self._apply(batch, batch_id, None)

    def _apply(self, batch: DataFrame, batch_id: int, bounds: Bounds | None) -> None:
        """``bounds`` are the batch's least and last offsets, where they are known.

        The source is read once, into compressed files that go at the end. First the offsets alone are compared
        with the stored ones, and the ranges that are new are written; then the rows in these, if there are any.
        """
        ids = self.store.published()
        # The id may be another reader's, or within the compacted batch
        if ids and (batch_id in ids or batch_id <= self._compacted()):
            batch_id = max(*ids, self._compacted()) + 1
        try:
            self.store.write(batch_id, {self.TAKEN: batch.select("partition", "offset", "value")})
            taken = self.store.read(self.TAKEN, [batch_id]).drop("batch_id")
            offsets = taken.select("partition", "offset")
            if ids:
                applied = self.store.read(self.APPLIED, ids).select("partition", "first", "last")
                offsets = not_within(offsets, ranges_near(applied, bounds_of(offsets) if bounds is None else bounds))
            self.store.write(batch_id, {self.APPLIED: ranges_of(offsets)})
            brought = self.store.read(self.APPLIED, [batch_id]).select("partition", "first", "last")
            # Records that are no events count as applied
            if not ids or not brought.isEmpty():
                self.store.write(batch_id, {self.EVENTS: decode(within(taken, brought))})
                self.store.publish([batch_id])
        finally:
            self.store.discard(batch_id, [self.TAKEN])

    def follow(
        self, log: DataFrame, checkpoint: str, **trigger: object
    ) -> StreamingQuery:
        """Starts applying a streaming log; ``checkpoint`` is the identity of this reader.

        Without a trigger it applies everything that is there now and stops.
        """
        return (
            log.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def positions(self) -> dict[int, int]:
        """The next offset by log partition: one past the last applied one. A number per partition."""
        ids = self.store.published()
        if not ids:
            return {}
        rows = self.store.read(self.APPLIED, ids).groupBy("partition").agg((F.max("last") + 1).alias("next"))
        return {r["partition"]: r["next"] for r in rows.collect()}

    def apply_bite(self, log: DataFrame, first: int) -> dict[int, int]:
        """Applies the next ``first`` records of a log, exactly, or all that are left; gives where that ends.

        The reader stands where the stored positions are, which are published together with the events.
        So a reader that is started again goes on there, and a bite that failed before it was published is
        taken again. Records count in the order of partition and offset. Nothing left gives no positions.
        """
        if first < 1:
            raise ValueError("a bite has at least one record")
        start = self.positions()
        ends = eventlog.bite_ends(log, start, first)
        if ends:
            bounds = {p: (start.get(p, 0), end - 1) for p, end in ends.items()}
            self._apply(
                eventlog.replay(eventlog.since(log, start), ends), max(self.store.published(), default=-1) + 1, bounds)
        return ends

    def apply_bites(self, log: DataFrame, first: int, ends: Mapping[int, int] | None = None) -> int:
        """Applies a log in bites of ``first`` records up to its watermark now; gives how many bites.

        ``ends`` is a watermark taken earlier. Records that come after it wait for the next call.
        """
        log = eventlog.replay(log, eventlog.high_watermarks(log) if ends is None else ends)
        bites = 0
        while self.apply_bite(log, first):
            bites += 1
        return bites

    def _compacted(self) -> int:
        # A compacted batch is named after the last batch in it: -n - 1 holds everything up to n
        return max((-i - 1 for i in self.store.published() if i < 0), default=-1)

    def _states(self, ids: list[int]) -> DataFrame:
        compacted = [i for i in ids if i < 0]
        if not compacted:
            return fold.order_states(self.store.read(self.EVENTS, ids))
        stored = self.store.read(self.STATES, compacted).drop("batch_id")
        if len(ids) == 1:
            # One compacted batch has a state per order
            return stored
        # Events and stored states meet in one shuffle
        return fold.merged_states(fold.event_states(self.store.read(self.EVENTS, ids)).unionByName(stored))

    def events(self) -> DataFrame:
        """The stored events; those of compacted orders are in their states."""
        return self.store.read(self.EVENTS)

    def customers(self) -> DataFrame:
        return fold.customers(self.events())

    def order_headers(self) -> DataFrame:
        """The rows of the order_header table; changes to unknown orders are ignored."""
        return fold.presented(self._states(self.store.published())).filter("known").drop("known", "n_changes")

    def order_lines(self) -> DataFrame:
        return fold.order_lines(self.events())

    def compact(self) -> None:
        """Replaces all published batches by one with a state per order. Not while a stream is writing.

        The files of the replaced batches stay until ``remove_unused``.
        """
        ids = self.store.published()
        if len(ids) < 2:
            return
        target = -max([i for i in ids if i >= 0] or [self._compacted()]) - 1
        self.store.write(target, {
            self.EVENTS: self.store.read(self.EVENTS, ids).filter(F.col("kind").isin("customer", "lines")),
            self.STATES: self._states(ids),
            self.APPLIED: merged_ranges(self.store.read(self.APPLIED, ids).select("partition", "first", "last")),
        })
        self.store.publish([target], without=set(ids) - {target})

    def remove_unused(self, keep: int = 1) -> list[int]:
        """Deletes the files of batches that none of the last ``keep`` versions shows, and gives their ids."""
        return self.store.remove_unused((self.EVENTS, self.STATES, self.APPLIED), keep)


def until_quiet(query: StreamingQuery, seconds: float, poll: float = 0.2) -> None:
    """Waits until no record has come for ``seconds``, then stops the query between two batches."""
    seen, since = None, time.monotonic()
    while query.isActive:
        last = query.lastProgress
        if last and last["numInputRows"] > 0 and last["batchId"] != seen:
            seen, since = last["batchId"], time.monotonic()
        if time.monotonic() - since >= seconds and not query.status["isTriggerActive"]:
            query.stop()
        time.sleep(poll)


def lag(progress: Mapping) -> dict[str, int]:
    """Records a reader is behind, per source, from a query progress with numeric offsets."""
    def total(offsets) -> int:
        return sum(int(n) for parts in offsets.values() for n in parts.values())

    return {
        source["description"]: total(source["latestOffset"]) - total(source["endOffset"])
        for source in progress["sources"]
        if isinstance(source.get("latestOffset"), dict) and isinstance(source.get("endOffset"), dict)
    }

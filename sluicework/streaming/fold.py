"""Folding a history into its current state. The batch and the streaming reader share this."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.functions.clock import iso_timestamp
from sluicework.streaming.envelope import position

#: The fields of an order's state, each with the position that set it.
STATE = ["h", "u", "p", "s"]


def latest_values(
    events: DataFrame, keys: Sequence[str], order: Column, values: Mapping[str, tuple[Column, Column]],
) -> DataFrame:
    """One row per key: for every name the last value, in ``order``, among the rows that set it.

    ``values`` maps a name to (value, condition). Each name is folded on its own: an event that does
    not set a name leaves it as it was. Folding combines map-side.
    """
    return events.groupBy(*keys).agg(*[
        F.max_by(F.when(value.isNotNull() & condition, value),
                 F.when(value.isNotNull() & condition, order)).alias(name)
        for name, (value, condition) in values.items()
    ])


def event_states(events: DataFrame) -> DataFrame:
    """The state that every event makes by itself, of the columns of ``order_states``; an order has several rows."""
    order_id = F.coalesce(F.col("header.id"), F.col("change.order_id")).alias("id")

    def placed(value: Column, name: str) -> Column:
        return F.when(value.isNotNull(), F.struct(position().alias("at"), value.alias("value"))).alias(name)

    return events.filter(F.col("kind").isin("header", "change")).select(
        order_id,
        placed(F.col("header"), "h"),
        placed(F.col("change.updated_at"), "u"),
        placed(F.col("change.payment_uuid"), "p"),
        placed(F.col("change.shipment_uuid"), "s"),
        F.col("change").isNotNull().cast("bigint").alias("n_changes"),
    )


def order_states(events: DataFrame) -> DataFrame:
    """What is known of every order, each field with the position it was set at.

    Columns ``id``, ``h`` (the last header), ``u``, ``p``, ``s`` (the last ``updated_at``, payment and
    shipment of a change), all structs with ``at``, and ``n_changes``. Orders without a header have a row.
    """
    return merged_states(event_states(events))


def merged_states(states: DataFrame) -> DataFrame:
    """One state per order out of several, in any order and number: of every field the last one set."""
    return states.groupBy("id").agg(
        *(F.max_by(f, F.col(f)["at"]).alias(f) for f in STATE), F.sum("n_changes").alias("n_changes"))


def presented(states: DataFrame) -> DataFrame:
    """The orders of states: a header's own value counts unless a change after it set another."""
    def now(changed: str, field: str) -> Column:
        newer = F.col(f"{changed}.at") > F.col("h.at")
        return F.when(newer, F.col(f"{changed}.value")).otherwise(F.col(f"h.value.{field}"))

    return states.select(
        "id",
        F.col("h.value.customer_id").alias("customer_id"),
        iso_timestamp(F.col("h.value.created_at")).alias("created_at"),
        iso_timestamp(now("u", "updated_at")).alias("updated_at"),
        F.lower(now("p", "payment_uuid")).alias("payment_uuid"),
        F.lower(now("s", "shipment_uuid")).alias("shipment_uuid"),
        F.col("h").isNotNull().alias("known"),
        "n_changes",
    )


def fold_orders(events: DataFrame) -> DataFrame:
    """Order headers after all their changes.

    Per order: the last header, and of the changes after it the last ``updated_at``, payment and
    shipment, each on its own. Changes to an order without a header come out with ``known`` false.
    """
    return presented(order_states(events))


def order_headers(events: DataFrame) -> DataFrame:
    """The rows of the order_header table; changes to unknown orders are ignored."""
    return fold_orders(events).filter("known").drop("known", "n_changes")


def ignored_changes(events: DataFrame) -> DataFrame:
    """How many changes named an order that has no header."""
    return fold_orders(events).filter("not known").agg(
        F.count("*").alias("n_orders"), F.coalesce(F.sum("n_changes"), F.lit(0)).alias("n_changes")
    )


def customers(events: DataFrame) -> DataFrame:
    """All customers; a repeated id stays visible (see ``repeated_keys``)."""
    return events.filter(F.col("kind") == "customer").select("customer.*")


def order_lines(events: DataFrame) -> DataFrame:
    """The lists of all order-details events, one row per line."""
    return (
        events.filter(F.col("kind") == "lines")
        .select(F.inline("lines"))
        .withColumn("price", F.col("price").cast("decimal(7,2)"))
    )

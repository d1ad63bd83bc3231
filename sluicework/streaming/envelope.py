"""The event envelope and the five kinds of events in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of the envelope and of the bodies, and the messages that name the kinds.
ENVELOPE = "Message STRING, Details STRING"  # what decoding needs; encode writes all seven fields
CUSTOMER = "id BIGINT, firstname STRING, surname STRING, city STRING, email STRING"
HEADER = (
    "id BIGINT, customer_id BIGINT, created_at STRING, updated_at STRING, payment_uuid STRING, "
    "shipment_uuid STRING"
)
LINE = "order_id: BIGINT, photo_id: BIGINT, quantity: BIGINT, price: STRING"
CHANGE = "order_id BIGINT, updated_at STRING, payment_uuid STRING, shipment_uuid STRING"
MESSAGES = {
    "Added customer": "customer",
    "Added order header": "header",
    "Added order details": "lines",
    "Added payment": "change",
    "Added shipment": "change",
}


def decode(log: DataFrame) -> DataFrame:
    """Log records as typed events: (partition, offset, kind, customer, header, lines, change).

    ``Details`` stays text until its kind is known, because only one kind carries a list. Events of
    other kinds are passed over. A value that is not JSON is an error.
    """
    fast = {"mode": "FAILFAST"}
    # inline keeps the parsed envelope in one place; a filter on it would otherwise parse it again
    opened = log.select(
        "partition", "offset", F.inline(F.array(F.from_json("value", ENVELOPE, fast)))
    )
    kinds = F.create_map(*[F.lit(word) for pair in MESSAGES.items() for word in pair])
    events = opened.filter(F.col("Message").isin(list(MESSAGES))).withColumn(
        "kind", kinds[F.col("Message")]
    )

    def body(name: str, schema: str) -> Column:
        return F.when(
            F.col("kind") == name, F.from_json("Details", schema, fast)
        ).alias(name)

    return events.select(
        "partition", "offset", "kind",
        body("customer", CUSTOMER), body("header", HEADER),
        body("lines", f"ARRAY<STRUCT<{LINE}>>"),
        body("change", CHANGE),
    )


def position() -> Column:
    """Where an event stands: order is kept per partition, and a key stays on one partition."""
    return F.struct("partition", "offset")


def encode(
    df: DataFrame, message: Column, details: Column, stamp: Column, component: str = "Order",
    host: str = "local", app: str = "sluicework",
) -> DataFrame:
    """Rows with ``value`` = the envelope as JSON; ``details`` is JSON text and goes in unquoted."""
    # The body is spliced in as JSON: as a struct field it would be quoted into a string
    head = F.to_json(
        F.struct(
            stamp.cast("string").alias("Timestamp"), F.lit(host).alias("Hostname"),
            F.lit(app).alias("Appname"), F.lit(component).alias("Component"),
            F.lit("INFO").alias("Level"), message.alias("Message"),
        )
    )
    rest = F.substring(head, 2, 2**31 - 1)
    body = F.coalesce(details, F.lit("null"))
    return df.withColumn("value", F.concat(F.lit('{"Details":'), body, F.lit(","), rest))

"""Nested documents out of flat rows, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.operators.matching import join_per_key


def nest(df: DataFrame, shape: Mapping[str, str | Mapping]) -> DataFrame:
    """Columns as documents: ``{"_id": "Id", "Name": {"First": "first"}}``."""
    def build(part: str | Mapping, name: str) -> Column:
        if isinstance(part, str):
            return F.col(part).alias(name)
        return F.struct(*[build(p, n) for n, p in part.items()]).alias(name)

    return df.select(*[build(part, name) for name, part in shape.items()])


def paged_lists(
    entries: DataFrame, key: str, columns: Sequence[str], page_size: int,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Per key its entries as sorted lists: (key, page, pages, entries).

    A key with up to ``page_size`` entries has one list, page 0. A larger key is spread by hash over
    as many pages as it needs, each its own row and its own group, so no task ever holds the
    whole key. Every entry is on exactly one page. Entries should be distinct within a key (see
    ``quantities``): copies share a page. ``counted`` may give the same keys with at least as many
    rows from a cheaper plan.
    """
    large = (
        (entries if counted is None else counted)
        .groupBy(key)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > page_size)
        .select(key, F.ceil(F.col("_n") / page_size).alias("_pages"))
    )
    page = F.when(
        F.col("_pages").isNotNull(), F.pmod(F.xxhash64(*columns), F.col("_pages"))
    ).otherwise(F.lit(0))
    # Spread by key and page before collecting: the join may leave the rows partitioned by key alone
    placed = (
        join_per_key(entries, large, [key], null_safe=True)
        .select(key, page.cast("int").alias("page"), F.coalesce("_pages", F.lit(1)).cast("int").alias("pages"), F.struct(*columns).alias("_entry"))
        .repartition(key, "page")
    )
    return placed.groupBy(key, "page").agg(
        F.max("pages").alias("pages"), F.sort_array(F.collect_list("_entry")).alias("entries")
    )


def order_documents(
    orders: DataFrame, customers: DataFrame, lines: DataFrame, items: DataFrame,
    page_size: int,
) -> DataFrame:
    """One document per order and page: customer struct, photo array, price.

    An order with more than ``page_size`` photos has ``Pages`` documents, numbered by ``Page``; each
    of them carries the price of the whole order.

    Inputs: orders (order_id, created_at, customer_id), customers (customer_id, …), lines (order_id,
    photo_id, quantity) with one row per order and photo, items (photo_id, price as decimal, …).
    ``Price`` sums quantity times price over all lines of the order.
    """
    customer = F.struct(*[F.col(c) for c in customers.columns]).alias("Customer")
    photo = items.select(F.col("photo_id"), F.struct(*items.columns).alias("photo"))
    price_type = T.DecimalType(28, 2)
    price = (F.col("quantity").cast("decimal(18,0)") * F.col("photo.price")).cast(price_type)
    priced = lines.join(photo, "photo_id").select(
        "order_id", "photo_id", "quantity", price.alias("price"), "photo"
    )
    pages = paged_lists(
        priced, "order_id", ["photo_id", "quantity", "price", "photo"], page_size, lines
    )
    headers = orders.join(customers, "customer_id").select("order_id", "created_at", customer)
    kind = pages.schema["entries"].dataType
    photos = F.coalesce(F.col("entries"), F.array().cast(kind))
    total = priced.groupBy("order_id").agg(F.sum("price").cast(price_type).alias("total"))
    return headers.join(total, "order_id", "left").join(pages, "order_id", "left").select(
        F.col("order_id").alias("OrderId"),
        F.coalesce("page", F.lit(0)).alias("Page"),
        F.coalesce("pages", F.lit(1)).alias("Pages"),
        F.col("created_at").alias("CreatedAt"),
        "Customer",
        F.transform(
            photos, lambda e: F.struct(e["quantity"].alias("Quantity"), e["photo"].alias("Photo"))
        ).alias("Photos"),
        F.coalesce("total", F.lit(0)).cast(price_type).alias("Price"),
    )


def explode_list(df: DataFrame, body: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """The rows of a list-valued JSON body."""
    rows = F.from_json(F.col(body), f"ARRAY<{schema}>", {"mode": "FAILFAST"})
    return df.select(*keep, F.inline(rows))

"""Joins of facts and dimensions.

No side is broadcast by hint: Catalyst and AQE broadcast on measured size and
split hot keys of larger joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import with_group


def _match(left, right, pairs, null_safe):
    def one(a, b):
        l, r = left[a], right[b]
        return l.eqNullSafe(r) if null_safe else l == r

    return reduce(lambda x, y: x & y, [one(a, b) for a, b in pairs])


def order_heads(orders, customers) -> DataFrame:
    """Orders with their customer."""
    return orders.join(customers, "customer_id", "left")


def item_lines(items, products, sellers) -> DataFrame:
    """Items with product and seller."""
    return items.join(products, "product_id", "left").join(sellers, "seller_id", "left")


def order_items(orders, items, customers, products, sellers, reviews=None) -> DataFrame:
    """Item-grain table; orders without items survive, reviews are joined as they are."""
    out = (
        orders.join(items, "order_id", "left")
        .join(customers, "customer_id", "left")
        .join(products, "product_id", "left")
        .join(sellers, "seller_id", "left")
    )
    return out.join(reviews, "order_id", "left") if reviews is not None else out


def left_suffix(left, right, on, suffixes=("_x", "_y"), null_safe=False) -> DataFrame:
    """Left join on equally named keys; other shared names get a suffix on each side."""
    shared = [c for c in left.columns if c in right.columns and c not in on]
    l = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    r = right.withColumnsRenamed(
        {**{c: c + suffixes[1] for c in shared}, **{k: f"_r_{k}" for k in on}}
    )
    joined = l.join(r, _match(l, r, [(k, f"_r_{k}") for k in on], null_safe), "left")
    return joined.drop(*[f"_r_{k}" for k in on])


def left_on(left, right, left_key, right_key, null_safe=False) -> DataFrame:
    """Left join on keys with different names; both key columns stay."""
    return left.join(right, _match(left, right, [(left_key, right_key)], null_safe), "left")


def equi_join(left, right, on, how="inner", null_safe=False) -> DataFrame:
    """Join on equal names; ``null_safe`` lets null keys meet each other."""
    if not null_safe:
        return left.join(right, list(on), how)
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    return left.join(r, _match(left, r, [(k, f"_r_{k}") for k in on], True), how).drop(
        *[f"_r_{k}" for k in on]
    )


def semi(df, keys_df, left_key, right_key=None) -> DataFrame:
    right_key = right_key or left_key
    keys = keys_df.select(F.col(right_key).alias("_semi"))
    return df.join(keys, df[left_key] == keys["_semi"], "left_semi")


def key_mismatch(left, right, left_key, right_key=None) -> DataFrame:
    """Distinct keys found on one side only, tagged ``left_only`` or ``right_only``."""
    right_key = right_key or left_key
    l = left.select(F.col(left_key).alias("key")).distinct()
    r = right.select(F.col(right_key).alias("key")).distinct()
    return l.join(r, "key", "left_anti").withColumn("side", F.lit("left_only")).unionByName(
        r.join(l, "key", "left_anti").withColumn("side", F.lit("right_only"))
    )


def agg_back(df, by, aggregates) -> DataFrame:
    """Group aggregates beside every row of their group."""
    return with_group(df, by, aggregates)


def merge_month(calendar, listings, neighbourhoods) -> DataFrame:
    """Calendar rows of known listings with listing and neighbourhood columns."""
    places = neighbourhoods.select(
        F.col("neighbourhood").alias("neighbourhood_cleansed"), "neighbourhood_group"
    )
    slim = (
        listings.drop(
            "description", "neighborhood_overview", "host_about",
            "picture_url", "host_thumbnail_url", "host_picture_url", "data_month",
        )
        .withColumn("neighbourhood_cleansed", F.lower(F.trim("neighbourhood_cleansed")))
        .withColumnRenamed("price", "listing_price")
        .filter(F.col("listing_price").isNotNull())
        .join(places, "neighbourhood_cleansed", "left")
    )
    # Inner join: rows without a listing or a listing price leave the result anyway.
    return calendar.withColumnRenamed("price", "calendar_price").join(
        slim, F.col("listing_id") == F.col("id")
    )

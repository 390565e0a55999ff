"""Customer tables: conversions by week with running revenue, order summaries, tenure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from .ordered import with_group

AMOUNT = "decimal(10,2)"

CUSTOMER_INFO = T.StructType(
    [
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("conversion_id", T.IntegerType()),
        T.StructField("conversion_number", T.IntegerType()),
        T.StructField("conversion_type", T.StringType()),
        T.StructField("conversion_date", T.DateType()),
        T.StructField("conversion_week", T.StringType()),
        T.StructField("next_conversion_week", T.StringType()),
        T.StructField("conversion_channel", T.StringType()),
        T.StructField("first_order_week", T.StringType()),
        T.StructField("first_order_total_paid", T.DecimalType(10, 2)),
        T.StructField("week_counter", T.IntegerType()),
        T.StructField("order_week", T.StringType()),
        T.StructField("orders_placed", T.IntegerType()),
        T.StructField("total_before_discounts", T.DecimalType(10, 2)),
        T.StructField("total_discounts", T.DecimalType(10, 2)),
        T.StructField("total_paid_in_week", T.DecimalType(10, 2)),
        T.StructField("conversion_cumulative_revenue", T.DecimalType(10, 2)),
        T.StructField("lifetime_cumulative_revenue", T.DecimalType(10, 2)),
    ]
)


def order_with_product(orders, customers, products, dates_dim) -> DataFrame:
    """Order lines with customer, product and week, and the price before discount."""
    return (
        orders.join(products, orders.fk_product == products.sk_product, "left")
        .join(dates_dim, orders.fk_order_date == dates_dim.sk_date, "left")
        .join(
            customers.select("sk_customer", "customer_id"),
            orders.fk_customer == F.col("sk_customer"),
            "left",
        )
        .withColumn("price_before_discount", F.col("discount_value") + F.col("price_paid"))
    )


def _orders_by_week(orders, customers, weeks):
    return (
        orders.join(weeks, orders.fk_order_date == weeks.sk_date, "left")
        .join(
            customers.select("sk_customer", "customer_id"),
            orders.fk_customer == F.col("sk_customer"),
            "left",
        )
        .withColumn("price_before_discount", F.col("discount_value") + F.col("price_paid"))
    )


def grouped_orders(lines) -> DataFrame:
    """Orders and sums per customer and week."""
    return lines.groupBy("customer_id", "running_week").agg(
        F.count_distinct("order_number").alias("order_placed"),
        F.sum("price_before_discount").alias("total_before_discounts"),
        F.sum("discount_value").alias("total_discounts"),
        F.sum("price_paid").alias("total_paid"),
    )


def numbered_conversions(conversions, customers, weeks) -> DataFrame:
    """Conversions with their number (by id) and the next one's week (by date)."""
    placed = conversions.join(
        customers, conversions.fk_customer == customers.sk_customer
    ).join(weeks, conversions.fk_conversion_date == weeks.sk_date, "left")
    by_id = Window.partitionBy("customer_id").orderBy("conversion_id")
    by_date = Window.partitionBy("customer_id").orderBy("conversion_date", "conversion_id")
    return placed.select(
        "customer_id",
        "first_name",
        "last_name",
        "conversion_id",
        F.rank().over(by_id).alias("conversion_number"),
        "conversion_type",
        "conversion_date",
        F.col("year_week").alias("conversion_week"),
        "running_week",
        "conversion_channel",
        F.lead("year_week").over(by_date).alias("next_conversion_week"),
        F.lead("running_week").over(by_date).alias("next_run_week"),
        "order_number",
    )


def week_spine(conversions, last_week) -> DataFrame:
    """One row per conversion and week, from its own to the week before the next one.

    Linear in the output: the weeks are generated per row instead of being
    joined by ``>=``.
    """
    end = F.coalesce(F.col("next_run_week") - 1, last_week)
    weeks = F.when(end >= F.col("running_week"), F.sequence("running_week", end))
    return (
        conversions.select("*", F.posexplode(weeks).alias("_pos", "week"))
        .withColumn("week_counter", F.col("_pos") + 1)
        .drop("_pos")
    )


def customer_info(orders, conversions, customers, dates_dim, amounts=None) -> DataFrame:
    """Dense customer x conversion x week table, twenty columns.

    Running sums only move in weeks with orders, so they are taken over the
    weeks in which something happens (an order or a conversion).  Each such week
    is then stretched to the week before the next one; the dense rows appear in
    that last, narrow step and are never shuffled.  A customer has at most one
    row per week in every window.  ``amounts`` names the type of the sums, which
    are exact decimals without it; they are cast before the weeks are stretched.
    ``orders`` is read twice.
    """
    weeks = dates_dim.select("sk_date", "running_week", "year_week")
    labels = dates_dim.select(F.col("running_week").alias("week"), F.col("year_week").alias("order_week")).distinct()
    lines = _orders_by_week(orders, customers, weeks)
    first = lines.groupBy("order_number").agg(
        F.max("year_week").alias("first_order_week"),
        F.sum("price_paid").alias("first_order_total_paid"),
    )
    numbered = numbered_conversions(conversions, customers, weeks).join(first, "order_number", "left")
    last_week = dates_dim.agg(F.max("running_week")).scalar()
    end = F.coalesce(F.col("next_run_week") - 1, last_week)
    details = [c for c in CUSTOMER_INFO.names if c in numbered.columns and c != "customer_id"]
    # A conversion followed by another one in the same week has no week of its own.
    starts = numbered.withColumn("end_week", end).filter(F.col("end_week") >= F.col("running_week")).select(
        "customer_id",
        F.col("running_week").alias("week"),
        F.struct(*details, F.col("running_week").alias("start_week"), "end_week").alias("conversion"),
    )
    # count > 0 is what the distinct count is compared with, and needs no second pass
    weekly = lines.filter(F.col("customer_id").isNotNull()).groupBy("customer_id", F.col("running_week").alias("week")).agg(
        (F.count("order_number") > 0).cast("int").alias("placed"),
        F.sum("price_before_discount").alias("before"),
        F.sum("discount_value").alias("discounts"),
        F.sum("price_paid").alias("paid"),
    )
    # Both sides have one row per customer and week, so the rows of a week meet in neighbours.
    # A given number of parts: small rows must not be put together, as their weeks are many.
    parts = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same_week = Window.partitionBy("customer_id", "week")
    in_life = Window.partitionBy("customer_id").orderBy("week")
    moved = (
        starts.unionByName(weekly, allowMissingColumns=True)
        .repartition(parts, "customer_id")
        .withColumns(
            {
                **{c: F.max(c).over(same_week) for c in ("placed", "before", "discounts", "paid")},
                "_both": F.count(F.lit(1)).over(same_week),
            }
        )
        # Where a conversion and orders share a week, the conversion's row holds both.
        .filter((F.col("_both") == 1) | F.col("conversion").isNotNull())
        .withColumn("conversion", F.last("conversion", ignorenulls=True).over(in_life))
        .filter(F.col("conversion").isNotNull())
    )
    in_conversion = Window.partitionBy("customer_id", "conversion.conversion_id").orderBy("week")
    zero = F.lit(0).cast(AMOUNT)
    spans = moved.withColumns(
        {
            "until": F.coalesce(F.lead("week").over(in_life) - 1, F.col("conversion.end_week")),
            "lifetime_cumulative_revenue": F.coalesce(F.sum("paid").over(in_life), zero),
            "conversion_cumulative_revenue": F.coalesce(F.sum("paid").over(in_conversion), zero),
        }
    )
    typed = lambda c: c.cast(amounts) if amounts else c
    flat = spans.select(
        "customer_id",
        *[F.col(f"conversion.{c}") for c in details if c != "first_order_total_paid"],
        typed(F.col("conversion.first_order_total_paid")).alias("first_order_total_paid"),
        "conversion.start_week",
        "week",
        "until",
        F.coalesce("placed", F.lit(0)).alias("placed"),
        *[typed(F.coalesce(c, zero)).alias(c) for c in ("before", "discounts", "paid")],
        *[typed(F.col(c)).alias(c) for c in ("conversion_cumulative_revenue", "lifetime_cumulative_revenue")],
    )
    dense = flat.select("*", F.posexplode(F.sequence("week", "until")).alias("_pos", "_week")).drop("week")
    happened = F.col("_pos") == 0
    only = lambda c, other: F.when(happened, F.col(c)).otherwise(other)
    nothing = typed(zero)
    filled = dense.select(
        "*",
        F.col("_week").alias("week"),
        (F.col("_week") - F.col("start_week") + 1).alias("week_counter"),
        only("placed", F.lit(0)).alias("orders_placed"),
        only("before", nothing).alias("total_before_discounts"),
        only("discounts", nothing).alias("total_discounts"),
        only("paid", nothing).alias("total_paid_in_week"),
    )
    return filled.join(labels, "week", "left").select(*CUSTOMER_INFO.names)


def write_customer_info(df, table, mode="append"):
    """Cast to the target types and append to the table."""
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CUSTOMER_INFO])
    typed.write.mode(mode).saveAsTable(table)


def delivered(items) -> DataFrame:
    """Days from purchase to delivery."""
    return items.withColumn(
        "order_deliver_days", dates.floor_days(F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp"))
    )


def customer_tenure(purchases) -> DataFrame:
    """First purchase per customer and days since then; ``purchases`` has a row per order or per item."""
    first = F.min("order_purchase_timestamp").alias("first_order_ts")
    days = dates.floor_days(F.col("order_purchase_timestamp"), F.col("first_order_ts"))
    return with_group(purchases, ["customer_unique_id"], [first]).withColumn("customer_tenure_days", days)


def tenure(items) -> DataFrame:
    """First purchase per customer, days since then, and days to delivery."""
    return delivered(customer_tenure(items))


def order_summary(items) -> DataFrame:
    """Ten measures per order; rows are counted, so an order without items counts one.

    ``items`` is the output of :func:`tenure`.  Rows with a null key are left out.
    """
    keys = ["order_id", "customer_unique_id"]
    return (
        items.na.drop(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.max("order_value").alias("order_value"),
            F.avg("price").alias("avg_price_per_item"),
            # beside the modes a distinct count would make each group pass through four aggregates
            F.size(F.collect_set("seller_id")).cast("long").alias("seller_count"),
            F.mode("product_category_name", True).alias("product_category"),
            F.mode("seller_state", True).alias("seller_state"),
            F.mode("customer_state", True).alias("customer_state"),
            F.max("customer_tenure_days").alias("customer_tenure_days"),
            F.avg("order_deliver_days").alias("order_deliver_days"),
            F.avg("review_score").alias("review_score"),
        )
    )

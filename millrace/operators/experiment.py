"""Experiment design: splits, balance, counterfactual outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import aggregates, ranking, sampling


def stratified_split(df, key, stratum, fraction=0.5, seed=42, order=None, missing="MISSING") -> DataFrame:
    """One row per key with ``group``: floor(fraction * n) of each stratum is the test group."""
    strata = df.select(key, F.coalesce(F.col(stratum), F.lit(missing)).alias(stratum), *(order or []))
    units = ranking.keep_first(strata, [key], order or [stratum]).select(key, stratum)
    marked = sampling.split(units, key, fraction, seed, [stratum])
    return marked.withColumn("group", F.when(F.col("is_first"), "test").otherwise("control")).drop("is_first")


def assign(df, key, p=0.5, seed=42) -> DataFrame:
    """Independent assignment of the distinct keys."""
    units = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return units.withColumn("group", F.when(sampling.unit_number(key, seed) < p, "test").otherwise("control"))


def with_groups(df, groups, key) -> DataFrame:
    return df.join(groups.select(key, "group"), key)


def balance(summary, large=100) -> DataFrame:
    return summary.groupBy("group").agg(
        aggregates.mean(summary, "order_value").alias("avg_order_value"),
        F.avg("customer_tenure_days").alias("avg_tenure_days"),
        F.avg("n_items").alias("avg_items_per_ord"),
        aggregates.share_above("order_value", large).alias("pct_large_orders"),
    )


def counterfactual(df, actual="seller_id", listed="topk") -> DataFrame:
    """Rows whose simulated seller is the actual one: control keeps it, test takes the first listed."""
    simulated = F.when(F.col("group") == "control", F.col(actual)).otherwise(F.get(listed, F.lit(0)))
    return df.withColumn("simulated_seller", simulated).filter(F.col("simulated_seller") == F.col(actual))

"""Dashboard tables; every one takes the same filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import aggregates

FACTORS = ("aggressive", "alcohol", "red_light", "speeding")

# Fixed value: night runs from 18 to 24; the other borders are a choice of the report.
PERIODS = {"late_night": (0, 5), "morning": (5, 9), "midday": (9, 14), "afternoon": (14, 18), "night": (18, 24)}


def period(ts="ts", periods=None):
    hour = F.hour(ts)
    out = None
    for name, (low, high) in (periods or PERIODS).items():
        test = (hour >= low) & (hour < high)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out


def apply_filters(df, years=None, wanted_periods=None, flags=None, ts="ts", periods=None) -> DataFrame:
    """Cross-filter: year range, time-of-day periods and factor switches (name -> bool)."""
    if years:
        df = df.filter(F.year(ts).between(*years))
    if wanted_periods:
        df = df.filter(period(ts, periods).isin(list(wanted_periods)))
    for name, value in (flags or {}).items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def kpis(df, factors=FACTORS) -> DataFrame:
    """Distinct events and the share of rows with each factor."""
    shares = [
        F.try_divide(F.count_if(F.col(f)).cast("double"), F.count(F.lit(1)).cast("double")).alias(f"share_{f}")
        for f in factors
    ]
    return df.agg(F.count_distinct("event_id").alias("events"), *shares)


def time_mix(df, ts="ts", periods=None) -> DataFrame:
    mix = df.select(period(ts, periods).alias("period"), F.lit("all").alias("total"))
    return aggregates.share(mix, "total", "period").drop("total")


def hotspots(df, n=20) -> DataFrame:
    """Intersections with most events, with their mean place."""
    return (
        df.groupBy("intersection")
        .agg(
            F.count_distinct("event_id").alias("events"),
            F.avg("lat").alias("lat"),
            F.avg("lon").alias("lon"),
        )
        .orderBy(F.desc("events"), "intersection")
        .limit(n)
    )

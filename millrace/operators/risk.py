"""Portfolio limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordered


def sector_exposure(positions, portfolio_value, cap=0.30) -> DataFrame:
    """Market value and share per sector, flagged above the cap."""
    pct = F.try_divide(F.sum("market_value").cast("double"), F.lit(float(portfolio_value)))
    return (
        positions.groupBy("sector")
        .agg(F.sum("market_value").alias("market_value"), pct.alias("pct"))
        .withColumn("over_cap", F.col("pct") > cap)
    )


def daily_cap(trades, per_day=2, ts="ts", tiebreak="event_id") -> DataFrame:
    """First ``per_day`` trades of each day; surplus rows are cut before the shuffle."""
    w = Window.partitionBy("day").orderBy(ts, tiebreak)
    return (
        trades.withColumn("day", F.to_date(ts))
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= per_day)
        .drop("_rn")
    )


def sector_cap(candidates, portfolio_value, cap=0.30, rank="rank", tiebreak="ticker") -> DataFrame:
    """Candidates whose sector, summed in rank order, stays within the cap; ties go by ``tiebreak``."""
    summed = ordered.running(candidates, ["sector"], [rank, tiebreak], {"sector_value": F.col("value")}, ordered.number_block(rank))
    return summed.filter(F.col("sector_value") / F.lit(float(portfolio_value)) <= cap)


def open_slots(candidates, positions, max_positions=10, rank="rank") -> DataFrame:
    """Best-ranked candidates not held, as many as there are free slots."""
    free = F.lit(max_positions) - positions.agg(F.count(F.lit(1))).scalar()
    fresh = candidates.join(positions.select("ticker"), "ticker", "left_anti")
    best = fresh.orderBy(rank, "ticker").limit(max_positions)
    order = Window.partitionBy(F.lit(1)).orderBy(rank, "ticker")
    return best.withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= free)

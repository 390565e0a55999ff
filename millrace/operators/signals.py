"""Daily signals per ticker and the gates before an entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import screens, timeseries as ts

# Default limits of the entry gates.
GATES = {
    "tech_floor": 0.3,
    "rsi_min": 35,
    "rsi_max": None,
    "min_headlines": 5,
    "sentiment_floor": 6.0,
    "consensus": 0.70,
}


def tech_score(bars, fast=50, slow=200) -> DataFrame:
    """Trend score and the above-mean flag for days on which both means exist."""
    both = ts.rolling_means(bars, "close", {"ma50": fast, "ma200": slow})
    gap = (F.col("close") - F.col("ma50")) / F.col("ma50")
    trend = (F.col("ma50") - F.col("ma200")) / F.col("ma200")
    return both.filter(F.col("ma200").isNotNull()).withColumns(
        {
            "tech_score": gap + trend,
            "tech_norm": screens.tech_norm(gap + trend),
            "above_ma50": F.col("close") >= F.col("ma50"),
        }
    )


def entry_gates(days, sentiment=None, gates=None) -> DataFrame:
    """First failing gate per ticker and day, in order; ``passes`` where there is none.

    ``days`` holds ``tech_norm``, ``above_ma50`` and ``rsi`` (null skips that
    gate), ``sentiment`` the daily roll-up; without it ``days`` holds its columns
    too.  A day without a roll-up fails.
    """
    g = {**GATES, **(gates or {})}
    joined = days
    if sentiment is not None:
        mood = sentiment.select("ticker", "date", "score", "consensus_pct", "headline_count", "momentum")
        joined = days.join(mood, ["ticker", "date"], "left")
    reason = (
        F.when(~F.coalesce("above_ma50", F.lit(False)), "below_ma50")
        .when(F.coalesce("tech_norm", F.lit(0.0)) < g["tech_floor"], "tech_floor")
        .when(F.col("rsi") < g["rsi_min"], "rsi_floor")
    )
    if g["rsi_max"] is not None:
        reason = reason.when(F.col("rsi") > g["rsi_max"], "rsi_ceiling")
    reason = (
        reason.when(F.col("score").isNull(), "no_sentiment")
        .when(F.col("headline_count") < g["min_headlines"], "headlines")
        .when(F.col("score") < g["sentiment_floor"], "sentiment_floor")
        .when(F.col("consensus_pct") < g["consensus"], "consensus")
        .when(F.coalesce("momentum", F.lit(0)) < 0, "momentum")
    )
    return joined.withColumn("reason", reason).withColumn("passes", F.col("reason").isNull())


def next_candidate(gated, rank="rank") -> DataFrame:
    """Best-ranked passing ticker per day, as an aggregate."""
    return (
        gated.filter("passes")
        .groupBy("date")
        .agg(F.min_by(F.struct("ticker", "score"), F.struct(rank, "ticker")).alias("best"))
        .select("date", "best.*")
    )


def exit_alerts(positions, bars, sentiment, window=50, sell_floor=4.0) -> DataFrame:
    """Open positions to close: price below its mean, else sentiment below the floor."""
    newest = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))
    recent = bars.withColumn("_rn", newest).filter(F.col("_rn") <= window)
    means = recent.groupBy("ticker").agg(F.avg("close").alias("_ma"), F.count(F.lit(1)).alias("_n"))
    mood = sentiment.groupBy("ticker").agg(F.max_by("score", "date").alias("score"))
    known = positions.join(means, "ticker", "left").join(mood, "ticker", "left")
    alert = F.when(
        (F.col("_n") >= window) & (F.col("current_price") < F.col("_ma")), "TREND_FAIL"
    ).when(F.col("score") < sell_floor, "SENTIMENT_SELL")
    return known.withColumn("alert", alert).filter(F.col("alert").isNotNull()).drop("_ma", "_n")

"""Screens of a universe by return, trend, liquidity and risk."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as x
from . import timeseries as ts


def universe(df) -> DataFrame:
    """Ticker dimension; dots in symbols become dashes."""
    return df.withColumn("symbol", F.replace("symbol", F.lit("."), F.lit("-")))


def positive_return(bars, min_return=0.05, years=5) -> DataFrame:
    """Tickers whose annual return over ``years`` is positive and at least ``min_return``."""
    span = bars.filter(F.col("close").isNotNull()).groupBy("ticker").agg(
        F.min_by("close", "date").alias("first"), F.max_by("close", "date").alias("last"), F.count(F.lit(1)).alias("n")
    )
    total = (F.col("last") - F.col("first")) / F.col("first")
    return (
        span.filter((F.col("n") >= 2) & (F.col("first") > 0))
        .withColumn("total_return", total)
        .withColumn("ann_return", x.annualised(F.col("total_return"), years))
        .filter((F.col("ann_return") >= min_return) & (F.col("total_return") > 0))
        .select("ticker", "total_return", "ann_return")
        .orderBy(F.desc("ann_return"), "ticker")
    )


def _newest_first(bars):
    return bars.withColumn("_rn", F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date"))))


def _last(c, n):
    """Mean of the newest ``n`` rows, for rows numbered from the newest."""
    return F.avg(F.when(F.col("_rn") <= n, F.col(c)))


def technical(bars, min_avg_volume=1_000_000, min_rows=200) -> DataFrame:
    """Last price above the 50-row mean above the 200-row mean, with enough volume."""
    last = (
        _newest_first(bars)
        .groupBy("ticker")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max_by("close", "date").alias("price"),
            _last("close", 50).alias("ma50"),
            _last("close", 200).alias("ma200"),
            _last("volume", 20).alias("avg_volume"),
        )
    )
    return (
        last.filter(F.col("n") >= min_rows)
        .filter((F.col("price") > F.col("ma50")) & (F.col("ma50") > F.col("ma200")))
        .filter(F.col("avg_volume") > min_avg_volume)
        .select(
            "ticker", "price", "ma50", "ma200",
            F.floor("avg_volume").alias("avg_volume"),
            (F.col("price") / F.col("ma50")).alias("trend_strength"),
        )
        .orderBy(F.desc("trend_strength"), "ticker")
    )


def quality(bars, inflation=0.035, excess=0.05, risk_free=0.04, min_months=60, min_returns=24) -> DataFrame:
    """Annual return above inflation plus excess, and a positive Sharpe ratio, from month-end closes."""
    months = bars.groupBy("ticker", F.trunc("date", "month").alias("month")).agg(
        F.max_by("close", "date").alias("close")
    )
    moved = months.withColumn("_r", ts.pct_change("close", order="month"))
    stats = moved.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_r").alias("n_returns"),
        F.min_by("close", "month").alias("first"),
        F.max_by("close", "month").alias("last"),
        (F.stddev_samp("_r") * F.sqrt(F.lit(12.0))).alias("ann_vol"),
    )
    total = (F.col("last") - F.col("first")) / F.col("first")
    sharpe = F.when(F.col("ann_vol") > 0, (F.col("ann_return") - risk_free) / F.col("ann_vol")).otherwise(0.0)
    return (
        stats.filter((F.col("n") >= min_months) & (F.col("first") > 0) & (F.col("n_returns") >= min_returns))
        .withColumn("ann_return", x.annualised(total, F.col("n") / 12.0))
        .withColumn("sharpe", sharpe)
        .filter((F.col("ann_return") >= inflation + excess) & (F.col("sharpe") > 0))
        .select("ticker", "ann_return", "sharpe")
        .orderBy(F.desc("ann_return"), "ticker")
    )


def risk_measures(bars, min_rows=200) -> DataFrame:
    """Per ticker with enough rows: last price, means, volume, downside deviation, drawdown, trend."""
    rows = _newest_first(bars).withColumn("_r", ts.pct_change("close"))
    year = F.when(F.col("_rn") <= 252, F.col("close"))
    peak = F.max(year).over(ts.by_time().rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_dd", (year - peak) / peak)
    negative = F.when((F.col("_rn") <= 90) & (F.col("_r") < 0), F.col("_r"))
    last = rows.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("close", "date").alias("price"),
        _last("volume", 20).alias("avg_volume"),
        _last("close", 50).alias("ma50"),
        _last("close", 200).alias("ma200"),
        (F.coalesce(F.stddev_samp(negative), F.lit(0.0)) * F.sqrt(F.lit(252.0))).alias("volatility"),
        F.min("_dd").alias("max_drawdown"),
    )
    return last.filter(F.col("n") >= min_rows).withColumn(
        "tech_score",
        (F.col("price") - F.col("ma50")) / F.col("ma50") + (F.col("ma50") - F.col("ma200")) / F.col("ma200"),
    )


def tech_norm(score):
    return F.least(F.greatest(score, F.lit(0.0)) / 0.15, F.lit(1.0))


def reject_reason(min_volume, min_price, max_volatility, max_drawdown):
    """First failing criterion in order; null for a pass."""
    return (
        F.when(F.col("avg_volume") < min_volume, "low_volume")
        .when(F.col("price") < min_price, "low_price")
        .when(F.col("volatility") >= max_volatility, "high_volatility")
        .when(F.col("max_drawdown") <= max_drawdown, "deep_drawdown")
    )


def liquidity_risk_trend(
    bars, quality_rows=None, min_volume=1_000_000, min_price=5.0, max_volatility=0.50, max_drawdown=-0.60, min_rows=200
) -> DataFrame:
    """All measured tickers with their scores and ``reason`` (null where they pass)."""
    if quality_rows is not None:
        bars = bars.join(quality_rows.select("ticker"), "ticker", "left_semi")
    m = risk_measures(bars, min_rows).withColumn(
        "reason", reject_reason(min_volume, min_price, max_volatility, max_drawdown)
    )
    vol_score = F.greatest(F.lit(0.0), 1.0 - F.col("volatility") / max_volatility)
    dd_score = F.greatest(F.lit(0.0), 1.0 + F.col("max_drawdown") / abs(max_drawdown))
    m = m.withColumn("risk_score", (vol_score + dd_score) / 2).withColumn(
        "rank_score", 0.5 * tech_norm(F.col("tech_score")) + 0.5 * F.col("risk_score")
    )
    return m.join(quality_rows, "ticker") if quality_rows is not None else m


def funnel(measured) -> DataFrame:
    return measured.groupBy(F.coalesce("reason", F.lit("pass")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def ranked_candidates(bars, universe_df, tickers=None, inflation=0.035, excess=0.05, risk_free=0.04, **limits) -> DataFrame:
    """Quality screen, then liquidity and risk, ranked by score, with the sector."""
    if tickers is not None:
        bars = bars.filter(F.col("ticker").isin(list(tickers)))
    else:
        bars = bars.join(universe_df.select("ticker"), "ticker", "left_semi")
    good = quality(bars, inflation, excess, risk_free)
    passed = liquidity_risk_trend(bars, good, **limits).filter(F.col("reason").isNull()).drop("reason", "n")
    named = passed.join(universe_df.select("ticker", "sector"), "ticker", "left")
    if tickers is not None:
        named = named.withColumn("sector", F.lit("Override"))
    return named.orderBy(F.desc("rank_score"), "ticker")


def event_risk(candidates, earnings, days=2) -> DataFrame:
    """Candidates without an event 0 to ``days`` days ahead.

    Each event is spread over the few days it blocks, so this is an equality
    anti join.
    """
    blocked = earnings.select(
        "ticker",
        F.explode(F.sequence(F.date_sub("event_date", days), "event_date", F.expr("interval 1 day"))).alias("date"),
    )
    return candidates.join(blocked, ["ticker", "date"], "left_anti")


def regime(bench, n=50, bear_slots=2, bull_slots=10) -> DataFrame:
    """Benchmark days with their slots: few below the moving mean, all above it or before it exists."""
    means = ts.rolling_means(bench.withColumn("_k", F.lit(1)), "close", {"ma": n}, "_k")
    marked = means.withColumn("bear", F.coalesce(F.col("close") < F.col("ma"), F.lit(False)))
    return marked.withColumn("slots", F.when(F.col("bear"), bear_slots).otherwise(bull_slots)).drop("_k")

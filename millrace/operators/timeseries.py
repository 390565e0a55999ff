"""Series of daily bars: ``(ticker, date, open, high, low, close, volume)``, one row per ticker and day.

Windows here run per ticker over its days, so a group is bounded by the
calendar however many tickers there are.  Finer or unbounded orders go through
:mod:`millrace.operators.ordered`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BAR_TYPES = {"open": "double", "high": "double", "low": "double", "close": "double", "volume": "double"}


def by_time(key="ticker", order="date"):
    return Window.partitionBy(key).orderBy(order)


def to_long(wide, id_cols, columns, name="ticker", value="value", min_rows=1) -> DataFrame:
    """Wide panel to long rows; incomplete rows leave, then series of fewer than ``min_rows`` rows."""
    columns = list(dict.fromkeys(columns))
    long = wide.unpivot(list(id_cols), columns, name, value).na.drop(subset=[value])
    if min_rows <= 1:
        return long
    long_enough = long.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
    return long.join(long_enough.select(name), name, "left_semi")


def as_of(df, date_col, day, lookback_days, warmup_days=0) -> DataFrame:
    """Rows of the ``lookback_days`` (plus warm-up) before ``day``; the filter reaches the scan."""
    day = F.lit(day).cast("date")
    first = F.date_sub(day, lookback_days + warmup_days)
    return df.filter((F.col(date_col) >= first) & (F.col(date_col) < day))


def rolling_means(df, c, sizes, key="ticker", order="date", step=10) -> DataFrame:
    """Means of the last n rows (``sizes``: name -> n), null until there are n values.

    Sums of ``step`` rows are taken once; a longer sum adds such sums by lag.  A
    row then costs about n / step additions in place of n, and nothing is ever
    subtracted, so no digits are lost.
    """
    w = by_time(key, order)
    short = w.rowsBetween(-(step - 1), 0)
    out = df.withColumns(
        {"_s": F.sum(c).over(short), "_n": F.count(c).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_r": F.row_number().over(w)}
    )
    means = {}
    for name, n in sizes.items():
        known = F.col("_n") - F.coalesce(F.lag("_n", n).over(w), F.lit(0))
        if n % step == 0:
            total = F.col("_s")
            for k in range(step, n, step):
                total = total + F.lag("_s", k).over(w)
        else:
            total = F.sum(c).over(w.rowsBetween(-(n - 1), 0))
        means[name] = F.when((F.col("_r") >= n) & (known == n), total / n)
    return out.withColumns(means).drop("_s", "_n", "_r")


def centered_mean(c, n=5, key="ticker", order="date") -> Column:
    half = n // 2
    return F.avg(c).over(by_time(key, order).rowsBetween(-half, half))


def tail_mean(df, c, n, key="ticker", order="date", name="tail_mean") -> DataFrame:
    """Mean of the newest ``n`` rows per key."""
    newest = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return df.withColumn("_rn", newest).filter(F.col("_rn") <= n).groupBy(key).agg(F.avg(c).alias(name))


def diff(c, key="ticker", order="date") -> Column:
    return F.col(c) - F.lag(c).over(by_time(key, order))


def pct_change(c, key="ticker", order="date") -> Column:
    return F.try_divide(F.col(c), F.lag(c).over(by_time(key, order))) - 1


def drawdown(c, key="ticker", order="date") -> Column:
    """Distance from the running maximum, at most 0."""
    peak = F.max(c).over(by_time(key, order).rowsBetween(Window.unboundedPreceding, 0))
    return (F.col(c) - peak) / peak


def rebase(c, key="ticker", order="date") -> Column:
    return F.col(c) / F.first(c).over(by_time(key, order))


def ewm(df, inputs, alpha, min_periods, key="ticker", order="date") -> DataFrame:
    """Recursive exponential mean ``y = a*x + (1-a)*y_before``, started at the first value.

    ``inputs`` maps result names to input columns; leading nulls are skipped,
    nulls after the first value are refused, and results are null until
    ``min_periods`` values were seen.  Rows are cut into blocks short enough for
    ``(1-a)**-rows`` to stay in range; inside a block the recursion is one
    weighted running sum, and from the block before only its last value can
    still count in double precision.  All inputs share the same three windows.
    """
    keep = 1.0 - alpha
    block_rows = max(1, int(150 * math.log(10) / -math.log(keep)))
    seen = by_time(key, order).rowsBetween(Window.unboundedPreceding, 0)
    before = by_time(key, order).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    row = F.row_number().over(by_time(key, order)) - 1
    out = df.withColumns({"_row": row, **{f"_n_{n}": F.count(c).over(seen) for n, c in inputs.items()}})
    out = out.withColumns({"_b": F.floor(F.col("_row") / block_rows), "_j": F.col("_row") % block_rows})
    sums = {}
    for name, source in inputs.items():
        gap = F.col(source).isNull() & (F.col(f"_n_{name}") > 0)
        value = F.when(gap, F.raise_error(F.lit(f"null inside the series of {source}"))).otherwise(F.col(source))
        weight = F.when(F.col(f"_n_{name}") == 1, F.lit(1.0)).otherwise(F.lit(alpha))
        term = value * weight * F.pow(F.lit(keep), -F.col("_j"))
        sums[f"_s_{name}"] = F.sum(term).over(inside) * F.pow(F.lit(keep), F.col("_j"))
    out = out.withColumns(sums)
    results = {}
    for name in inputs:
        ends = F.when(F.col("_j") == block_rows - 1, F.col(f"_s_{name}"))
        carried = F.last(ends, ignorenulls=True).over(before) * F.pow(F.lit(keep), F.col("_j") + 1)
        value = F.col(f"_s_{name}") + F.coalesce(carried, F.lit(0.0))
        results[name] = F.when(F.col(f"_n_{name}") >= min_periods, value)
    out = out.withColumns(results)
    return out.drop("_row", "_b", "_j", *[f"_n_{n}" for n in inputs], *sums)


def _moves(bars, key, order):
    """Gain and loss against the day before; null on the first day."""
    d = F.col("_d")
    return bars.withColumn("_d", diff("close", key, order)).withColumns(
        {
            "_gain": F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))),
            "_loss": F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0))),
        }
    ).drop("_d")


def _strength():
    return 100 - 100 / (1 + F.col("_ag") / F.nullif(F.col("_al"), F.lit(0.0)))


def rsi(bars, period=14, name="rsi", key="ticker", order="date") -> DataFrame:
    """Relative strength index with recursive smoothing; no losses give null."""
    smooth = ewm(_moves(bars, key, order), {"_ag": "_gain", "_al": "_loss"}, 1 / period, period, key, order)
    return smooth.withColumn(name, _strength()).drop("_gain", "_loss", "_ag", "_al")


def rsi_and_atr(bars, period=14, key="ticker", order="date") -> DataFrame:
    """Both indicators in one pass over the series."""
    moved = _moves(bars, key, order).withColumn("_tr", true_range(key, order))
    smooth = ewm(moved, {"_ag": "_gain", "_al": "_loss", "atr": "_tr"}, 1 / period, period, key, order)
    return smooth.withColumn("rsi", _strength()).drop("_gain", "_loss", "_ag", "_al", "_tr")


def true_range(key="ticker", order="date") -> Column:
    """Largest of the day's range and the moves from the last close; the first day has its range only."""
    last = F.lag("close").over(by_time(key, order))
    return F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - last), F.abs(F.col("low") - last)
    )


def atr(bars, period=14, name="atr", key="ticker", order="date") -> DataFrame:
    ranged = bars.withColumn("_tr", true_range(key, order))
    return ewm(ranged, {name: "_tr"}, 1 / period, period, key, order).drop("_tr")


def lookup(df, series, on, value, default=None) -> DataFrame:
    """Exact lookup in a series, with a default for absent keys."""
    out = df.join(series.select(*on, value), list(on), "left")
    return out if default is None else out.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def align(df, calendar, key="ticker", order="date") -> DataFrame:
    """Every calendar day within each key's own span, with the key's row where there is one.

    Days come from a per-key sequence cut to the calendar, not from a product
    of keys and calendar.
    """
    span = df.groupBy(key).agg(F.min(order).alias("_a"), F.max(order).alias("_z"))
    days = span.select(key, F.explode(F.sequence("_a", "_z", F.expr("interval 1 day"))).alias(order))
    days = days.join(calendar.select(order).distinct(), order, "left_semi")
    return days.join(df, [key, order], "left")

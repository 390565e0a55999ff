"""Parameter sweeps: every parameter set over the same entries, and its check on another window."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import trades

# The four parameter grids.
GRIDS = {
    "quick": {
        "atr_multiplier": [2.0, 2.5, 3.0],
        "take_profit_pct": [0.10, 0.15, 0.20],
        "sentiment_floor": [6.5, 7.0, 7.5],
        "rsi_entry_min": [30, 35],
        "min_headlines": [5],
        "reentry_cooldown_days": [5],
        "trend_fail_min_hold": [5],
    },
    "medium": {
        "atr_multiplier": [1.5, 2.0, 2.5, 3.0, 3.5],
        "take_profit_pct": [0.08, 0.10, 0.12, 0.15, 0.20],
        "sentiment_floor": [6.0, 6.5, 7.0, 7.5],
        "rsi_entry_min": [25, 30, 35, 40],
        "min_headlines": [5],
        "reentry_cooldown_days": [5],
        "trend_fail_min_hold": [5],
    },
    "full": {
        "atr_multiplier": [2.0, 2.5, 3.0, 3.5],
        "take_profit_pct": [0.10, 0.12, 0.15, 0.20],
        "sentiment_floor": [6.5, 7.0, 7.5],
        "rsi_entry_min": [25, 30, 35],
        "min_headlines": [3, 5],
        "reentry_cooldown_days": [3, 5, 7],
        "trend_fail_min_hold": [5],
    },
    "comprehensive": {
        "atr_multiplier": [2.0, 2.5, 3.0, 3.5],
        "take_profit_pct": [0.10, 0.12, 0.15, 0.20],
        "sentiment_floor": [6.5, 7.0, 7.5],
        "rsi_entry_min": [25, 30, 35],
        "min_headlines": [3, 5],
        "reentry_cooldown_days": [3, 5, 7],
        "trend_fail_min_hold": [3, 5, 7, 10],
    },
}

PARAMETERS = list(GRIDS["quick"])


def grid_size(params):
    return len(list(product(*params.values())))


def with_grid(df, params) -> DataFrame:
    """Every row once per parameter set; the values are literals, so nothing is joined."""
    for name, values in params.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(x) for x in values])))
    return df


COUNTS = {
    "n_trades": "true",
    "n_stops": "exit_reason = 'STOP_LOSS'",
    "n_targets": "exit_reason = 'TAKE_PROFIT'",
    "n_open": "exit_reason = 'OPEN'",
    "n_winners": "exit_price > entry_price",
}


def run(entries, bars, params, bench, calendar=None, sentiment=None, capital=100_000.0, stake=100_000.0, min_trades=20) -> DataFrame:
    """Metrics of the daily equity of every parameter set, best return first; sets without a trade included.

    ``entries`` are gated candidates with ``ticker, entry_date, entry_price,
    atr, rsi, score, headline_count`` under the loosest limits.
    Exits depend on the stop, target and hold parameters only, so each entry is
    labelled once per such triple; the gate parameters then only pick rows, and
    the cooldown of the set accepts them in order per ticker.  Accepted trades
    are sized for ``stake`` and become one equity curve per set over the days
    of ``calendar`` (default: of the bars), from ``capital`` (a number or a
    scalar) on; ``bench`` has ``date, close`` over the same days.
    """
    exit_params = {k: params[k] for k in ("atr_multiplier", "take_profit_pct", "trend_fail_min_hold")}
    gate_params = {k: v for k, v in params.items() if k not in exit_params}
    names = [*exit_params, *gate_params]
    spread = trades.size(with_grid(entries, exit_params), stake, multiplier=F.col("atr_multiplier"))
    labelled = trades.label_exits(spread.withColumn("trend_min_hold", F.col("trend_fail_min_hold")), bars, sentiment)
    gated = with_grid(labelled, gate_params)
    passes = F.lit(True)
    if "sentiment_floor" in gate_params:
        passes = passes & (F.col("score") >= F.col("sentiment_floor"))
    if "rsi_entry_min" in gate_params:
        passes = passes & (F.col("rsi") >= F.col("rsi_entry_min"))
    if "min_headlines" in gate_params:
        passes = passes & (F.col("headline_count") >= F.col("min_headlines"))
    kept = gated.filter(passes)
    if "reentry_cooldown_days" in gate_params:
        kept = trades.cooldown(kept, "reentry_cooldown_days", ["ticker", *names])
    calendar = (bars if calendar is None else calendar).select("date").distinct()
    curves = trades.equity(kept, bars, calendar, capital, names, with_grid(bars.sparkSession.range(1), params), COUNTS)
    metrics = trades.performance(curves, bench, capital, by=names, counts=COUNTS)
    n = F.col("n_trades").cast("double")
    edges = F.lit(False)
    for name in names:
        if len(params[name]) > 1:
            edges = edges | F.col(name).isin(min(params[name]), max(params[name]))
    note = F.when(F.col("n_trades") < min_trades, f"<{min_trades} trades").when(edges, "extreme value").otherwise("")
    rate = lambda c: F.coalesce(F.try_divide(F.col(c), n), F.lit(0.0))
    return metrics.withColumns(
        {"win_rate": rate("n_winners"), "stop_rate": rate("n_stops"), "note": note}
    ).orderBy(F.desc("total_return"), *names)


def top_unique(results, n, keys, decimals=4, digits=7) -> DataFrame:
    """Best ``n`` distinct sets by return, then those by Sharpe not among them, with their order.

    Metrics are compared to ``digits`` places, as their last bits hang on the
    order of a sum; equal ones follow the keys, then all other parameters.
    """
    rounded = [F.round(F.col(k).cast("double"), decimals).alias(f"_k_{k}") for k in keys]
    marked = results.select("*", *rounded)
    key_names = [f"_k_{k}" for k in keys]

    def best(metric, source):
        rest = [c for c in marked.columns if c not in key_names]
        rank = F.round(metric, digits)
        others = [F.col(c) for c in PARAMETERS if c in marked.columns]
        first = F.min_by(F.struct(*rest), F.struct(-rank, *others)).alias("_r")
        unique = marked.filter(F.col(metric).isNotNull()).groupBy(*key_names).agg(first).select(*key_names, "_r.*")
        top = unique.orderBy(F.desc(rank), *key_names).limit(n)
        order = Window.partitionBy(F.lit(1)).orderBy(F.desc(rank), *key_names)
        return top.withColumn("place", F.row_number().over(order)).withColumn("source", F.lit(source))

    by_return, by_sharpe = best("total_return", "return"), best("sharpe", "sharpe")
    extra = by_sharpe.join(by_return.select(*key_names), key_names, "left_anti")
    return by_return.unionByName(extra).drop(*key_names)


def verdict(ret, sharpe):
    missing = ret.isNull() | sharpe.isNull() | F.isnan(ret) | F.isnan(sharpe)
    return (
        F.when(missing, "ERROR")
        .when((ret > 0.05) & (sharpe > 0.5), "STRONG_PASS")
        .when((ret > 0) & (sharpe > 0), "PASS")
        .when(ret > 0, "MARGINAL")
        .otherwise("FAIL")
    )


def walk_forward(in_sample, out_of_sample, names) -> DataFrame:
    """In-sample sets beside their result on another window, with a verdict."""
    metrics = ["total_return", "ann_return", "sharpe", "win_rate", "n_trades", "max_drawdown", "ann_vol", "alpha", "stop_rate"]
    a = in_sample.select(*names, *[F.col(m).alias(f"is_{m}") for m in metrics])
    b = out_of_sample.select(*names, *[F.col(m).alias(f"oos_{m}") for m in metrics])
    both = a.join(b, list(names), "left")
    return both.withColumn("verdict", verdict(F.col("oos_total_return"), F.col("oos_sharpe")))


def share_passing(checked) -> DataFrame:
    good = F.count_if(F.col("verdict").isin("STRONG_PASS", "PASS"))
    return checked.agg(F.count(F.lit(1)).alias("n"), good.alias("n_pass"), (good / F.count(F.lit(1))).alias("share"))

"""Trades: entries, exit labels, cooldown, logs, equity and performance."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import timeseries as ts

# Default sizes, stops and targets.
RULES = {
    "atr_multiplier": 3.5,
    "take_profit_pct": 0.12,
    "fallback_stop_pct": 0.05,
    "trend_min_hold": 5,
    "sell_floor": 4.0,
    "sell_consensus": 0.70,
    "min_headlines": 5,
}
#: Columns of an exit and their pandas types; the day is counted from 1970.
EXITS = [("exit_day", "int32"), ("exit_price", "float64"), ("exit_reason", object)]
#: Calls that label exits; each takes the tickers of one hash value.
PARTS = 2_048


def holding_days(trades, calendar) -> DataFrame:
    """One row per trade and calendar day from entry to exit.

    The calendar becomes one flag per day from its first to its last, so the
    rows of days are filtered where they arise and never shuffled; the trades
    are dealt evenly before, as each becomes many rows.
    """
    known = calendar.agg(F.collect_set("date").alias("days"))
    known = known.select("days", F.array_min("days").alias("a"), F.array_max("days").alias("z"))
    flags = F.transform(F.sequence("a", "z", F.expr("interval 1 day")), lambda d: F.array_contains("days", d))
    one = known.select(F.struct("a", "z", flags.alias("open")).alias("c")).scalar()
    first, last = F.greatest("entry_date", one["a"]), F.least("exit_date", one["z"])
    days = trades.filter((F.col("entry_date") <= F.col("exit_date")) & (first <= last))
    # a given number of parts: small trades must not be put together, as their days are many
    parts = int(trades.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = days.repartition(parts, *trades.columns).withColumn("date", F.explode(F.sequence(first, last, F.expr("interval 1 day"))))
    return days.filter(F.get(one["open"], F.datediff("date", one["a"]))).select("date", *trades.columns)


def next_entry(bars, extra=("atr",)) -> DataFrame:
    """Beside each day the ticker's next one: its date, open and, named ``entry_*``, further columns."""
    w = ts.by_time()
    return bars.withColumns(
        {
            "entry_date": F.lead("date").over(w),
            "entry_price": F.lead("open").over(w),
            **{f"entry_{c}": F.lead(c).over(w) for c in extra},
        }
    )


def size(df, capital=100_000.0, cash=None, risk=0.02, cap=0.15, multiplier=3.5, fallback=0.05) -> DataFrame:
    """Shares by risk to the stop, capped by a share of cash; without ATR 5 % of price stands in."""
    cash = capital if cash is None else cash
    width = F.coalesce(F.col("atr"), F.col("entry_price") * fallback) * multiplier
    by_risk = F.greatest(F.lit(1), F.floor(F.lit(capital * risk) / width))
    by_cash = F.greatest(F.lit(1), F.floor(F.lit(cash * cap) / F.col("entry_price")))
    return df.withColumns({"dist": width, "shares": F.least(by_risk, by_cash)})


def size_live(df, capital, share=0.10, max_shares=20) -> DataFrame:
    return df.withColumn("shares", F.least(F.floor(F.lit(capital * share) / F.col("price")), F.lit(max_shares)))


def _cents(x):
    """To two decimals, halves away from zero, as SQL rounds."""
    return np.sign(x) * np.floor(np.abs(x) * 100 + 0.5) / 100


def _first_exit(o, h, l, c, ma, sell, start, entry, dist, target, hold):
    """Index, price and reason of the first exit from ``start`` on, scanned in growing steps."""
    peak, i, step, n = entry, start, 32, len(o)
    while i < n:
        j = min(n, i + step)
        peaks = np.maximum(np.maximum.accumulate(h[i:j]), peak)
        stops = _cents(peaks - dist)
        stop, goal = l[i:j] <= stops, h[i:j] >= target
        trend = (np.arange(i, j) - start + 1 >= hold) & (c[i:j] < ma[i:j])
        hit = stop | goal | trend | sell[i:j]
        if hit.any():
            k = int(hit.argmax())
            if stop[k]:
                return i + k, min(o[i + k], stops[k]), "STOP_LOSS"
            if goal[k]:
                return i + k, target, "TAKE_PROFIT"
            return i + k, o[i + k], "TREND_FAIL" if trend[k] else "SENTIMENT_SELL"
        peak, i, step = peaks[-1], j, step * 2
    return n - 1, c[n - 1], "OPEN"


def _label_part(entries, bars):
    """Exits of the entries of some tickers; an entry on a day without a bar leaves."""
    bars = bars.sort_values(["ticker", "_day"], kind="stable")
    o, h, l, c, ma = (bars[x].to_numpy(float) for x in ("open", "high", "low", "close", "ma50"))
    sell, days = bars["sell"].to_numpy(bool), bars["_day"].to_numpy()
    names, starts = np.unique(bars["ticker"].to_numpy(), return_index=True)
    ends = np.append(starts[1:], len(bars))
    spans = {name: slice(x, y) for name, x, y in zip(names.tolist(), starts.tolist(), ends.tolist())}
    rows, out = [], []
    for i, e in enumerate(entries.itertuples(index=False)):
        own = spans.get(e.ticker)
        if own is None:
            continue
        at = int(np.searchsorted(days[own], e.start_day))
        if at == own.stop - own.start or days[own][at] != e.start_day:
            continue
        target = float(_cents(e.entry_price * (1 + e.take_profit_pct)))
        k, price, why = _first_exit(o[own], h[own], l[own], c[own], ma[own], sell[own], at, e.entry_price, e.dist, target, e.trend_min_hold)
        rows.append(i)
        out.append((int(days[own][k]), float(price), why))
    done = entries.iloc[rows].drop(columns=["_part", "start_day"])
    return done.assign(**{n: pd.Series([r[j] for r in out], index=done.index, dtype=t) for j, (n, t) in enumerate(EXITS)})


def label_exits(entries, bars, sentiment=None, rules=None) -> DataFrame:
    """Exit of every entry on its own: stop, else target, else trend, else sentiment, else open.

    ``entries`` needs ``ticker, entry_date, entry_price, dist``, may bring its own
    ``take_profit_pct`` and ``trend_min_hold``, and keeps its other columns.  Each
    entry scans its ticker's days until the first exit, so no entry-by-day table
    is built.  Days and entries per ticker are bounded by the calendar (times the
    parameter sets of a sweep); one call takes the tickers of one of ``PARTS``
    hash values, as a call per ticker costs more than its work.  The daily
    roll-up is ``sentiment``, or lies in the columns of ``bars``.
    """
    r = {**RULES, **(rules or {})}
    for name in ("take_profit_pct", "trend_min_hold"):
        if name not in entries.columns:
            entries = entries.withColumn(name, F.lit(r[name]))
    bad = (
        (F.col("score") < r["sell_floor"])
        & (F.col("consensus_pct") >= r["sell_consensus"])
        & (F.col("headline_count") >= r["min_headlines"])
    )
    if sentiment is not None:
        days = sentiment.filter(bad).select("ticker", "date").distinct().withColumn("sell", F.lit(True))
        bars = bars.join(days, ["ticker", "date"], "left")
    else:
        bars = bars.withColumn("sell", bad if "score" in bars.columns else F.lit(False))
    part = F.pmod(F.xxhash64("ticker"), F.lit(PARTS)).alias("_part")
    used = bars.join(entries.select("ticker").distinct(), "ticker", "left_semi")
    used = used.select("ticker", "date", "open", "high", "low", "close", F.coalesce("sell", F.lit(False)).alias("sell"), part)
    # dealt once: the windows of a ticker lie within its part
    marked = ts.rolling_means(used.repartition("_part"), "close", {"ma50": 50}, ["_part", "ticker"])
    marked = marked.select("ticker", F.unix_date("date").alias("_day"), "open", "high", "low", "close", "ma50", "sell", "_part")
    typed = entries.withColumns(
        {"take_profit_pct": F.col("take_profit_pct").cast("double"), "trend_min_hold": F.col("trend_min_hold").cast("int")}
    )
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in typed.schema)
    dealt = typed.select("*", F.unix_date("entry_date").alias("start_day"), part)
    labelled = dealt.groupBy("_part").cogroup(marked.groupBy("_part")).applyInPandas(
        _label_part, f"{kept}, exit_day int, exit_price double, exit_reason string"
    )
    return labelled.select(*typed.columns, F.date_from_unix_date("exit_day").alias("exit_date"), "exit_price", "exit_reason")


def cooldown(df, gap_days=5, key="ticker", start="entry_date", end="exit_date") -> DataFrame:
    """Accepted rows per key in order: each starts at least ``gap_days`` after the last accepted end.

    ``key`` may be several columns, and ``gap_days`` one of them.  A fold, because a skipped row does not count.  One row per key and start
    day is taken (the first id), so the folded list is bounded by the calendar.
    """
    keys = [key] if isinstance(key, str) else list(key)
    gap = F.col(gap_days) if isinstance(gap_days, str) else F.lit(gap_days)
    one = df.groupBy(*keys, start).agg(F.min_by(F.struct(*[c for c in df.columns if c not in (*keys, start)]), "trade_id").alias("_r"))
    rows = F.sort_array(F.collect_list(F.struct(F.col(start).alias("s"), F.col(f"_r.{end}").alias("e"), "_r")))
    kind = "array<date>"

    def step(state, row):
        free = state["last"].isNull() | (F.datediff(row["s"], state["last"]) >= gap)
        return F.when(
            free,
            F.struct(row["e"].alias("last"), F.concat(state["kept"], F.array(row["s"])).alias("kept")),
        ).otherwise(state)

    first = F.struct(F.lit(None).cast("date").alias("last"), F.array().cast(kind).alias("kept"))
    kept = one.groupBy(*keys).agg(rows.alias("_rows")).withColumn("_f", F.aggregate("_rows", first, step))
    accepted = F.filter("_rows", lambda row: F.array_contains(F.col("_f.kept"), row["s"]))
    return kept.select(*keys, F.explode(accepted).alias("_a")).select(*keys, F.col("_a.s").alias(start), "_a._r.*").select(*df.columns)


def log(trades) -> DataFrame:
    """Profit in percent and calendar days held."""
    return trades.withColumns(
        {
            "pnl_pct": (F.col("exit_price") - F.col("entry_price")) / F.col("entry_price") * 100,
            "holding_days": F.datediff("exit_date", "entry_date"),
        }
    )


def _count(reason):
    return F.count_if(F.col("exit_reason") == reason)


def summary(trades, by=()) -> DataFrame:
    """Trades by exit, winners, win rate and stop rate."""
    n = F.count(F.lit(1))
    winners = F.count_if(F.col("exit_price") > F.col("entry_price"))
    rate = lambda c: F.coalesce(F.try_divide(c.cast("double"), n.cast("double")), F.lit(0.0))
    return trades.groupBy(*by).agg(
        n.alias("n_trades"),
        _count("STOP_LOSS").alias("n_stops"),
        _count("TAKE_PROFIT").alias("n_targets"),
        _count("OPEN").alias("n_open"),
        winners.alias("n_winners"),
        rate(winners).alias("win_rate"),
        rate(_count("STOP_LOSS")).alias("stop_rate"),
    )


def by_ticker(trades) -> DataFrame:
    """Return on deployed capital per ticker, busiest first."""
    gain = F.sum((F.col("exit_price") - F.col("entry_price")) * F.col("shares"))
    spent = F.sum(F.col("entry_price") * F.col("shares"))
    return (
        trades.groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("n_trades"), F.coalesce(F.try_divide(gain, spent) * 100, F.lit(0.0)).alias("return_pct"))
        .orderBy(F.desc("n_trades"), "ticker")
    )


def position_report(positions) -> DataFrame:
    gain = F.col("unrealized_pl")
    return positions.select(
        "symbol",
        "qty",
        F.round("avg_entry_price", 2).alias("entry"),
        F.round("current_price", 2).alias("current"),
        F.round(gain, 2).alias("pnl"),
        F.when(gain >= 0, "+").otherwise("-").alias("sign"),
    )


def equity(trades, bars, calendar, capital=100_000.0, by=(), groups=None, counts=None) -> DataFrame:
    """Cash plus open positions on every calendar day, per ``by``.

    Open shares and their cost are running sums over the days on which a ticker
    trades; each stands until the ticker's next trade and is laid over just the
    days it is held, so neither a trade-by-day nor a ticker-by-day table is
    built, and ``trades`` are read once.  A day without a bar values the shares
    at cost.  With ``by``, ``groups`` holds all combinations, those without a
    trade included.  ``counts`` maps names to SQL conditions; the trades that meet
    them are counted on their entry day.
    """
    by, counts = list(by), counts or {}
    if by and groups is None:
        raise ValueError("groups must hold every combination of by")
    entry, out = F.col("entry_price") * F.col("shares"), F.col("exit_price") * F.col("shares")
    opened = [F.when(F.expr(c), 1).otherwise(0).alias(n) for n, c in counts.items()]
    closed = [F.lit(0).alias(n) for n in counts]
    flows = (
        trades.select(
            *by,
            "ticker",
            F.inline(
                F.array(
                    F.struct(F.col("entry_date").alias("date"), F.col("shares").alias("d_shares"), entry.alias("d_cost"), (-entry).alias("d_cash"), *opened),
                    F.struct(F.col("exit_date").alias("date"), (-F.col("shares")).alias("d_shares"), (-entry).alias("d_cost"), out.alias("d_cash"), *closed),
                )
            ),
        )
        .groupBy(*by, "ticker", "date")
        .agg(*[F.sum(c).alias(c) for c in ("d_shares", "d_cost", "d_cash", *counts)])
    )
    order = Window.partitionBy(*by, "ticker").orderBy("date")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    last = calendar.agg(F.max("date")).scalar()
    stands = flows.withColumns(
        {"shares": F.sum("d_shares").over(so_far), "cost": F.sum("d_cost").over(so_far), "_next": F.lead("date").over(order)}
    )
    until = F.when(F.col("shares") > 0, F.greatest("date", F.coalesce(F.date_sub("_next", 1), last))).otherwise(F.col("date"))
    days = stands.select("*", F.posexplode(F.sequence("date", until, F.expr("interval 1 day"))).alias("_nth", "_day"))
    once = [F.when(F.col("_nth") == 0, F.col(c)).alias(c) for c in ("d_cash", *counts)]
    days = days.select(*by, "ticker", F.col("_day").alias("date"), "shares", "cost", *once)
    valued = days.join(bars.select("ticker", "date", "close"), ["ticker", "date"], "left")
    value = F.when(F.col("shares") > 0, F.coalesce(F.col("shares") * F.col("close"), F.col("cost"))).otherwise(0.0)
    moved = valued.select(*by, "date", value.alias("held"), "d_cash", *counts, F.lit(False).alias("_open"))
    dates = calendar.agg(F.collect_set("date")).scalar()
    blank = [F.lit(0).alias(n) for n in counts]
    groups = calendar.sparkSession.range(1).select() if groups is None else groups.select(*by)
    empty = groups.select(*by, F.explode(dates).alias("date"), F.lit(0.0).alias("held"), F.lit(0.0).alias("d_cash"), *blank, F.lit(True).alias("_open"))
    daily = moved.unionByName(empty).groupBy(*by, "date").agg(
        *[F.sum(c).alias(c) for c in ("held", "d_cash", *counts)], F.max("_open").alias("_open")
    )
    # one row per group and calendar day is left: the running cash is a window over the calendar
    along = Window.partitionBy(*(by or [F.lit(1)])).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    worth = F.lit(capital) if isinstance(capital, (int, float)) else capital
    return (
        daily.withColumn("equity", worth + F.sum("d_cash").over(along) + F.col("held"))
        .filter("_open")
        .select(*by, "date", "equity", *counts)
    )


def performance(equity_days, bench, capital=100_000.0, risk_free=0.04, by=(), counts=()) -> DataFrame:
    """One row per ``by``: returns, volatility, Sharpe ratio, drawdown, benchmark return, alpha and sums of ``counts``."""
    keys = list(by) or ["_p"]
    marked = equity_days.withColumn("_p", F.lit(1))
    rows = marked.withColumns(
        {"_r": ts.pct_change("equity", keys), "_dd": ts.drawdown("equity", keys)}
    )
    one = rows.groupBy(*by).agg(
        F.max_by("equity", "date").alias("end_value"),
        F.count("_r").alias("n_days"),
        F.stddev_samp("_r").alias("_sd"),
        F.min("_dd").alias("max_drawdown"),
        *[F.sum(c).alias(c) for c in counts],
    )
    spans = bench.agg(F.min_by("close", "date").alias("a"), F.max_by("close", "date").alias("z"))
    bench_return = spans.select(F.col("z") / F.col("a") - 1).scalar()
    total = F.col("end_value") / capital - 1
    ann = F.pow(F.col("end_value") / capital, F.lit(252.0) / F.greatest("n_days", F.lit(1))) - 1
    out = one.withColumns(
        {
            "total_return": total,
            "ann_return": ann,
            "ann_vol": F.when(F.col("n_days") > 1, F.col("_sd") * F.sqrt(F.lit(252.0))).otherwise(0.0),
            "bench_return": bench_return,
        }
    )
    return out.withColumns(
        {
            "sharpe": F.when(F.col("ann_vol") > 0, (F.col("ann_return") - risk_free) / F.col("ann_vol")).otherwise(0.0),
            "alpha": F.col("total_return") - F.col("bench_return"),
        }
    ).drop("_sd")

"""Equity per parameter set against a loop over days, and the order of equal sets."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import sweeps, trades

DAY = date(2024, 1, 1)


def on(n):
    return DAY + timedelta(days=n)


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(4)
    closes = {(t, on(d)): round(rng.uniform(5, 50), 2) for t in "abc" for d in range(40) if d % 7 < 5 and (t, d) != ("a", 10)}
    rows = []
    for i in range(60):
        a = rng.choice([d for d in range(38) if d % 7 < 5])
        z = rng.choice([d for d in range(a, 40) if d % 7 < 5])
        rows.append((rng.choice(["p", "q"]), rng.choice("abc"), on(a), on(z), rng.uniform(5, 50), rng.uniform(5, 50), rng.randint(1, 9), rng.choice(["OPEN", "STOP_LOSS"])))
    bars = spark.createDataFrame([(t, d, c) for (t, d), c in closes.items()], "ticker string, date date, close double")
    df = spark.createDataFrame(rows, "s string, ticker string, entry_date date, exit_date date, entry_price double, exit_price double, shares int, exit_reason string")
    return closes, rows, bars, df


def loop(closes, rows, capital):
    out, cost = {}, lambda r: r[4] * r[6]
    for day in sorted({d for _, d in closes}):
        worth = capital
        for r in rows:
            worth -= cost(r) if r[2] <= day else 0
            worth += r[5] * r[6] if r[3] <= day else 0
        held = {}
        for r in rows:
            if r[2] <= day < r[3]:
                shares, spent = held.get(r[1], (0, 0.0))
                held[r[1]] = shares + r[6], spent + cost(r)
        for t, (shares, spent) in held.items():
            worth += shares * closes[t, day] if (t, day) in closes else spent
        out[day] = worth
    return out


def test_equity_per_set(spark, made):
    closes, rows, bars, df = made
    groups = spark.createDataFrame([("p",), ("q",), ("none",)], "s string")
    counts = {"n": "true", "n_stops": "exit_reason = 'STOP_LOSS'"}
    got = trades.equity(df, bars, bars.select("date"), 1e4, ["s"], groups, counts).toPandas()
    for name in ("p", "q", "none"):
        mine = [r for r in rows if r[0] == name]
        want = loop(closes, mine, 1e4)
        part = got[got["s"] == name].sort_values("date")
        assert part["date"].tolist() == list(want)
        assert np.allclose(part["equity"], list(want.values()))
        assert part["n"].sum() == len(mine) and part["n_stops"].sum() == sum(r[7] == "STOP_LOSS" for r in mine)
    whole = trades.equity(df, bars, bars.select("date"), 1e4).toPandas().sort_values("date")
    assert np.allclose(whole["equity"], list(loop(closes, rows, 1e4).values()))


def test_performance_per_set(spark, made):
    closes, rows, bars, df = made
    groups = spark.createDataFrame([("p",), ("q",), ("none",)], "s string")
    bench = bars.groupBy("date").agg(F.avg("close").alias("close"))
    curves = trades.equity(df, bars, bars.select("date"), 1e4, ["s"], groups, {"n": "true"})
    got = {r["s"]: r for r in trades.performance(curves, bench, 1e4, by=["s"], counts=["n"]).collect()}
    for name in ("p", "q"):
        e = np.array(list(loop(closes, [r for r in rows if r[0] == name], 1e4).values()))
        r = e[1:] / e[:-1] - 1
        ann, vol = (e[-1] / 1e4) ** (252 / len(r)) - 1, r.std(ddof=1) * 252**0.5
        dd = (e / np.maximum.accumulate(e) - 1).min()
        mine = got[name]
        assert np.allclose([mine["total_return"], mine["ann_return"], mine["ann_vol"], mine["sharpe"], mine["max_drawdown"]], [e[-1] / 1e4 - 1, ann, vol, (ann - 0.04) / vol, dd])
        assert mine["alpha"] == pytest.approx(mine["total_return"] - mine["bench_return"])
    idle = got["none"]
    assert (idle["total_return"], idle["ann_vol"], idle["sharpe"], idle["max_drawdown"], idle["n"]) == (0, 0, 0, 0, 0)


def test_trades_are_read_once(made):
    _, _, bars, df = made
    marked = df.groupBy("ticker").applyInPandas(lambda x: x, df.schema)
    plan = trades.equity(marked, bars, bars.select("date"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 1


def test_equal_sets_follow_their_keys(spark):
    rows = [(2.0, 0.1, 6.5, r, v + 1e-13 * r, v) for r, v in ((30, 0.5), (35, 0.5))] + [(2.0, 0.1, f, 30, 0.5 - 1e-12 * f, 0.1) for f in (7.5, 7.0)]
    df = spark.createDataFrame(rows, "atr_multiplier double, take_profit_pct double, sentiment_floor double, rsi_entry_min int, total_return double, sharpe double")
    got = sweeps.top_unique(df, 2, ["atr_multiplier", "take_profit_pct", "sentiment_floor"]).orderBy("source", "place").collect()
    assert [(r["source"], r["sentiment_floor"], r["rsi_entry_min"]) for r in got] == [("return", 6.5, 30), ("return", 7.0, 30)]

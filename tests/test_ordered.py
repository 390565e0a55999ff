"""Block-wise orders against NumPy and pandas, with one key holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered, ranking, sampling, timeseries


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(7)
    n = 4000
    key = np.where(rng.random(n) < 0.6, "hot", rng.integers(0, 20, n).astype(str))
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "x": np.round(rng.lognormal(3, 2, n), 2)})
    return pdf, spark.createDataFrame(pdf).repartition(6).cache()


def test_running_total(hot):
    pdf, df = hot
    out = ordered.running(df, ["k"], ["x", "id"], {"s": F.lit(1)}, ordered.number_block("x"), totals=True).toPandas()
    want = pdf.sort_values(["x", "id"]).assign(s=lambda d: d.groupby("k").cumcount() + 1).set_index("id")["s"]
    got = out.set_index("id")
    assert (got["s"].sort_index() == want.sort_index()).all()
    assert (got["s_total"] == got["k"].map(pdf["k"].value_counts())).all()


def test_quantiles(hot):
    pdf, df = hot
    probs = [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]
    got = {r["k"]: r["q"] for r in ordered.quantiles(df, ["x"], probs, ["k"]).collect()}
    for key, part in pdf.groupby("k"):
        assert np.allclose(got[key], np.quantile(part["x"], probs))


def test_quantiles_one_value(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, None)], "k int, x double")
    assert [tuple(r) for r in ordered.quantiles(df, ["x"], [0.5], ["k"]).collect()] == [(1, "x", 2, [5.0])]


def test_rank_first(spark):
    rng = np.random.default_rng(3)
    n = 1500
    pdf = pd.DataFrame(
        {"id": np.arange(n), "p": np.where(rng.random(n) < 0.5, 1, rng.integers(2, 9, n)), "s": rng.integers(0, 4, n).astype(float)}
    )
    pdf.loc[pdf["id"] % 13 == 0, "s"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("s", F.nanvl("s", F.lit(None).cast("double")))
    got = ranking.rank_first(df, "p", "s", ["id"]).toPandas().set_index("id")["rank"].sort_index()
    want = pdf.set_index("id").groupby("p")["s"].rank(ascending=False, method="first")
    assert got.fillna(-1).tolist() == want.fillna(-1).tolist()


def test_rank_within_is_the_top_of_the_full_ranking(spark):
    rng = np.random.default_rng(5)
    rows = [(i, None if rng.random() < 0.05 else int(rng.integers(0, 60)), None if rng.random() < 0.5 else float(rng.integers(0, 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, p int, s double")
    full = ranking.fill_worst(ranking.rank_first(df, "p", "s", ["id"]), "p").filter("rank <= 3")
    assert sorted(map(tuple, ranking.rank_within(df, "p", "s", ["id"], 3).collect())) == sorted(map(tuple, full.collect()))


def test_intervals_never_fall(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate(
        [
            rng.normal(0, 1, 3000), rng.normal(1e6, 1e-3, 3000), 2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1022, 1023), 0),
            -(2.0 ** np.arange(-60, 60)), np.arange(-500, 500), 10.0 ** np.arange(-300, 300), [0.0, -0.0, np.inf, -np.inf],
        ]
    )
    df = spark.createDataFrame(pd.DataFrame({"x": x}), "x double").union(spark.range(2).selectExpr("double('NaN')"))
    got = df.select("x", *[c.alias(n) for c, n in zip(ordered._interval(F.col("x")), ("c", "f"))]).orderBy("x").collect()
    keys = [(r["c"], r["f"]) for r in got]
    assert keys == sorted(keys) and None not in {k for pair in keys for k in pair}


@pytest.mark.parametrize("centre,spread", [(0, 1), (1.7e9, 0.01), (-1e6, 1e-4)])
def test_quantiles_of_narrow_columns(spark, centre, spread):
    rng = np.random.default_rng(2)
    x = centre + spread * rng.standard_normal(5000)
    pdf = pd.DataFrame({"x": x, "y": np.round(x, 1), "g": rng.integers(0, 3, 5000)})
    df = spark.createDataFrame(pdf).repartition(5)
    probs = [0.0, 0.013, 0.25, 0.5, 0.9, 1.0]
    got = {r["column"]: r["q"] for r in ordered.quantiles(df, ["x", "y"], probs).collect()}
    for c in ("x", "y"):
        assert np.allclose(got[c], np.quantile(pdf[c], probs), rtol=1e-15)
    for r in ordered.quantiles(df, ["x", "y"], probs, ["g"]).collect():
        assert np.allclose(r["q"], np.quantile(pdf[pdf["g"] == r["g"]][r["column"]], probs), rtol=1e-15)


def test_building_starts_no_job(spark, hot):
    _, df = hot
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building")
    try:
        ordered.quantiles(df, ["x", "id"], [0.5])
        ordered.quantiles(df, ["x"], [0.5], ["k"])
        ranking.rank_first(df, "k", "x", ["id"])
        ranking.rank_within(df, "k", "x", ["id"], 3)
        ordered.number_rows(df, ["k"], ["x", "id"], ordered.number_block("x"))
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_split_sizes(hot):
    _, df = hot
    rows = sampling.split(df, "id", 0.5, by=["k"]).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_first").alias("a")
    )
    assert all(r["a"] == r["n"] // 2 for r in rows.collect())


@pytest.mark.parametrize("alpha,n", [(1 / 14, 60), (0.5, 1200), (1 / 3, 3000)])
def test_ewm_matches_pandas(spark, alpha, n):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"ticker": "a", "date": np.arange(n), "x": rng.normal(100, 5, n)})
    pdf.loc[0, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None).cast("double")))
    got = timeseries.ewm(df, {"y": "x"}, alpha, 14).orderBy("date").toPandas()["y"].astype(float)
    want = pdf["x"].ewm(alpha=alpha, min_periods=14, adjust=False).mean()
    assert np.allclose(got, want, equal_nan=True, rtol=1e-10)


def test_rsi_and_atr_edges(spark):
    rows = [("a", i, 10.0 + i, 11.0 + i, 9.5 + i, 10.5 + i, 1.0) for i in range(20)]
    bars = spark.createDataFrame(rows, "ticker string, date int, open double, high double, low double, close double, volume double")
    out = timeseries.atr(timeseries.rsi(bars)).orderBy("date").toPandas()
    assert out["rsi"].isna().all()  # never a loss
    assert out["atr"].isna().sum() == 13
    down = timeseries.rsi(bars.withColumn("close", -F.col("close"))).orderBy("date").toPandas()["rsi"]
    assert down[:14].isna().all() and (down[14:].astype(float) == 0).all()


def test_rank_of_small_groups_shuffles_rows_once(spark):
    rows = [(p, float(i % 5) if i % 4 else None, i, f"x{i}") for p in (None, "a", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "p string, s double, id int, rest string")
    ranks = ranking.rank_first(df, "p", "s", ["id"])
    got = {(r["p"], r["id"]): r["rank"] for r in ranks.collect()}
    final = ranks._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert sum("Exchange hashpartitioning(p" in x for x in final.splitlines()) == 1
    want = {}
    for p in (None, "a", "b"):
        known = sorted(((-s, i) for q, s, i, _ in rows if q == p and s is not None))
        want |= {(p, i): None for q, s, i, _ in rows if q == p and s is None} | {(p, i): n for n, (_, i) in enumerate(known, 1)}
    assert got == want


def test_large_and_small_groups_rank_alike(spark, monkeypatch):
    rows = [(p, float(i % 3) if i % 5 else None, i) for p, n in ((None, 30), ("a", 30), ("b", 4), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "p string, s double, id int")
    found = []
    for large in (0, 10, 100):
        monkeypatch.setattr(ranking, "LARGE", large)
        first = ranking.rank_first(df, "p", "s", ["id"])
        found.append([sorted(map(tuple, x.collect()), key=str) for x in (first, ranking.fill_worst(first, "p"), ranking.fill_worst(first, "p", sizes=df))])
    assert found[0] == found[1] == found[2]
    assert found[0][1] == found[0][2]

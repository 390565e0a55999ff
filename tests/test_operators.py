"""Rules of single operators on hand-made rows."""

import datetime as dt
import gzip
import json
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates, text, values as x
from millrace.operators import (
    cleaning, cohort, detections, evaluation, experiment, forecast, joins, ranking, screens, sentiment, signals, stats,
    sweeps, trades,
)
from millrace.plans import customers, summaries, views
from millrace.sources import files


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def star(spark, conversions, lines):
    days = [dt.date(2020, 1, 6) + dt.timedelta(days=i) for i in range(70)]
    key = lambda d: int(d.strftime("%Y%m%d"))
    date_dim = spark.createDataFrame([(d,) for d in days], "day date").select(
        dates.date_key(F.col("day")).alias("sk_date"),
        dates.running_week(F.col("day")).alias("running_week"),
        dates.year_week(F.col("day")).alias("year_week"),
    )
    customers = spark.createDataFrame([(1, 11, "A", "B")], "sk_customer int, customer_id int, first_name string, last_name string")
    conv = spark.createDataFrame(
        [(i, 1, key(days[d]), "activation", days[d], "web", o) for i, d, o in conversions],
        "conversion_id int, fk_customer int, fk_conversion_date int, conversion_type string, conversion_date date, conversion_channel string, order_number string",
    )
    orders = spark.createDataFrame(
        [(o, 1, key(days[d]), 1, 1.0, paid) for o, d, paid in lines],
        "order_number string, fk_product int, fk_order_date int, fk_customer int, discount_value double, price_paid double",
    ).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("discount_value", "price_paid")})
    return orders, conv, customers, date_dim


def test_customer_info(spark):
    orders, conv, customers, date_dim = star(
        spark, [(1, 0, "o1"), (2, 21, "o2")], [("o1", 0, 10.0), ("o1", 0, 5.0), ("o2", 22, 7.0), ("o3", 23, 1.0)]
    )
    out = cohort.customer_info(orders, conv, customers, date_dim).toPandas().sort_values(["conversion_id", "week_counter"])
    first = out[out["conversion_id"] == 1]
    assert first["week_counter"].tolist() == [1, 2, 3]  # up to the week before the next conversion
    assert first["orders_placed"].tolist() == [1, 0, 0]
    assert float(first["first_order_total_paid"].iloc[0]) == 15.0  # one row per order, both lines
    second = out[out["conversion_id"] == 2]
    assert len(second) == 7 and float(second["total_paid_in_week"].iloc[0]) == 8.0
    assert float(second["lifetime_cumulative_revenue"].iloc[-1]) == 23.0
    assert float(second["conversion_cumulative_revenue"].iloc[-1]) == 8.0


def test_two_conversions_in_one_week(spark):
    out = cohort.customer_info(*star(spark, [(1, 0, "o1"), (2, 1, "o2")], [("o1", 0, 10.0), ("o2", 1, 7.0)])).toPandas()
    assert set(out["conversion_id"]) == {2}  # the first one has no week of its own
    assert set(out["conversion_number"]) == {2}


def test_ids_out_of_date_order(spark):
    out = cohort.customer_info(*star(spark, [(2, 0, "o1"), (1, 21, "o2")], [("o1", 0, 10.0)])).toPandas()
    early = out[out["conversion_id"] == 2]
    assert set(early["conversion_number"]) == {2} and len(early) == 3  # numbered by id, ended by date


def test_customer_weeks_dealt_evenly(spark):
    args = star(spark, [(1, 0, "o1"), (2, 21, "o2")], [("o1", 0, 10.0), ("o2", 22, 7.0), ("o3", 23, 1.5)])
    exact, cast = cohort.customer_info(*args), cohort.customer_info(*args, "double")
    # small rows are not put together again before they become many weeks
    assert "REPARTITION_BY_NUM" in exact._jdf.queryExecution().executedPlan().toString()
    amounts = [f.name for f in cohort.CUSTOMER_INFO if isinstance(f.dataType, T.DecimalType)]
    assert {t for n, t in cast.dtypes if n in amounts} == {"double"} and cast.columns == exact.columns
    assert rows(cast, *cast.columns) == rows(exact.withColumns({c: F.col(c).cast("double") for c in amounts}), *cast.columns)


def test_lines_are_added_up_once(spark, tmp_path):
    lines = [(1, 7, 10.05, 0.1), (1, 5, 0.35, 0.5), (1, 9, 99.0, None), (2, 4, None, 0.1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(i, 1, "5-LOW", dt.datetime(2020, 1, 5 + i)) for i in (1, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "a", "b")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = views.fact(spark, str(tmp_path)).select("order_number", "fk_product", *[F.col(c).cast("string") for c in ("discount_value", "price_paid")])
    # 1.0050 + 0.1750 off and 9.0450 + 0.1750 paid; a line without a discount counts in neither
    assert rows(got, *got.columns) == [(1, 5, "1.18", "9.22"), (2, 4, "0.00", "0.00"), (3, None, "0.00", "0.00")]
    plan = customers.q1(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "lineitem.parquet" not in plan  # read by the written facts alone


def test_write_customer_info(spark):
    df = cohort.customer_info(*star(spark, [(1, 0, "o1")], [("o1", 0, 10.0)]))
    cohort.write_customer_info(df, "customer_info_test", mode="overwrite")
    assert spark.table("customer_info_test").dtypes == [(f.name, f.dataType.simpleString()) for f in cohort.CUSTOMER_INFO]


def test_order_summary_quirks(spark):
    items = spark.createDataFrame(
        [("o1", "c", None, None, None, 2.0), ("o2", "c", "b", "s", 1.0, 2.0), ("o2", "c", "a", "s", 3.0, 4.0), (None, "c", "a", "s", 1.0, 1.0)],
        "order_id string, customer_unique_id string, product_category_name string, seller_id string, price double, review_score double",
    ).withColumns({c: F.lit(None).cast("string") for c in ("seller_state", "customer_state")}).withColumns(
        {"order_value": F.lit(9.0), "customer_tenure_days": F.lit(0), "order_deliver_days": F.lit(1)}
    )
    out = {r["order_id"]: r for r in cohort.order_summary(items).collect()}
    assert set(out) == {"o1", "o2"} and out["o1"]["n_items"] == 1  # an order without items counts one row
    assert out["o2"]["product_category"] == "a" and out["o2"]["seller_count"] == 1


def test_column_functions(spark):
    df = spark.createDataFrame([("$1,234.50", "97%", "t"), ("x", "n/a", "f"), (None, None, "z")], "a string, b string, c string")
    got = [tuple(r) for r in df.select(x.currency("a"), x.percent("b"), x.tf_flag("c")).collect()]
    assert got == [(1234.5, 97.0, True), (None, None, False), (None, None, None)]
    nums = spark.createDataFrame([(-3.0,), (-2.0,), (0.0,), (1.0,), (3.0,), (8.0,), (9.0,), (None,)], "d double")
    bins = [r[0] for r in nums.select(x.cut("d", cleaning.DELAY_EDGES, cleaning.DELAY_LABELS)).collect()]
    assert bins == [None, "on_time", "on_time", "short_delay", "medium_delay", "long_delay", None, None]
    assert [r[0] for r in nums.select(x.clip("d", -2.0, 8.0)).collect()] == [-2.0, -2.0, 0.0, 1.0, 3.0, 8.0, 8.0, None]


def test_floor_days(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2, 0, 0), dt.datetime(2020, 1, 2, 1, 0))], "a timestamp, b timestamp")
    assert df.select(dates.floor_days(F.col("a"), F.col("b"))).first()[0] == -1


def test_fill_group_median_null_key(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (1, 4.0), (None, 5.0)], "g int, v double")
    assert rows(cleaning.fill_group_median(df, ["v"], "g"), "g", "v") == [(1, 2.0), (1, 3.0), (1, 4.0), (None, None)]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    b = spark.createDataFrame([(None, 9)], "k int, w int")
    assert joins.equi_join(a, b, ["k"]).count() == 0
    assert rows(joins.equi_join(a, b, ["k"], null_safe=True), "v", "w") == [(1, 9)]


def test_priority_nan_policy(spark):
    perf = spark.createDataFrame([("a", 1.0, 1.0), ("b", 3.0, 2.0), ("c", None, 3.0)], "seller_id string, avg_rev double, avg_del double")
    omit = {r["seller_id"]: r for r in ranking.priority(perf).collect()}
    spread = {r["seller_id"]: r for r in ranking.priority(perf, "propagate").collect()}
    assert omit["a"]["z_rev"] == pytest.approx(-1.0) and omit["c"]["priority_score"] == omit["c"]["z_del"]
    assert all(r["z_rev"] is None and r["priority_score"] == r["z_del"] for r in spread.values())


def test_p_value():
    # Two-sided p of Student's t from tables.
    for t, df, p in [(2.228, 10, 0.05), (1.96, 1e6, 0.05), (0.0, 5, 1.0), (-12.706, 1, 0.05), (3.169, 10, 0.01)]:
        assert stats.two_sided_p(t, df) == pytest.approx(p, abs=2e-5)


def test_two_sided_as_a_column(spark):
    rows = [(t, d) for t in (0.0, 1e-6, 0.3, -1.0, 1.96, 5.0, -40.0, 1e200) for d in (1.0, 2.5, 30.0, 1e3, 1e6)]
    df = spark.createDataFrame([*rows, (None, 5.0), (1.0, None)], "t double, d double")
    for r in df.select("t", "d", stats.two_sided(F.col("t"), F.col("d")).alias("p")).collect():
        want = stats.two_sided_p(r["t"], r["d"])
        assert r["p"] is None if want is None else r["p"] == pytest.approx(want, abs=1e-6)


def test_welch(spark):
    df = spark.createDataFrame([("test", v) for v in (1.0, 2.0, 3.0)] + [("control", v) for v in (2.0, 4.0, 9.0)], "group string, v double")
    r = stats.welch(df, "v").first()
    assert r["t"] == pytest.approx(-3 / math.sqrt(1 / 3 + 13 / 3)) and 0 < r["p"] < 1


def test_ngrams_and_jaccard(spark):
    df = spark.createDataFrame([("ABCD", "abc"), ("ab", "ab"), ("", "x")], "a string, b string")
    got = df.select(text.ngrams(F.col("a")).alias("x"), text.jaccard(text.ngrams(F.col("a")), text.ngrams(F.col("b")))).collect()
    assert sorted(got[0][0]) == ["abc", "bcd"] and got[0][1] == 0.5
    assert got[1][0] == [] and got[1][1] == 0.0 and got[2][1] == 0.0


def grams(s):
    s = s.lower()
    return {s[i : i + 3] for i in range(len(s) - 2)} if len(s) >= 3 else set()


def greedy(texts, threshold=0.72):
    kept = []
    for t in texts:
        a = grams(t)
        if not any((a or grams(k)) and len(a & grams(k)) / len(a | grams(k)) >= threshold for k in kept):
            kept.append(t)
    return kept


def test_dedup_jaccard_brute_force(spark):
    rng = random.Random(5)
    stems = ["shares rise after strong earnings", "court rules on merger", "oil prices fall again", "ab", ""]
    data = []
    for day in range(4):
        for pos in range(1, 25):
            words = rng.choice(stems)
            if words and rng.random() < 0.5:
                words += rng.choice(["!", " today", " x", " in europe and asia"])
            data.append(("t", dt.date(2024, 1, 1 + day), pos, words))
    page = spark.createDataFrame(data, "ticker string, day date, pos int, headline string")
    got = sentiment.dedup_jaccard(page).collect()
    for day in range(4):
        when = dt.date(2024, 1, 1 + day)
        want = greedy([d[3] for d in data if d[1] == when])
        assert [r["headline"] for r in sorted(got, key=lambda r: r["pos"]) if r["day"] == when] == want


def test_daily_needs_five(spark):
    schema = "ticker string, day date, pos int, label string, conviction double, decay_weight double"
    day = dt.date(2024, 1, 1)
    four = [("a", day, i, "positive", 9.0, None) for i in range(4)]
    five = [("b", day, i, "positive", 9.0 - i, None) for i in range(5)]
    two = [("c", day, i, "positive" if i < 2 else "neutral", 5.0, None) for i in range(6)]
    out = {r["ticker"]: r for r in sentiment.daily(spark.createDataFrame(four + five + two, schema)).collect()}
    assert (out["a"]["score"], out["a"]["consensus_pct"], out["a"]["headline_count"]) == (5.0, 0.0, 4)
    weights = [0.9**i for i in range(5)]
    assert out["b"]["score"] == pytest.approx(sum(w * (9 - i) for i, w in enumerate(weights)) / sum(weights))
    assert out["b"]["momentum"] == 1 and out["b"]["consensus_pct"] == 1.0
    assert out["c"]["consensus_pct"] == 0.0  # fewer than three directional headlines


def test_sector_weight_rules(spark):
    words = spark.createDataFrame(
        [("s", 1, "a", 1.5, "oil", 0.7), ("s", 2, "b", 1.5, "gas", 0.7), ("s", 3, "c", 0.5, "low", 0.7)],
        "sector string, cat_order int, category string, weight double, keyword string, default_weight double",
    )
    news = spark.createDataFrame([("s", "GASOIL"), ("s", "low"), ("u", "oil"), ("s", "turmoil")], "sector string, headline string")
    got = [(r["category"], r["weight"]) for r in sentiment.sector_weight(news, words).collect()]
    assert sorted(got) == sorted([("a", 1.5), ("default", 0.7), ("default", 0.8), ("a", 1.5)])


def brute_exit(bars, start, entry, dist, tp, hold, sell):
    peak, target = entry, round(entry * (1 + tp), 2)
    for i in range(start, len(bars)):
        o, h, l, c, ma = bars[i]
        peak = max(peak, h)
        stop = round(peak - dist, 2)
        if l <= stop:
            return i, min(o, stop), "STOP_LOSS"
        if h >= target:
            return i, target, "TAKE_PROFIT"
        if i - start + 1 >= hold and ma is not None and c < ma:
            return i, o, "TREND_FAIL"
        if sell[i]:
            return i, o, "SENTIMENT_SELL"
    return len(bars) - 1, bars[-1][3], "OPEN"


def test_label_exits_brute_force(spark):
    rng = random.Random(11)
    start, price, raw = dt.date(2024, 1, 1), 100.0, []
    for i in range(260):
        o = price * (1 + rng.uniform(-0.02, 0.02))
        price = o * (1 + rng.uniform(-0.03, 0.03))
        raw.append((o, max(o, price) * 1.01, min(o, price) * 0.99, price))
    means = [None] * 49 + [sum(r[3] for r in raw[i - 49 : i + 1]) / 50 for i in range(49, 260)]
    sell = [i % 41 == 0 for i in range(260)]
    day = lambda i: start + dt.timedelta(days=i)
    bars = spark.createDataFrame(
        [("a", day(i), *r, 1.0) for i, r in enumerate(raw)],
        "ticker string, date date, open double, high double, low double, close double, volume double",
    )
    mood = spark.createDataFrame(
        [("a", day(i), 2.0 if s else 8.0, 0.9, 6) for i, s in enumerate(sell)],
        "ticker string, date date, score double, consensus_pct double, headline_count int",
    )
    entries = [(f"e{i}", "a", day(i), raw[i][0], 7.5 + i % 5) for i in range(0, 260, 3)]
    df = spark.createDataFrame(entries, "trade_id string, ticker string, entry_date date, entry_price double, dist double")
    got = {r["trade_id"]: r for r in trades.label_exits(df, bars, mood).collect()}
    full = [(*r, m) for r, m in zip(raw, means)]
    reasons = set()
    for e in entries:
        i = int(e[0][1:])
        at, px, why = brute_exit(full, i, e[3], e[4], 0.12, 5, sell)
        r = got[e[0]]
        assert (r["exit_date"], r["exit_reason"]) == (day(at), why) and r["exit_price"] == pytest.approx(px)
        reasons.add(why)
    assert {"STOP_LOSS", "TAKE_PROFIT", "SENTIMENT_SELL", "OPEN"} <= reasons


def test_cooldown_skips_do_not_count(spark):
    d = lambda n: dt.date(2024, 1, n)
    df = spark.createDataFrame(
        [("1", "a", d(1), d(2)), ("2", "a", d(5), d(6)), ("3", "a", d(7), d(8)), ("4", "a", d(11), d(12))],
        "trade_id string, ticker string, entry_date date, exit_date date",
    )
    assert rows(trades.cooldown(df), "trade_id") == [("1",), ("3",)]


def test_entry_gate_order(spark):
    day = dt.date(2024, 1, 1)
    days = spark.createDataFrame(
        [("a", day, 0.1, False, 10.0), ("b", day, 0.1, True, 10.0), ("c", day, 0.9, True, 10.0), ("d", day, 0.9, True, None), ("e", day, 0.9, True, 50.0)],
        "ticker string, date date, tech_norm double, above_ma50 boolean, rsi double",
    )
    mood = spark.createDataFrame([("e", day, 7.0, 0.8, 6, 0)], "ticker string, date date, score double, consensus_pct double, headline_count int, momentum int")
    got = rows(signals.entry_gates(days, mood), "ticker", "reason")
    assert got == [("a", "below_ma50"), ("b", "tech_floor"), ("c", "rsi_floor"), ("d", "no_sentiment"), ("e", None)]


def test_curve_ties_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "label int, score double")
    assert evaluation.roc_auc(df).first()["auc"] == pytest.approx(0.75 - 0.125 + 0.0)
    ones = spark.createDataFrame([(1, 0.9), (1, 0.2)], "label int, score double")
    assert evaluation.roc_auc(ones).first()["auc"] is None
    picked = evaluation.threshold_for_recall(df, targets=(0.5, 1.0)).collect()
    assert {r["strategy"]: r["threshold"] for r in picked} == {"recall_50": 0.9, "recall_100": 0.5}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=30))
def test_auc_property(spark, data):
    df = spark.createDataFrame([(y, s / 7) for y, s in data], "label int, score double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    got = evaluation.roc_auc(df).first()["auc"]
    if pos and neg:
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert got == pytest.approx(want)
    recall = [r["recall"] for r in evaluation.pr_curve(df).orderBy("threshold").collect() if r["threshold"] is not None]
    if pos:
        assert recall == sorted(recall, reverse=True)


def test_constant_series_and_short_series(spark):
    df = spark.createDataFrame([("a", i, 5.0) for i in range(9)], "series string, t int, demand double")
    assert {r["scaled"] for r in forecast.minmax(forecast.split(df)).collect()} == {0.0}
    assert forecast.sequences(df).count() == 1 and forecast.sequences(df.filter("t < 8")).count() == 0


def test_verdicts(spark):
    df = spark.createDataFrame([(0.06, 0.6), (0.01, 0.1), (0.01, -0.1), (-0.1, 1.0), (None, 1.0), (float("nan"), 1.0)], "r double, s double")
    got = [r[0] for r in df.select(sweeps.verdict(F.col("r"), F.col("s"))).collect()]
    assert got == ["STRONG_PASS", "PASS", "MARGINAL", "FAIL", "ERROR", "ERROR"]
    assert {n: sweeps.grid_size(g) for n, g in sweeps.GRIDS.items()} == {"quick": 54, "medium": 400, "full": 864, "comprehensive": 3456}


def test_event_risk(spark):
    d = lambda n: dt.date(2024, 1, n)
    cands = spark.createDataFrame([("a", d(1)), ("a", d(4)), ("a", d(6)), ("a", d(7))], "ticker string, date date")
    events = spark.createDataFrame([("a", d(6))], "ticker string, event_date date")
    assert rows(screens.event_risk(cands, events), "date") == [(d(1),), (d(7),)]


def test_stratified_split_fills_missing(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(40)], "c int, cat string")
    out = experiment.stratified_split(df, "c", "cat").groupBy("cat", "group").count()
    assert rows(out, "cat", "group", "count") == [
        ("MISSING", "control", 10), ("MISSING", "test", 10), ("x", "control", 10), ("x", "test", 10)
    ]


def test_coco(spark, tmp_path):
    doc = {
        "images": [{"id": 1, "file_name": "x/a.png"}, {"id": 2, "file_name": "b.png"}],
        "annotations": [
            {"id": 9, "image_id": 1, "category_id": 0, "bbox": [1.0, 2.0, 3.0, 4.0], "area": 12.0},
            {"id": 8, "image_id": 1, "category_id": 1, "bbox": [0.0, 0.0, 1.0, 1.0], "area": 1.0},
        ],
        "categories": [{"id": 0, "name": "Owl"}, {"id": 1, "name": "Cat"}],
    }
    path = tmp_path / "coco.json"
    path.write_text(json.dumps(doc))
    images, annotations, categories = detections.read_coco(spark, str(path))
    got = {r["image_id"]: r for r in detections.to_records(images, annotations).collect()}
    assert got[1]["file_name"] == "a.png" and got[1]["objects"]["id"] == [8, 9]
    assert got[2]["objects"]["bbox"] == []
    assert rows(detections.named(categories.select("id"), categories), "id", "name") == [(0, "Owl"), (1, "Cat")]
    label = detections.label_map({0: "Owl", 1: "Cat"})
    assert categories.select(F.element_at(label, F.col("id").cast("int")).alias("x")).first()["x"] == "Owl"


def test_nest_annotations_has_one_row_for_each_image(spark):
    images = spark.createDataFrame([(1,)], "image_id bigint")
    boxes = spark.range(1000).select(F.lit(1).cast("bigint").alias("image_id"), F.array(F.lit(1.0)).alias("bbox"), F.lit(1).alias("category"), F.lit(1.0).alias("area"), "id")
    (row,) = detections.nest_annotations(images, boxes).collect()
    assert row["objects"]["id"] == list(range(1000))


def test_near_duplicates_of_a_large_group(spark):
    """500 headlines of one day against the greedy rule taken literally."""
    import random

    rng = random.Random(2)
    said = []
    for k in range(500):
        if k % 3 and said:
            words = rng.choice(said).split()
            words[rng.randrange(len(words))] = f"{rng.randrange(10**6)}"
            said.append(" ".join(words))
        else:
            said.append(" ".join(f"{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 9))))
    said += ["", "ab", "ab", said[7], said[8].upper()]
    news = spark.createDataFrame([("t", 1, k, s) for k, s in enumerate(said)], "ticker string, day int, pos long, headline string")
    grams = [{s.lower()[i : i + 3] for i in range(len(s) - 2)} for s in said]
    kept = []
    for k, g in enumerate(grams):
        if not any(g and grams[j] and len(g & grams[j]) / len(g | grams[j]) >= sentiment.SIMILAR for j in kept):
            kept.append(k)
    assert sorted(r["pos"] for r in sentiment.dedup_jaccard(news).collect()) == kept


def test_twenty_thousand_near_copies_on_one_day(spark):
    rng = random.Random(9)
    story = "regulator opens inquiry into battery supplier after factory fire in southern port city".split()
    said = ["regulator opens new terminal in the southern port city"]
    for k in range(20_000):
        words = list(story)
        words[rng.randrange(len(words))] = f"{rng.randrange(10**3)}" if k else words[0]
        said.append(" ".join(words))
    news = spark.createDataFrame([("t", 1, k, s) for k, s in enumerate(said)], "ticker string, day int, pos long, headline string").repartition(8)
    grams = [{s[i : i + 3] for i in range(len(s) - 2)} for s in said]
    kept = []
    for k, g in enumerate(grams):
        if not any(len(g & grams[j]) / len(g | grams[j]) >= sentiment.SIMILAR for j in kept):
            kept.append(k)
    assert len(kept) < 200
    assert sorted(r["pos"] for r in sentiment.dedup_jaccard(news).collect()) == kept


def test_folds_and_rounds_agree(spark):
    rng = random.Random(4)
    stems = ["bank cuts outlook for the second half", "bank raises outlook for the second half", "airline orders forty new jets", "", "ab"]
    rows = []
    for g in (None, "a", "b"):
        for pos in range(60):
            words = rng.choice(stems)
            rows.append((g, 1, pos, words + (f" {rng.randrange(30)}" if words and rng.random() < 0.6 else "")))
    news = spark.createDataFrame(rows, "ticker string, day int, pos int, headline string")
    one, two = ({(r["ticker"], r["pos"]) for r in sentiment.dedup_jaccard(news, fold=n).collect()} for n in (100, 10))
    assert one == two


def test_class_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(1, "Owl", 0.15), (2, "Owl", 0.14), (3, "Fox", 0.9)], "det_id int, label string, score double")
    got = dict(rows(detections.class_counts(df), "label", "n"))
    assert got["Owl"] == 1 and got["Cat"] == 0 and "Fox" not in got


def test_month_files(spark, tmp_path):
    for month, text_ in (("2024-01", "listing_id,price\n1,$5.00\n"), ("2024-02", "listing_id,price\n2,$6.00\nbad,$1.00\n")):
        for kind in ("calendar", "listings"):
            with gzip.open(tmp_path / f"{kind}_{month}.csv.gz", "wt") as f:
                f.write(text_)
        (tmp_path / f"neighbourhoods_{month}.csv").write_text("neighbourhood,neighbourhood_group\nA,B\n")
    calendar = files.read_months(spark, f"{tmp_path}/calendar_*.csv.gz", "listing_id bigint, price string")
    assert rows(calendar.groupBy("data_month").count(), "data_month", "count") == [("2024-01", 1), ("2024-02", 2)]
    assert calendar.cache().filter("_corrupt_record is not null").count() == 1
    raw = spark.read.option("header", True).csv(f"{tmp_path}/calendar_*.csv.gz")
    assert rows(files.months_available(raw), "data_month") == [("2024-01",), ("2024-02",)]
    assert [d.count() for d in files.load_month(spark, tmp_path, "2024-01")] == [1, 1, 1]
    report = files.run_months(["2024-01", "2024-09"], lambda m: [d.count() for d in files.load_month(spark, tmp_path, m)])
    assert [(m, s) for m, s, _ in report] == [("2024-01", "saved"), ("2024-09", "failed")]


def test_write_months_replaces_only_its_months(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "v int, data_month string")
    files.write_months(df, path)
    files.write_months(spark.createDataFrame([(3, "2024-02")], "v int, data_month string"), path)
    assert rows(spark.read.parquet(path), "v") == [(1,), (3,)]


def test_report_csv(spark, tmp_path):
    path = str(tmp_path / "report")
    files.write_report_csv(spark.createDataFrame([(1.23456,)], "pnl double"), path, {"pnl": 2})
    assert spark.read.option("header", True).csv(path).first()["pnl"] == "1.23"


def test_sets_are_compared_exactly_whatever_the_columns():
    """Long texts of a common vocabulary: the rarer elements, not held as columns, are counted where they decide."""
    rng = np.random.default_rng(3)
    base = np.arange(400)
    sets = []
    for _ in range(300):
        own = rng.choice(base, rng.integers(180, 300), replace=False)
        sets.append(np.sort(np.concatenate([own, rng.choice(np.arange(1000, 4000), rng.integers(0, 60), replace=False)])))
        if rng.random() < 0.5:
            old = sets[rng.integers(len(sets))]
            sets.append(np.sort(old[rng.random(len(old)) < 0.85]))
    sets += [sets[5].copy(), np.empty(0, np.int64), np.empty(0, np.int64)]
    places = rng.permutation(len(sets))
    plain = [set(s.tolist()) for s in sets]
    kept = []
    for i in np.argsort(places):
        a = plain[i]
        if not any(a and plain[j] and len(a & plain[j]) / len(a | plain[j]) >= sentiment.SIMILAR for j in kept):
            kept.append(i)
    assert len(kept) < len(sets) - 20
    assert sorted(sentiment._greedy(places, sets, sentiment.SIMILAR, step=64)) == sorted(kept)
    full = [s for s in sets if len(s)]
    for columns in (16, 256, 8_192):
        compared, rows, others = sentiment._Sets(full, sentiment.SIMILAR, columns), np.arange(40), np.arange(40, len(full))
        want = [i for i in rows if not any(len(set(full[i]) & set(full[j])) / len(set(full[i]) | set(full[j])) >= sentiment.SIMILAR for j in others)]
        assert compared.open(rows, others, 32).tolist() == want


def test_holding_days_never_shuffle_the_days(spark):
    d = lambda k: dt.date(2024, 1, 1) + dt.timedelta(k)
    spans = [(1, d(-5), d(3)), (2, d(2), d(2)), (3, d(4), d(40)), (4, d(3), d(2)), (5, d(-9), d(-2)), (6, None, d(3)), (7, d(3), d(3))]
    open_ = [d(k) for k in (0, 1, 2, 5, 6, 9)]
    trades_ = spark.createDataFrame(spans, "trade_id int, entry_date date, exit_date date")
    calendar = spark.createDataFrame([(x,) for x in open_ * 2 + [None]], "date date")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = trades.holding_days(trades_, calendar).select("trade_id", "date")
        got = sorted(tuple(r) for r in days.collect())
        plan = days._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == sorted((i, x) for i, a, z in spans if a for x in open_ if a <= x <= z)
    assert "Join" not in plan
    assert trades.holding_days(trades_, calendar.limit(0)).count() == 0


def test_exits_of_many_tickers_are_labelled_once(spark, monkeypatch):
    """Tickers share calls, and the cooldown reads the labelled trades once."""
    monkeypatch.setattr(trades, "PARTS", 3)
    rng, d = random.Random(2), lambda k: dt.date(2024, 1, 1) + dt.timedelta(k)
    bars, opened = [], []
    for ticker in range(20):
        for k in range(45):
            if rng.random() < 0.8:
                close = 100 + rng.uniform(-11, 11)
                bars.append((ticker, d(k), close, close + 2, close - 2, close, 5.0))
        opened += [(f"{ticker}-{k}", ticker, d(k), 100.0, 20.0) for k in range(0, 45, 7)]
    opened += [("none", 99, d(0), 100.0, 20.0), ("null", None, d(0), 100.0, 20.0)]
    days = spark.createDataFrame(bars, "ticker long, date date, open double, high double, low double, close double, volume double")
    starts = spark.createDataFrame(opened, "trade_id string, ticker long, entry_date date, entry_price double, dist double")
    got = {r["trade_id"]: (r["exit_date"], r["exit_price"], r["exit_reason"]) for r in trades.label_exits(starts, days).collect()}
    want = {}
    for i, ticker, start, price, dist in opened:
        own = sorted(b for b in bars if b[0] == ticker)
        if start not in [b[1] for b in own]:
            continue
        own, peak = [b for b in own if b[1] >= start], price
        want[i] = (own[-1][1], own[-1][5], "OPEN")
        for _, day, o, h, low, c, _ in own:
            peak = max(peak, h)
            stop = math.floor((peak - dist) * 100 + 0.5) / 100
            if low <= stop:
                want[i] = (day, min(o, stop), "STOP_LOSS")
                break
            if h >= 112.0:
                want[i] = (day, 112.0, "TAKE_PROFIT")
                break
    assert got == want and len({w[2] for w in want.values()}) > 1
    cooled = trades.cooldown(trades.label_exits(starts, days))
    assert cooled.columns == [*starts.columns, "take_profit_pct", "trend_min_hold", "exit_date", "exit_price", "exit_reason"]
    plan = cooled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInPandas") == 1


def test_delivery_days_without_a_second_pass(spark):
    rows_ = [(1, "a", dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 4)), (2, "a", dt.datetime(2024, 1, 5), None), (3, None, dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 8))]
    items = spark.createDataFrame(rows_, "order_id int, customer_unique_id string, order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz")
    slim = cohort.delivered(items)
    assert {(r["order_id"], r["order_deliver_days"]) for r in slim.collect()} == {
        (r["order_id"], r["order_deliver_days"]) for r in cohort.tenure(items).collect()
    }
    assert "Exchange" not in slim._jdf.queryExecution().executedPlan().toString()


def test_order_summary_reads_the_items_once(spark):
    folder = "/root/testdata/sf0.001"
    plan = customers.summary(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [l_orderkey") == 1  # tenure comes from the orders alone
    slim, full = views.tenured_items(spark, folder), cohort.tenure(views.items(spark, folder))
    assert sorted(slim.columns) == sorted(full.columns)
    assert slim.count() == full.count() and slim.select(*full.columns).exceptAll(full).count() == 0


def test_order_summary_counts_sellers_without_nulls(spark):
    schema = "order_id string, customer_unique_id string, seller_id string, price double, review_score double"
    data = [("o1", "c", "s", 1.0, None), ("o1", "c", "s", 2.0, None), ("o1", "c", "t", 3.0, 1.0), ("o1", "c", None, None, 2.0), ("o2", "c", None, None, None)]
    items = spark.createDataFrame(data, schema).withColumns(
        {c: F.lit(None).cast("string") for c in ("product_category_name", "seller_state", "customer_state")}
    ).withColumns({"order_value": F.lit(9.0), "customer_tenure_days": F.lit(0), "order_deliver_days": F.lit(1)})
    out = cohort.order_summary(items)
    assert rows(out, "order_id", "n_items", "seller_count") == [("o1", 4, 2), ("o2", 1, 0)]
    # one pair of aggregates; a distinct count beside the modes makes it four
    assert out._jdf.queryExecution().executedPlan().toString().count("ObjectHashAggregate") == 2


def test_groups_read_the_items_once(spark):
    folder = "/root/testdata/sf0.001"
    for query in (summaries.q_balance, summaries.q_category_share, summaries.q_welch, summaries.q_cohens_d):
        plan = query(spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "l_orderkey" not in plan  # split and measures both come from the written orders
    got = summaries.grouped(spark, folder, "n_items")
    orders = customers.summary(spark, folder)
    want = experiment.with_groups(orders, summaries.split(orders), "customer_unique_id").select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_gram_sets_are_compact_and_keep_all_letters(spark):
    texts = ["", "ab", None, "abcabc abd", "größe ģ ж", "日本語の見出し", "a\U0001f600b\U0001f600c", "same ab日"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: bytes(r["g"]) for r in df.select("i", sentiment._grams("t").alias("g")).collect()}
    for i, t in enumerate(texts):
        code = lambda x: (ord(x[0]) << 42) | (ord(x[1]) << 21) | ord(x[2])
        want = sorted({code((t or "")[k : k + 3]) for k in range(len(t or "") - 2)})
        assert sentiment._set(got[i]).tolist() == want
    assert len(got[3]) == 4 * len(set(texts[3][k : k + 3] for k in range(len(texts[3]) - 2)))


def test_only_sets_of_like_size_are_compared():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 40, n)) for n in np.repeat([20, 200, 2_000], 100)]
    own = sentiment._Sets([*sets, *[s[:-1] for s in sets]], sentiment.SIMILAR)
    met, near = [], own.near
    own.near = lambda rows, others: met.append(len(rows) * len(others)) or near(rows, others)
    rows = np.arange(300)
    assert own.open(rows, np.arange(300, 600)).tolist() == []
    assert own.open(rows[:100], np.arange(400, 600)).tolist() == rows[:100].tolist()
    # 300 x 300 and 100 x 200 pairs in all
    assert sum(met) <= 3 * 100 * 200

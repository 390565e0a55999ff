"""Aggregates, statistics, experiment and dashboard tables."""

from pyspark.sql import functions as F

from ..session import stored
from ..operators import aggregates as agg
from ..operators import cohort, dashboard, experiment, ordered, ranking, stats
from . import views as v
from .customers import summary
from .registry import query

M = v.mean_sql


def exact(df, *cols):
    return df.withColumns({c: v.money(c) for c in cols})


@query(
    "q_price_trend",
    f"SELECT data_month, neighbourhood_cleansed, {M('calendar_price')} AS avg_price FROM v_calendar GROUP BY ALL",
)
def q_price_trend(spark, folder):
    return agg.price_trend(exact(v.calendar(spark, folder), "calendar_price"), ["data_month", "neighbourhood_cleansed"])


@query("q_price_by_month", f"SELECT data_month, {M('calendar_price')} AS avg_price FROM v_calendar GROUP BY 1")
def q_price_by_month(spark, folder):
    return agg.price_trend(exact(v.calendar(spark, folder), "calendar_price"), ["data_month"])


@query("q_nunique", "SELECT neighbourhood_cleansed, count(DISTINCT listing_id) AS n_unique FROM v_calendar GROUP BY 1")
def q_nunique(spark, folder):
    return agg.nunique_by(v.calendar(spark, folder), ["neighbourhood_cleansed"], "listing_id")


@query("q_value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def q_value_counts(spark, folder):
    return agg.value_counts(v.table(spark, folder, "orders"), "o_orderpriority")


@query(
    "q_mean_of_means",
    f"""SELECT data_month, neighbourhood_cleansed, round(avg(calendar_price) + 1e-7, 4) AS calendar_price, round(avg(booked) + 1e-9, 6) AS booked FROM (
 SELECT data_month, neighbourhood_cleansed, listing_id, {M('calendar_price')} AS calendar_price, avg((available = 'f')::int) AS booked
 FROM v_calendar GROUP BY ALL) GROUP BY ALL""",
)
def q_mean_of_means(spark, folder):
    days = exact(v.calendar(spark, folder), "calendar_price").withColumn("booked", (F.col("available") == "f").cast("int"))
    out = agg.mean_of_means(
        days,
        ["data_month", "neighbourhood_cleansed", "listing_id"],
        ["data_month", "neighbourhood_cleansed"],
        ["calendar_price", "booked"],
    )
    # A mean of few cents may end in an exact 5; the shift makes both engines round it the same way.
    return out.withColumns(
        {"calendar_price": F.round(F.col("calendar_price") + 1e-7, 4), "booked": F.round(F.col("booked") + 1e-9, 6)}
    )


@query(
    "q_occupancy",
    "SELECT data_month, coalesce(count(*) FILTER (available = 'f')::double / nullif(count(*) FILTER (available IN ('f', 't')), 0) * 100, 0) AS occupancy_rate FROM v_calendar GROUP BY 1",
)
def q_occupancy(spark, folder):
    return agg.occupancy(v.calendar(spark, folder))


@query(
    "q_crosstab",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""",
)
def q_crosstab(spark, folder):
    return agg.crosstab(v.table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "q_mean_std",
    f"SELECT o_orderstatus, {M('o_totalprice')} AS mean_o_totalprice, round(stddev_samp(o_totalprice), 4) AS std_o_totalprice FROM orders GROUP BY 1",
)
def q_mean_std(spark, folder):
    out = agg.mean_std(exact(v.table(spark, folder, "orders"), "o_totalprice"), ["o_orderstatus"], ["o_totalprice"])
    return out.withColumn("std_o_totalprice", F.round("std_o_totalprice", 4))


CORR = [f"bill_{i}" for i in range(1, 7)] + [f"pay_{i}" for i in range(1, 7)]


@query(
    "q_corr_target",
    "WITH c AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", corr({c}, target) AS corr FROM v_credit" for c in CORR)
    + """) SELECT "column", round(corr, 6) AS corr FROM (SELECT * FROM c ORDER BY corr DESC LIMIT 3) UNION ALL
SELECT "column", round(corr, 6) AS corr FROM (SELECT * FROM c ORDER BY corr LIMIT 3)""",
)
def q_corr_target(spark, folder):
    out = stats.corr_with(v.credit(spark, folder), "target", CORR, top=3, bottom=3)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    "q_quantiles",
    "SELECT o_orderpriority, count(*) AS n, round(quantile_cont(o_totalprice, 0.5), 6) AS q50, round(quantile_cont(o_totalprice, 0.95), 6) AS q95 FROM orders GROUP BY 1",
)
def q_quantiles(spark, folder):
    q = ordered.quantiles(v.table(spark, folder, "orders"), ["o_totalprice"], [0.5, 0.95], ["o_orderpriority"])
    return q.select(
        "o_orderpriority", "n", F.round(F.get("q", F.lit(0)), 6).alias("q50"), F.round(F.get("q", F.lit(1)), 6).alias("q95")
    )


@query(
    "q_histogram",
    "SELECT l_returnflag, floor(l_extendedprice / 5000)::bigint AS bin, count(*) AS n FROM lineitem GROUP BY ALL",
)
def q_histogram(spark, folder):
    return stats.histogram(v.table(spark, folder, "lineitem"), "l_extendedprice", 0.0, 5000.0, "l_returnflag")


@query(
    "q_box",
    """WITH q AS (SELECT o_orderstatus, quantile_cont(o_totalprice, 0.25) AS q25, quantile_cont(o_totalprice, 0.5) AS q50, quantile_cont(o_totalprice, 0.75) AS q75 FROM orders GROUP BY 1)
SELECT o_orderstatus, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
 min(o_totalprice) FILTER (o_totalprice BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS low,
 max(o_totalprice) FILTER (o_totalprice BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS high
FROM orders JOIN q USING (o_orderstatus) GROUP BY ALL""",
)
def q_box(spark, folder):
    out = stats.box(v.table(spark, folder, "orders"), "o_totalprice", "o_orderstatus")
    return out.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})


@query(
    "q_density",
    """WITH s AS (SELECT o_orderstatus, count(*)::double AS n, stddev_samp(o_totalprice) * pow(count(*), -0.2) AS h FROM orders GROUP BY 1)
SELECT o_orderstatus, grid, round(1e6 * sum(exp(-pow((o_totalprice - grid) / h, 2) / 2)) / (n * h * sqrt(2 * pi())), 6) AS density
FROM orders JOIN s USING (o_orderstatus), (SELECT unnest(generate_series(0, 500000, 50000))::double AS grid) GROUP BY o_orderstatus, grid, n, h""",
)
def q_density(spark, folder):
    out = stats.density(v.table(spark, folder, "orders"), "o_totalprice", "o_orderstatus", range(0, 500001, 50000))
    return out.withColumn("density", F.round(F.col("density") * 1e6, 6))


KSI_SHARES = ", ".join(
    f"count(*) FILTER ({f})::double / count(*) AS share_{f}" for f in dashboard.FACTORS
)


@query("q_kpis", f"SELECT count(DISTINCT event_id) AS events, {KSI_SHARES} FROM v_ksi")
def q_kpis(spark, folder):
    return dashboard.kpis(v.collisions(spark, folder))


PERIOD = """CASE WHEN hour(ts) < 5 THEN 'late_night' WHEN hour(ts) < 9 THEN 'morning' WHEN hour(ts) < 14 THEN 'midday'
 WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'night' END"""


@query("q_time_mix", f"SELECT {PERIOD} AS period, count(*) AS n, count(*)::double / sum(count(*)) OVER () AS share FROM v_ksi GROUP BY 1")
def q_time_mix(spark, folder):
    return dashboard.time_mix(v.collisions(spark, folder))


@query(
    "q_cross_filter",
    f"SELECT count(DISTINCT event_id) AS events, {KSI_SHARES} FROM v_ksi WHERE year(ts) BETWEEN 2023 AND 2024 AND {PERIOD} IN ('night', 'morning') AND aggressive AND NOT speeding",
)
def q_cross_filter(spark, folder):
    kept = dashboard.apply_filters(
        v.collisions(spark, folder), (2023, 2024), ("night", "morning"), {"aggressive": True, "speeding": False}
    )
    return dashboard.kpis(kept)


@query(
    "q_hotspots",
    "SELECT intersection, count(DISTINCT event_id) AS events, round(avg(lat), 4) AS lat, round(avg(lon), 4) AS lon FROM v_ksi GROUP BY 1 ORDER BY events DESC, intersection LIMIT 20",
)
def q_hotspots(spark, folder):
    return dashboard.hotspots(v.collisions(spark, folder)).withColumns({"lat": F.round("lat", 4), "lon": F.round("lon", 4)})


# -- ranking of sellers ------------------------------------------------------------------------

v.SQL["v_tenure"] = """SELECT *,
 date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS order_deliver_days FROM v_items"""
v.SQL["v_perf"] = """SELECT seller_id, avg_rev, coalesce(avg_del, avg(avg_del) OVER ()) AS avg_del FROM (
 SELECT seller_id, sum(review_score)::double / count(review_score) AS avg_rev, sum(order_deliver_days)::double / count(order_deliver_days) AS avg_del
 FROM v_tenure WHERE seller_id IS NOT NULL GROUP BY seller_id)"""
v.SQL["v_priority"] = """SELECT seller_id, avg_rev, avg_del, (avg_rev - avg(avg_rev) OVER ()) / stddev_pop(avg_rev) OVER () AS z_rev,
 -(avg_del - avg(avg_del) OVER ()) / stddev_pop(avg_del) OVER () AS z_del FROM v_perf"""
v.SQL["v_scored"] = """SELECT *, round((z_rev + z_del) / 2, 9) AS priority_score FROM v_priority"""
v.SQL["v_ranked"] = f"""SELECT i.*, CASE WHEN priority_score IS NOT NULL THEN row_number() OVER (PARTITION BY product_id ORDER BY priority_score DESC NULLS LAST, {', '.join(v.ITEM_TIE)}) END AS rank, priority_score
FROM v_tenure i LEFT JOIN (SELECT seller_id, CASE WHEN seller_id % 10 <> 0 THEN priority_score END AS priority_score FROM v_scored) USING (seller_id)"""
v.SQL["v_filled"] = """SELECT * REPLACE (coalesce(rank, max(rank) OVER (PARTITION BY product_id) + 1) AS rank) FROM v_ranked WHERE product_id IS NOT NULL"""


def delivered(spark, folder):
    """Items with their delivery days; the tenure of customers, a second pass over all items, is not needed here."""
    return cohort.delivered(v.items(spark, folder))


def sellers(spark, folder):
    # One row per seller, read several times by the standard scores.
    return stored(ranking.seller_perf(delivered(spark, folder)), "sellers")


def scored(spark, folder):
    return rounded_priority(sellers(spark, folder))


def rounded_priority(perf):
    return ranking.priority(perf).withColumn("priority_score", F.round("priority_score", 9))


#: What is ranked, and what the sellers' scores are made of.
RANKED = [*v.ITEM_TIE, "product_id", "seller_id", "customer_unique_id", "review_score", "order_deliver_days"]


def with_score(items, scores):
    """Order rows with the score of their seller; one seller in ten is left without."""
    scores = scores.select(
        "seller_id", F.when(F.col("seller_id") % 10 != 0, F.col("priority_score")).alias("priority_score")
    )
    return items.join(scores, "seller_id", "left")


def to_rank(spark, folder):
    return with_score(delivered(spark, folder).select(*RANKED), scored(spark, folder))


def delivered_items(spark, folder):
    """Order rows, joined and written once: the sellers' scores and the ranking read them."""
    return stored(delivered(spark, folder).select(*RANKED), "items")


def ranked(items):
    scores = rounded_priority(stored(ranking.seller_perf(items), "sellers"))
    return ranking.rank_first(with_score(items, scores), "product_id", "priority_score", v.ITEM_TIE, sizes=items)


def filled(items):
    return ranking.fill_worst(ranked(items), "product_id", sizes=items)


RANK_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "price", "rank"]
RANK_SQL = "order_id, order_item_id::bigint AS order_item_id, product_id, seller_id, price, rank::bigint AS rank"


@query("q_seller_perf", "SELECT seller_id, round(avg_rev, 6) AS avg_rev, round(avg_del, 6) AS avg_del FROM v_perf")
def q_seller_perf(spark, folder):
    return ranking.seller_perf(delivered(spark, folder)).withColumns(
        {"avg_rev": F.round("avg_rev", 6), "avg_del": F.round("avg_del", 6)}
    )


@query(
    "q_priority",
    "SELECT seller_id, round(z_rev, 6) AS z_rev, round(z_del, 6) AS z_del, round((z_rev + z_del) / 2, 6) AS priority_score FROM v_priority",
)
def q_priority(spark, folder):
    out = ranking.priority(sellers(spark, folder))
    return out.select("seller_id", *[F.round(c, 6).alias(c) for c in ("z_rev", "z_del", "priority_score")])


@query("q_rank_first", f"SELECT {RANK_SQL} FROM v_ranked")
def q_rank_first(spark, folder):
    return ranked(delivered_items(spark, folder)).select(*RANK_COLS)


@query("q_rank_fill_worst", f"SELECT {RANK_SQL} FROM v_filled")
def q_rank_fill_worst(spark, folder):
    return filled(delivered_items(spark, folder)).select(*RANK_COLS)


TOPK = "SELECT product_id, list(seller_id ORDER BY rank, seller_id) AS topk FROM (SELECT DISTINCT product_id, seller_id, rank FROM v_filled WHERE rank <= 3) GROUP BY product_id"
v.SQL["v_topk"] = TOPK


@query("q_topk_list", "SELECT product_id, array_to_string(topk, ',') AS topk FROM v_topk")
def q_topk_list(spark, folder):
    best = ranking.rank_within(to_rank(spark, folder), "product_id", "priority_score", v.ITEM_TIE, 3)
    lists = ranking.topk_list(best, "product_id", "seller_id", "rank", 3)
    return lists.withColumn("topk", F.array_join(F.transform("topk", lambda x: x.cast("string")), ","))


@query(
    "q_top_groups_trend",
    f"""WITH top AS (SELECT neighbourhood_cleansed FROM v_calendar GROUP BY 1 ORDER BY count(DISTINCT listing_id) DESC, 1 LIMIT 5)
SELECT data_month, neighbourhood_cleansed, {M('calendar_price')} AS avg_price FROM v_calendar WHERE neighbourhood_cleansed IN (SELECT * FROM top) GROUP BY ALL""",
)
def q_top_groups_trend(spark, folder):
    days = exact(v.calendar(spark, folder), "calendar_price")
    return agg.price_trend(
        ranking.in_top_groups(days, "neighbourhood_cleansed", "listing_id"), ["data_month", "neighbourhood_cleansed"]
    )


@query(
    "q_most_frequent",
    """SELECT 'most_frequent' AS what, product_id, n FROM (SELECT product_id, count(*) AS n FROM v_items WHERE product_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1)
UNION ALL SELECT 'first_with_min', product_id, n FROM (SELECT product_id, count(DISTINCT seller_id) AS n FROM v_items WHERE product_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT seller_id) >= 5 ORDER BY n DESC, 1 LIMIT 1)""",
)
def q_most_frequent(spark, folder):
    items = v.items(spark, folder)
    a = ranking.most_frequent(items, "product_id").withColumn("what", F.lit("most_frequent"))
    b = ranking.first_with_min(items, "product_id", "seller_id").withColumn("what", F.lit("first_with_min"))
    return a.unionByName(b)


@query(
    "q_top_sellers",
    """WITH p AS (SELECT product_id FROM v_items WHERE product_id IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
s AS (SELECT DISTINCT seller_id FROM v_items WHERE product_id = (SELECT product_id FROM p) AND seller_id IS NOT NULL)
SELECT row_number() OVER (ORDER BY priority_score DESC, seller_id) AS rank, seller_id, round(priority_score, 6) AS priority_score, round(avg_rev, 6) AS mean_review_score, round(avg_del, 6) AS mean_delivery_days
FROM v_scored JOIN s USING (seller_id) ORDER BY priority_score DESC, seller_id LIMIT 5""",
)
def q_top_sellers(spark, folder):
    items = v.items(spark, folder)
    product = ranking.most_frequent(items, "product_id").select("product_id").scalar()
    out = ranking.top_sellers(items, scored(spark, folder), product)
    return out.withColumns(
        {c: F.round(c, 6) for c in ("priority_score", "mean_review_score", "mean_delivery_days")}
    )


@query("q_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def q_top_n(spark, folder):
    orders = v.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ranking.top_n(orders, [F.desc("o_totalprice"), "o_orderkey"], 25)


@query(
    "q_extremes",
    """SELECT *, 'largest' AS side FROM (SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 3)
UNION ALL SELECT *, 'smallest' FROM (SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 3)""",
)
def q_extremes(spark, folder):
    return ranking.extremes(v.table(spark, folder, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 3, ["c_custkey"])


@query(
    "q_keep_first",
    "SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) = 1)",
)
def q_keep_first(spark, folder):
    orders = v.table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    return ranking.keep_first(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


# -- experiment -----------------------------------------------------------------------------------

v.SQL["v_split"] = """
SELECT customer_unique_id, product_category, CASE WHEN rn <= floor(0.5 * n) THEN 'test' ELSE 'control' END AS "group" FROM (
 SELECT *, row_number() OVER (PARTITION BY product_category ORDER BY md5('42' || customer_unique_id), customer_unique_id) AS rn, count(*) OVER (PARTITION BY product_category) AS n
 FROM (SELECT customer_unique_id, coalesce(arg_min_null(product_category, order_id), 'MISSING') AS product_category FROM v_summary GROUP BY 1))
"""
UNIT = "(('0x' || substr(md5('42' || customer_unique_id), 1, 8))::bigint / 4294967296.0)"
v.SQL["v_assign"] = f"""SELECT customer_unique_id, CASE WHEN {UNIT} < 0.5 THEN 'test' ELSE 'control' END AS "group"
 FROM (SELECT DISTINCT customer_unique_id FROM v_items WHERE customer_unique_id IS NOT NULL)"""
v.SQL["v_grouped"] = 'SELECT v_summary.*, "group" FROM v_summary JOIN v_split USING (customer_unique_id)'


def split(orders):
    return experiment.stratified_split(orders, "customer_unique_id", "product_category", order=["order_id"])


def grouped(spark, folder, *measures):
    """Orders with their group.  The orders are read for the split and for the measures: written once."""
    wanted = ["order_id", "customer_unique_id", "product_category", *measures]
    orders = stored(summary(spark, folder).select(*wanted), "orders")
    return experiment.with_groups(orders, split(orders), "customer_unique_id")


@query("q_stratified_split", "SELECT * FROM v_split")
def q_stratified_split(spark, folder):
    return split(summary(spark, folder))


@query("q_assign", "SELECT * FROM v_assign")
def q_assign(spark, folder):
    return experiment.assign(v.items(spark, folder), "customer_unique_id")


@query(
    "q_balance",
    f"""SELECT "group", {M('order_value')} AS avg_order_value, round(avg(customer_tenure_days), 4) AS avg_tenure_days, round(avg(n_items), 4) AS avg_items_per_ord,
 round(avg((coalesce(order_value > 100, false))::int), 6) AS pct_large_orders FROM v_grouped GROUP BY 1""",
)
def q_balance(spark, folder):
    out = experiment.balance(exact(grouped(spark, folder, "order_value", "customer_tenure_days", "n_items"), "order_value"))
    return out.withColumns(
        {"avg_tenure_days": F.round("avg_tenure_days", 4), "avg_items_per_ord": F.round("avg_items_per_ord", 4), "pct_large_orders": F.round("pct_large_orders", 6)}
    )


@query(
    "q_category_share",
    """SELECT "group", product_category, count(*) AS n, count(*)::double / sum(count(*)) OVER (PARTITION BY "group") AS share FROM v_grouped WHERE product_category IS NOT NULL GROUP BY "group", product_category""",
)
def q_category_share(spark, folder):
    return agg.share(grouped(spark, folder), "group", "product_category")


WELCH = """WITH a AS (SELECT avg(x) FILTER (g = 'test') AS ma, avg(x) FILTER (g = 'control') AS mb, var_samp(x) FILTER (g = 'test') AS va, var_samp(x) FILTER (g = 'control') AS vb,
  count(x) FILTER (g = 'test') AS na, count(x) FILTER (g = 'control') AS nb FROM (SELECT "group" AS g, review_score AS x FROM v_grouped))"""


@query(
    "q_welch",
    f"""WITH RECURSIVE {WELCH.removeprefix('WITH ')},
s AS (SELECT (ma - mb) / sqrt(va / na + vb / nb) AS t, pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)) AS df FROM a),
v AS (SELECT *, df / (df + t * t) < (df / 2 + 1) / (df / 2 + 2.5) AS near FROM s),
e AS (SELECT t, df, near, CASE WHEN near THEN df / 2 ELSE 0.5::double END AS a, CASE WHEN near THEN 0.5::double ELSE df / 2 END AS b,
 CASE WHEN near THEN df / (df + t * t) ELSE t * t / (df + t * t) END AS x, CASE WHEN near THEN t * t / (df + t * t) ELSE df / (df + t * t) END AS y FROM v),
f AS (SELECT 0 AS m, a, b, x, 1.0::double AS c, 1 / (1 - (a + b) * x / (a + 1)) AS d, 1 / (1 - (a + b) * x / (a + 1)) AS h FROM e
 UNION ALL SELECT m, a, b, x, 1 + o / c, 1 / (1 + o * d), h * (1 + o / c) / (1 + o * d) FROM (
  SELECT m, a, b, x, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m)) AS o, 1 + w / c AS c, 1 / (1 + w * d) AS d, h * (1 + w / c) / (1 + w * d) AS h FROM (
   SELECT m + 1 AS m, a, b, x, c, d, h, (m + 1) * (b - (m + 1)) * x / ((a - 1 + 2 * (m + 1)) * (a + 2 * (m + 1))) AS w FROM f WHERE m < 1000))),
p AS (SELECT t, df, near, exp(lgamma(e.a + e.b) - lgamma(e.a) - lgamma(e.b) + e.a * ln(e.x) + e.b * ln(y)) * h / e.a AS i FROM e, f WHERE m = 1000)
SELECT 'review_score' AS measure, round(t, 6) AS t, round(df, 4) AS df, round(CASE WHEN near THEN i ELSE 1 - i END, 6) AS p FROM p""",
)
def q_welch(spark, folder):
    out = stats.welch(grouped(spark, folder, "review_score"), "review_score")
    return out.withColumns({"t": F.round("t", 6), "df": F.round("df", 4), "p": F.round("p", 6)})


@query(
    "q_cohens_d",
    f"""{WELCH.replace('review_score', 'order_deliver_days')} SELECT 'order_deliver_days' AS measure, round((mb - ma) / sqrt((va + vb) / 2), 6) AS d FROM a""",
)
def q_cohens_d(spark, folder):
    out = stats.cohens_d(grouped(spark, folder, "order_deliver_days"), "order_deliver_days", lower_is_better=True)
    return out.withColumn("d", F.round("d", 6))


@query(
    "q_counterfactual",
    """WITH e AS (SELECT "group", review_score, order_deliver_days, seller_id, CASE WHEN "group" = 'control' THEN seller_id ELSE topk[1] END AS sim
 FROM v_filled JOIN v_assign USING (customer_unique_id) LEFT JOIN v_topk USING (product_id))
SELECT "group", round(avg(review_score), 6) AS mean_review_score, round(stddev_samp(review_score), 6) AS std_review_score,
 round(avg(order_deliver_days), 6) AS mean_order_deliver_days, round(stddev_samp(order_deliver_days), 6) AS std_order_deliver_days FROM e WHERE sim = seller_id GROUP BY 1""",
)
def q_counterfactual(spark, folder):
    items = delivered_items(spark, folder)
    rows = filled(items)
    groups = experiment.assign(items, "customer_unique_id")
    lists = ranking.topk_list(rows, "product_id", "seller_id", "rank", 3)
    # the lists first: the rows already lie by product
    listed = experiment.with_groups(rows.join(lists, "product_id", "left"), groups, "customer_unique_id")
    out = agg.mean_std(experiment.counterfactual(listed), ["group"], ["review_score", "order_deliver_days"])
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "group"})

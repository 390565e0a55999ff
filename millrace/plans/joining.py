"""Joins and set operations."""

from pyspark.sql import functions as F

from ..operators import cleaning, joins, sweeps, timeseries as ts, trades
from . import cleaning as plan_cleaning
from . import views as v
from .registry import query


@query(
    "q_order_items",
    """SELECT order_id, customer_unique_id, order_item_id::bigint AS order_item_id, product_id, seller_id, price, product_category_name,
 seller_state, customer_state FROM v_items""",
)
def q_order_items(spark, folder):
    return joins.order_items(*v.market_tables(spark, folder)).select(
        "order_id", "customer_unique_id", "order_item_id", "product_id", "seller_id", "price",
        "product_category_name", "seller_state", "customer_state",
    )


@query(
    "q_review_fanout",
    """WITH r AS (SELECT l_orderkey AS order_id, l_linenumber % 5 + 1 AS review_score FROM lineitem WHERE l_returnflag = 'A')
SELECT o_orderkey AS order_id, count(*) AS n_rows, sum(review_score)::bigint AS review_sum FROM orders
 LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN r ON r.order_id = o_orderkey GROUP BY 1""",
)
def q_review_fanout(spark, folder):
    reviews = (
        v.table(spark, folder, "lineitem")
        .filter("l_returnflag = 'A'")
        .select(F.col("l_orderkey").alias("order_id"), (F.col("l_linenumber") % 5 + 1).alias("review"))
    )
    full = joins.order_items(*v.market_tables(spark, folder), reviews=reviews)
    return full.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("review").alias("review_sum"))


@query(
    "q_left_suffix",
    """SELECT c.key, c.name AS name_x, n.name AS name_y, c.bal FROM (SELECT c_nationkey AS key, c_name AS name, c_acctbal AS bal FROM customer) c
 LEFT JOIN (SELECT n_nationkey AS key, n_name AS name FROM nation WHERE n_regionkey < 3) n ON n.key = c.key""",
)
def q_left_suffix(spark, folder):
    left = v.table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal")
    )
    right = v.table(spark, folder, "nation").filter("n_regionkey < 3").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")
    )
    return joins.left_suffix(left, right, ["key"])


@query(
    "q_calendar_listings",
    """SELECT listing_id, date, calendar_price, s_name AS id_name, s_acctbal AS bal
FROM v_calendar LEFT JOIN supplier ON s_suppkey = listing_id AND s_acctbal > 0""",
)
def q_calendar_listings(spark, folder):
    listings = v.table(spark, folder, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("id_name"), F.col("s_acctbal").alias("bal")
    )
    days = v.calendar(spark, folder).select("listing_id", "date", "calendar_price")
    return joins.left_on(days, listings, "listing_id", "id").drop("id")


@query(
    "q_semi",
    "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 10)",
)
def q_semi(spark, folder):
    small = v.table(spark, folder, "part").filter("p_size < 10")
    lines = v.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return joins.semi(lines, small, "l_partkey", "p_partkey")


@query(
    "q_anti_mismatch",
    """SELECT o_orderkey AS key, 'left_only' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT DISTINCT l_orderkey, 'right_only' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""",
)
def q_anti_mismatch(spark, folder):
    orders, lines = v.table(spark, folder, "orders"), v.table(spark, folder, "lineitem")
    left = joins.key_mismatch(orders, lines, "o_orderkey", "l_orderkey").filter("side = 'left_only'")
    right = joins.key_mismatch(orders.filter("o_orderstatus <> 'P'"), lines, "o_orderkey", "l_orderkey")
    return left.unionByName(right.filter("side = 'right_only'"))


@query(
    "q_inner",
    "SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL",
)
def q_inner(spark, folder):
    t = lambda n: v.table(spark, folder, n)
    return (
        t("customer")
        .join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .groupBy("n_name", "r_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "q_agg_back",
    """SELECT o_orderkey, min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_ts, max(o_totalprice) OVER (PARTITION BY o_custkey) AS best,
 count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""",
)
def q_agg_back(spark, folder):
    orders = v.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    back = joins.agg_back(
        orders,
        ["o_custkey"],
        [F.min("o_orderdate").alias("first_ts"), F.max("o_totalprice").alias("best"), F.count(F.lit(1)).alias("n")],
    )
    return back.select("o_orderkey", "first_ts", "best", "n")


@query(
    "q_lookup_default",
    """SELECT b.ticker, b.date, coalesce(s.demand, 0.0) AS demand FROM v_bars b
 LEFT JOIN (SELECT o_custkey AS ticker, cast(o_orderdate as date) AS date, max(o_totalprice) AS demand FROM orders GROUP BY ALL) s
 ON s.ticker = b.ticker AND s.date = b.date""",
)
def q_lookup_default(spark, folder):
    series = (
        v.table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("ticker"), F.to_date("o_orderdate").alias("date"))
        .agg(F.max("o_totalprice").alias("demand"))
    )
    bars = v.bars(spark, folder).select("ticker", "date")
    return ts.lookup(bars, series, ["ticker", "date"], "demand", 0.0)


@query(
    "q_calendar_align",
    """WITH s AS (SELECT ticker, min(date) AS a, max(date) AS z, arg_min(close, date) AS entry FROM v_bars GROUP BY ticker),
c AS (SELECT DISTINCT cast(o_orderdate as date) AS date FROM orders WHERE dayofweek(o_orderdate) BETWEEN 1 AND 5)
SELECT s.ticker, c.date, coalesce(b.close, s.entry) AS close FROM s JOIN c ON c.date BETWEEN a AND z
 LEFT JOIN v_bars b ON b.ticker = s.ticker AND b.date = c.date""",
)
def q_calendar_align(spark, folder):
    bars = v.bars(spark, folder).select("ticker", "date", "close")
    trading = v.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date")).filter(
        F.weekday("date") < 5
    )
    entry = bars.groupBy("ticker").agg(F.min_by("close", "date").alias("entry"))
    return ts.align(bars, trading).join(entry, "ticker").select(
        "ticker", "date", F.coalesce("close", "entry").alias("close")
    )


PARAMS = {"atr_multiplier": [2.0, 2.5, 3.0], "take_profit_pct": [0.10, 0.15, 0.20], "price_floor": [1e5, 2e5, 3e5], "rsi_min": [30, 35]}


@query(
    "q_param_grid",
    """SELECT o_orderpriority, a AS atr_multiplier, t AS take_profit_pct, f AS price_floor, r::bigint AS rsi_min, count(*) FILTER (o_totalprice >= f) AS n
FROM orders, (SELECT unnest([2.0, 2.5, 3.0])::double AS a), (SELECT unnest([0.10, 0.15, 0.20])::double AS t), (SELECT unnest([1e5, 2e5, 3e5])::double AS f), (SELECT unnest([30, 35]) AS r)
GROUP BY ALL""",
)
def q_param_grid(spark, folder):
    """Orders above each floor of the grid: orders are counted per floor before the grid opens."""
    floors = PARAMS["price_floor"]
    counts = (
        v.table(spark, folder, "orders")
        .groupBy("o_orderpriority")
        .agg(*[F.count_if(F.col("o_totalprice") >= f).alias(f"n{i}") for i, f in enumerate(floors)])
    )
    spread = sweeps.with_grid(counts, PARAMS)
    picked = F.when(F.col("price_floor") == floors[0], F.col("n0"))
    for i, f in enumerate(floors[1:], 1):
        picked = picked.when(F.col("price_floor") == f, F.col(f"n{i}"))
    return spread.select("o_orderpriority", *PARAMS, picked.alias("n"))


@query(
    "q_holding_days",
    """SELECT l_orderkey AS trade_id, l_linenumber::bigint AS line, l_partkey AS part, c.date FROM (SELECT * FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate >= o_orderdate)
 JOIN (SELECT DISTINCT cast(o_orderdate as date) AS date FROM orders) c ON c.date BETWEEN cast(o_orderdate as date) AND cast(l_shipdate as date)""",
)
def q_holding_days(spark, folder):
    orders, lines = v.table(spark, folder, "orders"), v.table(spark, folder, "lineitem")
    span = F.datediff("l_shipdate", "o_orderdate")
    held = lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).filter(span >= 0)
    spans = held.select(
        F.col("l_orderkey").alias("trade_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.to_date("o_orderdate").alias("entry_date"),
        F.to_date("l_shipdate").alias("exit_date"),
    )
    calendar = orders.select(F.to_date("o_orderdate").alias("date"))
    return trades.holding_days(spans, calendar).select("trade_id", "line", "part", "date")


@query(
    "q_null_safe_join",
    """WITH a AS (SELECT c_custkey, nullif(c_nationkey, 3) AS k FROM customer), b AS (SELECT nullif(n_nationkey, 3) AS k, n_name FROM nation)
SELECT c_custkey, n_name, 'null_safe' AS how FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k
UNION ALL SELECT c_custkey, n_name, 'equal' FROM a JOIN b ON a.k = b.k""",
)
def q_null_safe_join(spark, folder):
    a = v.table(spark, folder, "customer").select("c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("k"))
    b = v.table(spark, folder, "nation").select(F.nullif(F.col("n_nationkey"), F.lit(3)).alias("k"), "n_name")
    safe = joins.equi_join(a, b, ["k"], null_safe=True).withColumn("how", F.lit("null_safe"))
    return safe.unionByName(joins.equi_join(a, b, ["k"]).withColumn("how", F.lit("equal"))).drop("k")


@query(
    "q_merge_month",
    """WITH l AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_acctbal END AS listing_price, lower(trim(' ' || upper(n_name))) AS place
  FROM supplier JOIN nation ON n_nationkey = s_nationkey),
p AS (SELECT lower(trim(n_name)) AS place, r_name AS grp FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey <> 4)
SELECT listing_id, date, calendar_price, listing_price, place AS neighbourhood_cleansed, grp AS neighbourhood_group
FROM (SELECT listing_id, date, calendar_price FROM v_calendar) c JOIN l ON id = listing_id LEFT JOIN p USING (place) WHERE listing_price IS NOT NULL""",
)
def q_merge_month(spark, folder):
    calendar = v.calendar(spark, folder).select("listing_id", "date", F.col("calendar_price").alias("price"))
    listings = v.table(spark, folder, "supplier").join(
        v.table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey")
    ).select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_suppkey") % 9 != 0, F.col("s_acctbal")).alias("price"),
        F.concat(F.lit(" "), F.upper("n_name")).alias("neighbourhood_cleansed"),
        F.lit("text").alias("description"),
    )
    places = cleaning.neighbourhoods(plan_cleaning.raw_places(spark, folder), "2025-05").filter("neighbourhood <> 'nation_4'")
    return joins.merge_month(calendar, listings, places).select(
        "listing_id", "date", "calendar_price", "listing_price", "neighbourhood_cleansed", "neighbourhood_group"
    )


@query(
    "q_union",
    "SELECT c_custkey AS key, c_acctbal AS bal, NULL::varchar AS extra FROM customer UNION ALL SELECT s_suppkey, s_acctbal, s_name FROM supplier",
)
def q_union(spark, folder):
    a = v.table(spark, folder, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("bal"))
    b = v.table(spark, folder, "supplier").select(
        F.col("s_name").alias("extra"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("bal")
    )
    return a.unionByName(b, allowMissingColumns=True)


@query("q_except", "SELECT o_custkey AS key FROM orders EXCEPT SELECT l_suppkey FROM lineitem")
def q_except(spark, folder):
    return v.table(spark, folder, "orders").select(F.col("o_custkey").alias("key")).subtract(
        v.table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("key"))
    )


@query("q_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def q_distinct(spark, folder):
    return v.table(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()

"""The driver's tables seen as the operators' inputs, in Spark and as SQL text.

Every view reads its whole tables.  ``SQL`` holds the twin of each view for
the oracle; :func:`sql` puts the needed ones in front of a query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Report types: whole numbers as bigint, decimals and floats as double."""
    out = []
    for field in df.schema:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        out.append(column.alias(field.name))
    return df.select(*out)


def money(column, scale=2):
    """Exact decimal of a two-digit amount, so that sums do not depend on row order."""
    return F.col(column).cast(f"decimal(18,{scale})")


def mean(column, scale=2):
    """Mean of a two-digit amount from its exact decimal sum."""
    return F.sum(money(column, scale)).cast("double") / F.count(column)


def mean_sql(column, scale=2):
    return f"(cast(sum(cast({column} as decimal(18,{scale}))) as double) / count({column}))"


LINE_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_shipdate",
    "l_returnflag",
    "l_linestatus",
]


# -- star schema of customers, orders and conversions ------------------------------------

SQL = {}

SQL["v_week"] = """
SELECT cast(strftime(d, '%Y%m%d') as integer) AS sk_date,
       cast(date_diff('day', DATE '1969-12-29', d) // 7 as integer) AS running_week,
       strftime(d, '%G-W%V') AS year_week, d AS day
FROM (SELECT cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) as date) AS d
      FROM orders)
"""


def week(spark, folder):
    orders = table(spark, folder, "orders")
    span = orders.agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    day = F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day")
    d = F.col("day")
    return span.select(day).select(
        dates.date_key(d).alias("sk_date"),
        dates.running_week(d).alias("running_week"),
        dates.year_week(d).alias("year_week"),
        "day",
    )


SQL["v_fact"] = """
SELECT o.o_orderkey AS order_number, cast(strftime(o_orderdate, '%Y%m%d') as integer) AS fk_order_date,
       o_custkey AS fk_customer, i.fk_product,
       coalesce(i.discount_value, 0) AS discount_value, coalesce(i.price_paid, 0) AS price_paid
FROM orders o LEFT JOIN (
  SELECT l_orderkey, min(l_partkey) AS fk_product,
         cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))) as decimal(14,2)) AS discount_value,
         cast(sum(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))) as decimal(14,2)) AS price_paid
  FROM lineitem GROUP BY l_orderkey) i ON i.l_orderkey = o.o_orderkey
"""


def fact(spark, folder):
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    rate = F.col("l_discount").cast("decimal(4,2)")
    items = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_number"))
        .agg(
            F.min("l_partkey").alias("fk_product"),
            F.sum(F.when(rate.isNotNull(), price)).alias("_price"),
            F.sum(price * rate).alias("_off"),
        )
        # exact sums of decimals: what is paid is the price less the discount, rounded at the end
        .select(
            "order_number",
            "fk_product",
            F.col("_off").cast("decimal(14,2)").alias("discount_value"),
            (F.col("_price") - F.col("_off")).cast("decimal(14,2)").alias("price_paid"),
        )
    )
    head = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_number"),
        dates.date_key(F.col("o_orderdate")).alias("fk_order_date"),
        F.col("o_custkey").alias("fk_customer"),
    )
    zero = F.lit(0).cast("decimal(14,2)")
    return head.join(items, "order_number", "left").withColumns(
        {
            "discount_value": F.coalesce("discount_value", zero),
            "price_paid": F.coalesce("price_paid", zero),
        }
    )


SQL["v_conv"] = """
SELECT conversion_id, fk_customer, cast(strftime(conversion_date, '%Y%m%d') as integer) AS fk_conversion_date,
       CASE WHEN prev IS NULL THEN 'activation' ELSE 'reactivation' END AS conversion_type,
       conversion_date, conversion_channel, conversion_id AS order_number
FROM (
  SELECT o_custkey AS fk_customer, cast(o_orderdate as date) AS conversion_date, min(o_orderkey) AS conversion_id,
         arg_min(o_orderpriority, o_orderkey) AS conversion_channel,
         lag(cast(o_orderdate as date)) OVER (PARTITION BY o_custkey ORDER BY cast(o_orderdate as date)) AS prev
  FROM orders GROUP BY o_custkey, cast(o_orderdate as date))
WHERE prev IS NULL OR date_diff('day', prev, conversion_date) > 180
"""


def conversions(spark, folder):
    # One row per customer and day before the window: its groups are bounded by the calendar.
    days = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("fk_customer"), F.to_date("o_orderdate").alias("conversion_date"))
        .agg(
            F.min("o_orderkey").alias("conversion_id"),
            F.min_by("o_orderpriority", "o_orderkey").alias("conversion_channel"),
        )
    )
    w = Window.partitionBy("fk_customer").orderBy("conversion_date")
    prev = F.lag("conversion_date").over(w)
    return (
        days.withColumn("prev", prev)
        .filter(F.col("prev").isNull() | (F.datediff("conversion_date", "prev") > 180))
        .select(
            "conversion_id",
            "fk_customer",
            dates.date_key(F.col("conversion_date")).alias("fk_conversion_date"),
            F.when(F.col("prev").isNull(), "activation").otherwise("reactivation").alias("conversion_type"),
            "conversion_date",
            "conversion_channel",
            F.col("conversion_id").alias("order_number"),
        )
    )


SQL["v_customer_dim"] = """
SELECT c_custkey AS sk_customer, c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name FROM customer
"""


def customer_dim(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("sk_customer"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
    )


SQL["v_product_dim"] = "SELECT p_partkey AS sk_product, p_name AS product_name FROM part"


def product_dim(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("sk_product"), F.col("p_name").alias("product_name")
    )


# -- marketplace: items, customers, products, sellers -------------------------------------

SQL["v_items"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_unique_id, o_orderdate AS order_purchase_timestamp,
       l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id, l_extendedprice AS price,
       l_shipdate AS order_delivered_customer_date, p_type AS product_category_name, n_name AS seller_state,
       c_mktsegment AS customer_state, o_totalprice AS order_value,
       CASE l_returnflag WHEN 'A' THEN 3 + l_linenumber % 3 WHEN 'R' THEN 1 + l_linenumber % 3 END AS review_score,
       l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_returnflag AS flag, l_linestatus AS status
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
     LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
     LEFT JOIN nation ON n_nationkey = s_nationkey
"""

ITEM_TIE = ["order_id", "order_item_id", "price", "quantity", "discount", "tax", "order_delivered_customer_date", "flag", "status"]


def market_tables(spark, folder):
    """Orders, items, customers, products and sellers under the marketplace names."""
    t = lambda n: table(spark, folder, n)
    orders = t("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_totalprice").alias("order_value"),
    )
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    items = t("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        line.alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("order_delivered_customer_date"),
        F.when(flag == "A", 3 + line % 3).when(flag == "R", 1 + line % 3).alias("review_score"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        flag.alias("flag"),
        F.col("l_linestatus").alias("status"),
    )
    customers = t("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        F.col("c_mktsegment").alias("customer_state"),
    )
    products = t("part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
    )
    sellers = t("supplier").join(
        t("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    ).select(F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_state"))
    return orders, items, customers, products, sellers


def items(spark, folder):
    from ..operators.joins import order_items

    return order_items(*market_tables(spark, folder)).drop("customer_id")


def tenured_items(spark, folder):
    """Items with tenure and days to delivery, left in parts by order.

    Tenure is the orders' own, so the items are read once, and customers meet
    the orders, not the items.  What is grouped by seller or product is better
    off with :func:`items`, whose last joins are those.
    """
    from ..operators import cohort, joins

    orders, lines, customers, products, sellers = market_tables(spark, folder)
    heads = cohort.customer_tenure(joins.order_heads(orders, customers))
    items = heads.join(joins.item_lines(lines, products, sellers), "order_id", "left")
    return cohort.delivered(items).drop("customer_id")


# -- rental calendar -----------------------------------------------------------------------

SQL["v_calendar"] = """
SELECT l_suppkey AS listing_id, cast(l_shipdate as date) AS date, strftime(l_shipdate, '%Y-%m') AS data_month,
       l_extendedprice AS calendar_price, CASE WHEN l_returnflag = 'R' THEN 'f' ELSE 't' END AS available,
       lower(trim(n_name)) AS neighbourhood_cleansed, r_name AS neighbourhood_group
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
     JOIN region ON r_regionkey = n_regionkey
"""


def calendar(spark, folder):
    t = lambda n: table(spark, folder, n)
    places = (
        t("supplier")
        .join(t("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .join(t("region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .select("s_suppkey", "n_name", "r_name")
    )
    return (
        t("lineitem")
        .join(places, F.col("s_suppkey") == F.col("l_suppkey"))
        .select(
            F.col("l_suppkey").alias("listing_id"),
            F.to_date("l_shipdate").alias("date"),
            dates.month_label(F.col("l_shipdate")).alias("data_month"),
            F.col("l_extendedprice").alias("calendar_price"),
            F.when(F.col("l_returnflag") == "R", "f").otherwise("t").alias("available"),
            F.lower(F.trim("n_name")).alias("neighbourhood_cleansed"),
            F.col("r_name").alias("neighbourhood_group"),
        )
    )


# -- daily bars ------------------------------------------------------------------------------

SQL["v_bars"] = f"""
SELECT l_suppkey AS ticker, cast(l_shipdate as date) AS date,
       first(l_extendedprice / l_quantity ORDER BY {', '.join(LINE_ORDER)}) AS open,
       max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
       last(l_extendedprice / l_quantity ORDER BY {', '.join(LINE_ORDER)}) AS close,
       sum(l_quantity) AS volume
FROM lineitem GROUP BY l_suppkey, cast(l_shipdate as date)
"""


def bar_columns():
    """Aggregates of a bar.  Lines equal up to price and quantity give the same unit price, so the rest of LINE_ORDER decides nothing."""
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    price = lambda line: line["l_extendedprice"] / line["l_quantity"]
    return [
        price(F.min(order)).alias("open"),
        F.max(unit).alias("high"),
        F.min(unit).alias("low"),
        price(F.max(order)).alias("close"),
        F.sum("l_quantity").alias("volume"),
    ]


def bars(spark, folder):
    """One row per ticker and day: groups by ticker are bounded by the calendar."""
    lines = table(spark, folder, "lineitem")
    return lines.groupBy(F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date")).agg(*bar_columns())


SQL["v_bench"] = """
SELECT date, cast(sum(cast(close as decimal(18,6))) as double) / count(*) AS close FROM v_bars GROUP BY date
"""


def bench(spark, folder, days=None):
    return (bars(spark, folder) if days is None else days).groupBy("date").agg(
        (F.sum(F.col("close").cast("decimal(18,6)")).cast("double") / F.count(F.lit(1))).alias("close")
    )


# -- credit table ------------------------------------------------------------------------------

SQL["v_credit"] = (
    "SELECT c_custkey AS id, c_acctbal AS limit_bal, c_nationkey % 7 AS education, c_nationkey % 4 AS marriage, "
    + ", ".join(
        f"max(CASE WHEN rn = {i} THEN o_totalprice - 100000 END) AS bill_{i}, "
        f"max(CASE WHEN rn = {i} THEN o_totalprice * (o_orderkey % 10) / 10 END) AS pay_amt_{i}, "
        f"max(CASE WHEN rn = {i} THEN o_orderkey % 11 - 2 END) AS pay_{i}"
        for i in range(1, 7)
    )
    + """, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS target
FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders QUALIFY rn <= 6) ON o_custkey = c_custkey
GROUP BY c_custkey, c_acctbal, c_nationkey
"""
)

BILLS = [f"bill_{i}" for i in range(1, 7)]
PAYMENTS = [f"pay_amt_{i}" for i in range(1, 7)]
DELAYS = [f"pay_{i}" for i in range(1, 7)]


def credit(spark, folder):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    latest = (
        table(spark, folder, "orders").withColumn("rn", F.row_number().over(w)).filter("rn <= 6")
    )
    picks = []
    for i in range(1, 7):
        at = F.col("rn") == i
        picks += [
            F.max(F.when(at, F.col("o_totalprice") - 100000)).alias(f"bill_{i}"),
            F.max(F.when(at, F.col("o_totalprice") * (F.col("o_orderkey") % 10) / 10)).alias(f"pay_amt_{i}"),
            F.max(F.when(at, F.col("o_orderkey") % 11 - 2)).alias(f"pay_{i}"),
        ]
    wide = latest.groupBy("o_custkey").agg(*picks)
    return (
        table(spark, folder, "customer")
        .join(wide, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_acctbal").alias("limit_bal"),
            (F.col("c_nationkey") % 7).alias("education"),
            (F.col("c_nationkey") % 4).alias("marriage"),
            *[c for i in range(6) for c in (BILLS[i], PAYMENTS[i], DELAYS[i])],
            (F.col("c_acctbal") < 0).cast("int").alias("target"),
        )
    )


# -- news, scores, demand, detections, collisions --------------------------------------------

SQL["v_news"] = """
SELECT d.doc_id, lang AS ticker, source, text AS headline,
       cast(DATE '2024-01-01' + cast(d.doc_id % 30 as integer) as date) AS day,
       cast(DATE '2024-01-01' + cast(d.doc_id % 30 as integer) as timestamp) + to_minutes(cast(d.doc_id * 37 % 1440 as bigint)) AS created_at,
       CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label,
       ('0x' || substr(md5(cast(d.doc_id as varchar)), 1, 8))::bigint / 4294967296.0 AS confidence
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


def fraction(column):
    """Even number in [0, 1) from the md5 of a column."""
    return F.conv(F.substring(F.md5(F.col(column).cast("string")), 1, 8), 16, 10).cast("double") / F.lit(
        4294967296.0
    )


def news(spark, folder):
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    minute = (F.col("doc_id") * 37 % 1440).cast("int")
    return docs.select(
        "doc_id",
        F.col("lang").alias("ticker"),
        "source",
        F.col("text").alias("headline"),
        day.alias("day"),
        (day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minute)).alias("created_at"),
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral")
        .alias("label"),
        fraction("doc_id").alias("confidence"),
    )


SQL["v_scores"] = """
SELECT doc_id, quality AS label,
       floor((0.6 * (('0x' || substr(md5(cast(doc_id as varchar)), 1, 8))::bigint / 4294967296.0) + 0.3 * quality) * 1000) / 1000 AS score
FROM labels
"""


def scores(spark, folder):
    return table(spark, folder, "labels").select(
        "doc_id",
        F.col("quality").alias("label"),
        (F.floor((F.lit(0.6) * fraction("doc_id") + F.lit(0.3) * F.col("quality")) * 1000) / 1000).alias("score"),
    )


SQL["v_demand"] = """
SELECT o_orderpriority AS series, cast(o_orderdate as date) AS day, cast(count(*) as double) AS demand,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY cast(o_orderdate as date)) - 1 AS t
FROM orders GROUP BY o_orderpriority, cast(o_orderdate as date)
"""


def demand(spark, folder):
    """Orders per priority and day: each series is as long as the calendar at most."""
    daily = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day"))
        .agg(F.count(F.lit(1)).cast("double").alias("demand"))
    )
    return daily.withColumn("t", F.row_number().over(Window.partitionBy("series").orderBy("day")) - 1)


SQL["v_det"] = """
SELECT event_id AS det_id, user_id AS image_id, event_type AS label, value / (SELECT max(value) FROM events) AS score FROM events
"""


def detections(spark, folder):
    events = table(spark, folder, "events")
    return events.select(
        F.col("event_id").alias("det_id"),
        F.col("user_id").alias("image_id"),
        F.col("event_type").alias("label"),
        (F.col("value") / events.agg(F.max("value")).scalar()).alias("score"),
    )


SQL["v_ksi"] = """
SELECT event_id, ts, user_id AS intersection, value AS lat, k AS lon,
       k < 50 AS aggressive, k % 10 = 0 AS alcohol, k BETWEEN 20 AND 29 AS red_light, k >= 80 AS speeding
FROM (SELECT *, cast(json_extract_string(props, '$.k') as integer) AS k FROM events)
"""


def collisions(spark, folder):
    k = F.get_json_object("props", "$.k").try_cast("int")
    return table(spark, folder, "events").withColumn("k", k).select(
        "event_id",
        "ts",
        F.col("user_id").alias("intersection"),
        F.col("value").alias("lat"),
        F.col("k").alias("lon"),
        (F.col("k") < 50).alias("aggressive"),
        (F.col("k") % 10 == 0).alias("alcohol"),
        F.col("k").between(20, 29).alias("red_light"),
        (F.col("k") >= 80).alias("speeding"),
    )


def sql(body: str) -> str:
    """Query text with the definitions of the views it names, in dependency order."""
    needed = []

    def visit(text):
        for name in re.findall(r"\bv_[a-z_]+\b", text):
            if name in SQL and name not in needed:
                visit(SQL[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    heads = ", ".join(f"{n} AS ({SQL[n].strip()})" for n in needed)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {heads}, {body[14:].strip()}"
    if body.upper().startswith("WITH"):
        return f"WITH {heads}, {body[4:].strip()}"
    return f"WITH {heads} {body}"

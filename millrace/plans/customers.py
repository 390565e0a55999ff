"""Customer 360: the flagship query and its parts."""

from pyspark.sql import functions as F

from ..operators import cohort
from ..session import stored
from . import views as v
from .registry import query

Q1 = """
WITH sale AS (
  SELECT f.order_number, f.fk_customer AS buyer, w.running_week AS wk, w.year_week AS sale_week, f.discount_value AS off, f.price_paid AS paid
  FROM v_fact f LEFT JOIN v_week w ON w.sk_date = f.fk_order_date),
per_week AS (SELECT buyer, wk, sum(off + paid) AS gross, sum(off) AS off, sum(paid) AS paid FROM sale GROUP BY buyer, wk),
segment AS (
  SELECT c.customer_id, c.first_name, c.last_name, v.conversion_id, v.conversion_type, v.conversion_date, v.conversion_channel,
         w.running_week AS begin_wk, w.year_week AS conversion_week, s.sale_week AS first_order_week, s.paid AS first_paid,
         rank() OVER (PARTITION BY c.customer_id ORDER BY v.conversion_id) AS conversion_number,
         lead(w.running_week) OVER by_day AS next_wk, lead(w.year_week) OVER by_day AS next_conversion_week
  FROM v_conv v JOIN v_customer_dim c ON c.sk_customer = v.fk_customer
       LEFT JOIN v_week w ON w.sk_date = v.fk_conversion_date LEFT JOIN sale s ON s.order_number = v.order_number
  WINDOW by_day AS (PARTITION BY c.customer_id ORDER BY v.conversion_date)),
spine AS (
  SELECT segment.*, unnest(range(begin_wk, coalesce(next_wk, final + 1))) AS wk
  FROM segment, (SELECT max(running_week) AS final FROM v_week)),
label AS (SELECT running_week AS wk, any_value(year_week) AS order_week FROM v_week GROUP BY running_week)
SELECT customer_id, first_name, last_name, conversion_id, conversion_number, conversion_type, conversion_date,
       conversion_week, next_conversion_week, conversion_channel, first_order_week,
       first_paid::double AS first_order_total_paid, (spine.wk - begin_wk + 1)::bigint AS week_counter, order_week,
       (p.wk IS NOT NULL)::bigint AS orders_placed, coalesce(gross, 0)::double AS total_before_discounts,
       coalesce(off, 0)::double AS total_discounts, coalesce(p.paid, 0)::double AS total_paid_in_week,
       (sum(coalesce(p.paid, 0)) OVER (PARTITION BY customer_id, conversion_id ORDER BY spine.wk))::double AS conversion_cumulative_revenue,
       (sum(coalesce(p.paid, 0)) OVER (PARTITION BY customer_id ORDER BY spine.wk))::double AS lifetime_cumulative_revenue
FROM spine LEFT JOIN per_week p ON p.buyer = customer_id AND p.wk = spine.wk LEFT JOIN label ON label.wk = spine.wk
"""


@query("q1_customer_info", Q1)
def q1(spark, folder):
    # Read twice (orders by week, first orders): written once, so the lines are added up once.
    fact = stored(v.fact(spark, folder).drop("fk_product"), "fact")
    return cohort.customer_info(
        fact, v.conversions(spark, folder), v.customer_dim(spark, folder), v.week(spark, folder), "double"
    )


@query(
    "q_order_with_product",
    """SELECT order_number, customer_id, product_name, running_week::bigint AS running_week, year_week,
       cast(discount_value + price_paid as double) AS price_before_discount
FROM v_fact LEFT JOIN v_product_dim ON sk_product = fk_product LEFT JOIN v_week ON sk_date = fk_order_date
     LEFT JOIN v_customer_dim ON sk_customer = fk_customer""",
)
def q_order_with_product(spark, folder):
    return cohort.order_with_product(
        v.fact(spark, folder), v.customer_dim(spark, folder), v.product_dim(spark, folder), v.week(spark, folder)
    ).select("order_number", "customer_id", "product_name", "running_week", "year_week", "price_before_discount")


@query(
    "q_grouped_orders",
    """SELECT customer_id, running_week::bigint AS running_week, count(DISTINCT order_number) AS order_placed,
       cast(sum(discount_value + price_paid) as double) AS total_before_discounts,
       cast(sum(discount_value) as double) AS total_discounts, cast(sum(price_paid) as double) AS total_paid
FROM v_fact LEFT JOIN v_week ON sk_date = fk_order_date LEFT JOIN v_customer_dim ON sk_customer = fk_customer
GROUP BY customer_id, running_week""",
)
def q_grouped_orders(spark, folder):
    lines = cohort.order_with_product(
        v.fact(spark, folder), v.customer_dim(spark, folder), v.product_dim(spark, folder), v.week(spark, folder)
    )
    return cohort.grouped_orders(lines)


@query(
    "q_range_join",
    """SELECT conversion_id, w.running_week::bigint AS week
FROM v_conv JOIN v_week c ON c.sk_date = fk_conversion_date
     JOIN (SELECT DISTINCT running_week FROM v_week) w ON w.running_week >= c.running_week""",
)
def q_range_join(spark, folder):
    weeks = v.week(spark, folder)
    placed = v.conversions(spark, folder).join(
        weeks.select("sk_date", "running_week"), F.col("sk_date") == F.col("fk_conversion_date")
    )
    last = weeks.agg(F.max("running_week")).scalar()
    open_ended = placed.withColumn("next_run_week", F.lit(None).cast("int"))
    return cohort.week_spine(open_ended, last).select("conversion_id", "week")


@query(
    "q_tenure",
    """SELECT order_id, order_item_id::bigint AS order_item_id, seller_id, product_id, price, quantity,
       cast(date_diff('day', min(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id), order_purchase_timestamp) as bigint) AS customer_tenure_days,
       cast(date_diff('day', order_purchase_timestamp, order_delivered_customer_date) as bigint) AS order_deliver_days
FROM v_items""",
)
def q_tenure(spark, folder):
    return v.tenured_items(spark, folder).select(
        "order_id", "order_item_id", "seller_id", "product_id", "price", "quantity",
        "customer_tenure_days", "order_deliver_days",
    )


SUMMARY = """
WITH t AS (SELECT *,
    date_diff('day', min(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id), order_purchase_timestamp) AS tenure,
    date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS deliver FROM v_items),
modes AS (
  SELECT order_id, max(v) FILTER (kind = 'c') AS product_category, max(v) FILTER (kind = 's') AS seller_state,
         max(v) FILTER (kind = 'k') AS customer_state
  FROM (SELECT order_id, kind, v, row_number() OVER (PARTITION BY order_id, kind ORDER BY count(*) DESC, v) AS rn
        FROM (SELECT order_id, 'c' AS kind, product_category_name AS v FROM t UNION ALL
              SELECT order_id, 's', seller_state FROM t UNION ALL SELECT order_id, 'k', customer_state FROM t)
        WHERE v IS NOT NULL GROUP BY order_id, kind, v) WHERE rn = 1 GROUP BY order_id),
s AS (
  SELECT order_id, customer_unique_id, count(*) AS n_items, max(order_value) AS order_value,
         cast(sum(cast(price as decimal(18,2))) as double) / count(price) AS avg_price_per_item,
         count(DISTINCT seller_id) AS seller_count, max(tenure) AS customer_tenure_days,
         cast(sum(deliver) as double) / count(deliver) AS order_deliver_days,
         cast(sum(review_score) as double) / count(review_score) AS review_score
  FROM t WHERE order_id IS NOT NULL AND customer_unique_id IS NOT NULL GROUP BY order_id, customer_unique_id)
"""
v.SQL["v_summary"] = SUMMARY.strip().replace("WITH t AS", "WITH t AS") + (
    " SELECT s.*, product_category, seller_state, customer_state FROM s LEFT JOIN modes USING (order_id)"
)


def summary(spark, folder):
    return cohort.order_summary(v.tenured_items(spark, folder))


@query(
    "q_order_summary",
    "SELECT * REPLACE (round(avg_price_per_item, 6) AS avg_price_per_item, round(order_deliver_days, 6) AS order_deliver_days, "
    "round(review_score, 6) AS review_score) FROM v_summary",
)
def q_order_summary(spark, folder):
    return summary(spark, folder).withColumns(
        {c: F.round(c, 6) for c in ("avg_price_per_item", "order_deliver_days", "review_score")}
    )

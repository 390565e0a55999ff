"""Cleaning, profiling and feature expressions."""

from pyspark.sql import functions as F

from ..functions import values as x
from ..operators import cleaning, profile, sampling
from . import views as v
from .registry import query

MASKED = """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer"""


def masked(spark, folder):
    """Customers with some balances and segments hidden, to have nulls to fill."""
    key = F.col("c_custkey")
    return v.table(spark, folder, "customer").select(
        "c_custkey",
        F.when(key % 7 != 0, F.col("c_acctbal")).alias("bal"),
        F.when(key % 11 != 0, F.col("c_mktsegment")).alias("seg"),
    )


def order_lines(spark, folder):
    """Orders with their lines; orders without lines give nulls."""
    return v.table(spark, folder, "orders").join(
        v.table(spark, folder, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )


@query(
    "q_clean_currency",
    "SELECT o_orderkey, cast(replace(replace(format('${:,.2f}', o_totalprice), '$', ''), ',', '') as double) AS price FROM orders",
)
def q_clean_currency(spark, folder):
    shown = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return v.table(spark, folder, "orders").select("o_orderkey", x.currency(shown).alias("price"))


@query(
    "q_clean_percent",
    "SELECT try_cast(replace(CASE WHEN l_discount = 0.1 THEN 'N/A' ELSE cast(l_discount * 100 as varchar) || '%' END, '%', '') as double) AS rate, count(*) AS n FROM lineitem GROUP BY 1",
)
def q_clean_percent(spark, folder):
    shown = F.when(F.col("l_discount") == 0.1, "N/A").otherwise(
        F.concat((F.col("l_discount") * 100).cast("string"), F.lit("%"))
    )
    return (
        v.table(spark, folder, "lineitem")
        .groupBy(x.percent(shown).alias("rate"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "q_tf_flag",
    "SELECT CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS flag, count(*) AS n FROM lineitem GROUP BY 1",
)
def q_tf_flag(spark, folder):
    letter = F.when(F.col("l_returnflag") == "A", "t").when(F.col("l_returnflag") == "R", "f").otherwise("x")
    return (
        v.table(spark, folder, "lineitem").groupBy(x.tf_flag(letter).alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "q_to_numeric",
    "SELECT p_partkey, try_cast(split_part(p_brand, '#', 2) as double) AS brand_no, try_cast(p_name as double) AS name_no FROM part",
)
def q_to_numeric(spark, folder):
    return v.table(spark, folder, "part").select(
        "p_partkey",
        x.to_numeric(F.split_part("p_brand", F.lit("#"), F.lit(2))).alias("brand_no"),
        x.to_numeric("p_name").alias("name_no"),
    )


@query(
    "q_require",
    "SELECT o_orderstatus, count(*) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1",
)
def q_require(spark, folder):
    kept = cleaning.require(order_lines(spark, folder), ["l_orderkey", "l_partkey"])
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q_fill_group_median",
    f"""WITH m AS ({MASKED}), g AS (SELECT seg, quantile_cont(bal, 0.5) AS med FROM m WHERE seg IS NOT NULL GROUP BY seg)
SELECT c_custkey, m.seg, round(CASE WHEN m.seg IS NOT NULL THEN coalesce(bal, med) END, 6) AS bal FROM m LEFT JOIN g ON g.seg = m.seg""",
)
def q_fill_group_median(spark, folder):
    return cleaning.fill_group_median(masked(spark, folder), ["bal"], "seg").withColumn("bal", F.round("bal", 6))


@query(
    "q_fill_median",
    f"WITH m AS ({MASKED}) SELECT c_custkey, seg, round(coalesce(bal, (SELECT quantile_cont(bal, 0.5) FROM m)), 6) AS bal FROM m",
)
def q_fill_median(spark, folder):
    return cleaning.fill_median(masked(spark, folder), ["bal"]).withColumn("bal", F.round("bal", 6))


@query(
    "q_fill_mode",
    """WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders)
SELECT o_orderkey, coalesce(p, (SELECT p FROM m WHERE p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1)) AS p FROM m""",
)
def q_fill_mode(spark, folder):
    hidden = v.table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("p")
    )
    return cleaning.fill_mode(hidden, "p")


@query(
    "q_coalesce",
    "SELECT coalesce(l_returnflag, 'MISSING') AS flag, count(*) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1",
)
def q_coalesce(spark, folder):
    return (
        order_lines(spark, folder)
        .na.fill("MISSING", ["l_returnflag"])
        .groupBy(F.col("l_returnflag").alias("flag"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


DEDUP_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount"]


@query("q_dedup_rows", f"SELECT DISTINCT {', '.join(DEDUP_COLS[:3])}::bigint AS l_linenumber, l_quantity, l_discount FROM lineitem")
def q_dedup_rows(spark, folder):
    return cleaning.dedup(v.table(spark, folder, "lineitem").select(*DEDUP_COLS))


@query(
    "q_count_duplicates",
    f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(DEDUP_COLS)} FROM lineitem)) AS duplicates FROM lineitem",
)
def q_count_duplicates(spark, folder):
    return cleaning.count_duplicates(v.table(spark, folder, "lineitem").select(*DEDUP_COLS))


@query("q_norm_key", "SELECT lower(trim('  ' || upper(p_name) || ' ')) AS name, count(*) AS n FROM part GROUP BY 1")
def q_norm_key(spark, folder):
    padded = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return v.table(spark, folder, "part").groupBy(x.norm_key(padded).alias("name")).agg(F.count(F.lit(1)).alias("n"))


NULL_COLS = ["o_orderkey", "l_orderkey", "l_returnflag", "l_quantity"]


@query(
    "q_null_profile",
    """WITH j AS (SELECT o_orderkey, l_orderkey, l_returnflag, nullif(l_quantity, 50) AS l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)
SELECT * FROM (SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS nulls FROM j UNION ALL
 SELECT 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM j UNION ALL
 SELECT 'l_returnflag', count(*) FILTER (l_returnflag IS NULL) FROM j UNION ALL
 SELECT 'l_quantity', count(*) FILTER (l_quantity IS NULL) FROM j) WHERE nulls > 0""",
)
def q_null_profile(spark, folder):
    joined = order_lines(spark, folder).select(
        "o_orderkey", "l_orderkey", "l_returnflag", F.nullif(F.col("l_quantity"), F.lit(50.0)).alias("l_quantity")
    )
    return profile.nulls(joined)


@query(
    "q_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, max({c}) AS max,
 round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem"""
        for c in ("l_extendedprice", "l_quantity")
    ),
)
def q_describe(spark, folder):
    out = profile.describe(v.table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])
    return out.withColumns({c: F.round(c, d) for c, d in (("mean", 4), ("std", 4), ("q25", 6), ("q50", 6), ("q75", 6))})


@query("q_md5_sample", "SELECT c_custkey, c_name FROM customer ORDER BY md5('7' || c_custkey), c_custkey LIMIT 50")
def q_md5_sample(spark, folder):
    return sampling.sample_rows(v.table(spark, folder, "customer"), "c_custkey", 50, seed=7).select("c_custkey", "c_name")


@query(
    "q_sample_per_month",
    """SELECT data_month, arg_min(o_orderkey, md5('42' || o_orderkey)) AS o_orderkey, arg_min(o_totalprice, md5('42' || o_orderkey)) AS o_totalprice
FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS data_month FROM orders) GROUP BY data_month""",
)
def q_sample_per_month(spark, folder):
    orders = v.table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("data_month")
    )
    return sampling.one_per_group(orders, ["data_month"], "o_orderkey", seed=42)


@query(
    "q_recode",
    "SELECT education::bigint AS education, marriage::bigint AS marriage, count(*) AS n FROM (SELECT CASE WHEN education IN (0, 5, 6) THEN 4 ELSE education END AS education, CASE WHEN marriage = 0 THEN 3 ELSE marriage END AS marriage FROM v_credit) GROUP BY ALL",
)
def q_recode(spark, folder):
    return (
        v.credit(spark, folder)
        .select(
            x.recode("education", cleaning.EDUCATION_CODES).alias("education"),
            x.recode("marriage", cleaning.MARRIAGE_CODES).alias("marriage"),
        )
        .groupBy("education", "marriage")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "q_clip",
    "SELECT id, CASE WHEN pay_1 IS NOT NULL THEN greatest(least(pay_1, 5), 0) END AS low_high, CASE WHEN bill_6 IS NOT NULL THEN greatest(bill_6, 0) END AS low_only FROM v_credit",
)
def q_clip(spark, folder):
    return v.credit(spark, folder).select(
        "id", x.clip("pay_1", 0, 5).alias("low_high"), x.clip("bill_6", 0.0).alias("low_only")
    )


@query(
    "q_winsorize",
    """WITH b AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber::bigint AS l_linenumber, round(greatest(least(l_extendedprice, hi), lo), 6) AS price FROM lineitem, b""",
)
def q_winsorize(spark, folder):
    lines = v.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").alias("price")
    )
    return cleaning.winsorize(lines, ["price"]).withColumn("price", F.round("price", 6))


NEG = " + ".join(f"coalesce((bill_{i} < 0)::bigint, 0)" for i in range(1, 7))


@query("q_row_count_neg", f"SELECT id, {NEG} AS n_neg FROM v_credit")
def q_row_count_neg(spark, folder):
    return v.credit(spark, folder).select("id", x.row_count_if(v.BILLS, lambda c: c < 0).alias("n_neg"))


def _sql_mean(cols):
    total = " + ".join(f"coalesce({c}::double, 0)" for c in cols)
    count = " + ".join(f"({c} IS NOT NULL)::int" for c in cols)
    return f"(({total}) / nullif({count}, 0))"


@query(
    "q_row_aggs",
    f"""SELECT id, round({_sql_mean(v.BILLS)}, 6) AS avg_bill, greatest({', '.join(v.DELAYS)}) AS max_delay,
 ({' OR '.join(f'coalesce({c} > 0, false)' for c in v.DELAYS)}) AS ever_late FROM v_credit""",
)
def q_row_aggs(spark, folder):
    return v.credit(spark, folder).select(
        "id",
        F.round(x.row_mean(v.BILLS), 6).alias("avg_bill"),
        x.row_max(v.DELAYS).alias("max_delay"),
        x.row_any(v.DELAYS, lambda c: c > 0).alias("ever_late"),
    )


@query(
    "q_safe_ratio",
    f"""WITH m AS (SELECT id, limit_bal, {_sql_mean(v.BILLS)} AS avg_bill FROM v_credit),
f AS (SELECT *, CASE WHEN avg_bill IS NOT NULL THEN greatest(avg_bill, (SELECT min(avg_bill) FROM m WHERE avg_bill > 0)) END AS adj FROM m)
SELECT id, round(limit_bal / adj, 8) AS utilization FROM f""",
)
def q_safe_ratio(spark, folder):
    means = v.credit(spark, folder).select("id", "limit_bal", x.row_mean(v.BILLS).alias("avg_bill"))
    out = cleaning.safe_ratio(means, {"utilization": "limit_bal"}, "avg_bill")
    return out.select("id", F.round("utilization", 8).alias("utilization"))


CUT = """CASE WHEN d > -3 AND d <= 0 THEN 'on_time' WHEN d > 0 AND d <= 1 THEN 'short_delay'
 WHEN d > 1 AND d <= 3 THEN 'medium_delay' WHEN d > 3 AND d <= 8 THEN 'long_delay' END"""


@query("q_cut", f"SELECT {CUT} AS bucket, count(*) AS n FROM (SELECT greatest({', '.join(v.DELAYS)}) AS d FROM v_credit) GROUP BY 1")
def q_cut(spark, folder):
    bucket = x.cut(x.row_max(v.DELAYS), cleaning.DELAY_EDGES, cleaning.DELAY_LABELS)
    return v.credit(spark, folder).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("q_all_finite", "SELECT bool_and(isfinite(l_extendedprice) AND isfinite(l_discount)) AS all_finite FROM lineitem")
def q_all_finite(spark, folder):
    return profile.all_finite(v.table(spark, folder, "lineitem"), ["l_extendedprice", "l_discount"])


@query("q_trend", "SELECT id, round(bill_6 - bill_1, 6) AS bill_trend, round(pay_amt_6 - pay_amt_1, 6) AS pay_trend FROM v_credit")
def q_trend(spark, folder):
    return v.credit(spark, folder).select(
        "id",
        F.round(F.col("bill_6") - F.col("bill_1"), 6).alias("bill_trend"),
        F.round(F.col("pay_amt_6") - F.col("pay_amt_1"), 6).alias("pay_trend"),
    )


@query("q_booked", "SELECT data_month, sum((available = 'f')::int)::bigint AS booked FROM v_calendar GROUP BY 1")
def q_booked(spark, folder):
    booked = (F.col("available") == "f").cast("int")
    return v.calendar(spark, folder).groupBy("data_month").agg(F.sum(booked).alias("booked"))


@query(
    "q_cleaning_audit",
    """WITH b AS (SELECT education, marriage, pay_1 FROM v_credit),
a AS (SELECT DISTINCT * FROM b)
SELECT 'rows_before' AS operation, count(*) AS value FROM b UNION ALL SELECT 'rows_after', count(*) FROM a
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM b) - (SELECT count(*) FROM a)
UNION ALL SELECT 'education_recoded', count(*) FROM b WHERE education IN (0, 5, 6)
UNION ALL SELECT 'marriage_recoded', count(*) FROM b WHERE marriage = 0""",
)
def q_cleaning_audit(spark, folder):
    before = v.credit(spark, folder).select("education", "marriage", "pay_1")
    rules = {"education_recoded": F.col("education").isin(0, 5, 6), "marriage_recoded": F.col("marriage") == 0}
    return profile.audit(before, cleaning.dedup(before), rules)


v.SQL["v_raw_listings"] = """
SELECT p_partkey AS id, CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE format('${:,.2f}', p_retailprice) END AS price,
 CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_size END AS host_id, p_type AS room_type,
 CASE WHEN p_partkey % 5 = 0 THEN 'N/A' ELSE (p_partkey % 101) || '%' END AS host_response_rate,
 CASE p_partkey % 3 WHEN 0 THEN 't' WHEN 1 THEN 'f' END AS host_is_superhost,
 CASE p_partkey % 2 WHEN 0 THEN 't' ELSE 'f' END AS host_identity_verified,
 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE cast(p_size % 4 as varchar) END AS bathrooms,
 CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE cast(p_size % 5 as varchar) END AS bedrooms,
 CASE WHEN p_partkey % 6 = 0 THEN 'x' ELSE cast(p_size % 7 as varchar) END AS beds,
 CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_brand END AS host_response_time
FROM part
"""


def raw_listings(spark, folder):
    k, size = F.col("p_partkey"), F.col("p_size")
    return v.table(spark, folder, "part").select(
        k.alias("id"),
        F.when(k % 17 != 0, F.concat(F.lit("$"), F.format_number("p_retailprice", 2))).alias("price"),
        F.when(k % 23 != 0, size).alias("host_id"),
        F.col("p_type").alias("room_type"),
        F.when(k % 5 == 0, "N/A").otherwise(F.concat((k % 101).cast("string"), F.lit("%"))).alias("host_response_rate"),
        F.lit("50%").alias("host_acceptance_rate"),
        F.when(k % 3 == 0, "t").when(k % 3 == 1, "f").alias("host_is_superhost"),
        F.when(k % 2 == 0, "t").otherwise("f").alias("host_identity_verified"),
        F.when(k % 2 == 0, "t").otherwise("f").alias("instant_bookable"),
        F.when(k % 4 != 0, (size % 4).cast("string")).alias("bathrooms"),
        F.when(k % 9 != 0, (size % 5).cast("string")).alias("bedrooms"),
        F.when(k % 6 == 0, "x").otherwise((size % 7).cast("string")).alias("beds"),
        F.when(k % 8 != 0, F.col("p_brand")).alias("host_response_time"),
        F.lit("old").alias("license"),
    )


v.SQL["v_clean_listings"] = """
SELECT id, price, host_id, room_type, host_response_rate, host_is_superhost, host_identity_verified,
 coalesce(bathrooms, (SELECT quantile_cont(bathrooms, 0.5) FROM g2)) AS bathrooms,
 coalesce(bedrooms, (SELECT quantile_cont(bedrooms, 0.5) FROM g2)) AS bedrooms,
 coalesce(beds, (SELECT quantile_cont(beds, 0.5) FROM g2)) AS beds,
 coalesce(host_response_time, (SELECT host_response_time FROM g2 WHERE host_response_time IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS host_response_time,
 '2025-05' AS data_month
FROM g2
"""
v.SQL["v_clean_listings"] = (
    """
WITH g1 AS (
 SELECT id, try_cast(replace(replace(price, '$', ''), ',', '') as double) AS price, host_id, room_type,
  try_cast(replace(host_response_rate, '%', '') as double) AS host_response_rate,
  CASE host_is_superhost WHEN 't' THEN true WHEN 'f' THEN false END AS host_is_superhost,
  host_identity_verified = 't' AS host_identity_verified, try_cast(bathrooms as double) AS bathrooms,
  try_cast(bedrooms as double) AS bedrooms, try_cast(beds as double) AS beds, host_response_time FROM v_raw_listings),
k AS (SELECT * FROM g1 WHERE price IS NOT NULL AND room_type IS NOT NULL AND host_id IS NOT NULL),
m AS (SELECT bedrooms, quantile_cont(bathrooms, 0.5) AS mb, quantile_cont(beds, 0.5) AS me FROM k WHERE bedrooms IS NOT NULL GROUP BY bedrooms),
g2 AS (SELECT k.* REPLACE (CASE WHEN k.bedrooms IS NOT NULL THEN coalesce(bathrooms, mb) END AS bathrooms,
  CASE WHEN k.bedrooms IS NOT NULL THEN coalesce(beds, me) END AS beds) FROM k LEFT JOIN m ON m.bedrooms = k.bedrooms)
"""
    + v.SQL["v_clean_listings"]
)

LISTING_COLS = [
    "id", "price", "host_id", "room_type", "host_response_rate", "host_is_superhost", "host_identity_verified",
    "bathrooms", "bedrooms", "beds", "host_response_time", "data_month",
]


@query("q_clean_listings", "SELECT * REPLACE (host_id::bigint AS host_id) FROM v_clean_listings")
def q_clean_listings(spark, folder):
    return cleaning.listings(raw_listings(spark, folder), "2025-05").select(*LISTING_COLS)


@query(
    "q_clean_calendar",
    """WITH r AS (SELECT l_suppkey AS listing_id, cast(l_shipdate as date) AS date, l_extendedprice AS price,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS minimum_nights,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity * 30 END AS maximum_nights FROM lineitem)
SELECT listing_id, date, price, coalesce(minimum_nights, (SELECT quantile_cont(minimum_nights, 0.5) FROM r)) AS minimum_nights,
  coalesce(maximum_nights, (SELECT quantile_cont(maximum_nights, 0.5) FROM r)) AS maximum_nights, '2025-05' AS data_month FROM r""",
)
def q_clean_calendar(spark, folder):
    line, price = F.col("l_linenumber"), F.format_number("l_extendedprice", 2)
    raw = v.table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("listing_id"),
        F.to_date("l_shipdate").alias("date"),
        F.concat(F.lit("$"), price).alias("price"),
        price.alias("adjusted_price"),
        F.when(line != 3, F.col("l_quantity")).alias("minimum_nights"),
        F.when(line != 5, F.col("l_quantity") * 30).alias("maximum_nights"),
    )
    return cleaning.calendar(raw, "2025-05")


@query(
    "q_clean_dim",
    "SELECT DISTINCT lower(trim(' ' || n_name)) AS neighbourhood, r_name AS neighbourhood_group, '2025-05' AS data_month FROM nation JOIN region ON r_regionkey = n_regionkey",
)
def q_clean_dim(spark, folder):
    return cleaning.neighbourhoods(raw_places(spark, folder), "2025-05")


def raw_places(spark, folder):
    """Neighbourhood rows, every one twice."""
    one = (
        v.table(spark, folder, "nation")
        .join(v.table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .select(F.concat(F.lit(" "), F.col("n_name")).alias("neighbourhood"), F.col("r_name").alias("neighbourhood_group"))
    )
    return one.unionByName(one)


WINSOR = v.BILLS + v.PAYMENTS
CREDIT_SQL = (
    "WITH r AS (SELECT DISTINCT * EXCLUDE (id) REPLACE (CASE WHEN education IN (0, 5, 6) THEN 4 ELSE education END AS education, "
    "CASE WHEN marriage = 0 THEN 3 ELSE marriage END AS marriage) FROM v_credit), q AS (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in WINSOR)
    + f" FROM r), w AS (SELECT limit_bal, education, marriage, target, {NEG} AS num_neg_bill_months, "
    + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, hi_{c}), lo_{c}) END AS {c}" for c in WINSOR)
    + ", "
    + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, 8), -2) END AS {c}" for c in v.DELAYS)
    + f" FROM r, q), m AS (SELECT *, {_sql_mean(v.BILLS)} AS avg_bill, {_sql_mean(v.PAYMENTS)} AS avg_pay FROM w),"
    + " f AS (SELECT *, CASE WHEN avg_bill IS NOT NULL THEN greatest(avg_bill, (SELECT min(avg_bill) FROM m WHERE avg_bill > 0)) END AS adj,"
    + f" greatest({', '.join(v.DELAYS)}) AS d FROM m)"
    + f""" SELECT limit_bal, education::bigint AS education, num_neg_bill_months, round(avg_bill, 4) AS avg_bill, round(limit_bal / adj, 6) AS utilization,
 round(avg_pay / adj, 6) AS payment_ratio, d AS max_delay, round({_sql_mean(v.DELAYS)}, 6) AS avg_delay,
 ({' OR '.join(f'coalesce({c} > 0, false)' for c in v.DELAYS)})::bigint AS ever_late, round(bill_6 - bill_1, 4) AS bill_trend, {CUT} AS delay_bucket, target::bigint AS target FROM f"""
)


def credit_clean(spark, folder):
    raw = v.credit(spark, folder)
    return cleaning.credit_features(
        cleaning.credit(raw, v.BILLS, v.PAYMENTS, v.DELAYS), v.BILLS, v.PAYMENTS, v.DELAYS
    )


@query("q_credit_features", CREDIT_SQL)
def q_credit_features(spark, folder):
    return credit_clean(spark, folder).select(
        "limit_bal",
        "education",
        "num_neg_bill_months",
        F.round("avg_bill", 4).alias("avg_bill"),
        F.round("utilization", 6).alias("utilization"),
        F.round("payment_ratio", 6).alias("payment_ratio"),
        "max_delay",
        F.round("avg_delay", 6).alias("avg_delay"),
        "ever_late",
        F.round("bill_trend", 4).alias("bill_trend"),
        "delay_bucket",
        "target",
    )

"""Sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import timeseries as ts
from ..session import scratch
from ..sources import files
from . import views as v
from .registry import query


@query("q_io_csv_roundtrip", "SELECT * FROM customer")
def q_io_csv_roundtrip(spark, folder):
    source = v.table(spark, folder, "customer")
    path = scratch(spark, "csv")
    source.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)
    return files.read_csv(spark, path, source.schema, partitions=8)


@query("q_limit_ordered", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5000")
def q_limit_ordered(spark, folder):
    return v.table(spark, folder, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5000)


@query(
    "q_months_available",
    "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS data_month FROM orders WHERE strftime(o_orderdate, '%Y-%m') <> '1995-05'",
)
def q_months_available(spark, folder):
    month = F.date_format("o_orderdate", "yyyy-MM")
    paths = v.table(spark, folder, "orders").select(
        F.concat(F.lit("/data/calendar_"), month, F.lit(".csv.gz")).alias("path")
    )
    return files.months_available(paths, "path", exclude=("1995-05",))


@query(
    "q_month_batch",
    """WITH r AS (SELECT strftime(o_orderdate, '%Y-%m') AS data_month, o_orderkey,
  o_orderkey % 1000 = 0 OR strftime(o_orderdate, '%Y-%m') = '1995-05' AS bad FROM orders),
m AS (SELECT data_month, count(*) AS n, count(*) FILTER (WHERE bad) AS n_bad, (sum(o_orderkey) FILTER (WHERE NOT bad))::bigint AS key_sum FROM r GROUP BY 1)
SELECT data_month, n, n_bad, CASE WHEN n_bad > 0.5 * n THEN 'failed' ELSE 'saved' END AS status,
  CASE WHEN n_bad > 0.5 * n THEN NULL ELSE key_sum END AS key_sum FROM m""",
)
def q_month_batch(spark, folder):
    month = F.date_format("o_orderdate", "yyyy-MM")
    broken = (F.col("o_orderkey") % 1000 == 0) | (month == "1995-05")
    orders = v.table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(broken, F.lit("n/a?")).otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.concat(F.lit("calendar_"), month).alias("file"),
    )
    path = scratch(spark, "feed")
    orders.repartition("file").write.partitionBy("file").option("header", True).csv(path)
    rows, _, report = files.load_months(
        spark, f"{path}/file=*/*.csv", "o_orderkey long, price double", scratch(spark, "loaded")
    )
    sums = rows.groupBy("data_month").agg(F.sum("o_orderkey").alias("key_sum"))
    return report.join(sums, "data_month", "left")


@query(
    "q_report_csv",
    "SELECT c_custkey, c_mktsegment, round(c_acctbal, 0) AS c_acctbal FROM customer",
)
def q_report_csv(spark, folder):
    path = scratch(spark, "report")
    files.write_report_csv(v.table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), path, {"c_acctbal": 0})
    return files.read_csv(spark, path, "c_custkey long, c_mktsegment string, c_acctbal double")


@query(
    "q_io_parquet_roundtrip",
    "SELECT o_orderkey, o_totalprice, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS data_month FROM orders",
)
def q_io_parquet_roundtrip(spark, folder):
    orders = v.table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("data_month")
    )
    path = scratch(spark, "months")
    files.write_months(orders, path, splits=2)
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "q_consolidate_schema",
    """SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) BETWEEN 1997 AND 1998 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
)
def q_consolidate_schema(spark, folder):
    orders = v.table(spark, folder, "orders")
    year = F.year("o_orderdate")
    a = orders.filter(year < 1997).select("o_orderkey", "o_totalprice", "o_orderpriority")
    b = orders.filter(year.between(1997, 1998)).select("o_totalprice", F.col("o_orderkey").cast("string").alias("o_orderkey"))
    c = orders.filter(year > 1998).select("o_orderpriority", "o_totalprice", "o_orderkey", "o_custkey")
    return files.consolidate([a, b, c])


@query(
    "q_upsert_missing",
    """SELECT event_type, cast(ts as date) AS day, count(*) AS n,
       cast(CASE WHEN day(ts) % 2 = 0 THEN 0 ELSE 1 END as bigint) AS momentum
FROM events GROUP BY event_type, cast(ts as date), day(ts) % 2""",
)
def q_upsert_missing(spark, folder):
    events = v.table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    keys = ["event_type", "day"]

    def compute(rows):
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    # The store holds the even days and was written before the momentum column existed.
    stored = compute(events.filter(F.day("day") % 2 == 0))
    wanted = events.select(*keys).distinct()
    return files.upsert_missing(
        stored,
        wanted,
        lambda missing: compute(events.join(missing, keys, "left_semi")).withColumn("momentum", F.lit(1)),
        keys,
        {"momentum": 0},
    )


@query(
    "q_universe_sector",
    "SELECT s_suppkey AS ticker, replace('S.' || s_suppkey, '.', '-') AS symbol, n_name AS sector FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey",
)
def q_universe_sector(spark, folder):
    return universe(spark, folder)


def universe(spark, folder):
    from ..operators.screens import universe as build

    raw = v.table(spark, folder, "supplier").join(
        v.table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey"), "left"
    )
    return build(
        raw.select(
            F.col("s_suppkey").alias("ticker"),
            F.concat(F.lit("S."), F.col("s_suppkey")).alias("symbol"),
            F.col("n_name").alias("sector"),
        )
    )


@query(
    "q_source_fallback",
    """SELECT ticker, date, close, CASE WHEN ticker % 2 = 0 THEN 'primary' ELSE 'fallback' END AS origin FROM v_bars""",
)
def q_source_fallback(spark, folder):
    bars = v.bars(spark, folder).select("ticker", "date", "close")
    primary = bars.filter(F.col("ticker") % 2 == 0).withColumn("origin", F.lit("primary"))
    return files.with_fallback(primary, bars.withColumn("origin", F.lit("fallback")), "ticker")


@query(
    "q_unpivot_panel",
    """SELECT cast(o_orderdate as date) AS date, o_orderstatus AS ticker, count(*) AS value
FROM orders GROUP BY cast(o_orderdate as date), o_orderstatus""",
)
def q_unpivot_panel(spark, folder):
    wide = (
        v.table(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .pivot("o_orderstatus", ["F", "O", "P"])
        .count()
    )
    return ts.to_long(wide, ["date"], ["F", "O", "P", "F"], min_rows=11)


@query(
    "q_asof_slice",
    """SELECT ticker, date, close FROM v_bars
WHERE date >= DATE '2001-01-01' - INTERVAL 430 DAY AND date < DATE '2001-01-01'""",
)
def q_asof_slice(spark, folder):
    return ts.as_of(v.bars(spark, folder), "date", "2001-01-01", 360, 70).select("ticker", "date", "close")


@query(
    "q_news_cap",
    """SELECT doc_id, source, ticker, day FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, day ORDER BY created_at DESC, doc_id DESC) AS rn FROM v_news) WHERE rn <= 30""",
)
def q_news_cap(spark, folder):
    from ..operators.sentiment import news_window

    return news_window(v.news(spark, folder)).select("doc_id", "source", "ticker", "day")


@query(
    "q_recent_news",
    """SELECT doc_id, ticker FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY created_at DESC, doc_id DESC) AS rn FROM v_news) WHERE rn <= 15""",
)
def q_recent_news(spark, folder):
    from ..operators.sentiment import recent_news

    return recent_news(v.news(spark, folder)).select("doc_id", "ticker")

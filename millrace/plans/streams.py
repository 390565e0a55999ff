"""Streaming jobs run to the end of their input; the twins are the batch forms."""

from pyspark.sql import functions as F

from ..session import scratch
from ..streaming import jobs
from . import trading
from . import views as v
from .registry import query


def events(spark, folder):
    schema = v.table(spark, folder, "events").schema
    return jobs.file_stream(spark, folder, schema, "events.parquet")


def finish(spark, stream, label, mode="append", keys=None, work=None):
    path = scratch(spark, label)
    run = jobs.start(stream, path, scratch(spark, f"{label}-state"), mode, work=work)
    run.awaitTermination()
    return jobs.stored(spark, path, keys)


@query(
    "q_stream_daily",
    "SELECT cast(ts as date) AS day, event_type, count(*) AS n, max(value) AS top FROM events GROUP BY ALL",
)
def q_stream_daily(spark, folder):
    rolled = jobs.daily_news(events(spark, folder), ["event_type"], measures={"top": F.max("value")})
    return finish(spark, rolled, "daily", "update", ["day", "event_type"])


@query("q_stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def q_stream_dedup(spark, folder):
    unique = jobs.dedup(events(spark, folder), ["user_id", "event_type"], watermark="60 days")
    return finish(spark, unique.select("user_id", "event_type"), "dedup")


@query(
    "q_stream_cooldown",
    """WITH RECURSIVE n AS (SELECT a.user_id, a.event_id, a.ts, (SELECT min(b.ts) FROM events b WHERE b.user_id = a.user_id AND b.ts >= a.ts + INTERVAL 24 HOUR) AS nxt FROM events a),
acc AS (SELECT n.* FROM n JOIN (SELECT user_id, min(ts) AS ts FROM events GROUP BY 1) f USING (user_id, ts)
 UNION ALL SELECT n.* FROM acc JOIN n ON n.user_id = acc.user_id AND n.ts = acc.nxt)
SELECT event_id AS id, user_id AS key FROM acc""",
)
def q_stream_cooldown(spark, folder):
    accepted = jobs.cooldown(events(spark, folder), "user_id", row_id="event_id")
    return finish(spark, accepted, "cooldown").select("id", "key")


@query(
    "q_stream_daily_cap",
    "SELECT event_id AS id, cast(ts as date) AS key FROM events QUALIFY row_number() OVER (PARTITION BY cast(ts as date) ORDER BY ts, event_id) <= 2",
)
def q_stream_daily_cap(spark, folder):
    capped = jobs.daily_cap(events(spark, folder), row_id="event_id")
    return finish(spark, capped, "cap").select("id", "key")


@query(
    "q_stream_alerts",
    """WITH u AS (SELECT user_id AS ticker, arg_max(value * 100, ts) AS current_price FROM events GROUP BY 1),
m AS (SELECT ticker, avg(close) AS ma, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM v_bars) WHERE rn <= 50 GROUP BY ticker),
s AS (SELECT ticker, arg_max(score, date) AS score FROM v_sent GROUP BY 1)
SELECT * FROM (SELECT p.ticker, CASE WHEN n >= 50 AND u.current_price < ma THEN 'TREND_FAIL' WHEN score < 4 THEN 'SENTIMENT_SELL' END AS alert
FROM v_positions p JOIN u USING (ticker) LEFT JOIN m USING (ticker) LEFT JOIN s USING (ticker)) WHERE alert IS NOT NULL""",
)
def q_stream_alerts(spark, folder):
    prices = events(spark, folder).select(
        F.col("user_id").alias("ticker"), (F.col("value") * 100).alias("current_price"), "ts"
    )
    path = scratch(spark, "alerts")
    run = jobs.exit_alerts(
        prices,
        trading.positions(spark, folder),
        v.bars(spark, folder),
        trading.sentiment(spark, folder),
        path,
        scratch(spark, "alerts-state"),
        every=None,
    )
    run.awaitTermination()
    return jobs.stored(spark, path).select("ticker", "alert")

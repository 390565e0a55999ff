"""Headlines, sentiment and scalar functions."""

from pyspark.sql import functions as F

from ..functions import dates, text, values as x
from ..operators import sentiment as s
from . import views as v
from .registry import query

SOURCES = [f"src{i}" for i in range(16)]
KEYWORDS = [
    ("en", 1, "driver", 1.8, "other"), ("en", 1, "driver", 1.8, "then "), ("en", 2, "risk", 2.0, "ththth"),
    ("en", 3, "trade", 1.2, "the "), ("en", 4, "late", 1.8, "ing"), ("fr", 1, "driver", 1.5, "eaux"),
    ("fr", 2, "risk", 1.7, "tion "), ("de", 1, "driver", 1.4, "sch"), ("de", 2, "weak", 0.5, "en"),
]
DEFAULTS = {"en": 0.7, "fr": 0.8, "de": 0.6}

v.SQL["v_keywords"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{a}', {b}, '{c}', {d}::double, '{e}', {DEFAULTS[a]}::double)" for a, b, c, d, e in KEYWORDS
) + ") t(sector, cat_order, category, weight, keyword, default_weight)"


def keywords(spark):
    rows = [(*k, DEFAULTS[k[0]]) for k in KEYWORDS]
    return spark.createDataFrame(
        rows, "sector string, cat_order int, category string, weight double, keyword string, default_weight double"
    )


CHARS = "string_split(lower({0}), '')"
GRAMS = (
    "CASE WHEN length({0}) >= 3 THEN list_distinct(list_transform(list_zip("
    + "{c}[:-3], {c}[2:-2], {c}[3:]".replace("{c}", CHARS)
    + "), lambda x: x[1] || x[2] || x[3])) ELSE [] END"
)
v.SQL["v_page"] = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, day ORDER BY created_at DESC, doc_id DESC) AS pos FROM v_news)"""
v.SQL["v_unique"] = f"""
WITH RECURSIVE g AS MATERIALIZED (SELECT ticker, day, doc_id, pos, {GRAMS.format('headline')} AS grams FROM v_page),
x AS MATERIALIZED (SELECT ticker, day, pos, len(grams) AS n, unnest(grams) AS gram FROM g),
shared AS (SELECT a.ticker, a.day, a.pos AS ap, b.pos AS bp, a.n AS an, b.n AS bn, count(*) AS c FROM x a JOIN x b ON a.ticker = b.ticker AND a.day = b.day AND a.gram = b.gram
 WHERE a.pos < b.pos AND least(a.n, b.n) >= 0.72 * greatest(a.n, b.n) GROUP BY ALL),
pairs AS MATERIALIZED (SELECT ticker, day, bp AS pos, list(ap) AS earlier FROM shared WHERE c::double / (an + bn - c) >= 0.72 GROUP BY ALL),
places AS MATERIALIZED (SELECT g.ticker, g.day, g.pos, p.earlier FROM g LEFT JOIN pairs p ON p.ticker = g.ticker AND p.day = g.day AND p.pos = g.pos),
fold AS (SELECT DISTINCT ticker, day, 0::bigint AS i, []::bigint[] AS kept FROM places
 UNION ALL SELECT f.ticker, f.day, f.i + 1, CASE WHEN p.earlier IS NOT NULL AND list_has_any(p.earlier, f.kept) THEN f.kept ELSE list_append(f.kept, f.i + 1) END
 FROM fold f JOIN places p ON p.ticker = f.ticker AND p.day = f.day AND p.pos = f.i + 1),
last AS (SELECT ticker, day, arg_max(kept, i) AS kept FROM fold GROUP BY ALL)
SELECT n.* FROM v_page n JOIN last l ON l.ticker = n.ticker AND l.day = n.day AND list_contains(l.kept, n.pos)
"""
KEY = "trim(regexp_replace(lower(substr(headline, 1, 60)), '[^\\p{L}\\p{N} ]', '', 'g'))"
v.SQL["v_keyed"] = f"""SELECT * EXCLUDE (k, rn) FROM (SELECT *, row_number() OVER (PARTITION BY ticker, day, k ORDER BY pos) AS rn FROM (SELECT *, {KEY} AS k FROM v_unique) WHERE k <> '') WHERE rn = 1"""
v.SQL["v_weighted"] = """
SELECT n.*, n.ticker AS sector, CASE WHEN w.weight > coalesce(d.default_weight, 0.8) THEN w.weight ELSE coalesce(d.default_weight, 0.8) END AS weight,
 CASE WHEN w.weight > coalesce(d.default_weight, 0.8) THEN w.category ELSE 'default' END AS category
FROM v_keyed n LEFT JOIN (SELECT DISTINCT sector, default_weight FROM v_keywords) d ON d.sector = n.ticker
LEFT JOIN (SELECT doc_id, weight, category FROM (SELECT doc_id, weight, category, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, cat_order) AS rn
  FROM v_keyed JOIN v_keywords ON sector = ticker AND contains(lower(headline), keyword)) WHERE rn = 1) w USING (doc_id)
WHERE source IS NULL OR source = '' OR source IN (""" + ", ".join(f"'{c}'" for c in SOURCES) + ")"
v.SQL["v_conv_news"] = """
SELECT *, greatest(0.0, least(10.0, 5 + (base - 5) * weight)) AS conviction,
 exp(-0.08 * greatest(date_diff('second', created_at, cast(day as timestamp) + INTERVAL '86399 seconds') / 3600.0, 0)) AS decay_weight
FROM (SELECT *, CASE label WHEN 'positive' THEN 5 + confidence * 5 WHEN 'negative' THEN 5 - confidence * 5 ELSE 5.0 END AS base FROM v_weighted)
"""
v.SQL["v_daily"] = """
SELECT ticker, day, n AS headline_count, CASE WHEN n >= 5 THEN score ELSE 5.0 END AS score,
 CASE WHEN n >= 5 AND pos_n + neg_n >= 3 THEN greatest(pos_n, neg_n)::double / (pos_n + neg_n) ELSE 0.0 END AS consensus_pct,
 (CASE WHEN n < 5 THEN 0 WHEN recent > older + 0.5 THEN 1 WHEN recent < older - 0.5 THEN -1 ELSE 0 END)::bigint AS momentum,
 CASE WHEN n >= 5 THEN pos_n ELSE 0 END AS positive_count, CASE WHEN n >= 5 THEN neg_n ELSE 0 END AS negative_count, CASE WHEN n >= 5 THEN neu_n ELSE 0 END AS neutral_count
FROM (SELECT ticker, day, count(*) AS n, count(*) FILTER (label = 'positive') AS pos_n, count(*) FILTER (label = 'negative') AS neg_n, count(*) FILTER (label = 'neutral') AS neu_n,
 sum(conviction * decay_weight) / sum(decay_weight) AS score, avg(conviction) FILTER (i <= half) AS recent, coalesce(avg(conviction) FILTER (i > half), 0) AS older
 FROM (SELECT *, row_number() OVER (PARTITION BY ticker, day ORDER BY pos) AS i, greatest(1, count(*) OVER (PARTITION BY ticker, day) // 2) AS half FROM v_conv_news) GROUP BY ticker, day)
"""


def unique(spark, folder):
    return s.dedup_jaccard(s.placed(v.news(spark, folder)))


def weighted(spark, folder):
    news = v.news(spark, folder).withColumn("sector", F.col("ticker"))
    return s.pipeline(news, keywords(spark), SOURCES)


def daily(spark, folder):
    return s.daily(weighted(spark, folder))


@query("q_jaccard_dedup", "SELECT doc_id, ticker, day, pos FROM v_unique")
def q_jaccard_dedup(spark, folder):
    return unique(spark, folder).select("doc_id", "ticker", "day", "pos")


@query(
    "q_headline_key",
    f"SELECT ticker, k AS key, min(doc_id) AS doc_id FROM (SELECT *, {KEY} AS k FROM v_news) WHERE k <> '' GROUP BY ALL",
)
def q_headline_key(spark, folder):
    keyed = v.news(spark, folder).select("ticker", "doc_id", text.headline_key(F.col("headline")).alias("key"))
    return keyed.filter("key <> ''").groupBy("ticker", "key").agg(F.min("doc_id").alias("doc_id"))


@query(
    "q_dedup_key",
    f"SELECT doc_id, ticker FROM (SELECT *, row_number() OVER (PARTITION BY ticker, k ORDER BY doc_id) AS rn FROM (SELECT *, {KEY} AS k FROM v_news) WHERE k <> '') WHERE rn = 1",
)
def q_dedup_key(spark, folder):
    news = v.news(spark, folder).select("ticker", "doc_id", "headline")
    return s.dedup_key(news, group=("ticker",), order=("doc_id",)).select("doc_id", "ticker")


@query(
    "q_trusted",
    "SELECT doc_id, src AS source FROM (SELECT doc_id, nullif(source, 'src3') AS src FROM documents) WHERE src IS NULL OR src IN ("
    + ", ".join(f"'{c}'" for c in SOURCES) + ")",
)
def q_trusted(spark, folder):
    docs = v.table(spark, folder, "documents").select("doc_id", F.nullif(F.col("source"), F.lit("src3")).alias("source"))
    return s.trusted(docs, SOURCES)


@query(
    "q_conviction",
    "SELECT doc_id, round(CASE label WHEN 'positive' THEN 5 + confidence * 5 WHEN 'negative' THEN 5 - confidence * 5 ELSE 5.0 END, 9) AS base FROM v_news",
)
def q_conviction(spark, folder):
    base = s.conviction(F.col("label"), F.col("confidence"))
    return v.news(spark, folder).select("doc_id", F.round(base, 9).alias("base"))


@query(
    "q_sector_weight",
    "SELECT doc_id, category, weight, round(conviction, 6) AS conviction, round(decay_weight, 9) AS decay_weight FROM v_conv_news",
)
def q_sector_weight(spark, folder):
    return weighted(spark, folder).select(
        "doc_id", "category", "weight", F.round("conviction", 6).alias("conviction"), F.round("decay_weight", 9).alias("decay_weight")
    )


@query("q_sentiment_daily", "SELECT * REPLACE (round(score, 6) AS score) FROM v_daily")
def q_sentiment_daily(spark, folder):
    return daily(spark, folder).withColumn("score", F.round("score", 6))


@query(
    "q_tradeable",
    """SELECT ticker, day, round(0.7 * ((day(day) * 7) % 10) / 10.0 + 0.3 * score / 10, 6) AS final_score,
 0.7 * ((day(day) * 7) % 10) / 10.0 + 0.3 * score / 10 >= 0.65 AND consensus_pct >= 0.7 AND headline_count >= 5 AND momentum >= 0 AS tradeable FROM v_daily""",
)
def q_tradeable(spark, folder):
    days = daily(spark, folder).withColumn("tech_norm", ((F.day("day") * 7) % 10) / F.lit(10.0))
    return s.final(days).select("ticker", "day", F.round("final_score", 6).alias("final_score"), "tradeable")


@query(
    "q_sentiment_series",
    """SELECT t.ticker, d.day, round(coalesce(score, 5.0), 6) AS score, round(coalesce(score, 5.0), 2) <> 5.0 AS is_real
FROM (SELECT DISTINCT ticker FROM v_daily) t, (SELECT DISTINCT day FROM v_news) d LEFT JOIN v_daily x ON x.ticker = t.ticker AND x.day = d.day""",
)
def q_sentiment_series(spark, folder):
    out = s.series(daily(spark, folder), v.news(spark, folder))
    return out.withColumn("score", F.round("score", 6))


@query(
    "q_top_categories",
    """WITH w AS (SELECT ticker, day, category, max(weight) AS weight, row_number() OVER (PARTITION BY ticker, day ORDER BY max(weight) DESC, category) AS place FROM v_conv_news GROUP BY ticker, day, category)
SELECT w.*, bullish FROM w JOIN (SELECT ticker, day, count(*) FILTER (label = 'positive') >= count(*) FILTER (label = 'negative') AS bullish FROM v_conv_news GROUP BY ALL) USING (ticker, day) WHERE place <= 3""",
)
def q_top_categories(spark, folder):
    return s.top_categories(weighted(spark, folder))


# -- scalar functions ----------------------------------------------------------------------------


@query(
    "q_string_funcs",
    """SELECT page_id, lower(url) AS lower_url, upper(substr(url, 1, 12)) AS head, replace(url, 'http://', '') AS bare, regexp_replace(url, '[0-9]+', '#', 'g') AS masked,
 contains(html, '</p>') AS has_p, split_part(url, '/', len(string_split(url, '/'))::int) AS base, trim('. ' FROM coalesce(url, '') || '. ' || '') AS sentence, length(html)::bigint AS n FROM pages""",
)
def q_string_funcs(spark, folder):
    url = F.col("url")
    return v.table(spark, folder, "pages").select(
        "page_id",
        F.lower(url).alias("lower_url"),
        F.upper(F.substring(url, 1, 12)).alias("head"),
        F.replace(url, F.lit("http://"), F.lit("")).alias("bare"),
        F.regexp_replace(url, "[0-9]+", "#").alias("masked"),
        F.contains(F.col("html"), F.lit("</p>")).alias("has_p"),
        text.basename(url).alias("base"),
        text.join_sentences(url, F.lit("")).alias("sentence"),
        F.length("html").alias("n"),
    )


@query(
    "q_jaccard",
    f"""WITH g AS (SELECT conv_id, turn, {GRAMS.format('text')} AS grams FROM conversations)
SELECT a.conv_id, b.turn, round(CASE WHEN len(a.grams) + len(b.grams) = 0 THEN 0 ELSE len(list_intersect(a.grams, b.grams))::double / (len(a.grams) + len(b.grams) - len(list_intersect(a.grams, b.grams))) END, 9) AS similarity
FROM g a JOIN g b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn""",
)
def q_jaccard(spark, folder):
    grams = v.table(spark, folder, "conversations").select("conv_id", "turn", text.ngrams(F.col("text")).alias("grams"))
    before = grams.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("grams").alias("other"))
    return grams.join(before, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.round(text.jaccard(F.col("grams"), F.col("other")), 9).alias("similarity")
    )


@query(
    "q_date_funcs",
    """SELECT event_id, cast(ts as date) AS day, strftime(ts, '%Y-%m') AS month, cast(ts as date) + 5 AS later,
 date_trunc('second', ts) AS back FROM events""",
)
def q_date_funcs(spark, folder):
    ts = F.col("ts")
    shown = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return v.table(spark, folder, "events").select(
        "event_id",
        F.to_date(ts).alias("day"),
        dates.month_label(ts).alias("month"),
        F.date_add(F.to_date(ts), 5).alias("later"),
        dates.iso_instant(shown).cast("timestamp_ntz").alias("back"),
    )


@query(
    "q_floor_days",
    "SELECT event_id, floor(date_diff('microsecond', ts, TIMESTAMP '2024-01-15 12:00:00') / 86400000000.0)::bigint AS days FROM events",
)
def q_floor_days(spark, folder):
    middle = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return v.table(spark, folder, "events").select("event_id", dates.floor_days(middle, F.col("ts")).alias("days"))


@query(
    "q_year_week",
    "SELECT DISTINCT strftime(o_orderdate, '%G-W%V') AS year_week, (date_diff('day', DATE '1969-12-29', cast(o_orderdate as date)) // 7)::bigint AS running_week FROM orders",
)
def q_year_week(spark, folder):
    day = F.col("o_orderdate")
    return v.table(spark, folder, "orders").select(
        dates.year_week(day).alias("year_week"), dates.running_week(day).alias("running_week")
    ).distinct()


@query(
    "q_time_decay",
    """SELECT event_id, round(CASE WHEN event_type = 'error' THEN 1.0 ELSE exp(-0.08 * greatest(date_diff('microsecond', ts, TIMESTAMP '2024-01-15 12:00:00') / 3600000000.0, 0)) END, 9) AS w FROM events""",
)
def q_time_decay(spark, folder):
    ts = F.when(F.col("event_type") != "error", F.col("ts"))
    w = s.time_decay(ts, F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return v.table(spark, folder, "events").select("event_id", F.round(w, 9).alias("w"))


@query(
    "q_math_funcs",
    """SELECT event_id, round(pow(1 + value / 1000, 1 / 3.0) - 1, 9) AS ann, round(sqrt(value) * sqrt(252), 6) AS vol, abs(value - 50) AS dist,
 greatest(least(value, 90), 10) AS clamped, trunc(value)::bigint AS whole FROM events""",
)
def q_math_funcs(spark, folder):
    value = F.col("value")
    return v.table(spark, folder, "events").select(
        "event_id",
        F.round(x.annualised(value / 1000, 3), 9).alias("ann"),
        F.round(F.sqrt(value) * F.sqrt(F.lit(252.0)), 6).alias("vol"),
        F.abs(value - 50).alias("dist"),
        x.clip(value, 10.0, 90.0).alias("clamped"),
        value.cast("bigint").alias("whole"),
    )


@query(
    "q_array_funcs",
    """SELECT vec_id, embedding[1]::double AS first, (list_position(embedding, list_max(embedding)) - 1)::bigint AS best, len(list_distinct(embedding))::bigint AS n_distinct,
 list_transform(generate_series(0, 9), lambda i: CASE WHEN i = label % 10 THEN 1 ELSE 0 END)::varchar AS hot FROM embeddings""",
)
def q_array_funcs(spark, folder):
    e = F.col("embedding")
    hot = x.one_hot(F.col("label") % 10, 10)
    shown = F.concat(F.lit("["), F.array_join(hot.cast("array<string>"), ", "), F.lit("]"))
    return v.table(spark, folder, "embeddings").select(
        "vec_id",
        F.get(e, F.lit(0)).cast("double").alias("first"),
        x.argmax(e).alias("best"),
        F.size(F.array_distinct(e)).alias("n_distinct"),
        shown.alias("hot"),
    )


@query(
    "q_json_props",
    """SELECT event_id, cast(json_extract_string(props, '$.k') as bigint) AS k, '{"event_id":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}' AS dumped FROM events""",
)
def q_json_props(spark, folder):
    parsed = F.from_json("props", "k int")
    return v.table(spark, folder, "events").select(
        "event_id", parsed["k"].alias("k"), F.to_json(F.struct("event_id", parsed["k"].alias("k"))).alias("dumped")
    )

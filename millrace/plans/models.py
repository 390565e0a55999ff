"""Evaluation, model pipelines, forecasts and detections."""

from pyspark.sql import functions as F

from ..operators import cleaning, detections, evaluation as ev, forecast, models, sampling, stats
from . import views as v
from .registry import query
from ..session import scratch

v.SQL["v_curve"] = """
SELECT threshold, pos, neg, tp, fp, p - tp AS fn, n - fp AS tn, tp::double / (tp + fp) AS precision, tp::double / p AS recall, fp::double / n AS fpr,
 (2 * (tp::double / (tp + fp)) * (tp::double / p)) / nullif(tp::double / (tp + fp) + tp::double / p, 0) AS f1
FROM (SELECT *, sum(pos) OVER (ORDER BY threshold DESC)::bigint AS tp, sum(neg) OVER (ORDER BY threshold DESC)::bigint AS fp, sum(pos) OVER ()::bigint AS p, sum(neg) OVER ()::bigint AS n
 FROM (SELECT score AS threshold, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM v_scores GROUP BY 1))
"""


@query(
    "q_class_report",
    "WITH p AS (SELECT label, (score >= 0.5)::int AS pred FROM v_scores), c AS (SELECT unnest([0, 1])::bigint AS c), k AS (SELECT c, count(*) FILTER (label = c AND pred = c) AS tp, count(*) FILTER (pred = c) AS said, count(*) FILTER (label = c) AS support FROM p, c GROUP BY c) "
    """SELECT c AS class, tp::double / said AS precision, tp::double / support AS recall, round(2 * (tp::double / said) * (tp::double / support) / (tp::double / said + tp::double / support), 9) AS f1, support,
 (SELECT count(*) FILTER (label = pred)::double / count(*) FROM p) AS accuracy FROM k""",
)
def q_class_report(spark, folder):
    return ev.report(ev.predict(v.scores(spark, folder), 0.5)).withColumn("f1", F.round("f1", 9))


@query(
    "q_roc_auc",
    "SELECT round(sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)), 9) AS auc FROM (SELECT pos::double AS pos, neg::double AS neg, tp FROM v_curve)",
)
def q_roc_auc(spark, folder):
    return ev.roc_auc(v.scores(spark, folder)).withColumn("auc", F.round("auc", 9))


@query("q_roc_curve", "SELECT threshold, fpr, recall AS tpr FROM v_curve")
def q_roc_curve(spark, folder):
    return ev.roc_curve(v.scores(spark, folder))


@query("q_pr_curve", "SELECT threshold, precision, recall FROM v_curve UNION ALL SELECT NULL, 1.0, 0.0")
def q_pr_curve(spark, folder):
    return ev.pr_curve(v.scores(spark, folder))


M = "threshold, tp, fp, fn, tn, precision, recall, round(f1, 9) AS f1, fpr, fn * 10 + fp AS cost, (fn * 10 + fp)::double / (tp + fp + fn + tn) AS cost_per_account"
BEST_F1 = f"(SELECT 'best_f1' AS strategy, {M} FROM (SELECT * FROM v_curve WHERE f1 IS NOT NULL ORDER BY f1 DESC, threshold LIMIT 1))"
BEST_COST = f"(SELECT 'best_cost' AS strategy, {M} FROM (SELECT * FROM v_curve ORDER BY fn * 10 + fp, threshold LIMIT 1))"
RECALL = " UNION ALL ".join(
    f"(SELECT 'recall_{t}' AS strategy, {M} FROM (SELECT * FROM v_curve WHERE recall >= {t / 100} ORDER BY threshold DESC LIMIT 1))"
    for t in (60, 65, 70)
)


def shown(df):
    return df.withColumn("f1", F.round("f1", 9))


@query("q_best_f1", f"SELECT * FROM {BEST_F1}")
def q_best_f1(spark, folder):
    return shown(ev.best_f1(v.scores(spark, folder)))


@query("q_recall_target", RECALL)
def q_recall_target(spark, folder):
    return shown(ev.threshold_for_recall(v.scores(spark, folder)))


@query("q_best_cost", f"SELECT * FROM {BEST_COST}")
def q_best_cost(spark, folder):
    return shown(ev.best_cost(v.scores(spark, folder)))


@query("q_strategies", f"SELECT * FROM {BEST_F1} UNION ALL SELECT * FROM {BEST_COST} UNION ALL {RECALL}")
def q_strategies(spark, folder):
    return shown(ev.strategies(v.scores(spark, folder)))


@query(
    "q_confusion",
    "SELECT label::bigint AS label, (score >= 0.5)::bigint AS pred, count(*) AS n, count(*)::double / sum(count(*)) OVER (PARTITION BY label) AS share FROM v_scores GROUP BY label, (score >= 0.5)::bigint",
)
def q_confusion(spark, folder):
    return ev.confusion(ev.predict(v.scores(spark, folder), 0.5))


DENSE = [[((i * 7 + j * 13) % 11 - 5) / 10 for i in range(64)] for j in range(3)]
BIAS = [0.1, 0.0, -0.1]
LOGITS = [
    f"(list_dot_product(e, [{', '.join(str(x) for x in w)}]::double[]) + {b})" for w, b in zip(DENSE, BIAS)
]
v.SQL["v_logits"] = "SELECT vec_id, label % 3 AS label, " + ", ".join(f"{z} AS z{i}" for i, z in enumerate(LOGITS)) + " FROM (SELECT vec_id, label, embedding::double[] AS e FROM embeddings)"
v.SQL["v_probs"] = "SELECT vec_id, label, " + ", ".join(
    f"exp(z{i} - greatest(z0, z1, z2)) / (exp(z0 - greatest(z0, z1, z2)) + exp(z1 - greatest(z0, z1, z2)) + exp(z2 - greatest(z0, z1, z2))) AS p{i}" for i in range(3)
) + " FROM v_logits"


def logits(spark, folder):
    e = F.col("embedding").cast("array<double>")
    return v.table(spark, folder, "embeddings").select(
        "vec_id", (F.col("label") % 3).alias("label"), ev.dense(e, DENSE, BIAS).alias("z")
    )


@query("q_dense_score", "SELECT vec_id, round(greatest(z0, 0), 6) AS a0, round(greatest(z1, 0), 6) AS a1, round(greatest(z2, 0), 6) AS a2 FROM v_logits")
def q_dense_score(spark, folder):
    active = logits(spark, folder).withColumn("a", ev.relu(F.col("z")))
    return active.select("vec_id", *[F.round(F.get("a", F.lit(i)), 6).alias(f"a{i}") for i in range(3)])


@query("q_softmax", "SELECT vec_id, round(p0, 9) AS p0, round(p1, 9) AS p1, round(p2, 9) AS p2 FROM v_probs")
def q_softmax(spark, folder):
    probs = logits(spark, folder).withColumn("p", ev.softmax(F.col("z")))
    return probs.select("vec_id", *[F.round(F.get("p", F.lit(i)), 9).alias(f"p{i}") for i in range(3)])


@query(
    "q_log_loss",
    """SELECT round(avg((CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END = label)::int), 9) AS accuracy,
 round(avg(-ln(least(greatest(CASE label WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1e-7), 1 - 1e-7))), 6) AS log_loss FROM v_probs""",
)
def q_log_loss(spark, folder):
    probs = logits(spark, folder).withColumn("probs", ev.softmax(F.col("z")))
    return ev.multiclass(probs).withColumns({"accuracy": F.round("accuracy", 9), "log_loss": F.round("log_loss", 6)})


@query("q_class_weights", "SELECT quality::bigint AS label, count(*) AS n, (SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)) AS weight FROM labels GROUP BY 1")
def q_class_weights(spark, folder):
    return ev.class_weights(v.table(spark, folder, "labels").select(F.col("quality").alias("label")))


@query("q_standardize", "SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 8) AS z_c_acctbal FROM customer")
def q_standardize(spark, folder):
    rows = v.table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    out = models.preprocessed(rows, ["c_acctbal"], ["c_mktsegment"])
    return out.select("c_custkey", F.round("z_c_acctbal", 8).alias("z_c_acctbal"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("q_onehot", "SELECT o_orderkey, " + ", ".join(f"(o_orderpriority = '{p}')::bigint AS is_{i}" for i, p in enumerate(PRIORITIES)) + " FROM orders")
def q_onehot(spark, folder):
    rows = v.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    hot = models.preprocessed(rows, ["o_totalprice"], ["o_orderpriority"])
    return hot.select(
        "o_orderkey",
        *[F.coalesce(F.try_element_at("hot_o_orderpriority", F.lit(p)), F.lit(0)).alias(f"is_{i}") for i, p in enumerate(PRIORITIES)],
    )


@query(
    "q_minibatch",
    """SELECT l.epoch, doc_id, ((row_number() OVER (PARTITION BY epoch ORDER BY md5('42-' || epoch || '-' || doc_id), doc_id) - 1) // 32)::bigint AS batch
FROM (SELECT unnest(generate_series(1, 10))::bigint AS epoch) l, documents""",
)
def q_minibatch(spark, folder):
    return sampling.minibatches(v.table(spark, folder, "documents").select("doc_id"), "doc_id")


@query(
    "q_split_80_20",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42' || doc_id), doc_id) <= floor(0.8 * (SELECT count(*) FROM documents)) AS is_first FROM documents",
)
def q_split_80_20(spark, folder):
    return sampling.split(v.table(spark, folder, "documents").select("doc_id"), "doc_id")


# -- model pipelines (no SQL twin) ------------------------------------------------------------------

NUMERIC = ["limit_bal", "avg_bill", "utilization", "payment_ratio", "avg_delay", "bill_trend", "num_neg_bill_months"]


def credit_rows(spark, folder):
    # The clean table feeds several fits: it is written once instead of being computed per pass.
    # The label, more lines returned than accepted, is no function of the features; every customer stays.
    sent = v.table(spark, folder, "lineitem").join(v.table(spark, folder, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    flag = F.col("l_returnflag")
    returns = sent.groupBy("o_custkey").agg((F.count_if(flag == "R") > F.count_if(flag == "A")).cast("int").alias("_more"))
    raw = v.credit(spark, folder).drop("target").join(returns, F.col("id") == F.col("o_custkey"), "left")
    raw = raw.withColumn("label", F.coalesce("_more", F.lit(0))).drop("_more", "o_custkey")
    rows = cleaning.credit_features(cleaning.credit(raw, v.BILLS, v.PAYMENTS, v.DELAYS), v.BILLS, v.PAYMENTS, v.DELAYS)
    path = scratch(spark, "credit")
    rows.na.fill(0.0, NUMERIC).na.fill("none", ["delay_bucket"]).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    key = F.md5(F.concat_ws("|", *NUMERIC))
    return models.balanced(stored.withColumn("is_train", F.conv(F.substring(key, 1, 4), 16, 10).cast("int") < 52428))


@query("q_ml_logistic")
def q_ml_logistic(spark, folder):
    rows = credit_rows(spark, folder)
    train, held = rows.filter("is_train"), rows.filter("not is_train")
    fit = models.pipeline(NUMERIC, ["delay_bucket", "education"], models.logistic(10, train.count(), l1=True)).fit(train)
    return ev.report(models.score(fit, held))


@query("q_ml_forest")
def q_ml_forest(spark, folder):
    rows = credit_rows(spark, folder)
    train, held = rows.filter("is_train"), rows.filter("not is_train")
    fit = models.pipeline(NUMERIC, ["delay_bucket", "education"], models.forest()).fit(train)
    return ev.strategies(models.score(fit, held))


@query("q_ml_mlp")
def q_ml_mlp(spark, folder):
    e = F.col("embedding")
    rows = v.table(spark, folder, "embeddings").select(
        *[F.get(e, F.lit(i)).cast("double").alias(f"x{i}") for i in range(64)], (F.col("label") % 3).alias("y"), "vec_id"
    )
    marked = sampling.split(rows, "vec_id")
    path = scratch(spark, "matrix")
    marked.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    part = lambda flag: models.load_matrix(stored.filter(flag), [f"x{i}" for i in range(64)], "y")
    fit = models.mlp(layers=(64, 16, 3)).fit(part("is_first"))
    return fit.transform(part("not is_first")).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("q_learned_forecast")
def q_learned_forecast(spark, folder):
    path = scratch(spark, "demand")
    v.demand(spark, folder).write.mode("overwrite").parquet(path)
    held, best = forecast.learned(spark.read.parquet(path))
    out = forecast.compare(held, {"linear": "linear", "boosted": "boosted"}, actual="actual")
    return out.withColumn("is_best", F.col("forecast") == best)


# -- forecasts ----------------------------------------------------------------------------------------

S = "(PARTITION BY series ORDER BY t)"
v.SQL["v_parts"] = f"""SELECT *, CASE WHEN is_train THEN rn - 1 ELSE rn - 1 - cut END AS i FROM (
 SELECT *, rn <= cut AS is_train FROM (SELECT *, row_number() OVER {S} AS rn, floor(0.8 * count(*) OVER (PARTITION BY series))::bigint AS cut FROM v_demand))"""
v.SQL["v_base"] = f"""SELECT * FROM (SELECT series, t, i, demand, lag(demand) OVER {S} AS naive,
 CASE WHEN count(*) OVER w = 7 THEN avg(demand) OVER w END AS ma FROM v_parts WHERE NOT is_train
 WINDOW w AS (PARTITION BY series ORDER BY t ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) WHERE i > 7"""


@query("q_time_split", "SELECT series, t, i::bigint AS i, is_train FROM v_parts")
def q_time_split(spark, folder):
    return forecast.split(v.demand(spark, folder)).select("series", "t", "i", "is_train")


@query(
    "q_minmax",
    """WITH f AS (SELECT *, min(demand) FILTER (is_train) OVER (PARTITION BY series) AS lo, max(demand) FILTER (is_train) OVER (PARTITION BY series) AS hi FROM v_parts)
SELECT series, t, round((demand - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END, 9) AS scaled FROM f""",
)
def q_minmax(spark, folder):
    return forecast.minmax(forecast.split(v.demand(spark, folder))).select("series", "t", F.round("scaled", 9).alias("scaled"))


@query(
    "q_sequences",
    f"""SELECT series, t, array_to_string(list_transform(win, lambda x: x::bigint), ',') AS window, target FROM (
 SELECT series, t, list(demand) OVER (PARTITION BY series ORDER BY t ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS win, lead(demand) OVER {S} AS target FROM v_demand)
WHERE len(win) = 8 AND target IS NOT NULL""",
)
def q_sequences(spark, folder):
    rows = forecast.sequences(v.demand(spark, folder))
    texts = F.transform("window", lambda x: x.cast("bigint").cast("string"))
    return rows.select("series", "t", F.array_join(texts, ",").alias("window"), "target")


@query(
    "q_ma_forecast",
    "SELECT series, t, round(CASE WHEN count(*) OVER w = 7 THEN avg(demand) OVER w END, 9) AS ma FROM v_demand WINDOW w AS (PARTITION BY series ORDER BY t ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)",
)
def q_ma_forecast(spark, folder):
    return v.demand(spark, folder).select("series", "t", F.round(forecast.moving_average(), 9).alias("ma"))


@query("q_naive_forecast", f"SELECT series, t, lag(demand) OVER {S} AS naive FROM v_demand")
def q_naive_forecast(spark, folder):
    return v.demand(spark, folder).select("series", "t", forecast.naive().alias("naive"))


@query("q_baselines", "SELECT series, t, demand, naive, round(ma, 9) AS ma FROM v_base")
def q_baselines(spark, folder):
    return forecast.baselines(v.demand(spark, folder)).select("series", "t", "demand", "naive", F.round("ma", 9).alias("ma"))


@query("q_rmse", "SELECT series, round(sqrt(avg(pow(demand - ma, 2))), 6) AS rmse FROM v_base GROUP BY 1")
def q_rmse(spark, folder):
    return forecast.baselines(v.demand(spark, folder)).groupBy("series").agg(F.round(ev.rmse("demand", "ma"), 6).alias("rmse"))


@query("q_inventory_cost", "SELECT series, round(sum(greatest(naive - demand, 0) + 5 * greatest(demand - naive, 0)), 6) AS ctot FROM v_base GROUP BY 1")
def q_inventory_cost(spark, folder):
    rows = forecast.baselines(v.demand(spark, folder))
    return rows.groupBy("series").agg(F.round(forecast.inventory_cost("demand", "naive"), 6).alias("ctot"))


@query(
    "q_forecast_compare",
    " UNION ALL ".join(
        f"SELECT series, '{n}' AS forecast, round(sqrt(avg(pow(demand - {c}, 2))), 6) AS rmse, round(sum(greatest({c} - demand, 0) + 5 * greatest(demand - {c}, 0)), 6) AS ctot FROM v_base GROUP BY 1"
        for n, c in (("Naive", "naive"), ("MA", "ma"))
    ),
)
def q_forecast_compare(spark, folder):
    out = forecast.compare(forecast.baselines(v.demand(spark, folder)), {"Naive": "naive", "MA": "ma"})
    return out.withColumns({"rmse": F.round("rmse", 6), "ctot": F.round("ctot", 6)})


# -- detections ----------------------------------------------------------------------------------------


def nested_orders(spark, folder):
    """Orders as images and their lines as annotations."""
    images = v.table(spark, folder, "orders").select(F.col("o_orderkey").alias("image_id"), "o_totalprice")
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    boxes = v.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("image_id"),
        F.array(q, p, F.col("l_discount"), F.col("l_tax")).alias("bbox"),
        F.col("l_suppkey").alias("category"),
        p.alias("area"),
        (F.col("l_partkey") * 1000 + F.col("l_linenumber")).alias("id"),
    )
    return detections.nest_annotations(images, boxes)


SORTED = "l_partkey * 1000 + l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_suppkey"
NESTED = f"""SELECT o_orderkey AS image_id, coalesce(string_agg(cast(l_partkey * 1000 + l_linenumber as varchar), ',' ORDER BY {SORTED}) FILTER (l_orderkey IS NOT NULL), '') AS ids,
 coalesce(string_agg(cast(l_suppkey as varchar), ',' ORDER BY {SORTED}) FILTER (l_orderkey IS NOT NULL), '') AS categories, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"""


def flat(df):
    join = lambda c: F.array_join(F.col(f"objects.{c}").cast("array<string>"), ",")
    return df.select("image_id", join("id").alias("ids"), join("category").alias("categories"), F.size("objects.id").alias("n"))


@query("q_nest_lineitems", NESTED)
def q_nest_lineitems(spark, folder):
    return flat(nested_orders(spark, folder))


@query("q_jsonl_roundtrip", NESTED)
def q_jsonl_roundtrip(spark, folder):
    from ..sources.files import write_jsonl

    nested = nested_orders(spark, folder)
    path = scratch(spark, "jsonl")
    write_jsonl(nested, path)
    return flat(spark.read.schema(nested.schema).json(path))


@query(
    "q_zip_structs",
    "SELECT l_orderkey AS image_id, l_quantity AS x, l_suppkey AS category_id, 0::bigint AS iscrowd, 0::bigint AS area FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
)
def q_zip_structs(spark, folder):
    rows = nested_orders(spark, folder).select("image_id", F.inline(detections.box_structs()))
    return rows.select("image_id", F.get("bbox", F.lit(0)).alias("x"), "category_id", "iscrowd", "area")


@query(
    "q_map_funcs",
    "SELECT n_nationkey::bigint AS id, n_name AS name, n_nationkey::bigint AS back FROM nation",
)
def q_map_funcs(spark, folder):
    nation = v.table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    named = detections.named(nation.select("id"), nation)
    back = nation.select(F.col("name").alias("_name"), F.col("id").alias("back"))
    return named.join(back, F.col("name") == F.col("_name")).drop("_name")


@query(
    "q_class_counts",
    "SELECT c AS label, count(det_id) AS n FROM (SELECT unnest(['click', 'error', 'purchase', 'view', 'owl']) AS c) LEFT JOIN (SELECT * FROM v_det WHERE score >= 0.15) ON label = c GROUP BY 1",
)
def q_class_counts(spark, folder):
    return detections.class_counts(v.detections(spark, folder), ["click", "error", "purchase", "view", "owl"])

"""Evaluation of scored tables: curves, thresholds, reports, losses.

Every curve works on distinct scores counted before the shuffle, and runs along
them in blocks, so it holds for any number of rows and scores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered


def _div(a, b) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def curve(df, label="label", score="score") -> DataFrame:
    """Per distinct score as a threshold: counts at and above it and the rates that follow."""
    counts = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    block = ordered.number_block("threshold", descending=True)
    summed = ordered.running(
        counts, [], [F.desc("threshold")], {"tp": F.col("pos"), "fp": F.col("neg")}, block, totals=True
    )
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "tp_total", "fp_total"))
    precision, recall = _div(tp, tp + fp), _div(tp, p)
    return summed.withColumns(
        {
            "precision": precision,
            "recall": recall,
            "fpr": _div(fp, n),
            "f1": _div(2 * precision * recall, precision + recall),
            "fn": p - tp,
            "tn": n - fp,
        }
    ).drop("tp_total", "fp_total")


def roc_curve(df, label="label", score="score") -> DataFrame:
    return curve(df, label, score).select("threshold", "fpr", F.col("recall").alias("tpr"))


def pr_curve(df, label="label", score="score") -> DataFrame:
    """Precision and recall per threshold, and the closing point (1, 0) without one."""
    points = curve(df, label, score).select("threshold", "precision", "recall")
    closing = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(closing)


def roc_auc(df, label="label", score="score") -> DataFrame:
    """Exact area: pairs ranked right, ties counting a half."""
    c = curve(df, label, score)
    right = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return c.agg(_div(right, F.sum("pos") * F.sum("neg")).alias("auc"))


METRICS = ["threshold", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "fpr"]


def _picks(fn_cost, fp_cost, targets):
    row = F.struct(*METRICS)
    cost = F.col("fn") * fn_cost + F.col("fp") * fp_cost
    picks = {
        "best_f1": F.max_by(row, F.when(F.col("f1").isNotNull(), F.struct(F.col("f1"), -F.col("threshold")))),
        "best_cost": F.min_by(row, F.struct(cost.alias("c"), F.col("threshold"))),
    }
    for t in targets:
        picks[f"recall_{round(t * 100)}"] = F.max_by(row, F.when(F.col("recall") >= t, F.col("threshold")))
    return picks


def strategies(df, label="label", score="score", fn_cost=10, fp_cost=1, targets=(0.60, 0.65, 0.70)) -> DataFrame:
    """Chosen threshold and metrics per strategy, all from one pass over the curve."""
    picks = _picks(fn_cost, fp_cost, targets)
    one = curve(df, label, score).agg(*[p.alias(n) for n, p in picks.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("strategy"), F.col(n).alias("m")) for n in picks])
    long = one.select(F.inline(rows)).select("strategy", "m.*")
    cost = F.col("fn") * fn_cost + F.col("fp") * fp_cost
    accounts = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return long.withColumns({"cost": cost, "cost_per_account": _div(cost, accounts)})


def best_f1(df, label="label", score="score") -> DataFrame:
    return strategies(df, label, score, targets=()).filter("strategy = 'best_f1'")


def best_cost(df, label="label", score="score", fn_cost=10, fp_cost=1) -> DataFrame:
    return strategies(df, label, score, fn_cost, fp_cost, ()).filter("strategy = 'best_cost'")


def threshold_for_recall(df, targets=(0.60, 0.65, 0.70), label="label", score="score") -> DataFrame:
    """Largest threshold whose recall still reaches each target."""
    return strategies(df, label, score, targets=targets).filter(F.col("strategy").startswith("recall_"))


def predict(df, threshold, score="score", name="pred") -> DataFrame:
    return df.withColumn(name, (F.col(score) >= threshold).cast("int"))


def report(df, label="label", pred="pred", classes=(0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, and the accuracy on every row."""
    parts = []
    for c in classes:
        is_c, said_c = F.col(label) == c, F.col(pred) == c
        parts += [
            F.count_if(is_c & said_c).alias(f"tp_{c}"),
            F.count_if(said_c).alias(f"said_{c}"),
            F.count_if(is_c).alias(f"n_{c}"),
        ]
    one = df.agg(*parts, _div(F.count_if(F.col(label) == F.col(pred)), F.count(F.lit(1))).alias("accuracy"))
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("class"), F.col(f"tp_{c}").alias("tp"), F.col(f"said_{c}").alias("said"), F.col(f"n_{c}").alias("support"))
            for c in classes
        ]
    )
    long = one.select("accuracy", F.inline(rows))
    p = F.coalesce(_div(F.col("tp"), F.col("said")), F.lit(0.0))
    r = F.coalesce(_div(F.col("tp"), F.col("support")), F.lit(0.0))
    return long.select(
        "class", p.alias("precision"), r.alias("recall"), F.coalesce(_div(2 * p * r, p + r), F.lit(0.0)).alias("f1"), "support", "accuracy"
    )


def confusion(df, label="label", pred="pred") -> DataFrame:
    """Counts per label and prediction with the share of the label's rows."""
    counts = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(label)))


def multiclass(df, label="label", probs="probs", eps=1e-7) -> DataFrame:
    """Accuracy of the likeliest class and mean cross-entropy with clipped probabilities."""
    p = F.get(probs, F.col(label).cast("int"))
    clipped = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    best = F.array_position(probs, F.array_max(probs)) - 1
    return df.agg(
        F.avg((best == F.col(label)).cast("double")).alias("accuracy"), F.avg(-F.log(clipped)).alias("log_loss")
    )


def rmse(actual, predicted) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(actual) - F.col(predicted), F.lit(2))))


def softmax(logits: Column) -> Column:
    """Row-wise softmax, shifted by the largest logit."""
    shifted = F.transform(F.array(logits), lambda z: F.transform(z, lambda v: F.exp(v - F.array_max(z))))
    return F.get(
        F.transform(shifted, lambda e: F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))),
        F.lit(0),
    )


def relu(z: Column) -> Column:
    return F.transform(z, lambda v: F.greatest(v, F.lit(0.0)))


def dense(features: Column, weights, bias) -> Column:
    """Affine map of a feature array: ``weights`` holds one list per output."""
    outs = []
    for w, b in zip(weights, bias):
        products = F.zip_with(features, F.array(*[F.lit(float(x)) for x in w]), lambda x, y: x * y)
        outs.append(F.aggregate(products, F.lit(float(b)), lambda a, c: a + c))
    return F.array(*outs)


def class_weights(df, label="label") -> DataFrame:
    """Balanced weights n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    one = counts.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return counts.withColumn("_t", one).select(
        label, "n", (F.col("_t.n") / (F.col("_t.k") * F.col("n"))).alias("weight")
    )

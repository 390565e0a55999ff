"""Demand forecasts on ``(series, t, demand)``; a series has one row per period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import evaluation, ordered

KEY, ORDER, VALUE = "series", "t", "demand"


def _w():
    return Window.partitionBy(KEY).orderBy(ORDER)


def split(df, ratio=0.8) -> DataFrame:
    """Flag the first floor(ratio * n) rows of each series as training rows; ``i`` counts within each part."""
    placed = ordered.with_group(df, [KEY], [F.count(F.lit(1)).alias("_n")])
    row = F.row_number().over(_w())
    cut = F.floor(F.lit(ratio) * F.col("_n"))
    return (
        placed.withColumn("_row", row)
        .withColumn("is_train", F.col("_row") <= cut)
        .withColumn("i", F.when(F.col("is_train"), F.col("_row") - 1).otherwise(F.col("_row") - 1 - cut))
        .drop("_row", "_n")
    )


def minmax(df) -> DataFrame:
    """Scale by the training rows' minimum and maximum; a constant series scales to 0."""
    train = F.when(F.col("is_train"), F.col(VALUE))
    fitted = ordered.with_group(df, [KEY], [F.min(train).alias("low"), F.max(train).alias("high")])
    spread = F.when(F.col("high") > F.col("low"), F.col("high") - F.col("low")).otherwise(F.lit(1.0))
    return fitted.withColumn("scaled", (F.col(VALUE) - F.col("low")) / spread)


def inverse(scaled):
    spread = F.when(F.col("high") > F.col("low"), F.col("high") - F.col("low")).otherwise(F.lit(1.0))
    return scaled * spread + F.col("low")


def sequences(df, lookback=7, value=VALUE) -> DataFrame:
    """Windows of ``lookback + 1`` values up to t and the value after it."""
    span = _w().rowsBetween(-lookback, 0)
    return (
        df.withColumns({"window": F.collect_list(value).over(span), "target": F.lead(value).over(_w())})
        .filter((F.size("window") == lookback + 1) & F.col("target").isNotNull())
    )


def naive(value=VALUE):
    return F.lag(value).over(_w())


def moving_average(n=7, value=VALUE):
    """Mean of the ``n`` rows before, null until there are so many."""
    w = _w().rowsBetween(-n, -1)
    return F.when(F.count(value).over(w) == n, F.avg(value).over(w))


def baselines(df, lookback=7, ratio=0.8, window=7) -> DataFrame:
    """Naive and moving-average forecasts of the validation rows a sequence model can predict."""
    held = split(df, ratio).filter(~F.col("is_train"))
    return held.withColumns({"naive": naive(), "ma": moving_average(window)}).filter(F.col("i") > lookback)


def inventory_cost(actual, predicted, holding=1.0, stockout=5.0):
    over = F.greatest(F.col(predicted) - F.col(actual), F.lit(0.0))
    under = F.greatest(F.col(actual) - F.col(predicted), F.lit(0.0))
    return F.sum(holding * over + stockout * under)


def compare(df, forecasts, actual=VALUE) -> DataFrame:
    """Error and cost per series and forecast (name -> column)."""
    parts = F.array(
        *[F.struct(F.lit(n).alias("forecast"), F.col(c).alias("predicted")) for n, c in forecasts.items()]
    )
    long = df.select(KEY, F.col(actual).alias("actual"), F.inline(parts))
    return long.groupBy(KEY, "forecast").agg(
        evaluation.rmse("actual", "predicted").alias("rmse"), inventory_cost("actual", "predicted").alias("ctot")
    )


def learned(df, lookback=7, ratio=0.8, seed=42):
    """Linear and boosted-tree one-step models on the lag windows, over all series at once.

    Returns the validation forecasts in original units and the name of the model
    with the lower error.
    """
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    scaled = minmax(split(df, ratio))
    parts = scaled.withColumn(KEY, F.concat_ws("|", F.col(KEY).cast("string"), F.col("is_train").cast("string")))
    rows = sequences(parts, lookback, "scaled").withColumn("features", array_to_vector("window"))
    train, held = rows.filter("is_train"), rows.filter("not is_train")
    models = {
        "linear": LinearRegression(labelCol="target", predictionCol="p_linear", regParam=1e-6),
        "boosted": GBTRegressor(labelCol="target", predictionCol="p_boosted", maxIter=10, seed=seed),
    }
    for model in models.values():
        held = model.fit(train).transform(held)
    held = held.withColumns({n: inverse(F.col(f"p_{n}")) for n in models}).withColumn("actual", inverse(F.col("target")))
    errors = held.agg(*[evaluation.rmse("actual", n).alias(n) for n in models]).first().asDict()
    best = min(errors, key=errors.get)
    return held.select(F.split_part(KEY, F.lit("|"), F.lit(1)).alias(KEY), "t", "actual", *models), best

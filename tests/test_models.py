"""Model pipelines on separable rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluation, models


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 400
    x, c = rng.normal(0, 1, n), rng.integers(0, 3, n)
    label = ((x + 0.8 * (c == 2) + rng.normal(0, 0.4, n)) > 0.6).astype(int)
    pdf = pd.DataFrame({"x": x, "noise": rng.normal(0, 1, n), "c": c.astype(str), "label": label})
    return models.balanced(spark.createDataFrame(pdf)).cache()


def test_balanced_weights(rows):
    totals = [r["w"] for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()]
    assert totals[0] == pytest.approx(totals[1])


def test_tuned_logistic(rows):
    classifier = models.logistic(1.0, 400)
    grid = models.logistic_grid(classifier, 400, strengths=(0.1, 10))
    best = models.tune(models.pipeline(["x", "noise"], ["c"], classifier), grid, rows, folds=2)
    assert len(best.avgMetrics) == 4 and max(best.avgMetrics) > 0.85
    scored = models.score(best.bestModel, rows.limit(5).unionByName(rows.limit(1).withColumn("c", F.lit("new"))))
    assert scored.count() == 6  # an unseen category is scored too
    assert evaluation.roc_auc(models.score(best.bestModel, rows)).first()["auc"] > 0.85


def test_forest_importances(rows):
    fitted = models.pipeline(["x", "noise"], ["c"], models.forest(trees=10, depth=4)).fit(rows)
    top = models.importances(fitted.stages[-1], fitted.transform(rows), 3)
    assert len(top) == 3 and top[0][1] >= top[1][1] and "_0" in top[0][0]


def test_grids():
    assert len(models.logistic_grid(models.logistic(), 100)) == 10
    assert len(models.forest_grid(models.forest())) == 24

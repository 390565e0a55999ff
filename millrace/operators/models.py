"""Spark ML pipelines for the tabular classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import evaluation


def load_matrix(df, features, label) -> DataFrame:
    """Feature vector and integer label from plain columns."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return assembled.select(F.col(label).cast("int").alias("label"), "features")


def preprocess(numeric, categorical):
    """Scaled numbers and one-hot categories (unseen ones go to a spare slot) in one vector.

    The scaler divides by the sample deviation.
    """
    numbers = VectorAssembler(inputCols=list(numeric), outputCol="_numbers")
    scaled = StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True)
    indexed = StringIndexer(
        inputCols=list(categorical), outputCols=[f"_i_{c}" for c in categorical], handleInvalid="keep"
    )
    hot = OneHotEncoder(
        inputCols=[f"_i_{c}" for c in categorical],
        outputCols=[f"_h_{c}" for c in categorical],
        handleInvalid="keep",
        dropLast=False,
    )
    vector = VectorAssembler(inputCols=["_scaled", *[f"_h_{c}" for c in categorical]], outputCol="features")
    return [numbers, scaled, indexed, hot, vector]


def preprocessed(df, numeric, categorical) -> DataFrame:
    """``df`` with the fitted stages as columns: ``z_<number>`` and a map ``hot_<category>`` of the known values to 0 or 1."""
    fitted = Pipeline(stages=preprocess(numeric, categorical)).fit(df)
    out = fitted.transform(df)
    scaled = vector_to_array("_scaled")
    columns = {f"z_{c}": F.get(scaled, F.lit(i)) for i, c in enumerate(numeric)}
    for c, names in zip(categorical, fitted.stages[2].labelsArray):
        known = F.slice(vector_to_array(f"_h_{c}"), 1, len(names))
        columns[f"hot_{c}"] = F.map_from_arrays(F.array(*[F.lit(x) for x in names]), F.transform(known, lambda x: x.cast("int")))
    return out.withColumns(columns).select(*df.columns, *columns)


def balanced(df, label="label", name="weight") -> DataFrame:
    """Row weights that give every class the same total."""
    weights = evaluation.class_weights(df, label).select(F.col(label).alias("_l"), F.col("weight").alias(name))
    return df.join(weights, F.col(label) == F.col("_l")).drop("_l")


def logistic(c=1.0, n_rows=None, l1=False, weight="weight", **options):
    """Logistic regression; the inverse strength ``c`` becomes 1 / (c * n_rows)."""
    strength = 1.0 / (c * n_rows) if n_rows else 0.0
    return LogisticRegression(
        labelCol="label", weightCol=weight, regParam=strength, elasticNetParam=1.0 if l1 else 0.0, maxIter=200, **options
    )


def forest(trees=200, depth=10, leaf=5, subset="sqrt", weight="weight", seed=42):
    return RandomForestClassifier(
        labelCol="label", weightCol=weight, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf,
        featureSubsetStrategy=subset, seed=seed,
    )


def pipeline(numeric, categorical, classifier):
    return Pipeline(stages=[*preprocess(numeric, categorical), classifier])


def logistic_grid(classifier, n_rows, strengths=(0.01, 0.1, 1, 10, 100)):
    """Ten settings: five strengths, both penalties."""
    return (
        ParamGridBuilder()
        .addGrid(classifier.regParam, [1.0 / (c * n_rows) for c in strengths])
        .addGrid(classifier.elasticNetParam, [0.0, 1.0])
        .build()
    )


def forest_grid(classifier, trees=(100, 200), depths=(5, 10, 20), leaves=(1, 5), subsets=("sqrt", "log2")):
    """Twenty-four settings."""
    return (
        ParamGridBuilder()
        .addGrid(classifier.numTrees, list(trees))
        .addGrid(classifier.maxDepth, list(depths))
        .addGrid(classifier.minInstancesPerNode, list(leaves))
        .addGrid(classifier.featureSubsetStrategy, list(subsets))
        .build()
    )


def tune(estimator, grid, train, folds=5, parallelism=4, seed=42):
    """Cross-validated search by area under the ROC curve; folds train side by side."""
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol="label"),
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )
    return validator.fit(train)


def score(model, df, threshold=0.5) -> DataFrame:
    """Probability of class 1 and the label at a threshold."""
    out = model.transform(df).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return evaluation.predict(out, threshold)


def importances(fitted, transformed, n=10):
    """Largest feature importances with their names: list of (name, importance)."""
    attrs = transformed.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    values = fitted.featureImportances.toArray()
    ranked = sorted(enumerate(values), key=lambda p: (-p[1], p[0]))[:n]
    return [(names.get(i, str(i)), float(x)) for i, x in ranked]


def mlp(layers=(3, 4, 8, 3), passes=10, seed=42, block=32):
    """Multi-layer classifier; the solver works on all rows per pass."""
    return MultilayerPerceptronClassifier(
        labelCol="label", layers=list(layers), maxIter=passes, blockSize=block, seed=seed
    )

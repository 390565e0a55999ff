"""Profiles of a table: nulls, statistics, finite check, audit rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ordered


def numeric_columns(df):
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _long(row_df, names, key, value):
    """One wide row to one row per name."""
    pairs = F.array(*[F.struct(F.lit(n).alias(key), F.col(n).alias(value)) for n in names])
    return row_df.select(F.inline(pairs))


def nulls(df) -> DataFrame:
    """Columns with nulls and their counts, in one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(row, df.columns, "column", "nulls").filter("nulls > 0").orderBy(F.desc("nulls"), "column")


def describe(df, cols=None) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles per numeric column."""
    cols = list(cols or numeric_columns(df))
    row = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    basics = _long(row, cols, "column", "s").select("column", "s.*")
    quartiles = ordered.quantiles(df, cols, [0.25, 0.5, 0.75]).select(
        "column", *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    )
    return basics.join(quartiles, "column", "left")


def all_finite(df, cols) -> DataFrame:
    """One row: is every value a finite number?"""
    checks = [~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))) & F.col(c).isNotNull() for c in cols]
    return df.agg(F.bool_and(reduce(lambda a, b: a & b, checks)).alias("all_finite"))


def audit(before, after, rules) -> DataFrame:
    """Rows before and after, duplicates, and one count per rule (name -> condition on ``before``)."""
    raw = before.groupBy(*before.columns).agg(F.count(F.lit(1)).alias("_n"))
    counted = raw.agg(
        F.sum("_n").alias("rows_before"),
        F.sum(F.col("_n") - 1).alias("duplicates"),
        *[F.sum(F.when(rule, F.col("_n")).otherwise(0)).alias(name) for name, rule in rules.items()],
    )
    one = _long(counted, ["rows_before", "duplicates", *rules], "operation", "value")
    rest = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return one.unionByName(_long(rest, ["rows_after"], "operation", "value"))

"""Grouped summaries; all of them combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def mean(df, c) -> Column:
    """Mean; a decimal column is summed exactly, so the result does not depend on row order."""
    if isinstance(df.schema[c].dataType, T.DecimalType):
        return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))
    return F.avg(c)


def keyed(df, keys) -> DataFrame:
    """Rows without a null in the keys: null groups are left out."""
    return df.na.drop(subset=list(keys)) if keys else df


def price_trend(df, by, price="calendar_price", name="avg_price") -> DataFrame:
    return keyed(df, by).groupBy(*by).agg(mean(df, price).alias(name))


def nunique_by(df, by, col, name="n_unique", approximate=False) -> DataFrame:
    count = F.approx_count_distinct(col) if approximate else F.count_distinct(col)
    return keyed(df, by).groupBy(*by).agg(count.alias(name)).orderBy(F.desc(name), *by)


def value_counts(df, col, name="n") -> DataFrame:
    return keyed(df, [col]).groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), col)


def mean_of_means(df, inner, outer, measures) -> DataFrame:
    """Mean per inner group, then the plain mean of those per outer group."""
    first = keyed(df, inner).groupBy(*inner).agg(*[mean(df, m).alias(m) for m in measures])
    return first.groupBy(*outer).agg(*[F.avg(m).alias(m) for m in measures])


def occupancy(df, by="data_month", flag="available") -> DataFrame:
    """Share of ``f`` among ``f`` and ``t`` in percent; 0 where there are neither."""
    booked, free = F.count_if(F.col(flag) == "f"), F.count_if(F.col(flag) == "t")
    rate = F.coalesce(F.try_divide(booked.cast("double"), (booked + free).cast("double")) * 100, F.lit(0.0))
    return keyed(df, [by]).groupBy(by).agg(rate.alias("occupancy_rate"))


def crosstab(df, row, col, values) -> DataFrame:
    """Counts per row and listed column value, 0 where there are none."""
    wide = keyed(df, [row, col]).groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    return wide.na.fill(0)


def share(df, by, cat, name="share") -> DataFrame:
    """Row-normalised shares of the categories within each ``by`` value."""
    counts = keyed(df, [by, cat]).groupBy(by, cat).agg(F.count(F.lit(1)).alias("n"))
    # one row per pair is left, so the window is as small as the category list
    total = F.sum("n").over(Window.partitionBy(by))
    return counts.withColumn(name, F.col("n") / total)


def share_above(col, x) -> Column:
    """Share of rows above ``x``; nulls count as not above."""
    return F.avg(F.coalesce(F.col(col) > x, F.lit(False)).cast("double"))


def mean_std(df, by, cols) -> DataFrame:
    parts = []
    for c in cols:
        parts += [mean(df, c).alias(f"mean_{c}"), F.stddev_samp(F.col(c).cast("double")).alias(f"std_{c}")]
    return keyed(df, by).groupBy(*by).agg(*parts)

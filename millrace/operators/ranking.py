"""Ranks, top-k lists and extremes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordered, stats

#: Rows of a group that one window takes.
LARGE = 1 << 20


def keep_first(df, keys, order) -> DataFrame:
    """First row per key in a total order, as an aggregate: hot keys shrink before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def top_n(df, order, n) -> DataFrame:
    return df.orderBy(*order).limit(n)


def extremes(df, col, n, tiebreak) -> DataFrame:
    """``n`` largest and ``n`` smallest rows, tagged."""
    some = df.filter(F.col(col).isNotNull())
    high = some.orderBy(F.desc(col), *tiebreak).limit(n).withColumn("side", F.lit("largest"))
    low = some.orderBy(F.asc(col), *tiebreak).limit(n).withColumn("side", F.lit("smallest"))
    return high.unionByName(low)


def seller_perf(items, seller="seller_id") -> DataFrame:
    """Mean review and delivery days per seller; missing delivery takes the mean of the sellers."""
    perf = (
        items.filter(F.col(seller).isNotNull())
        .groupBy(seller)
        .agg(F.avg("review_score").alias("avg_rev"), F.avg("order_deliver_days").alias("avg_del"))
    )
    return perf.withColumn("avg_del", F.coalesce("avg_del", perf.agg(F.avg("avg_del")).scalar()))


def priority(perf, nan_policy="omit") -> DataFrame:
    """Mean of the review z-score and the negated delivery z-score.

    ``omit`` standardizes over known values; ``propagate`` drops the whole
    review score as soon as one seller lacks it.
    """
    z = stats.standardize(perf, ["avg_rev", "avg_del"])
    z_rev = F.col("z_avg_rev")
    if nan_policy == "propagate":
        missing = perf.agg(F.count_if(F.col("avg_rev").isNull())).scalar()
        z_rev = F.when(missing == 0, z_rev)
    scored = z.withColumns({"z_rev": z_rev, "z_del": -F.col("z_avg_del")}).drop("z_avg_rev", "z_avg_del")
    known = F.col("z_rev").isNotNull().cast("int") + F.col("z_del").isNotNull().cast("int")
    total = F.coalesce("z_rev", F.lit(0.0)) + F.coalesce("z_del", F.lit(0.0))
    return scored.withColumn("priority_score", F.try_divide(total, known.cast("double")))


def _by_size(df, by, small, large, sizes=None) -> DataFrame:
    """``small`` of the groups of at most ``LARGE`` rows and ``large`` of the others.

    Which groups are large is part of the plan; they are fewer than the rows
    divided by ``LARGE``, and without any AQE drops their side.  ``sizes`` is
    counted in place of ``df`` where the same groups are cheaper to read.
    """
    counts = (df if sizes is None else sizes).groupBy(by).agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(counts.filter(F.col("_rows") > LARGE).select(F.col(by).alias("_hot")))
    match = F.col(by).eqNullSafe(F.col("_hot"))
    return small(df.join(hot, match, "left_anti")).unionByName(large(df.join(hot, match, "left_semi")))


def rank_first(df, by, col, tiebreak, name="rank", sizes=None) -> DataFrame:
    """Rank per ``by`` by descending ``col``, ties in ``tiebreak`` order; null scores get no rank.

    Groups of at most ``LARGE`` rows are one window, which shuffles the rows
    once; no task holds a larger group, see :func:`_rank_blocks`.
    """
    order = Window.partitionBy(by).orderBy(F.desc(col), *tiebreak)

    def small(rows):
        return rows.withColumn(name, F.when(F.col(col).isNotNull(), F.row_number().over(order).cast("bigint")))

    return _by_size(df, by, small, lambda rows: _rank_blocks(rows, by, col, tiebreak, name), sizes)


def _rank_blocks(df, by, col, tiebreak, name) -> DataFrame:
    """Ranks of groups of any size.

    Equal scores are counted first, which gives every score its starting rank;
    rows of one score are then numbered in blocks of the first tiebreak column.
    Neither step holds a group, or the rows of one score, in a single task.
    """
    scored = df.filter(F.col(col).isNotNull())
    counts = scored.groupBy(by, col).agg(F.count(F.lit(1)).alias("_n"))
    starts = ordered.running(
        counts, [by], [F.desc(col)], {"_upto": F.col("_n")}, ordered.number_block(col, descending=True)
    ).select(F.col(by).alias("_by"), F.col(col).alias("_score"), (F.col("_upto") - F.col("_n")).alias("_start"))
    inside = ordered.number_rows(scored, [by, col], tiebreak, ordered.number_block(tiebreak[0]), "_no")
    ranked = (
        inside.join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col(col) == F.col("_score")))
        .withColumn(name, F.col("_start") + F.col("_no"))
        .select(*df.columns, name)
    )
    return ranked.unionByName(
        df.filter(F.col(col).isNull()).withColumn(name, F.lit(None).cast("bigint"))
    )


def fill_worst(df, by, rank="rank", sizes=None) -> DataFrame:
    """Missing ranks become the group's largest rank plus one; rows without a group leave."""
    known = df.filter(F.col(by).isNotNull())

    def small(rows):
        return rows.withColumn("_max", F.max(rank).over(Window.partitionBy(by)))

    def large(rows):
        return ordered.with_group(rows, [by], [F.max(rank).alias("_max")])

    filled = _by_size(known, by, small, large, sizes)
    return filled.withColumn(rank, F.coalesce(F.col(rank), F.col("_max") + 1)).drop("_max")


def rank_within(df, by, col, tiebreak, k, name="rank") -> DataFrame:
    """The rows that :func:`rank_first` and then :func:`fill_worst` would rank within ``k``.

    Spark's group limit leaves at most ``k`` scored rows per group and partition
    before the shuffle; rows without a score come in where a group has fewer
    than ``k`` scored ones (and one at least).
    """
    known = df.filter(F.col(by).isNotNull())
    order = Window.partitionBy(by).orderBy(F.desc(col), *tiebreak)
    best = known.filter(F.col(col).isNotNull()).withColumn(name, F.row_number().over(order).cast("bigint")).filter(F.col(name) <= k)
    short = best.groupBy(F.col(by).alias("_by")).agg((F.max(name) + 1).alias(name)).filter(F.col(name) <= k)
    rest = known.filter(F.col(col).isNull()).join(short, F.col(by) == F.col("_by")).drop("_by")
    return best.unionByName(rest)


def topk_list(df, by, item, rank, k=3, name="topk") -> DataFrame:
    """Ordered list of the distinct items ranked within ``k`` per group."""
    best = df.filter(F.col(rank) <= k).select(by, item, rank).distinct()
    pairs = F.sort_array(F.collect_list(F.struct(rank, item)))
    return best.groupBy(by).agg(F.transform(pairs, lambda p: p[item]).alias(name))


def in_top_groups(df, group, counted, n=5) -> DataFrame:
    """Rows of the ``n`` groups with most distinct ``counted`` values."""
    best = (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count_distinct(counted).alias("_n"))
        .orderBy(F.desc("_n"), group)
        .limit(n)
    )
    return df.join(best.select(group), group, "left_semi")


def most_frequent(df, col) -> DataFrame:
    """The most frequent value (smallest on ties), one row."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col).limit(1)


def first_with_min(df, group, counted, at_least=5) -> DataFrame:
    """The group with most distinct ``counted`` values, if it has at least so many."""
    counts = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(counted).alias("n"))
    return counts.filter(F.col("n") >= at_least).orderBy(F.desc("n"), group).limit(1)


def top_sellers(items, scores, product, n=5, by="product_id", seller="seller_id") -> DataFrame:
    """Best-scored sellers of one product with their rank; ``product`` is a value or a scalar subquery."""
    sellers = items.filter((F.col(by) == product) & F.col(seller).isNotNull()).select(seller).distinct()
    best = scores.join(sellers, seller, "left_semi").orderBy(F.desc("priority_score"), seller).limit(n)
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("priority_score"), seller)
    return best.select(
        F.row_number().over(order).alias("rank"),
        seller,
        "priority_score",
        F.col("avg_rev").alias("mean_review_score"),
        F.col("avg_del").alias("mean_delivery_days"),
    )

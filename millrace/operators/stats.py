"""Statistics as aggregates: tests, correlations, histograms, box numbers, densities."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered
from .profile import _long


def corr_with(df, target, cols, top=None, bottom=None) -> DataFrame:
    """Correlation of each column with ``target``, strongest first; optionally only both ends."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    long = _long(row, list(cols), "column", "corr").filter("corr is not null")
    if top is None and bottom is None:
        return long.orderBy(F.desc("corr"), "column")
    high = long.orderBy(F.desc("corr"), "column").limit(top or 0)
    low = long.orderBy("corr", "column").limit(bottom or 0)
    return high.unionByName(low)


def histogram(df, col, low, width, by) -> DataFrame:
    """Counts per class and bin number ``floor((x - low) / width)``."""
    bin_no = F.floor((F.col(col) - F.lit(low)) / F.lit(width)).alias("bin")
    return df.filter(F.col(col).isNotNull()).groupBy(by, bin_no).agg(F.count(F.lit(1)).alias("n"))


def box(df, col, by, reach=1.5) -> DataFrame:
    """Exact quartiles per class and the outermost values within ``reach`` quartile ranges."""
    q = ordered.quantiles(df, [col], [0.25, 0.5, 0.75], [by]).select(
        F.col(by).alias("_by"),
        *[F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
    )
    spread = (F.col("q75") - F.col("q25")) * reach
    inside = F.col(col).between(F.col("q25") - spread, F.col("q75") + spread)
    return (
        df.select(by, col)
        .join(q, F.col(by).eqNullSafe(F.col("_by")))
        .groupBy(by, "q25", "q50", "q75")
        .agg(F.min(F.when(inside, F.col(col))).alias("low"), F.max(F.when(inside, F.col(col))).alias("high"))
    )


def density(df, col, by, grid) -> DataFrame:
    """Gaussian density per group on a fixed grid; every group is scaled on its own.

    Equal values are counted first; each distinct value then adds to the grid
    points, which are summed before the shuffle.
    """
    x = F.col(col).cast("double")
    spread = df.groupBy(F.col(by).alias("_by")).agg(
        F.count(x).cast("double").alias("_n"), F.stddev_samp(x).alias("_sd")
    )
    counts = df.filter(x.isNotNull()).groupBy(by, x.alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    points = F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("grid")
    h = F.col("_sd") * F.pow("_n", F.lit(-0.2))
    z = (F.col("_x") - F.col("grid")) / h
    weight = F.col("_c") * F.exp(-z * z / 2)
    return (
        counts.join(spread, F.col(by).eqNullSafe(F.col("_by")))
        .select(by, "_x", "_c", "_n", "_sd", points)
        .groupBy(by, "grid", "_n", "_sd")
        .agg(F.sum(weight).alias("_w"))
        .select(by, "grid", (F.col("_w") / (F.col("_n") * h * math.sqrt(2 * math.pi))).alias("density"))
    )


def two_sided_p(t, df):
    """Two-sided p of a t value: the incomplete beta function by its continued fraction."""
    if t is None or df is None:
        return None
    x = df / (df + t * t)
    a, b = df / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    if x <= 0.0:
        return 0.0

    def fraction(a, b, x):
        tiny = 1e-300
        c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
        d = 1.0 / (d if abs(d) > tiny else tiny)
        total = d
        for m in range(1, 400):
            for num in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1.0 + num * d
                d = 1.0 / (d if abs(d) > tiny else tiny)
                c = 1.0 + num / c
                c = c if abs(c) > tiny else tiny
                total *= c * d
            if abs(c * d - 1.0) < 1e-15:
                break
        return total

    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a
    return 1.0 - front * fraction(b, a, 1.0 - x) / b


def arms(df, col, group, a, b) -> DataFrame:
    """One row: count, mean and sample variance of both arms (``_a`` and ``_b``)."""
    x = F.col(col).cast("double")
    parts = []
    for tag, value in (("a", a), ("b", b)):
        arm = F.when(F.col(group) == value, x)
        parts += [
            F.count(arm).alias(f"n_{tag}"),
            F.avg(arm).alias(f"mean_{tag}"),
            F.var_samp(arm).alias(f"var_{tag}"),
        ]
    return df.agg(*parts)


def _log_gamma(z) -> Column:
    """Logarithm of the gamma function of a positive number: Stirling's series from eight places on."""
    high = z + 8
    series = 1 / (12 * high) - 1 / (360 * high * high * high) + 1 / (1260 * F.pow(high, F.lit(5))) - 1 / (1680 * F.pow(high, F.lit(7)))
    shift = reduce(lambda x, y: x + y, [F.log(z + i) for i in range(8)])
    return (high - 0.5) * F.log(high) - high + 0.5 * math.log(2 * math.pi) + series - shift


def two_sided(t, dof, steps=1_000) -> Column:
    """Two-sided p value of Student's t: the regularised incomplete beta function by its continued fraction."""
    x, y = dof / (dof + t * t), t * t / (dof + t * t)
    a, b = dof / 2, F.lit(0.5)
    near = x < (a + 1) / (a + b + 2)
    # The fraction converges fast on one side; the other side is its complement.
    side = F.struct(F.when(near, a).otherwise(b).alias("a"), F.when(near, b).otherwise(a).alias("b"), F.when(near, x).otherwise(y).alias("x"), F.when(near, y).otherwise(x).alias("y"))

    def value(s):
        a, b, x = s["a"], s["b"], s["x"]

        def half(state, factor):
            d = 1 / (1 + factor * state["d"])
            c = 1 + factor / state["c"]
            return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

        def step(state, m):
            even = m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m))
            # The half step stands in an array, so that it is worked out once.
            return F.get(F.transform(F.array(half(state, even)), lambda mid: half(mid, odd)), F.lit(0))

        d = 1 / (1 - (a + b) * x / (a + 1))
        first = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
        places = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda m: m.cast("double"))
        fraction = F.aggregate(places, first, step)["h"]
        front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(x) + b * F.log(s["y"]))
        return front * fraction / a

    found = F.get(F.transform(F.array(side), value), F.lit(0))
    return F.when(t == 0, F.lit(1.0)).when(x <= 0, F.lit(0.0)).otherwise(F.when(near, found).otherwise(1 - found))


def welch(df, col, group="group", a="test", b="control", with_p=True) -> DataFrame:
    """Unequal-variance t test: t, degrees of freedom and p."""
    one = arms(df, col, group, a, b)
    sa, sb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(sa + sb))
    dof = F.try_divide(
        F.pow(sa + sb, F.lit(2)), sa * sa / (F.col("n_a") - 1) + sb * sb / (F.col("n_b") - 1)
    )
    out = one.select(F.lit(col).alias("measure"), t.alias("t"), dof.alias("df"))
    return out.withColumn("p", two_sided(F.col("t"), F.col("df"))) if with_p else out


def cohens_d(df, col, group="group", a="test", b="control", lower_is_better=False) -> DataFrame:
    """Mean difference over the pooled deviation; sign flipped where lower is better."""
    one = arms(df, col, group, a, b)
    pooled = F.sqrt((F.col("var_a") + F.col("var_b")) / 2)
    gap = F.col("mean_b") - F.col("mean_a") if lower_is_better else F.col("mean_a") - F.col("mean_b")
    return one.select(F.lit(col).alias("measure"), F.try_divide(gap, pooled).alias("d"))


def standardize(df, cols, population=True) -> DataFrame:
    """z-scores from two global aggregates (one subquery row)."""
    deviation = F.stddev_pop if population else F.stddev_samp
    moments = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), deviation(c).alias("s")).alias(c) for c in cols])
    ).scalar()
    known = df.withColumn("_z", moments)
    return known.withColumns(
        {f"z_{c}": F.try_divide(F.col(c) - F.col(f"_z.{c}.m"), F.col(f"_z.{c}.s")) for c in cols}
    ).drop("_z")

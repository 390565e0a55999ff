"""Cleaners for raw feeds: typed columns, filled gaps, bounded outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as x
from . import ordered


def require(df, cols) -> DataFrame:
    return df.na.drop(subset=list(cols))


def dedup(df) -> DataFrame:
    """Whole-row duplicates removed (hash aggregate, combined before the shuffle)."""
    return df.dropDuplicates()


def count_duplicates(df) -> DataFrame:
    counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def fill_median(df, cols) -> DataFrame:
    """Nulls of numeric columns take the exact column median."""
    cols = list(cols)
    medians = ordered.wide_quantiles(df, cols, [0.5]).select(
        F.struct(*[F.get(f"q_{c}", F.lit(0)).alias(c) for c in cols]).alias("m")
    ).scalar()
    # One column for the subquery: naming it per column would plan it as often.
    known = df.withColumn("_m", medians)
    return known.withColumns({c: F.coalesce(F.col(c), F.col(f"_m.{c}")) for c in cols}).drop("_m")


def fill_group_median(df, cols, by) -> DataFrame:
    """Nulls take the exact median of their group; rows without a group lose their value.

    The loss for a null group is the source rule: such rows are left to
    :func:`fill_median`.
    """
    cols = list(cols)
    medians = ordered.wide_quantiles(df.filter(F.col(by).isNotNull()), cols, [0.5], [by])
    medians = medians.select(F.col(by).alias("_by"), *[F.get(f"q_{c}", F.lit(0)).alias(f"_m_{c}") for c in cols])
    joined = df.join(medians, F.col(by) == F.col("_by"), "left")
    filled = {c: F.when(F.col(by).isNotNull(), F.coalesce(F.col(c), F.col(f"_m_{c}"))) for c in cols}
    return joined.withColumns(filled).select(*df.columns)


def mode_of(df, col, by=()):
    """Most frequent value; the smallest one on ties."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(col, F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v")))
    return counts.groupBy(*by).agg(best.alias("mode"))


def fill_mode(df, col) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), mode_of(df, col).scalar()))


def winsorize(df, cols, low=0.01, high=0.99) -> DataFrame:
    """Clip columns at exact quantiles with linear interpolation."""
    cols = list(cols)
    bounds = ordered.wide_quantiles(df, cols, [low, high]).select(
        F.struct(*[F.col(f"q_{c}").alias(c) for c in cols]).alias("b")
    ).scalar()
    known = df.withColumn("_b", bounds)
    bound = lambda c, i: F.get(F.col(f"_b.{c}"), F.lit(i))
    return known.withColumns({c: x.clip(F.col(c), bound(c, 0), bound(c, 1)) for c in cols}).drop("_b")


def floor_at_smallest_positive(df, col, name) -> DataFrame:
    """Copy of ``col`` raised to the smallest positive value of the column."""
    least = df.agg(F.min(F.when(F.col(col) > 0, F.col(col)))).scalar()
    return df.withColumn(name, F.when(F.col(col).isNotNull(), F.greatest(F.col(col), least)))


def safe_ratio(df, ratios, den) -> DataFrame:
    """Ratios with the denominator floored; ``ratios`` maps names to numerators."""
    floored = floor_at_smallest_positive(df, den, f"{den}_adj")
    return floored.withColumns(
        {name: F.try_divide(F.col(num).cast("double"), F.col(f"{den}_adj")) for name, num in ratios.items()}
    )


def listings(df, month) -> DataFrame:
    """One month of listings: prices, rates, flags, room counts and response time."""
    drop = ("calendar_updated", "license", "neighbourhood", "host_acceptance_rate")
    typed = df.drop(*drop).withColumns(
        {
            "price": x.currency("price"),
            "host_response_rate": x.percent("host_response_rate"),
            "host_is_superhost": x.tf_flag("host_is_superhost"),
            "host_identity_verified": x.tf_flag("host_identity_verified"),
            "instant_bookable": x.tf_flag("instant_bookable"),
            **{c: x.to_numeric(F.col(c).cast("string")) for c in ("bathrooms", "bedrooms", "beds")},
        }
    )
    kept = require(typed, ["price", "room_type", "host_id"])
    filled = fill_group_median(kept, ["bathrooms", "beds"], "bedrooms")
    filled = fill_median(filled, ["bathrooms", "bedrooms", "beds"])
    return fill_mode(filled, "host_response_time").withColumn("data_month", F.lit(month))


def calendar(df, month) -> DataFrame:
    """One month of calendar rows: price as a number, night limits filled by the median."""
    typed = df.drop("adjusted_price").withColumn("price", x.currency("price"))
    return fill_median(typed, ["minimum_nights", "maximum_nights"]).withColumn("data_month", F.lit(month))


def neighbourhoods(df, month) -> DataFrame:
    return (
        dedup(df)
        .withColumn("neighbourhood", x.norm_key("neighbourhood"))
        .withColumn("data_month", F.lit(month))
    )


# Codes of the credit table and the delay bins.
EDUCATION_CODES = {4: [0, 5, 6]}
MARRIAGE_CODES = {3: [0]}
DELAY_EDGES = [-3, 0, 1, 3, 8]
DELAY_LABELS = ["on_time", "short_delay", "medium_delay", "long_delay"]


def credit(df, bills, payments, delays) -> DataFrame:
    """Recoded categories, whole-row dedup, negative months, winsorized amounts, capped delays."""
    recoded = df.withColumns(
        {"education": x.recode("education", EDUCATION_CODES), "marriage": x.recode("marriage", MARRIAGE_CODES)}
    ).drop("id")
    unique = dedup(recoded).withColumn("num_neg_bill_months", x.row_count_if(bills, lambda c: c < 0))
    bounded = winsorize(unique, [*bills, *payments])
    return bounded.withColumns({c: x.clip(c, -2, 8) for c in delays})


def credit_features(df, bills, payments, delays) -> DataFrame:
    """Means, ratios on a floored mean bill, delay summaries, trends and the delay bucket."""
    means = df.withColumns({"avg_bill": x.row_mean(bills), "avg_pay": x.row_mean(payments)})
    ratios = safe_ratio(means, {"utilization": "limit_bal", "payment_ratio": "avg_pay"}, "avg_bill")
    return ratios.withColumns(
        {
            "max_delay": x.row_max(delays),
            "avg_delay": x.row_mean(delays),
            "ever_late": x.row_any(delays, lambda c: c > 0).cast("int"),
            "bill_trend": F.col(bills[-1]) - F.col(bills[0]),
            "pay_trend": F.col(payments[-1]) - F.col(payments[0]),
        }
    ).withColumn("delay_bucket", x.cut("max_delay", DELAY_EDGES, DELAY_LABELS))

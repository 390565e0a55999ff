"""Date and week expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def year_week(date: Column) -> Column:
    """ISO label such as ``2020-W10``."""
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), date).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(date).cast("string"), 2, "0"),
    )


def running_week(date: Column) -> Column:
    """Whole weeks since Monday 1969-12-29."""
    return F.floor((F.unix_date(F.to_date(date)) + 3) / 7).cast("int")


def date_key(date: Column) -> Column:
    """Surrogate key ``yyyymmdd``."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("int")


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps; negative spans floor downwards."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(micros / F.lit(float(DAY_MICROS))).cast("int")


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def iso_instant(text: Column) -> Column:
    """ISO-8601 text, with or without ``Z``, to a timestamp; bad text is null."""
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00"))

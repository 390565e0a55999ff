"""Column expressions for cleaning and feature building."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def currency(c) -> Column:
    """``$1,234.00`` to double; bad text is null."""
    return F.regexp_replace(_col(c), "[$,]", "").try_cast("double")


def percent(c) -> Column:
    """``97%`` to 97.0; bad text is null."""
    return F.replace(_col(c), F.lit("%"), F.lit("")).try_cast("double")


def tf_flag(c) -> Column:
    c = _col(c)
    return F.when(c == "t", True).when(c == "f", False)


def to_numeric(c) -> Column:
    return _col(c).try_cast("double")


def norm_key(c) -> Column:
    return F.lower(F.trim(_col(c)))


def recode(c, mapping) -> Column:
    """Replace listed values, keep the others; ``mapping`` is new value -> old values."""
    c = _col(c)
    out = c
    for new, old in mapping.items():
        out = F.when(c.isin(list(old)), F.lit(new)).otherwise(out)
    return out


def clip(c, low=None, high=None) -> Column:
    """Bound a value; null stays null (``least`` and ``greatest`` would skip it)."""
    c = _col(c)
    out = c
    if high is not None:
        out = F.least(out, F.lit(high) if not isinstance(high, Column) else high)
    if low is not None:
        out = F.greatest(out, F.lit(low) if not isinstance(low, Column) else low)
    return F.when(c.isNotNull(), out)


def cut(c, edges, labels) -> Column:
    """Right-closed bins ``(low, high]``; outside the edges is null."""
    c = _col(c)
    pairs = list(zip(edges[:-1], edges[1:], labels))
    first, rest = pairs[0], pairs[1:]
    out = F.when((c > first[0]) & (c <= first[1]), F.lit(first[2]))
    for low, high, label in rest:
        out = out.when((c > low) & (c <= high), F.lit(label))
    return out


def row_count_if(cols, predicate) -> Column:
    return reduce(
        lambda a, b: a + b,
        [F.coalesce(predicate(F.col(c)), F.lit(False)).cast("int") for c in cols],
    )


def row_mean(cols) -> Column:
    """Mean of the columns that are not null."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    count = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.try_divide(total, count)


def row_max(cols) -> Column:
    return F.greatest(*[F.col(c) for c in cols])


def row_any(cols, predicate) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(predicate(F.col(c)), F.lit(False)) for c in cols])


def annualised(total_return: Column, years) -> Column:
    years = years if isinstance(years, Column) else F.lit(float(years))
    return F.pow(F.lit(1.0) + total_return, F.lit(1.0) / years) - 1


def one_hot(c, size) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == _col(c)).cast("int"))


def argmax(array: Column) -> Column:
    """Position (from 0) of the first largest element."""
    return F.array_position(array, F.array_max(array)) - 1

"""Totals, numbers and quantiles along an order, for groups of any size.

A plain window sends a whole group to one task.  Where a group may hold a
large share of the table, the functions here cut its order into blocks, total
each block with a map-side aggregate, add up the block totals (a table of
``groups x blocks`` rows) and finish inside each block.

The blocks are intervals of the values themselves: every power of two is cut
into ``COARSE`` parts, whatever the data, and the intervals that turn out to be
heavy are cut ``FINE`` times more.  Which are heavy is part of the plan: no job
runs while a query is built, and there are as many blocks as the data fill.
"""

from __future__ import annotations

from collections import namedtuple
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Intervals of a power of two, and of a heavy interval.
COARSE, FINE = 1 << 10, 1 << 20
#: An interval with more than one row in so many is heavy; there are fewer such intervals than that.
SHARE = 2_000

#: Blocks along a number (timestamps count as their seconds), for ``running``.
Blocks = namedtuple("Blocks", "value descending")


def number_block(column, descending=False) -> Blocks:
    """Blocks of a numeric column, by name or as a Column; null is the first block (the last if descending)."""
    value = F.col(column) if isinstance(column, str) else column
    return Blocks(value.cast("double"), descending)


def time_block(column, descending=False) -> Blocks:
    return Blocks(F.unix_seconds(F.col(column).cast("timestamp")).cast("double"), descending)


def _interval(value) -> tuple[Column, Column]:
    """Interval of a double and its part of that interval: a pair that never falls as the value grows.

    Dividing by a power of two, multiplying by one and cutting off the whole
    part are exact, and the logarithm is monotone, so no rounding can put two
    values in the wrong order.
    """
    size = F.abs(value)
    power = F.floor(F.log2(size))
    scaled = size / F.pow(F.lit(2.0), power) * COARSE
    whole = F.floor(scaled)
    # Two coarse counts per power leave room for a logarithm rounded across a power of two.
    coarse = (power + 1100) * (2 * COARSE) + whole
    fine = F.floor((scaled - whole) * FINE)
    sign = F.when(value < 0, -1).otherwise(1)
    huge = 4 * 1100 * COARSE
    plain = (value != 0) & (size < float("inf"))
    return (
        F.when(plain, sign * coarse).when(value == 0, F.lit(0)).when(F.isnan(value), huge + 1).when(value > 0, huge).when(value < 0, -huge),
        F.when(plain, sign * fine).otherwise(0),
    )


def _directed(value, descending):
    sign = -1 if descending else 1
    return [F.coalesce(c * sign, F.lit(-(1 << 40) * sign)) for c in _interval(value)]


def _cut(df: DataFrame, blocks: Blocks, name="_block") -> DataFrame:
    """``df`` with its block: the interval, and its part where the interval is heavy."""
    coarse, fine = _directed(*blocks)
    marked = df.withColumns({"_coarse": coarse, "_fine": fine})
    counts = marked.groupBy("_coarse").agg(F.count(F.lit(1)).alias("_rows"))
    limit = counts.agg(F.sum("_rows") / SHARE).scalar()
    heavy = F.broadcast(counts.filter(F.col("_rows") > limit).select("_coarse", F.lit(True).alias("_heavy")))
    part = F.when(F.col("_heavy"), F.col("_fine")).otherwise(0)
    return marked.join(heavy, "_coarse", "left").withColumn(name, F.struct("_coarse", part.alias("_fine"))).select(*df.columns, name)


def hash_block(digest: Column, digits=4) -> Column:
    """Block of an md5 hex string by its first digits: 65,536 even blocks with four; more rows, more digits."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def running(df: DataFrame, keys, order, sums, block, totals=False) -> DataFrame:
    """Add running totals (current row included) per ``keys`` along ``order``.

    ``sums`` maps new column names to the summed expressions, ``order`` must be
    total and ``block`` (a Column, or ``Blocks``) must not decrease along it.
    With ``totals`` the group's grand total comes along as ``<name>_total``.
    """
    keys = list(keys)
    parts = _cut(df, block) if isinstance(block, Blocks) else df.withColumn("_block", block)
    for name, expression in sums.items():
        parts = parts.withColumn(f"_v_{name}", expression)
    per_block = parts.groupBy(*keys, "_block").agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums]
    )
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    before = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    grand = [F.sum(f"_t_{n}").over(group).alias(f"{n}_total") for n in sums] if totals else []
    offsets = per_block.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_block").alias("_k_block"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *grand,
    )
    match = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys],
        F.col("_block") == F.col("_k_block"),
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return parts.join(offsets, match).select(
        *df.columns,
        *[(F.sum(f"_v_{n}").over(inside) + F.col(f"_o_{n}")).alias(n) for n in sums],
        *([f"{n}_total" for n in sums] if totals else []),
    )


def number_rows(df: DataFrame, keys, order, block, name="row_no", totals=False) -> DataFrame:
    """Exact ``row_number`` per ``keys`` for groups of any size."""
    return running(df, keys, order, {name: F.lit(1).cast("long")}, block, totals)


def with_group(df: DataFrame, keys, aggregates) -> DataFrame:
    """Aggregate per ``keys`` with map-side combine and join the result back."""
    keys = list(keys)
    grouped = df.groupBy(*keys).agg(*aggregates)
    renamed = grouped.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys],
        *[c for c in grouped.columns if c not in keys],
    )
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    return df.join(renamed, match).drop(*[f"_g_{k}" for k in keys])


def _long(df, by, columns):
    """``by``, column name and known value, one row per value."""
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
        )
    )
    return df.select(*by, pairs.alias("_p")).select(*by, "_p.column", "_p.value").filter(F.col("value").isNotNull())


def _narrow(rows, bins, level, order, first=None):
    """The intervals that hold a wanted rank: counts per ``order`` within ``bins``, with ranks and rows before.

    ``first`` gives the wanted ranks from the number of rows; later levels carry
    them in ``bins``, which is broadcast: two ranks per column and probability.
    """
    if first is None:
        rows = rows.join(F.broadcast(bins), ["column", *level])
        counts = rows.groupBy("column", *level, order, "n", "before", "ranks").agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = rows.groupBy("column", order).agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy("column", *level)
    earlier = F.coalesce(F.sum("_n").over(inside.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if first is None:
        counts = counts.withColumn("before", F.col("before") + earlier)
    else:
        counts = counts.withColumns({"n": F.sum("_n").over(inside), "before": earlier})
        counts = counts.withColumn("ranks", first(F.col("n")))
    held = F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("_n")))
    return counts.withColumn("ranks", held).filter(F.size("ranks") > 0).select("column", *level, order, "n", "before", "ranks")


def _selected(df, columns, probabilities):
    """``column, n, value, ranks``: the values at the wanted ranks, by three rounds of counting.

    The first round counts the intervals of all values, the second the parts of
    those intervals that hold a wanted rank, the third the values of such parts.
    Only counts are shuffled, never the values of a column.
    """
    rows = _long(df, [], columns)
    coarse, fine = _interval(F.col("value"))
    rows = rows.select("column", "value", coarse.alias("coarse"), fine.alias("fine"))
    spots = lambda n: [F.lit(float(p)) * (n - 1) for p in probabilities]
    ranks = lambda n: F.array_distinct(F.array(*[f(s) for s in spots(n) for f in (F.floor, F.ceil)]))
    bins = _narrow(rows, None, [], "coarse", ranks)
    bins = _narrow(rows, bins, ["coarse"], "fine")
    return _narrow(rows, bins, ["coarse", "fine"], "value").select("column", "n", "value", "ranks")


def quantiles(df: DataFrame, columns, probabilities, by=()) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per group and column.

    Result: ``by`` columns, ``column``, ``n`` and ``q`` (array, in the order of
    ``probabilities``).  Whole columns are searched by counting (``df`` is read
    three times); per group, equal values are counted before the shuffle and
    the work is on distinct values.  No group is held in memory.
    """
    columns, by = list(columns), list(by)
    keys = [*by, "column"]
    spots = [F.lit(float(p)) * (F.col("n") - 1) for p in probabilities]
    if by:
        counts = _long(df, by, columns).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_n"))
        sized = running(counts, keys, ["value"], {"_upto": F.col("_n")}, number_block("value"), totals=True)
        sized = sized.withColumnRenamed("_upto_total", "n")
        before = F.col("_upto") - F.col("_n")
        at = lambda rank: F.max(F.when(before <= rank, F.col("value")))
    else:
        sized = _selected(df, columns, probabilities)
        at = lambda rank: F.max(F.when(F.array_contains("ranks", rank), F.col("value")))
    picks = [at(f(s)).alias(f"_{side}{i}") for i, s in enumerate(spots) for side, f in (("lo", F.floor), ("hi", F.ceil))]
    found = sized.groupBy(*keys, "n").agg(*picks)

    def between(i, spot):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return low + (high - low) * (spot - F.floor(spot))

    return found.select(*keys, "n", F.array(*[between(i, s) for i, s in enumerate(spots)]).alias("q"))


def wide_quantiles(df: DataFrame, columns, probabilities, by=()) -> DataFrame:
    """As :func:`quantiles`, with one array column per input column (``q_<column>``)."""
    long = quantiles(df, columns, probabilities, by)
    aggregates = [F.max(F.when(F.col("column") == c, F.col("q"))).alias(f"q_{c}") for c in columns]
    return long.groupBy(*by).agg(*aggregates)

"""Joins whose many-rows side may hold a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import functions as F

#: A key with more than one row in ``SHARE`` is heavy; there are fewer such keys than ``SHARE``.
SHARE = 10_000


def lookup(many, one, on, share=SHARE):
    """Left join of ``many`` with ``one``, which holds every key at most once; null keys stay without a match.

    Keys with more than one in ``share`` of all rows of ``many`` find their row
    of ``one`` by a broadcast of fewer than ``share`` rows, at any size of the
    input; the others meet in shuffled partitions, where no key can weigh more
    than that share. ``many`` is read three times, so it should be a stored table.
    """
    on = [on] if isinstance(on, str) else list(on)
    known = many.dropna(subset=on)
    counts = known.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = known.agg(F.count(F.lit(1)).alias("_n")).select(F.col("_n").cast("double") / share)
    heavy = F.broadcast(counts.filter(F.col("_n") > total.scalar()).select(*on))
    rows = F.broadcast(one.join(heavy, on, "left_semi"))
    hot = many.join(heavy, on, "left_semi").join(rows, on, "left")
    return many.join(heavy, on, "left_anti").join(one, on, "left").unionByName(hot)

"""Seeded samples and splits: md5 of seed and id gives the same order on every run and engine.

Row numbers along that order come from :mod:`ordered`, whose blocks are the
first digits of the digest, so one stratum may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered


def digest(key, seed) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def unit_number(key, seed) -> Column:
    """Even number in [0, 1)."""
    return F.conv(F.substring(digest(key, seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sample_rows(df, key, n, seed=42) -> DataFrame:
    """``n`` random rows."""
    return df.orderBy(digest(key, seed), key).limit(n)


def one_per_group(df, by, key, seed=42) -> DataFrame:
    """One random row per group, as an aggregate."""
    rest = [c for c in df.columns if c not in by]
    pick = F.min_by(F.struct(*rest), F.struct(digest(key, seed).alias("h"), F.col(key).alias("k")))
    return df.groupBy(*by).agg(pick.alias("_row")).select(*by, "_row.*")


def numbered(df, by, key, seed, name="row_no", totals=False) -> DataFrame:
    """Row numbers per group in digest order."""
    hashed = df.withColumn("_h", digest(key, seed))
    block = ordered.hash_block(F.col("_h"))
    return ordered.number_rows(hashed, by, ["_h", key], block, name, totals).drop("_h")


def split(df, key, fraction=0.8, seed=42, by=()) -> DataFrame:
    """Flag ``is_first`` for exactly floor(fraction * n) rows, per group where ``by`` is given."""
    ranked = numbered(df, list(by), key, seed, "_no", totals=True)
    limit = F.floor(F.lit(float(fraction)) * F.col("_no_total"))
    return ranked.withColumn("is_first", F.col("_no") <= limit).drop("_no", "_no_total")


def minibatches(df, key, size=32, epochs=10, seed=42) -> DataFrame:
    """Every row once per epoch, in a new order, with its batch number."""
    spread = df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    hashed = spread.withColumn(
        "_h", F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(key).cast("string")))
    )
    ranked = ordered.number_rows(hashed, ["epoch"], ["_h", key], ordered.hash_block(F.col("_h")), "_no")
    return ranked.withColumn("batch", F.floor((F.col("_no") - 1) / size)).drop("_h", "_no")

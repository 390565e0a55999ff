"""Structured Streaming forms of the monitoring jobs.

State and output folders are parameters; on a cluster they lie in shared
storage.  Every sink writes one folder per epoch and overwrites it on a retry,
so a lost executor or a restarted query leaves each batch in the result once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark, folder, schema, pattern="*.parquet", files_per_batch=None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def start(stream, path, checkpoint, mode="append", every=None, work=None):
    """Start a query that stores every batch (after ``work``) under its epoch.

    ``every`` is a processing-time trigger such as ``15 minutes``; without it
    the query takes what is there and ends.
    """

    def store(batch, epoch):
        out = batch if work is None else work(batch)
        out.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def stored(spark, path, keys=None) -> DataFrame:
    """What a query stored; with ``keys`` the newest epoch's row per key (update mode)."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/epoch=*")
    if keys is None:
        return rows.drop("epoch")
    rest = [c for c in rows.columns if c not in keys and c != "epoch"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_r"))
    return newest.select(*keys, "_r.*")


def daily_news(stream, by, ts="ts", watermark="1 hour", measures=None) -> DataFrame:
    """Counts, and measures (name -> aggregate), per day and group; rows later than the watermark are ignored."""
    measures = measures or {}
    return (
        stream.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, "1 day").alias("_w"), *by)
        .agg(F.count(F.lit(1)).alias("n"), *[m.alias(name) for name, m in measures.items()])
        .select(F.to_date("_w.start").alias("day"), *by, "n", *measures)
    )


def dedup(stream, keys, ts="ts", watermark="1 hour") -> DataFrame:
    """First row per key within the watermark."""
    return (
        stream.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, watermark)
        .dropDuplicatesWithinWatermark(list(keys))
    )


class _Cooldown(StatefulProcessor):
    """Keeps the time of the last accepted row per key."""

    def __init__(self, hours):
        self.gap = pd.Timedelta(hours=hours)

    def init(self, handle):
        self.last = handle.getValueState("last", "ts timestamp")

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows)).sort_values(["ts", "id"], kind="stable")
        last = pd.Timestamp(self.last.get()[0]) if self.last.exists() else None
        kept = []
        for ts in pdf["ts"]:
            free = last is None or ts - last >= self.gap
            kept.append(free)
            last = ts if free else last
        self.last.update((last.to_pydatetime(),))
        yield pdf[kept][["id", "key", "ts"]]

    def close(self):
        pass


class _DailyCap(StatefulProcessor):
    """Counts the accepted rows of a day."""

    def __init__(self, per_day):
        self.per_day = per_day

    def init(self, handle):
        self.used = handle.getValueState("used", "n int")

    def handleInputRows(self, key, rows, timerValues):
        used = self.used.get()[0] if self.used.exists() else 0
        left = self.per_day - used
        pdf = pd.concat([r.nsmallest(max(left, 0), ["ts", "id"]) for r in rows])
        kept = pdf.nsmallest(max(left, 0), ["ts", "id"])
        self.used.update((used + len(kept),))
        yield kept[["id", "key", "ts"]]

    def close(self):
        pass


def _stateful(stream, processor, key):
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    kind = stream.schema["key"].dataType.simpleString()
    schema = f"id {stream.schema['id'].dataType.simpleString()}, key {kind}, ts timestamp"
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="none"
    )


def cooldown(stream, key, ts="ts", row_id="id", hours=24) -> DataFrame:
    """Rows at least ``hours`` after the last accepted one of their key."""
    rows = stream.select(F.col(row_id).alias("id"), F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("ts"))
    return _stateful(rows, _Cooldown(hours), "key")


def daily_cap(stream, ts="ts", row_id="id", per_day=2) -> DataFrame:
    """At most ``per_day`` rows per day, first come first served."""
    time = F.col(ts).cast("timestamp")
    rows = stream.select(F.col(row_id).alias("id"), F.to_date(time).alias("key"), time.alias("ts"))
    return _stateful(rows, _DailyCap(per_day), "key")


def exit_alerts(stream, positions, history, sentiment, path, checkpoint, every="15 minutes", **limits):
    """Price updates against open positions; each batch stores its alerts.

    ``stream`` brings ``ticker`` and ``current_price``; the static sides are read
    anew per batch.
    """
    from ..operators import signals

    def alerts(batch):
        latest = batch.groupBy("ticker").agg(F.max_by("current_price", "ts").alias("current_price"))
        held = positions.drop("current_price").join(latest, "ticker")
        return signals.exit_alerts(held, history, sentiment, **limits)

    return start(stream, path, checkpoint, every=every, work=alerts)


def refresh(stream, load, work, path, checkpoint, every="15 minutes"):
    """Batches against a static table that is loaded again when the day changes."""
    held = {}

    def step(batch):
        day = batch.sparkSession.range(1).select(F.current_date()).first()[0]
        if held.get("day") != day:
            held.update(day=day, table=load())
        return work(batch, held["table"])

    return start(stream, path, checkpoint, every=every, work=step)

"""Hard negatives by a vertical scan of the dimensions (BOND).

Vectors lie in blocks of bounded bytes, dimension by dimension, with the least
and the greatest value of each dimension. An anchor reads the dimensions in
descending order of its own magnitude. After some of them a row's score lies
between its sum so far plus the least and plus the greatest contribution that
the unread dimensions can make; rows that cannot reach an open place, or that
must lie above every window, leave the candidates. What remains after the last
dimension has its exact integer score.

Anchors lie in blocks too. Every block of anchors meets every block of rows
once, by a join on the group of the row block: nothing is broadcast, nothing is
collected, and a task holds one pair of blocks and the best places of the
anchor blocks it is at. The first pass finds the positives, the second one the
negatives in the windows below the positives' scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import stored

#: Bytes of a block of rows, anchors in a block (on average), dimensions read between two cuts.
BYTES, ANCHORS, STEP = 1 << 20, 512, 16
#: Anchor blocks whose best places a task holds at once.
HELD = 8
#: Greatest magnitude of a scaled component, so that scores stay within 64 bits.
LIMIT = 1 << 28

BLOCK = "block long, dim int, ids binary, labels binary, data binary"


def _scaled(batch, scale):
    """Ids, labels, scaled components, offsets and "takes part" of the rows of a batch."""
    vectors = batch.column("vector")
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values.cast(pa.float64())
    x = values.to_numpy(zero_copy_only=False)
    with np.errstate(all="ignore"):
        x = np.floor(x * scale)
    good = np.isfinite(x) & (np.abs(x) <= LIMIT)
    bad = np.concatenate([[0], np.cumsum(~good)])
    null = np.zeros(batch.num_rows, bool)
    for column in (batch.column("id"), batch.column("label"), vectors):
        null |= column.is_null().to_numpy(zero_copy_only=False)
    return x, offsets, ~null & (bad[offsets[1:]] == bad[offsets[:-1]])


def blocks(rows, id, label, vector, scale):
    """The rows that take part as blocks: ids, labels and, dimension by dimension, ``floor(scale * x)``."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            x, offsets, part = _scaled(batch, scale)
            size = np.diff(offsets)
            ids, labels = (batch.column(c).fill_null(0).to_numpy() for c in ("id", "label"))
            for dim in np.unique(size[part]).tolist():
                of = np.flatnonzero(part & (size == dim))
                step = max(1, BYTES // (4 * max(dim, 1)))
                for k in range(0, len(of), step):
                    at = of[k : k + step]
                    data = x[offsets[at][None, :] + np.arange(dim)[:, None]].astype("<i4")
                    yield pa.RecordBatch.from_pylist(
                        [{"block": number, "dim": dim, "ids": ids[at].astype("<i8").tobytes(), "labels": labels[at].astype("<i8").tobytes(), "data": data.tobytes()}],
                        schema=pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("data", pa.binary())]),
                    )
                    number += 1

    chosen = rows.select(F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("vector"))
    return chosen.mapInArrow(run, BLOCK)


def _unpack(row):
    """Ids, labels and the matrix (dimension by row) of a block."""
    ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(row["data"], "<i4").reshape(row["dim"], len(ids))


def anchors(table, every):
    """``id, label, dim, v, key``: the different rows whose id is divisible by ``every``, from ``blocks``."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, data = _unpack(row)
                at = np.flatnonzero(ids % every == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(labels[at]), pa.array(np.full(len(at), row["dim"], np.int32)), pa.array([data[:, i].tobytes() for i in at], pa.binary())],
                    names=["id", "label", "dim", "v"],
                )

    found = table.select("dim", "ids", "labels", "data").mapInArrow(run, "id long, label long, dim int, v binary")
    return found.distinct().withColumn("key", F.sha2(F.concat_ws(":", "id", "label", F.hex("v")), 256))


def scan(a, data, low, high, at, open_):
    """Vertical scan of the columns ``at`` of ``data`` for the anchor ``a``; returns those left and their exact scores.

    ``open_(least, greatest)`` tells which rows may still matter, by the bounds
    of their scores.
    """
    order = np.argsort(-np.abs(a), kind="stable")
    ends = np.stack([a * low, a * high])[:, order]
    rest = np.zeros((2, len(a) + 1), data.dtype)
    rest[0, :-1] = np.cumsum(ends.min(axis=0)[::-1])[::-1]
    rest[1, :-1] = np.cumsum(ends.max(axis=0)[::-1])[::-1]
    score = np.zeros(len(at), data.dtype)
    if len(at) and not open_(rest[0, :1], rest[1, :1]).any():
        return at[:0], score[:0]
    for k in range(0, len(a), STEP):
        dims = order[k : k + STEP]
        score += a[dims] @ (data[dims] if len(at) == data.shape[1] else data[np.ix_(dims, at)])
        end = min(k + STEP, len(a))
        alive = open_(score + rest[0, end], score + rest[1, end])
        if not alive.all():
            at, score = at[alive], score[alive]
        if not len(at):
            break
    return at, score


def _best(score, id, k):
    """Order of the first ``k`` by score, greatest first, and id."""
    return np.lexsort((id, -score))[:k]


class Nearest:
    """The first ``k`` rows of an anchor's label so far."""

    def __init__(self, anchor, k):
        self.anchor, self.k = anchor, k
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def candidates(self, ids, labels):
        return np.flatnonzero((labels == self.anchor["label"]) & (ids != self.anchor["id"]))

    def open_(self, least, greatest):
        if len(self.score) == self.k:
            return greatest >= self.score[-1]
        if len(least) > self.k:
            return greatest >= np.partition(least, -self.k)[-self.k]
        return np.ones(len(least), bool)

    def add(self, ids, scores):
        score, id = np.concatenate([self.score, scores]), np.concatenate([self.id, ids])
        best = _best(score, id, self.k)
        self.score, self.id = score[best], id[best]

    def rows(self):
        return [(self.anchor["key"], 0, i, s) for i, s in zip(self.id.tolist(), self.score.tolist())]


class Windows:
    """The first ``k`` rows of other labels in each of an anchor's score windows so far."""

    def __init__(self, anchor, k, share):
        self.anchor, self.k = anchor, k
        self.tops = sorted(set(anchor["tops"]))
        up, of = share
        self.floors = [-(-up * t // of) for t in self.tops]
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.tops]

    def candidates(self, ids, labels):
        return np.flatnonzero((labels != self.anchor["label"]) & (ids != self.anchor["id"]))

    def _least(self, j):
        score = self.found[j][0]
        return score[-1] if len(score) == self.k else self.floors[j]

    def open_(self, least, greatest):
        if not self.tops:
            return np.zeros(len(least), bool)
        return (greatest >= min(map(self._least, range(len(self.tops))))) & (least <= self.tops[-1])

    def add(self, ids, scores):
        for j, top in enumerate(self.tops):
            inside = (scores >= self._least(j)) & (scores <= top)
            if inside.any():
                score, id = (np.concatenate([old, new[inside]]) for old, new in zip(self.found[j], (scores, ids)))
                best = _best(score, id, self.k)
                self.found[j] = score[best], id[best]

    def rows(self):
        return [(self.anchor["key"], t, i, s) for t, (score, id) in zip(self.tops, self.found) for i, s in zip(id.tolist(), score.tolist())]


def _scans(table, searched, place):
    """``key, top, id, score``: the places of every anchor (``place`` makes them) after every block of rows, in parts."""
    spark = table.sparkSession
    count = searched.count()
    size = searched.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    packs = searched.join(size, "dim").withColumn("pack", F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / ANCHORS)))
    packs = packs.groupBy("dim", "pack").agg(F.collect_list(F.struct(*searched.columns)).alias("anchors"))
    parts = max(1, min(table.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))) if count else 1
    group = F.pmod(F.xxhash64("block"), F.lit(parts))
    left = packs.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    # Merged by hint: the copies of the anchors are many times what they are estimated at, and must not be broadcast.
    # Both sides are dealt by all keys of the join, so they are dealt once.
    left, right = (x.repartition(parts, "group", "dim") for x in (left, table.withColumn("group", group)))
    pairs = left.hint("merge").join(right, ["group", "dim"])

    def run(batches):
        held = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                pack = (row["dim"], row["pack"])
                if pack not in held:
                    if len(held) == HELD:
                        yield from _rows(held)
                        held = {}
                    held[pack] = [(place(x), np.frombuffer(x["v"], "<i4").astype(np.int64)) for x in row["anchors"]]
                ids, labels, data = _unpack(row)
                low, high = (data.min(axis=1), data.max(axis=1)) if len(ids) else (data.sum(axis=1),) * 2
                # Doubles hold every sum exactly up to 2**53; beyond that, integers do.
                reach = np.maximum(np.abs(low.astype(np.int64)), np.abs(high.astype(np.int64)))
                exact = {float: None, np.int64: None}
                for best, a in held[pack]:
                    kind = float if (np.abs(a).astype(float) * reach).sum() < 2**53 else np.int64
                    if exact[kind] is None:
                        exact[kind] = tuple(m.astype(kind) for m in (data, low, high))
                    at, score = scan(a.astype(kind), *exact[kind], best.candidates(ids, labels), best.open_)
                    if len(at):
                        best.add(ids[at], score.astype(np.int64))
        yield from _rows(held)

    return pairs.select("dim", "pack", "anchors", "ids", "labels", "data").mapInArrow(run, "key string, top long, id long, score long")


def _rows(held):
    rows = [r for places in held.values() for best, _ in places for r in best.rows()]
    if rows:
        key, *numbers = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(n, pa.int64()) for n in numbers)], names=["key", "top", "id", "score"])


def _first(found, k):
    """The first ``k`` of each anchor and window, from at most ``k`` rows a task."""
    order = Window.partitionBy("key", "top").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows, id="vec_id", label="label", vector="embedding", every=100, positives=5, negatives=5, share=(4, 5), scale=256):
    """Hard negatives of every row whose id is divisible by ``every``.

    Components are ``floor(scale * x)``; a score is the integer inner product
    with the anchor; greater scores come first, ties by smaller id. Positives
    are the first ``positives`` other rows of the anchor's label, all if there
    are fewer. Returned for each of them are the first ``negatives`` rows of
    other labels whose score is at least ``share`` (a fraction) of the
    positive's and not above it: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    ``label`` is a column name or a Column. Rows without an id, label or vector,
    or with a null, non-finite or (scaled) more than 2**28 large component take
    no part. Vectors of different length have no score; rows with the anchor's
    id are not its others; repeated rows are rows of their own, but equal
    anchors are one. Without rows, or without anchors, the result is empty.
    """
    label = F.col(label) if isinstance(label, str) else label
    table = stored(blocks(rows, id, label, vector, scale), "blocks")
    found = stored(anchors(table, every), "anchors")
    near = _first(_scans(table, found, lambda x: Nearest(x, positives)), positives)
    near = stored(near.select("key", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    tops = near.groupBy("key").agg(F.collect_set("positive_score").alias("tops"))
    far = _first(_scans(table, stored(found.join(tops, "key"), "windows"), lambda x: Windows(x, negatives, share)), negatives)
    far = far.select("key", F.col("top").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = near.join(far, ["key", "positive_score"]).join(found.select("key", F.col("id").alias("anchor_id")), "key")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

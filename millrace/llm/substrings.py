"""Substring dedup: word windows that stand somewhere earlier, found by doubling their length.

Level one looks at windows of half the wanted width. Of every wanted window only
its least half-width window by hash (the leftmost of equals) is counted over the
corpus, which is the same for equal windows; about one start in six is sent.
Windows whose half is repeated, and those alone, are extended to twice that
length, the wanted width, and counted again. A longer repeat consists of
windows of the wanted width, so doubling ends there.

Texts that occur more than once take part once, under their smallest id: every
window of the others starts earlier there. Positions travel, texts are shuffled
once (the exchange on the id serves all three passes). Counts of hot windows meet in
aggregates with map-side combine; the rows of one hot window join them in one task.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import Words, slices, whole, windows

WINDOW = 20
#: Stands for a null id inside the operator; it comes before all others.
_FIRST = -(1 << 63)
_CHECK = 24


def least_half(words, hashes, width):
    """For every start of a ``width`` window: the index of its least half, and which starts are whole.

    Returns ``(index, whole, half hashes)``; starts are word numbers of the slice.
    """
    half = (width + 1) // 2
    h = windows(hashes, half)
    span = width - half + 1
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool), h
    best, size = np.arange(len(h)), 1
    while size < span:
        step = min(size, span - size)
        a, b = best[: len(best) - step], best[step:]
        best, size = np.where(h[b] < h[a], b, a), size + step
    return best[:n], whole(words.first, width, n), h


def _lists(column):
    """Values and row offsets of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets


def _halves(width):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), "blank")
                index, ok, h = least_half(words, words.hash, width)
                picked = np.unique(index[ok])
                row = words.row()[picked] if len(picked) else picked
                ids = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[picked].view(np.int64)), pa.array(ids[row], pa.int64()), pa.array((picked - words.first[row]).astype(np.int32))],
                    names=["h", "doc_id", "p"],
                )

    return run


def _wanted(width):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), "blank")
                hashes = words.hash
                index, ok, _ = least_half(words, hashes, width)
                if not len(index):
                    continue
                repeated = np.zeros(len(hashes) + 1, bool)
                values, offsets = _lists(part.column("ps"))
                row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                place = words.first[row] + values[offsets[0] : offsets[-1]]
                inside = place < words.first[row + 1]
                repeated[place[inside]] = True
                starts = np.flatnonzero(ok & repeated[index])
                h = windows(hashes, width)[starts]
                row = words.row()[starts]
                # The first of equal windows in a row speaks for them all.
                order = np.lexsort((starts, h, row))
                new = np.ones(len(order), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
                keep = np.sort(order[new])
                ids = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[keep].view(np.int64)), pa.array(ids[row[keep]], pa.int64()),
                        pa.array((starts[keep] - words.first[row[keep]]).astype(np.int32)),
                    ],
                    names=["h", "doc_id", "s"],
                )

    return run


def removed_words(words, hashes, width, row, s, check):
    """Which words go: those under a window that starts earlier in its own row, or is named by ``row, s, check``."""
    gone = np.zeros(len(hashes) + 1, np.int64)
    n = len(hashes) - width + 1
    if n <= 0:
        return gone[:-1].astype(bool)
    h = windows(hashes, width)
    ok = np.flatnonzero(whole(words.first, width, n))
    rows = words.row()
    order = ok[np.lexsort((ok, h[ok], rows[ok]))]
    again = np.zeros(n, bool)
    if len(order):
        later = np.zeros(len(order), bool)
        later[1:] = (h[order][1:] == h[order][:-1]) & (rows[order][1:] == rows[order][:-1])
        again[order] = later
        place = words.first[row] + s
        fits = (place < n) & (place + width <= words.first[row + 1])
        place, check = place[fits], check[fits]
        same = (h[place] & np.uint64((1 << _CHECK) - 1)).astype(np.int64) == check
        again[place[same]] = True
    starts = np.flatnonzero(again)
    np.add.at(gone, starts, 1)
    np.add.at(gone, starts + width, -1)
    return np.cumsum(gone[:-1]) > 0


def _kept(width):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), "blank")
                values, offsets = _lists(part.column("gone"))
                row = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                values = values[offsets[0] : offsets[-1]]
                gone = removed_words(words, words.hash, width, row, values >> _CHECK, values & ((1 << _CHECK) - 1))
                data = words.data.tobytes()
                digests, removed = [], np.add.reduceat(np.append(gone, False), words.first[:-1].clip(max=len(gone))) if part.num_rows else []
                removed = np.where(words.counts > 0, removed, 0)
                for i in range(part.num_rows):
                    said = data[words.offsets[i] : words.offsets[i + 1]].split()
                    if removed[i]:
                        said = compress(said, (~gone[words.first[i] : words.first[i + 1]]).tolist())
                    digests.append(hashlib.sha256(b" ".join(said)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("sha"), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)],
                    names=["doc_id", "sha", "n_words", "n_removed", "kept_sha256"],
                )

    return run


def dedup(docs, id="doc_id", text="text", window=WINDOW):
    """Words left in every text after each word under an earlier-seen window is gone.

    Words are runs of characters other than the space and the characters 9 to
    13. A window of ``window`` words counts as seen earlier if the same words
    stand in a document of smaller id, or earlier in the same text; all are
    judged on the input. Returns ``doc_id, n_words, n_removed, kept_sha256``
    (SHA-256 of the kept words joined by spaces) for each row.

    A null text has no words; a text of fewer words than a window keeps all. A
    null id comes before all others; rows that share an id do not count as
    earlier than each other, so a row repeated as a whole loses nothing to its
    copy. Ids are integers; other columns are not read.
    """
    base = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(_FIRST)).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # Digests are made again after each shuffle of the texts, so that one exchange serves all passes.
    sha = F.unhex(F.sha2("text", 256))
    owners = base.groupBy(sha.alias("sha")).agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    texts = base.join(owners, "doc_id", "left_semi")
    halves = texts.select("doc_id", "text").mapInArrow(_halves(window), "h long, doc_id long, p int")
    seen = halves.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    places = halves.join(seen, "h", "left_semi").groupBy("doc_id").agg(F.collect_list("p").alias("ps"))
    wide = texts.join(places, "doc_id").select("doc_id", "text", "ps")
    wide = wide.mapInArrow(_wanted(window), "h long, doc_id long, s int")
    first = wide.groupBy("h").agg(F.min("doc_id").alias("first"))
    named = wide.join(first, "h").filter(F.col("first") < F.col("doc_id"))
    check = F.shiftleft(F.col("s").cast("long"), _CHECK).bitwiseOR(F.col("h").bitwiseAND(F.lit((1 << _CHECK) - 1)))
    gone = named.groupBy("doc_id").agg(F.collect_list(check).alias("gone"))
    empty = F.expr("cast(array() as array<long>)")
    judged = texts.join(gone, "doc_id", "left").select("doc_id", "text", sha.alias("sha"), F.coalesce("gone", empty).alias("gone"))
    judged = judged.mapInArrow(
        _kept(window),
        T.StructType().add("doc_id", T.LongType()).add("sha", T.BinaryType()).add("n_words", T.LongType())
        .add("n_removed", T.LongType()).add("kept_sha256", T.StringType()),
    )
    # The smallest id of each text; the rest of its copies lose every window.
    judged = judged.groupBy("sha").agg(F.min(F.struct("doc_id", "n_words", "n_removed", "kept_sha256")).alias("r"))
    rows = docs.select(
        F.col(id).alias("doc_id"), F.coalesce(F.col(id).cast("long"), F.lit(_FIRST)).alias("order"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("sha"),
    )
    copy = (F.col("order") != F.col("r.doc_id")) & (F.col("r.n_words") >= window)
    return rows.join(judged, "sha").select(
        "doc_id", F.col("r.n_words").alias("n_words"),
        F.when(copy, F.col("r.n_words")).otherwise(F.col("r.n_removed")).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("r.kept_sha256")).alias("kept_sha256"),
    )

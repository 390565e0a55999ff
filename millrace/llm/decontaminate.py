"""Benchmark decontamination with suffix arrays over shards of the training words.

One Arrow batch of documents is a shard. Words become ranks in the benchmark's
vocabulary; only stretches of known words at least as long as the shortest
window can hold a match, so the shard's suffix array is built over those. It is
ordered by prefix doubling up to the longest item, every benchmark suffix is
found in it by binary search, and common prefixes are read from the ranks of the
doubling levels. Documents are never shuffled and nothing is sampled.

The benchmark is broadcast in blocks of a checked size; with more than one block
the documents pass once per block and the marks add up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import Words, slices

WINDOW = 10
#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 32 << 20
_SPANS = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))


class Suffixes:
    """Ranks of all suffixes of a word stream (0 ends a run) by their first 1, 2, 4, ... words."""

    def __init__(self, stream, depth):
        self.levels = [np.unique(stream, return_inverse=True)[1].astype(np.int64) + 1]
        self.levels[0][stream == 0] = 0
        length = 1
        while length < depth:
            self.levels.append(self._twice(self.levels[-1], self.levels[-1], length))
            length *= 2
        self.rank = self.levels[-1]

    @staticmethod
    def _shift(rank, by):
        out = np.zeros_like(rank)
        out[: max(0, len(rank) - by)] = rank[by:]
        return out

    def _twice(self, left, right, by):
        pair = left * (int(right.max(initial=0)) + 1) + self._shift(right, by)
        return np.unique(pair, return_inverse=True)[1].astype(np.int64)

    def prefix(self, width):
        """One number for each distinct prefix of ``width`` words."""
        out, done = None, 0
        for k in reversed(range(len(self.levels))):
            if width - done >= 1 << k:
                out = self.levels[k] if out is None else self._twice(out, self.levels[k], done)
                done += 1 << k
        return out

    def common(self, a, b, stop):
        """Length of the common prefix of suffixes ``a`` and ``b`` within their runs (``stop``: ends of runs)."""
        a, b = a.copy(), b.copy()
        length = np.zeros(len(a), np.int64)
        most = np.minimum(stop[a] - a, stop[b] - b)
        for k in reversed(range(len(self.levels))):
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                inside = length + (1 << k) <= most
                at_a, at_b = np.where(inside, a + length, 0), np.where(inside, b + length, 0)
                length += np.where(inside & (self.levels[k][at_a] == self.levels[k][at_b]), 1 << k, 0)
        return length


class Index:
    """One block of benchmark items: vocabulary, word stream and windows."""

    def __init__(self, items, window=WINDOW):
        self.window = window
        ids = [str(i) for i, _ in items]
        words = Words(pa.array([t for _, t in items], pa.large_string()), "plain")
        hashes, counts = words.hash, words.counts
        self.vocabulary = np.unique(hashes)
        known = np.searchsorted(self.vocabulary, hashes) + 1
        self.size = len(hashes)
        # Runs are divided by one 0 each.
        place = np.arange(len(hashes)) + words.row()
        self.stream = np.zeros(len(hashes) + len(items), np.int64)
        self.stream[place] = known
        widths = np.minimum(counts, window)[words.row()]
        room = words.first[1:][words.row()] - np.arange(len(hashes))
        start = room >= widths
        self.windows = {int(w): place[start & (widths == w)] for w in np.unique(widths)}
        self.item = np.zeros(len(self.stream), np.int64)
        self.item[place] = words.row()
        self.ids = np.array(ids, object)
        self.least = int(widths.min(initial=window))
        self.depth = int(counts.max(initial=1))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def known(self, hashes):
        """Rank of each word in the vocabulary, from 1; 0 if it has none."""
        out = np.zeros(len(hashes), np.int64)
        if not len(self.vocabulary):
            return out
        at = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        out[at] = np.where(self.vocabulary[found] == hashes[at], found + 1, 0)
        return out

    def shard(self, batch):
        """Known stretches of a batch: ranks, document and word number of each entry; words of every document."""
        ranks, docs, places, counts, base = [], [], [], [], 0
        for part in slices(batch):
            words = Words(part.column("text"), "plain")
            counts.append(words.counts)
            known = self.known(words.hash)
            on = known > 0
            edge = np.zeros(len(known) + 1, bool)
            edge[0] = edge[-1] = True
            edge[1:-1] = on[1:] != on[:-1]
            edge[words.first] = True
            cuts = np.flatnonzero(edge)
            begin, end = cuts[:-1], cuts[1:]
            keep = on[begin] & (end - begin >= self.least) if len(begin) else np.zeros(0, bool)
            begin, size = begin[keep], (end - begin)[keep]
            if len(begin):
                after = np.cumsum(size + 1)
                fill = np.repeat(begin - (after - size - 1), size + 1) + np.arange(after[-1])
                last = after - 1
                fill[last] = begin
                row = words.row()[fill]
                rank = known[fill]
                rank[last] = 0
                ranks.append(rank)
                docs.append(row + base)
                places.append(fill - words.first[row])
            base += part.num_rows
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return join(ranks), join(docs), join(places), join(counts)

    def search(self, batch):
        """Marks of a batch: ``(n_words, {doc: spans}, {doc: items}, longest per doc)``."""
        ranks, docs, places, counts = self.shard(batch)
        longest = np.zeros(batch.num_rows, np.int64)
        if not len(ranks):
            return counts, {}, {}, longest
        own = len(self.stream)
        stream = np.concatenate([self.stream, ranks])
        order = Suffixes(stream, self.depth)
        zeros = np.flatnonzero(stream == 0)
        stop = zeros[np.searchsorted(zeros, np.arange(len(stream)))]
        train = np.flatnonzero(ranks) + own
        tests = np.flatnonzero(self.stream)
        array = train[np.argsort(order.rank[train], kind="stable")]
        tests = tests[np.argsort(order.rank[tests], kind="stable")]
        # Every benchmark suffix in the shard's array, and its neighbours there.
        at = np.searchsorted(order.rank[array], order.rank[tests])
        # The same places tell each training suffix its nearest benchmark suffixes.
        for side in (-1, 0):
            near = np.searchsorted(order.rank[tests], order.rank[array], "right") + side
            fits = (near >= 0) & (near < len(tests))
            same = order.common(array[fits], tests[near[fits]], stop)
            np.maximum.at(longest, docs[array[fits] - own], same)
        longest[longest < self.window] = 0
        best = np.zeros(len(tests), np.int64)
        for side in (-1, 0):
            fits = (at + side >= 0) & (at + side < len(array))
            best[fits] = np.maximum(best[fits], order.common(tests[fits], array[at[fits] + side], stop))
        matched = np.zeros(own, np.int64)
        matched[tests] = best
        cover = np.zeros(len(ranks) + 1, np.int64)
        items: dict[int, set] = {}
        for width, starts in self.windows.items():
            starts = starts[matched[starts] >= width]
            if not len(starts):
                continue
            key = order.prefix(width)
            wanted = np.unique(key[starts])
            hit = train[(stop[train] - train >= width)]
            hit = hit[np.isin(key[hit], wanted)]
            np.add.at(cover, hit - own, 1)
            np.add.at(cover, hit - own + width, -1)
            # Distinct (document, key) pairs against distinct (key, item) pairs.
            pairs = np.unique(np.stack([key[hit], docs[hit - own]]), axis=1)
            of = np.unique(np.stack([key[starts], self.item[starts]]), axis=1)
            low, high = np.searchsorted(of[0], pairs[0]), np.searchsorted(of[0], pairs[0], "right")
            for doc, a, b in zip(pairs[1], low, high):
                items.setdefault(int(doc), set()).update(self.ids[of[1][a:b]])
        covered = (np.cumsum(cover[:-1]) > 0).astype(np.int8)
        jump = np.diff(np.concatenate([[0], covered, [0]]))
        begin, end = np.flatnonzero(jump == 1), np.flatnonzero(jump == -1)
        spans: dict[int, list] = {}
        for b, e in zip(begin, end):
            spans.setdefault(int(docs[b]), []).append((int(places[b]), int(places[b]) + int(e - b)))
        return counts, spans, items, longest


def _merged(spans):
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _blocks(benchmark, block_bytes, window):
    """Index of each benchmark block; every block is collected alone."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // block_bytes) + 1
    for k in range(n):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else benchmark
        yield Index([(r[0], r[1]) for r in part.collect()], window)


def marks(docs, benchmark, id="doc_id", text="text", item="item_id", item_text="text", window=WINDOW, block_bytes=BLOCK_BYTES):
    """Where documents repeat benchmark items word for word.

    Returns ``doc_id, n_words, spans, items, longest`` for each row of ``docs``:
    the covered word ranges, the sorted ids of items with an occurring window,
    and the longest common stretch of words with any item (0 below ``window``
    words). A null text has no words and so no spans; a null item text is
    skipped; a null item id is listed as ``None``; repeated documents and items
    are each looked at; an empty benchmark marks nothing. Other columns of
    either table are not read.
    """
    schema = (
        T.StructType().add("doc_id", docs.schema[id].dataType).add("text", T.StringType()).add("n_words", T.LongType())
        .add("spans", _SPANS).add("items", T.ArrayType(T.StringType())).add("longest", T.LongType())
    )
    items = benchmark.select(F.col(item).cast("string").alias("item_id"), F.col(item_text).alias("text")).filter("text is not null")
    out = docs.select(
        F.col(id).alias("doc_id"), F.col(text).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<s:long,e:long>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"), F.lit(0).cast("long").alias("longest"),
    )
    for index in _blocks(items, block_bytes, window):
        shipped = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shipped=shipped):
            for batch in batches:
                counts, spans, items, longest = shipped.value.search(batch)
                was_spans, was_items = batch.column("spans"), batch.column("items")
                new_spans, new_items = [], []
                for i in range(batch.num_rows):
                    old = [(x["s"], x["e"]) for x in was_spans[i].as_py()] if len(was_spans[i]) else []
                    new_spans.append([{"s": s, "e": e} for s, e in _merged(old + spans.get(i, []))])
                    kept = was_items[i].as_py() if len(was_items[i]) else []
                    new_items.append(sorted({*kept, *items.get(i, ())}))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("text"), pa.array(counts, pa.int64()),
                        pa.array(new_spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                        pa.array(new_items, pa.list_(pa.string())),
                        pa.array(np.maximum(longest, np.asarray(batch.column("longest"))), pa.int64()),
                    ],
                    names=["doc_id", "text", "n_words", "spans", "items", "longest"],
                )

        out = out.mapInArrow(run, schema)
    return out.drop("text")


def report(docs, benchmark, **options):
    """``marks`` as figures for each document: words, hit words, items and their digest."""
    m = marks(docs, benchmark, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["e"] - x["s"])
    return m.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "longest",
    )


def clean(docs, benchmark, **options):
    """The rows of ``docs`` that share no window with the benchmark, with all their columns; repeated rows are judged one by one."""
    options.pop("id", None)
    text = options.pop("text", "text")
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text).alias("text"))
    found = marks(packed, benchmark, id="row", **options)
    return found.filter(F.size("spans") == 0).select("doc_id.*")

"""Best-fit decreasing packing of tokenised documents into sequences of a fixed capacity.

Best-fit decreasing takes the pieces from the longest to the shortest and puts
each into the open sequence with the least room that still holds it. A segment
tree over the rooms 0, 1, ..., capacity counts the open sequences of each room
and finds the tightest one in logarithmic time. Pieces of one length, and
sequences of one room, are interchangeable, so the packing is laid out once for
the histogram of lengths (at most ``capacity`` numbers, whatever the number of
documents): equal pieces go into equal sequences in runs. The result is what
best-fit decreasing gives piece by piece over the whole table, not over one task.

Nothing but the histogram reaches the driver, and nothing but the runs goes
back. A piece finds its place by its rank among all pieces of its length, which
is its rank in the task that encoded it plus the counts of the tasks before: no
length is ever gathered in one task.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices
from .shared import stored

MODEL = "/opt/tokenizers/word_bpe_49k.json"
CAPACITY = 2048
END = 0
#: Distinct words a worker remembers, and the longest of them in characters.
KNOWN, SHORT = 600_000, 64
#: Text bytes encoded at once; a longer text goes alone.
BYTES = 1 << 22
#: A mark after a letter and what stands in its place.
MARKS = r"([A-Za-z])([.,;:!?)])", r"\1 \2"

_tokenizers: dict[int, Encoder] = {}


class Encoder:
    """Ids of whole texts by way of their distinct words.

    The tokenizer lowers its text and never joins characters across white space,
    nor a letter and a mark such as a full stop. So a text's ids are the ids of
    its parts between ASCII white space and before such marks, laid end to end.
    Parts in ASCII are lowered first, but for those that may be a marker of the
    vocabulary; composed letters are left to the tokenizer.
    """

    def __init__(self, json):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        self._clear()

    def _clear(self):
        self.known = pa.array([], pa.large_string())
        self.flat, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @classmethod
    def of(cls, json):
        """The worker's encoder of this model, read once."""
        key = zlib.crc32(json.encode())
        if key not in _tokenizers:
            _tokenizers[key] = cls(json)
        return _tokenizers[key]

    def _ids(self, words):
        """A flat array of ids and, for each of ``words``, where its ids begin and how many there are."""
        if len(self.known) > KNOWN:
            self._clear()
        at = pc.index_in(words, value_set=self.known)
        lost = pc.is_null(at)
        new = words.filter(lost).unique()
        short = pc.less_equal(pc.utf8_length(new), SHORT)
        new = pa.concat_arrays([new.filter(short), new.filter(pc.invert(short))])
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(new.to_pylist(), add_special_tokens=False)]
        flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(coded), np.uint32)])
        first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))])
        index = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        index[lost.to_numpy(zero_copy_only=False)] = len(self.known) + pc.index_in(words.filter(lost), value_set=new).to_numpy()
        kept = len(self.known) + pc.sum(short, min_count=0).as_py()
        self.known = pa.concat_arrays([self.known, new.slice(0, kept - len(self.known))])
        self.flat, self.first = flat[: first[kept]], first[: kept + 1]
        return flat, first[index], first[index + 1] - first[index]

    def encode(self, texts, end=END):
        """Flat ids of a string array, ``end`` after each text, and the offsets of the texts; null is empty."""
        texts = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), *MARKS)
        rows = pc.ascii_split_whitespace(texts)
        offsets = rows.offsets.to_numpy().astype(np.int64)
        words = rows.flatten()
        plain = pc.and_not(pc.string_is_ascii(words), pc.match_substring(words, "|"))
        flat, start, size = self._ids(pc.if_else(plain, pc.ascii_lower(words), words))
        ends = np.concatenate([[0], np.cumsum(size)])
        total = ends[offsets - offsets[0]]
        # Each text's ids move on by one place for every closing id before them.
        closed = total + np.arange(len(total))
        out = np.full(closed[-1], end, np.uint32)
        inside = np.ones(len(out), bool)
        inside[closed[1:] - 1] = False
        out[inside] = flat[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
        return out, closed


def ranks(values, seen):
    """Rank of each value among its equals, counted on from ``seen``, which is brought up to date."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    begins = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    sizes = np.diff(np.r_[begins, len(ranked)])
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(ranked)) - np.repeat(begins, sizes) + seen[ranked]
    seen[ranked[begins]] += sizes
    return out


def pieces(docs, id="doc_id", text="text", path=MODEL, capacity=CAPACITY, end=END, keep=False):
    """``doc_id, piece, start, length, ids_crc32`` of every piece, with ``block, nth`` for ``place``.

    A document is its ids, then ``end``; only one longer than ``capacity`` is
    cut, into pieces of ``capacity`` ids and a rest. ``nth`` ranks the piece
    among those of its length within the task ``block``. ``keep`` returns
    ``ids`` as well.
    """
    with open(path, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        encoder = Encoder.of(shipped.value)
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", BYTES):
                ids, offsets = encoder.encode(part.column("text"), end)
                count = -(-np.diff(offsets) // capacity)
                row = np.repeat(np.arange(part.num_rows), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                a = offsets[row] + start
                b = np.minimum(a + capacity, offsets[row + 1])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(a.tolist(), b.tolist())]
                columns = [
                    part.column("doc_id").take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(b - a, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(np.full(len(row), block), pa.int32()),
                    pa.array(ranks(b - a, seen), pa.int64()),
                ]
                if keep:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[a, b[-1:]], pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    schema = T.StructType().add("doc_id", docs.schema[id].dataType).add("piece", T.IntegerType()).add("start", T.LongType())
    schema = schema.add("length", T.LongType()).add("ids_crc32", T.LongType()).add("block", T.IntegerType()).add("nth", T.LongType())
    if keep:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


class Rooms:
    """Open sequences by the room left in them, in a segment tree over the rooms ``0`` to ``capacity``."""

    def __init__(self, capacity):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)
        self.ranges = [[] for _ in range(capacity + 1)]

    def _count(self, room, change):
        node = room + self.size
        while node:
            self.open[node] += change
            node >>= 1

    def put(self, room, first, count):
        """Add the sequences ``first`` to ``first + count - 1``."""
        if count:
            self.ranges[room].append((first, count))
            self._count(room, count)

    def take(self, room):
        """Remove and return one range of sequences of this room."""
        first, count = self.ranges[room].pop()
        self._count(room, -count)
        return first, count

    def tightest(self, length):
        """The least room of an open sequence that holds ``length``, or None."""
        node = length + self.size
        while not self.open[node]:
            # To the right neighbour of the nearest ancestor that has one; the root has none.
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node *= 2
            if not self.open[node]:
                node += 1
        return node - self.size


def layout(counts, capacity=CAPACITY):
    """Best-fit decreasing of ``counts`` (length to number of pieces).

    Returns rows ``length, rank, each, sequence, offset``: from that rank on,
    ``each`` pieces a sequence, the first at ``offset`` of ``sequence``. A run
    ends where the next of its length begins. A sequence's pieces differ in
    length at most ``sqrt(2 * capacity)`` times, and a length leaves at most two
    cut ranges of sequences behind, which bounds the rows by the capacity
    alone: some 400,000 for 2,048, of 40 bytes each.
    """
    rooms, runs, used = Rooms(capacity), [], 0
    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, each = capacity, capacity // length
                first, count = used, -(-left // each)
                used += count
            else:
                each = room // length
                first, count = rooms.take(room)
            # Full sequences first; the last one may take fewer.
            full = min(count, left // each)
            if full:
                runs.append((length, rank, each, first, capacity - room))
                rooms.put(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < count and left:
                runs.append((length, rank, each, first + full, capacity - room))
                rooms.put(room - left * length, first + full, 1)
                left, full = 0, full + 1
            rooms.put(room, first + full, count - full)
    return np.array(runs, np.int64).reshape(-1, 5)


def place(found, capacity=CAPACITY):
    """``found`` (of ``pieces``, stored) with ``sequence_id`` and ``offset`` in place of ``block, nth``."""
    counts = found.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    total = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    runs = layout(total, capacity)
    # Runs of one length stand together, by rank; a key in one number finds them.
    bits = np.int64(1) << np.int64(48)
    runs = runs[np.argsort(runs[:, 0] * bits + runs[:, 1])]
    shipped = found.sparkSession.sparkContext.broadcast(runs)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    ranked = found.join(begins, ["block", "length"]).withColumn("rank", F.col("begin") + F.col("nth")).drop("block", "nth", "begin")
    names = [c for c in found.columns if c not in ("block", "nth")]

    def run(batches):
        runs = shipped.value
        keys = runs[:, 0] * bits + runs[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            _, first, each, sequence, offset = runs[np.searchsorted(keys, length * bits + rank, "right") - 1].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence + nth // each), pa.array(offset + nth % each * length)],
                names=schema.names,
            )

    schema = T.StructType([found.schema[c] for c in names]).add("sequence_id", T.LongType()).add("offset", T.LongType())
    return ranked.mapInArrow(run, schema)


def pack(docs, id="doc_id", text="text", path=MODEL, capacity=CAPACITY, end=END, keep=False):
    """Every piece of every document with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Sequences hold at most ``capacity`` ids, are numbered from 0 and have no
    gaps. A null or empty text is the closing id alone; null and repeated ids
    are documents of their own; an empty table has no pieces; other columns are
    not read. Equal lengths are placed in the order of tasks and rows, so which
    of two equally long pieces goes where depends on how the input is split,
    the number of sequences and their fillings do not. A marker of the
    vocabulary inside a text is its id, as in the tokenizer's own settings.
    With ``keep`` the ``ids`` come along, for ``sequences``.
    """
    return place(stored(pieces(docs, id, text, path, capacity, end, keep), "packing"), capacity)


def sequences(packed):
    """The packed sequences: ``sequence_id, n_ids, n_pieces, ids, lengths`` from ``pack(..., keep=True)``.

    ``lengths`` are the pieces' lengths in order, from which attention masks and
    position ids follow. A sequence is bounded by its capacity.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("n_ids"),
        F.size("parts").cast("long").alias("n_pieces"),
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.col("parts.length").alias("lengths"),
    )

"""Words and rolling hashes over the UTF-8 bytes of Arrow string columns, without a loop over rows.

Two kinds of words are used by the operators; both are runs of bytes, since
every byte of a non-ASCII character is 0x80 or more:

* ``PLAIN``: digits, letters and everything non-ASCII, after A-Z became a-z;
* ``BLANK``: everything but the space and the characters 9 to 13.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes worked on at once; a longer text goes alone.
BYTES = 1 << 20

_random = np.random.default_rng(20240229)
_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD1342543DE82EF95)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[97:123] = _PLAIN[128:] = True
_BLANK = np.ones(256, bool)
_BLANK[9:14] = _BLANK[32] = False
#: name: (byte to byte, byte to "is in a word", byte to hash value or 0)
KINDS = {
    "plain": (_LOWER, _PLAIN, np.where(_PLAIN, _VALUES, np.uint64(0))),
    "blank": (None, _BLANK, np.where(_BLANK, _VALUES, np.uint64(0))),
}
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base, n):
    """The first ``n`` powers of an odd ``base`` and of its inverse, modulo 2**64."""
    kept = _powers.get(int(base))
    if kept is None or len(kept[0]) < n:
        size = max(n + n // 8, 1 << 16)
        pair = []
        for b in (int(base), pow(int(base), -1, 1 << 64)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            pair.append(np.multiply.accumulate(row))
        kept = _powers[int(base)] = tuple(pair)
    return kept[0][:n], kept[1][:n]


def mix(h):
    """Finaliser of 64 bits: every bit of ``h`` reaches every bit of the result."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def bytes_of(column):
    """UTF-8 bytes and row offsets (from 0) of a string array; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch, name="text", limit=BYTES):
    """Parts of a record batch of at most ``limit`` text bytes, or of one row."""
    if batch.num_rows == 0:
        return
    _, offsets = bytes_of(batch.column(name))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


class Words:
    """The words of all rows of a string column, in order.

    ``start``: first byte of each word; ``first``: index of each row's first
    word (one entry more than rows); ``hash``: 64 bits for each word.
    """

    def __init__(self, column, kind):
        lower, inside, values = KINDS[kind]
        data, offsets = bytes_of(column)
        self.data = data = lower[data] if lower is not None else data
        self.offsets = offsets
        n = len(data)
        word = inside[data]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        edges = offsets[:-1][offsets[:-1] < n]
        begins[edges] = word[edges]
        self.start = np.flatnonzero(begins)
        self.first = np.searchsorted(self.start, offsets)
        self.rows = len(offsets) - 1
        self.inside = word
        self._values = values

    @property
    def counts(self):
        return np.diff(self.first)

    @property
    def hash(self):
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = powers(_P, len(self.data))
        sums = np.add.reduceat(self._values[self.data] * up, self.start)
        return mix(sums * down[self.start])

    def row(self):
        """Row index of each word."""
        return np.repeat(np.arange(self.rows), self.counts)

    def end(self):
        """Byte after each word."""
        word, n = self.inside, len(self.data)
        ends = word.copy()
        ends[:-1] &= ~word[1:]
        edges = self.offsets[1:][self.offsets[1:] > 0] - 1
        ends[edges] = word[edges]
        return np.flatnonzero(ends) + 1


def windows(hashes, width):
    """Hash of the ``width`` words from each word on; the last ``width - 1`` entries are missing."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = powers(_Q, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[: n - width + 1])


def whole(first, width, n):
    """Which of ``n`` window starts keep ``width`` words inside one row."""
    room = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + width <= room

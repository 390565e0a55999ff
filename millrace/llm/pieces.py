"""SentencePiece encoding and decoding with the pieces of a public BPE model.

Texts are cut into units, a run of spaces with the letters after it; no piece
reaches over a unit's end. Equal units are encoded once for each batch, and units
of equal length advance together: at every end position, hashes of the substrings
that end there probe the sorted piece keys, and a vectorised maximum keeps a
backpointer. A substring's candidate is open only if its piece can follow the
piece kept before it: in the encoding by merges, the last piece of every prefix
is the one that no earlier merge would take apart, so the pair of pieces must be
left alone by the merges themselves. That makes the path the one of the merges,
where summed scores would not. Characters without a piece become byte pieces.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import mix, powers
from .arrow import slices as parts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Spaces and what follows them.
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Encoded units kept for the next texts; beyond it they are encoded anew.
CACHE = 500_000
_R = np.uint64(0xA0761D6478BD642F)
_NONE = np.int64(-1)
#: Low bits of a hash that tell most other substrings from pieces.
_SIEVE = np.uint64((1 << 19) - 1)
_LOW = np.int64((1 << 32) - 1)
#: Above every rank.
_NEVER = 1 << 40


def _pair_slot(key):
    """Slot of a pair in the table that tells most other pairs from those that merge."""
    return (key.astype(np.uint64) * _R >> np.uint64(43)).astype(np.int64)


def _codes(text):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hash(codes):
    """64 bits for a run of code points."""
    up, _ = powers(_R, len(codes))
    return mix(np.atleast_1d(((codes.astype(np.uint64) + np.uint64(1)) * up).sum(dtype=np.uint64)))[0]


class Pieces:
    """Vocabulary of a model: pieces in the order of their merges, and how each is made."""

    def __init__(self, path=MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.byte = {int(t[3:5], 16): i for i, t in enumerate(self.text) if model.is_byte(i)}
        special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
        self.raw = [b"" if i in special else t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)]
        for b, i in self.byte.items():
            self.raw[i] = bytes([b])
        self.bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.sizes = np.array([len(r) for r in self.raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self._forget()
        normal = [i for i in range(n) if i not in special]
        if any(SPACE in self.text[i].lstrip(SPACE) for i in normal):
            raise ValueError("a piece reaches over a word's end")
        self.longest = max(len(self.text[i]) for i in normal)
        # Rank of a merge: better scores first; single characters are not made by merges.
        self.rank = np.full(n + 1, -1, np.int64)
        made = sorted((i for i in normal if len(self.text[i]) > 1), key=lambda i: (-model.get_score(i), i))
        for rank, i in enumerate(made):
            self.rank[i] = rank
        keys = np.array([_hash(_codes(self.text[i])) for i in normal], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(normal, np.int64)[order]
        self.maybe = np.zeros(int(_SIEVE) + 1, bool)
        self.maybe[(keys & _SIEVE).astype(np.int64)] = True
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.known = known = {self.text[i]: i for i in normal}
        self.ranks = {self.text[i]: r for r, i in enumerate(made)}
        self.left, self.right = np.full(n + 1, _NONE), np.full(n + 1, _NONE)
        for i in made:
            parts = self._merged(self.text[i], known, int(self.rank[i]))
            if len(parts) == 2:
                self.left[i], self.right[i] = parts
            else:
                # Merges never build this piece whole.
                self.rank[i] = -2
        pair = {}
        for i in made:
            said = self.text[i]
            for k in range(1, len(said)):
                a, b = known.get(said[:k]), known.get(said[k:])
                if a is not None and b is not None:
                    pair[a * (n + 1) + b] = self.ranks[said]
        self.pair_keys = np.array(sorted(pair), np.int64)
        self.pair_rank = np.array([pair[k] for k in sorted(pair)], np.int64)
        self.pair_maybe = np.zeros(1 << 21, bool)
        self.pair_maybe[_pair_slot(self.pair_keys)] = True
        self.n = n

    def _merged(self, said, known, below):
        """Merge ``said`` by rank, using ranks under ``below`` only."""
        parts = [known.get(c, None) for c in said]
        if None in parts:
            return []
        while len(parts) > 1:
            best, where = below, None
            for k in range(len(parts) - 1):
                whole = known.get(self.text[parts[k]] + self.text[parts[k + 1]])
                if whole is not None and 0 <= self.rank[whole] < best:
                    best, where = int(self.rank[whole]), k
            if where is None:
                return parts
            parts[where : where + 2] = [known[self.text[parts[where]] + self.text[parts[where + 1]]]]
        return parts

    def _forget(self):
        """Empty tables of what was encoded and judged last; they are not shipped."""
        self.seen: dict[str, bytes] = {}
        self.judged_keys, self.judged = np.full(1 << 21, -1, np.int64), np.zeros(1 << 21, bool)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("seen", "judged_keys", "judged")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def find(self, hashes):
        """Piece of each hash, or -1."""
        out = np.full(hashes.shape, _NONE)
        maybe = np.nonzero(self.maybe[(hashes & _SIEVE).astype(np.int64)])
        some = hashes[maybe]
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[at] == some, self.ids[at], _NONE)
        return out

    def _pair(self, a, b):
        """Rank of the merge of two pieces, or a number above all."""
        key = a * (self.n + 1) + b
        out = np.full(len(key), np.int64(_NEVER))
        maybe = np.flatnonzero(self.pair_maybe[_pair_slot(key)])
        some = key[maybe]
        at = np.minimum(np.searchsorted(self.pair_keys, some), len(self.pair_keys) - 1)
        out[maybe] = np.where(self.pair_keys[at] == some, self.pair_rank[at], np.int64(_NEVER))
        return out

    def fits(self, a, b):
        """As ``apart``, from a table of the pairs judged last."""
        key = a * (self.n + 1) + b
        slot = _pair_slot(key)
        out = self.judged[slot]
        new = np.flatnonzero(self.judged_keys[slot] != key)
        out[new] = self.apart(a[new], b[new])
        self.judged_keys[slot[new]], self.judged[slot[new]] = key[new], out[new]
        return out

    def apart(self, a, b):
        """Whether merges leave pieces ``a, b`` side by side: at no stage of making them would their ends merge first."""
        a, b = a.copy(), b.copy()
        out = np.ones(len(a), bool)
        # The merge across the edge must come later than the next merge that hides one of the two ends.
        limit = np.full(len(a), np.int64(_NEVER))
        open_ = np.arange(len(a))
        while len(open_):
            x, y, lim = a[open_], b[open_], limit[open_]
            across = self._pair(x, y)
            # Later of the two makings is undone first.
            rx, ry = self.rank[x], self.rank[y]
            bad = across < lim
            out[open_[bad]] = False
            take_x = rx > ry
            made = np.maximum(rx, ry)
            go = ~bad & (made >= 0)
            # A merge at the left of the edge's pair wins a tie; at the right it does not.
            limit[open_] = np.where(take_x, made, made + 1)
            a[open_] = np.where(go & take_x, self.right[x], x)
            b[open_] = np.where(go & ~take_x, self.left[y], y)
            open_ = open_[go]
        return out

    def units(self, codes):
        """Encode units of equal length, given as a matrix of code points: a list of piece ids for each."""
        n, length = codes.shape
        plus = codes.astype(np.uint64) + np.uint64(1)
        longest = min(self.longest, length)
        up, _ = powers(_R, longest)
        # All substrings that are pieces, by unit, end, width and piece.
        units, ends, widths, found = [], [], [], []
        sums = np.zeros((n, length), np.uint64)
        for width in range(1, longest + 1):
            sums = sums[:, : length - width + 1] + plus[:, width - 1 :] * up[width - 1]
            piece = self.find(mix(sums))
            # Without a piece a character stands for itself; pieces that no merges make stay out.
            piece = np.where(piece < 0, self.n, piece) if width == 1 else np.where(self.rank[piece] >= 0, piece, _NONE)
            unit, start = np.nonzero(piece >= 0)
            units.append(unit)
            ends.append(start + width)
            widths.append(np.full(len(unit), width))
            found.append(piece[unit, start])
        unit, end, width, piece = (np.concatenate(x) for x in (units, ends, widths, found))
        order = np.argsort(end, kind="stable")
        unit, width, piece = unit[order], width[order], piece[order]
        cuts = np.searchsorted(end[order], np.arange(1, length + 2))
        # Backpointers: width and piece of the path's last step to each end, in one number.
        last = np.full((n, length + 1), _NONE)
        last[:, 0] = self.n
        for at in range(1, length + 1):
            here = slice(cuts[at - 1], cuts[at])
            u, w, p = unit[here], width[here], piece[here]
            before = last[u, at - w]
            open_ = before >= 0
            before &= _LOW
            check = np.flatnonzero(open_ & (before != self.n) & (p != self.n))
            open_[check] = self.fits(before[check], p[check])
            np.maximum.at(last, (u[open_], at), w[open_] << 32 | p[open_])
        reached, size, best = last >= 0, last >> 32, last & _LOW
        # All units walk their backpointers together.
        at, steps = np.where(reached[:, length], length, 0), []
        rows = np.arange(n)
        while at.any():
            steps.append(np.where(at > 0, best[rows, at], _NONE))
            at = at - np.where(at > 0, size[rows, at], 0)
        ids = np.stack(steps[::-1], axis=1) if steps else np.zeros((n, 0), np.int64)
        counts = (ids >= 0).sum(axis=1).tolist()
        odd = (ids == self.n).any(axis=1) | ~reached[:, length]
        # Shorter paths have their steps at the end.
        out = [row[len(row) - k :] for row, k in zip(ids.tolist(), counts)]
        for i in np.flatnonzero(odd).tolist():
            if not reached[i, length]:
                out[i] = self._plain(codes[i])
                continue
            place, said = 0, []
            for piece in out[i]:
                if piece == self.n:
                    said += [self.byte[b] for b in chr(int(codes[i, place])).encode("utf-8", "surrogatepass")]
                    place += 1
                else:
                    said.append(piece)
                    place += len(self.text[piece])
            out[i] = said
        return out

    def _plain(self, codes):
        """One unit by its merges, for a path that ties between equal merges have cut off."""
        parts: list[str] = [chr(int(c)) for c in codes]
        while True:
            ranks = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
            best = min(ranks, default=_NEVER)
            if best == _NEVER:
                break
            k = ranks.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [i for p in parts for i in ([self.known[p]] if p in self.known else [self.byte[b] for b in p.encode("utf-8", "surrogatepass")])]

    def encode(self, texts):
        """Piece ids of every text."""
        return [np.frombuffer(blob, np.int32).tolist() for blob in self.blobs(texts)]

    def blobs(self, texts):
        """Piece ids of every text as the bytes of 32-bit numbers; a space is set before a text that is not empty."""
        cut = [_UNITS.findall(SPACE + said.replace(" ", SPACE)) if said else [] for said in texts]
        if len(self.seen) > CACHE:
            self.seen.clear()
        seen = self.seen
        new = {p for parts in cut for p in parts if p not in seen}
        by: dict[int, list] = {}
        for p in new:
            by.setdefault(len(p), []).append(p)
        for length, parts in by.items():
            step = max(1, (1 << 16) // length)
            for k in range(0, len(parts), step):
                some = parts[k : k + step]
                matrix = _codes("".join(some)).reshape(len(some), length)
                for p, ids in zip(some, self.units(matrix)):
                    seen[p] = np.array(ids, np.int32).tobytes()
        return [b"".join(map(seen.__getitem__, parts)) for parts in cut]

    def decode(self, rows):
        """Text of every list of piece ids; the space set before it is taken away."""
        out = []
        for ids in rows:
            said = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
            out.append(said[1:] if said.startswith(" ") else said)
        return out

    def texts(self, flat, offsets):
        """Texts of all rows of ids at once: their pieces' bytes laid end to end, cut at the rows."""
        size = self.sizes[flat]
        total = np.concatenate([[0], np.cumsum(size)])
        data = self.bytes[np.repeat(self.starts[flat] - total[:-1], size) + np.arange(total[-1])].tobytes()
        out = []
        for a, b in zip(total[offsets[:-1]].tolist(), total[offsets[1:]].tolist()):
            said = data[a:b].decode("utf-8", "replace")
            out.append(said[1:] if said.startswith(" ") else said)
        return out


def encode(docs, id="doc_id", text="text", path=MODEL, keep=False):
    """``doc_id, ids, decoded`` for each row: piece ids of the text and the text made of them again.

    A null text has null ids, an empty one none. Decoding gives the text back,
    but for the letter U+2581, which stands for a space. Rows are encoded one by
    one, so repeats and null ids are kept; other columns are not read. ``keep``
    returns the text too.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(Pieces(path))

    def run(batches):
        pieces = shipped.value
        for batch in batches:
            for part in parts_of(batch):
                texts = part.column("text").to_pylist()
                blobs = pieces.blobs([t or "" for t in texts])
                flat = np.frombuffer(b"".join(blobs), np.int32)
                offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])])
                back = pieces.texts(flat, offsets)
                gone = np.array([t is None for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=np.append(gone, False)), pa.array(flat)),
                        pa.array([None if g else x for g, x in zip(gone, back)], pa.string()),
                        *([part.column("text")] if keep else []),
                    ],
                    names=schema.names,
                )

    schema = T.StructType().add("doc_id", docs.schema[id].dataType).add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())
    if keep:
        schema = schema.add("text", T.StringType())
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)

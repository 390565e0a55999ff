"""Toxicity of deobfuscated texts, by a noisy channel.

Tokens with a look-alike sign beside a letter or a letter twice in a row, and
runs of single characters, are decoded: every sign may stand for letters, for a
word's end or for nothing, every repeated letter for one less, and Viterbi's
algorithm takes the likeliest reading of this lattice under a language model of
four characters, counted over all texts. Neighbouring words that together are a
telling one are decoded as well, so a word may be cut anywhere. The words of a
text and of its readings are then scored. What a word tells is learned from labelled texts: the share of toxic
ones among the texts with it, at the lower end of its confidence interval, for
words (and word beginnings) whose excess could not be chance.
"""

from __future__ import annotations

import math
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import _P, KINDS, Words, mix, powers, slices
from .shared import stored

#: Labelled texts to learn from, at most; those with the least hash of their id.
LEARN_ROWS = 50_000
THRESHOLD = 0.7
#: Least lower share of toxic texts for a word to tell anything.
SURE = 0.5
#: Bytes of a word's beginning that count as features of their own.
BEGINNINGS = (4, 5, 6)

# What a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "2": "z",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou", "€": "e", "£": "l", "(": "c",
}
_SEPARATORS = " \t.-_,*/"
_EDGE, _OTHER, _SIZE = 26, 27, 28
_LETTER = r"[^\W\d_]"
_SIGN_CLASS = "@$!|+*€£("
#: What makes a token suspicious; :func:`_suspicious` looks for it in all texts at once.
_MIXED = re.compile(rf"{_LETTER}(?=[0-9{_SIGN_CLASS}])|[0-9{_SIGN_CLASS}](?={_LETTER})|({_LETTER})\1")
_UNIT, _BETWEEN = rf"(?:[^\W_]|[{_SIGN_CLASS}])", rf"(?:[^\w{_SIGN_CLASS}]|_)+"
_SPACED = re.compile(rf"(?<!{_UNIT})(?:{_UNIT}{_BETWEEN}){{2,}}{_UNIT}(?!{_UNIT})")
_BLANKS = re.compile(_BETWEEN)
#: Signs beyond ASCII, which bytes alone do not tell from letters.
_FAR = re.compile(r"[^\w\x00-\x7f]")
#: Logarithms of the channel: kept letter, stretched letter left out, sign for a letter, for an end, for nothing, separator for nothing.
_KEPT, _STRETCH, _SIGN, _END, _NOTHING, _JOIN = (math.log(p) for p in (0.95, 0.3, 0.3, 0.2, 0.02, 0.5))
_classes: list[np.ndarray] = []
_kinds: list[np.ndarray] = []
_CACHE = 100_000
_START = (_EDGE * _SIZE + _EDGE) * _SIZE + _EDGE
#: Characters decoded together.
_TOGETHER = 1 << 16
#: A longer span is decoded alone.
_ALONE = 4096
#: Steps of such a span after which what all its ways share is written down.
_SETTLE = 4096


def classes():
    """Model symbol of every code point: a to z, 26 for a word's end, 27 for another letter."""
    if not _classes:
        table = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
        table = np.where(table, _OTHER, _EDGE).astype(np.int64)
        table[97:123] = np.arange(26)
        _classes.append(table)
    return _classes[0]


def symbols(text):
    """A text as model symbols, one end between words, three before and one after."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.concatenate([[_EDGE], classes()[codes], [_EDGE]])
    x = x[np.append(True, (x[1:] != _EDGE) | (x[:-1] != _EDGE))]
    return np.concatenate([[_EDGE, _EDGE], x])


def count_characters(docs, text="text"):
    """Occurrences of all runs of four symbols over all texts: an array of ``28 ** 4`` sums, whatever the corpus."""

    def count(batches):
        total = np.zeros(_SIZE**4, np.int64)
        for batch in batches:
            for part in slices(batch):
                x = symbols("\n".join(t or "" for t in part.column("text").to_pylist()))
                if len(x) > 3:
                    total += np.bincount(((x[:-3] * _SIZE + x[1:-2]) * _SIZE + x[2:-1]) * _SIZE + x[3:], minlength=_SIZE**4)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["run", "n"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(count, "run int, n long").groupBy("run").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(_SIZE**4)
    for run, n in sums:
        out[run] = n
    return out


class Model:
    """Log-probability of a symbol after three others, smoothed by shorter contexts."""

    def __init__(self, counts, strength=2.0):
        counts = counts.reshape((_SIZE,) * 4)
        level = np.full(_SIZE, 1 / _SIZE)
        for k in (3, 2, 1, 0):
            n = counts.sum(axis=tuple(range(k))) if k else counts
            level = (n + strength * level) / (n.sum(axis=-1, keepdims=True) + strength)
        self.log = np.log(level)

    def decode(self, span, whole=False):
        """The likeliest reading of one span, as in :meth:`readings`."""
        return self.readings([span], whole)[0]

    def readings(self, spans, whole=False):
        """The likeliest reading of each span: words of letters, lower case; of ``whole`` words blanks rarely join.

        Spans advance together, about ``_TOGETHER`` characters at a time; one beyond ``_ALONE`` goes alone.
        """
        low = [s.lower() for s in spans]
        order = sorted(range(len(low)), key=lambda i: -len(low[i]))
        out = [""] * len(low)
        at = 0
        while at < len(order) and low[order[at]]:
            end = min(at + max(_TOGETHER // len(low[order[at]]), 1), len(order))
            while not low[order[end - 1]]:
                end -= 1
            if len(low[order[at]]) > _ALONE:
                out[order[at]] = self._alone(low[order[at]], whole)
                at += 1
                continue
            for i, said in zip(order[at:end], self._together([low[i] for i in order[at:end]], whole)):
                out[i] = said
            at = end
        return out

    def _together(self, spans, whole):
        """Viterbi over spans of falling length: per position the best way into each state, and where it came from."""
        sizes = np.array([len(s) for s in spans])
        offsets = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        codes = np.frombuffer("".join(spans).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        again = np.zeros(len(codes), bool)
        again[1:] = codes[1:] == codes[:-1]
        again[offsets] = False
        kinds, kind = np.unique(codes * 2 + again, return_inverse=True)
        many, said, cost = _options(kinds.tolist(), whole)
        symbol = np.where(said > 0, classes()[said], -1)
        log = self.log.reshape(-1)
        span, state, score = np.arange(len(spans)), np.full(len(spans), _START), np.zeros(len(spans))
        last = np.zeros(len(spans), np.int64)
        back: list[tuple[np.ndarray, np.ndarray]] = []
        for t in range(int(sizes[0])):
            live = int(np.searchsorted(-sizes, -t, "left"))
            if live < len(spans):
                end = int(np.searchsorted(span, live))
                span, state, score = span[:end], state[:end], score[:end]
            k = kind[offsets[span] + t]
            n = many[k]
            origin = np.repeat(np.arange(len(k)), n)
            option = np.arange(len(origin)) - np.repeat(np.cumsum(n) - n, n)
            k, old = k[origin], state[origin]
            new = symbol[k, option]
            # Nothing said, or an end after an end, leaves the state.
            stays = (new < 0) | ((new == _EDGE) & (old % _SIZE == _EDGE))
            new = np.where(stays, 0, new)
            total = score[origin] + cost[k, option] + np.where(stays, 0.0, log[old * _SIZE + new])
            to = np.where(stays, old, old % _SIZE**2 * _SIZE + new)
            key = span[origin] * _SIZE**3 + to
            best = np.lexsort((-total, key))
            first = np.ones(len(best), bool)
            first[1:] = key[best[1:]] != key[best[:-1]]
            best = best[first]
            span, state, score = span[origin[best]], to[best], total[best]
            back.append((origin[best].astype(np.int32), said[k[best], option[best]].astype(np.uint32)))
            done = int(np.searchsorted(-sizes, -(t + 1), "left"))
            if done < live:
                low = int(np.searchsorted(span, done))
                ended = score[low:] + np.where(state[low:] % _SIZE == _EDGE, 0.0, log[state[low:] * _SIZE + _EDGE])
                rank = np.lexsort((state[low:], ended, span[low:]))
                top = np.append(span[low:][rank][1:] != span[low:][rank][:-1], True)
                last[done:live] = low + rank[top]
        out = np.zeros((len(spans), len(back)), np.uint32)
        for t in range(len(back) - 1, -1, -1):
            live = int(np.searchsorted(-sizes, -t, "left"))
            out[:live, t] = back[t][1][last[:live]]
            last[:live] = back[t][0][last[:live]]
        return [row[row > 0].tobytes().decode("utf-32-le", "surrogatepass") for row in out]

    def _alone(self, span, whole):
        """The same for one long span, most of which has few states: what all ways share is written down on the way."""
        log, table, chosen = self.log.reshape(-1), classes(), {}
        rows: dict[int, list[float]] = {}
        paths, back, read, before = {_START: 0.0}, [], [], ""
        for t, c in enumerate(span):
            kind = ord(c) * 2 + (c == before)
            options = chosen.get(kind)
            if options is None:
                many, said, cost = _options([kind], whole)
                options = chosen[kind] = [(x, int(table[x]) if x else -1, y) for x, y in zip(said[0].tolist(), cost[0].tolist())]
            new: dict[int, float] = {}
            steps: dict[int, tuple[int, int]] = {}
            for state, score in paths.items():
                row = rows.get(state)
                if row is None:
                    row = rows[state] = log[state * _SIZE : (state + 1) * _SIZE].tolist()
                for x, symbol, cost in options:
                    if symbol < 0 or symbol == _EDGE == state % _SIZE:
                        to, total = state, score + cost
                    else:
                        to, total = state % _SIZE**2 * _SIZE + symbol, score + cost + row[symbol]
                    if total > new.get(to, -math.inf):
                        new[to] = total
                        steps[to] = (state, x)
            back.append(steps)
            paths, before = new, c
            if t % _SETTLE == _SETTLE - 1:
                read.append(_settle(back, paths))
        best = max(paths, key=lambda s: (paths[s] + (0.0 if s % _SIZE == _EDGE else log[s * _SIZE + _EDGE]), s))
        return "".join(read) + _trace(back, best)


def _trace(back, state):
    """What the way into ``state`` says."""
    out = []
    for steps in reversed(back):
        state, said = steps[state]
        if said:
            out.append(chr(said))
    return "".join(reversed(out))


def _settle(back, states):
    """Take the steps off ``back`` that the ways into all ``states`` share; what they say."""
    at, t = set(states), len(back)
    while t and len(at) > 1:
        t -= 1
        at = {back[t][s][0] for s in at}
    read = _trace(back[:t], at.pop()) if t else ""
    del back[:t]
    return read


def _options(kinds, whole):
    """What a character may stand for: number of options, and per option the letter said (32: a word's end, 0: nothing) and its cost.

    ``kinds`` are code points times two, plus one after the same character.
    """
    blank, joined = (_KEPT, _NOTHING) if whole else (_END, _JOIN)
    rows = []
    for kind in kinds:
        c, again = chr(kind >> 1), kind & 1
        if c.isalpha():
            options = [(ord(c), _KEPT)]
        else:
            options = [(ord(x), _SIGN - math.log(len(SIGNS[c]))) for x in SIGNS.get(c, "")]
            sign = c in SIGNS and c not in _SEPARATORS
            options += [(32, _END if sign else blank), (0, _NOTHING if sign else joined)]
        if again and (c.isalpha() or c in SIGNS):
            options.append((0, _STRETCH))
        rows.append(options)
    many = np.array([len(r) for r in rows])
    said, cost = np.zeros((len(rows), many.max()), np.int64), np.zeros((len(rows), many.max()))
    for i, options in enumerate(rows):
        said[i, : len(options)], cost[i, : len(options)] = zip(*options)
    return many, said, cost


class Restorer:
    """Readings of texts; those of short spans are kept for the next texts."""

    def __init__(self, model):
        self.model, self.kept = model, ({}, {})

    def read(self, spans, whole=False):
        """The reading of each span."""
        kept = self.kept[whole]
        if len(kept) > _CACHE:
            kept.clear()
        new = [s for s in dict.fromkeys(spans) if s not in kept]
        kept.update(zip(new, self.model.readings(new, whole)))
        out = [kept[s] for s in spans]
        for s in new:
            if len(s) > 64:
                del kept[s]
        return out

    def __call__(self, texts):
        """For each text the readings of all suspicious tokens and spaced words, by spaces, and the text with the tokens' readings in place."""
        low = [t.lower() for t in texts]
        joined = "\n".join(low)
        edges = np.cumsum([0, *[len(t) + 1 for t in low]])
        row, start, end, spaced = _suspicious(joined, edges)
        spans = [_BLANKS.sub(" ", m[0]) for i in spaced for m in _SPACED.finditer(low[i])]
        runs = iter(self.read(spans))
        found: list[list[str]] = [[] for _ in low]
        for i in spaced:
            found[i] = [next(runs) for _ in _SPACED.finditer(low[i])]
        tokens = [joined[a:b] for a, b in zip(start, end)]
        said = self.read(tokens)
        first = np.searchsorted(row, np.arange(len(low) + 1)).tolist()
        read, placed = [], []
        for i in range(len(low)):
            told, pieces, at = {}, [], int(edges[i])
            for k in range(first[i], first[i + 1]):
                if said[k]:
                    told[tokens[k]] = said[k]
                    pieces += [joined[at : start[k]], said[k]]
                    at = end[k]
            read.append(" ".join([*found[i], *told.values()]))
            placed.append("".join([*pieces, joined[at : int(edges[i + 1]) - 1]]) if told else "")
        return read, placed

    def cut(self, texts, hashes, longest):
        """For each text the readings of runs of words that together are a known word, or begin as one."""
        words = Words(pa.array([_FAR.sub(" ", t) if not t.isascii() else t for t in texts], pa.large_string()), "plain")
        out = [""] * len(texts)
        ends, row = words.end(), words.row()
        rows, spans = [], []
        for i, j in sorted(set(_joined(words, ends, row, hashes, longest))):
            a, b = max(i - 1, words.first[row[i]]), min(j + 2, words.first[row[i] + 1])
            rows.append(row[i])
            spans.append(b" ".join(words.data[s:e].tobytes() for s, e in zip(words.start[a:b], ends[a:b])).decode("utf-8", "replace"))
        for i, said in zip(rows, self.read(spans, True)):
            out[i] += " " + said
        return out


def kinds():
    """What every code point is: 1 for a letter, 2 for a digit or sign of the channel, 4 for white space, 8 for part of a unit."""
    if not _kinds:
        table = np.zeros(sys.maxunicode + 1, np.uint8)
        for c in map(chr, range(sys.maxunicode + 1)):
            if c.isalnum():
                table[ord(c)] = 8 if c.isdecimal() else 9
            elif c.isspace():
                table[ord(c)] = 4
        table[[ord(c) for c in _SIGN_CLASS]] |= 8
        table[[ord(c) for c in "0123456789" + _SIGN_CLASS]] |= 2
        _kinds.append(table)
    return _kinds[0]


def _suspicious(joined, edges):
    """Where ``_MIXED`` is found, over texts at once: row, start and end of each such token; and the rows that ``_SPACED`` fits."""
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds()[codes]
    letter, sign = (kind & 1).astype(bool), (kind & 2).astype(bool)
    same = codes[1:] == codes[:-1]
    at = np.flatnonzero((letter[:-1] & (sign[1:] | same)) | (sign[:-1] & letter[1:]))
    inside = np.concatenate([[False], (kind & 4) == 0, [False]])
    start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    odd = np.unique(np.searchsorted(start, at, "right") - 1)
    start, end = start[odd], end[odd]
    unit = np.concatenate([[False], (kind & 8) > 0, [False]])
    begin, size = np.flatnonzero(unit[1:] & ~unit[:-1]), np.flatnonzero(unit[:-1] & ~unit[1:]) - np.flatnonzero(unit[1:] & ~unit[:-1])
    text = np.searchsorted(edges, begin, "right") - 1
    one = size == 1
    three = one[:-2] & one[1:-1] & one[2:] & (text[:-2] == text[2:])
    return np.searchsorted(edges, start, "right") - 1, start.tolist(), end.tolist(), np.unique(text[:-2][three]).tolist()


def _joined(words, ends, row, hashes, longest):
    """``(first, last)`` of runs of at least two words of one row whose letters put together are a known feature."""
    n = len(words.start)
    if n < 2 or not len(hashes):
        return
    sieve = np.zeros(1 << 16, bool)
    sieve[(hashes >> np.uint64(48)).astype(np.int64)] = True

    def known(h):
        at = np.flatnonzero(sieve[(h >> np.uint64(48)).astype(np.int64)])
        return at[hashes[np.minimum(np.searchsorted(hashes, h[at]), len(hashes) - 1)] == h[at]]

    at = np.zeros(n + 1, np.int64)
    np.cumsum(ends - words.start, out=at[1:])
    packed = words.data[words.inside]
    up, down = powers(_P, len(packed))
    sums = np.zeros(len(packed) + 1, np.uint64)
    np.cumsum(KINDS["plain"][2][packed] * up, out=sums[1:])
    edge = words.first[row + 1]
    for k in BEGINNINGS:
        i = np.flatnonzero((at[1:] - at[:-1] <= k) & (at[:-1] + k < at[edge]))
        i = i[known(mix((sums[at[i] + k] - sums[at[i]]) * down[at[i]] + np.uint64(k)))]
        yield from zip(i.tolist(), (np.searchsorted(at, at[i] + k, "right") - 1).tolist())
    i, step = np.arange(n - 1), 1
    while len(i):
        i = i[i + step < edge[i]]
        i = i[at[i + step + 1] - at[i] <= longest]
        found = i[known(mix((sums[at[i + step + 1]] - sums[at[i]]) * down[at[i]]))]
        yield from zip(found.tolist(), (found + step).tolist())
        step += 1


def _features(column):
    """Words of a string column with their rows and the hashes of word and beginnings, one array each (0: too short), and the bytes of each word."""
    words = Words(column, "plain")
    whole = words.hash
    out = [whole]
    if len(whole):
        up, down = powers(_P, len(words.data))
        sums = np.zeros(len(words.data) + 1, np.uint64)
        np.cumsum(KINDS["plain"][2][words.data] * up, out=sums[1:])
        ends = words.end()
        for k in BEGINNINGS:
            far = words.start + k < ends
            to = np.where(far, words.start + k, words.start)
            h = mix((sums[to] - sums[words.start]) * down[words.start] + np.uint64(k))
            out.append(np.where(far, h, np.uint64(0)))
    return words.row(), out, words.end() - words.start


def _both(part, restorer, hashes=None, longest=0):
    """Features of the texts and of their readings; words cut apart are looked for where ``hashes`` are known."""
    texts = [t or "" for t in part.column("text").to_pylist()]
    plain = _features(pa.array(texts, pa.large_string()))
    read, placed = restorer(texts)
    if hashes is not None:
        cut = restorer.cut([t.lower() for t in texts], hashes, longest), restorer.cut(placed, hashes, longest)
        read = [" ".join(x) for x in zip(read, *cut)]
    restored = _features(pa.array(read, pa.large_string()))
    return np.concatenate([plain[0], restored[0]]), [np.concatenate(pair) for pair in zip(plain[1], restored[1])], np.concatenate([plain[2], restored[2]])


def learn(rows, model):
    """Evidence of words: ``(sorted hashes, lower share of toxic texts, share without any, bytes of the longest)`` from ``text, toxic`` rows.

    ``rows`` are bounded; equal texts count once. A word counts if at least
    three toxic texts have it, its excess is beyond what the best of all the
    words tested would show by chance, and its lower share is at least ``SURE``.
    """
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def add(batches):
        restorer = Restorer(shipped.value)
        for batch in batches:
            for part in slices(batch):
                row, hashes, size = _both(part, restorer)
                toxic = np.asarray(part.column("toxic").to_numpy(zero_copy_only=False), np.int64)
                row, values, size = np.tile(row, len(hashes)), np.concatenate(hashes), np.tile(size, len(hashes))
                row, values, size = row[values != 0], values[values != 0], size[values != 0]
                order = np.lexsort((values, row))
                row, values, size = row[order], values[order], size[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (values[1:] != values[:-1])
                keys, at = np.unique(values[new], return_inverse=True)
                n = np.bincount(at, minlength=len(keys))
                t = np.bincount(at, weights=toxic[row[new]], minlength=len(keys)).astype(np.int64)
                most = np.zeros(len(keys), np.int64)
                np.maximum.at(most, at, size[new])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64()), pa.array(t), pa.array(most)], names=["h", "n", "t", "size"])

    rows = rows.dropDuplicates(["text", "toxic"])
    size, toxic = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic or toxic == size:
        return np.zeros(0, np.uint64), np.zeros(0), (toxic or 0) / max(size, 1), 0
    rate = toxic / size
    found = rows.select("text", "toxic").mapInArrow(add, "h long, n long, t long, size long").groupBy("h")
    found = found.agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.max("size").alias("size"))
    n, t = F.col("n").cast("double"), F.col("t").cast("double")
    side = F.when(n > t, (n - t) * F.log((n - t) / n / (1 - rate))).otherwise(0.0)
    found = found.filter(F.col("t") >= 3).withColumn("excess", F.when(t / n > rate, t * F.log(t / n / rate) + side).otherwise(0.0))
    found = stored(found, "toxic-words")
    z = 1.64
    p = t / n
    lower = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    least = math.log(max(found.count(), 1))
    found = found.select("h", "size", "excess", lower.alias("lower")).filter((F.col("excess") >= least) & (F.col("lower") >= SURE))
    kept = sorted((h & (1 << 64) - 1, share, size) for h, size, _, share in found.collect())
    return np.array([h for h, _, _ in kept], np.uint64), np.array([share for _, share, _ in kept]), 0.0, max((size for _, _, size in kept), default=0)


def score(docs, model, evidence, id="doc_id", text="text", keep=()):
    """``doc_id``, kept columns and ``score`` for each row; an empty or null text has the least score."""
    shipped = docs.sparkSession.sparkContext.broadcast((model, evidence))

    def run(batches):
        model, (hashes, shares, base, longest) = shipped.value
        restorer = Restorer(model)
        for batch in batches:
            for part in slices(batch):
                clean = np.full(part.num_rows, 1.0 - base)
                if len(hashes):
                    row, values, _ = _both(part, restorer, hashes, longest)
                    share = np.zeros(len(row))
                    for v in values:
                        at = np.minimum(np.searchsorted(hashes, v), len(hashes) - 1)
                        share = np.maximum(share, np.where(hashes[at] == v, shares[at], 0.0))
                    told = np.flatnonzero(share > 0)
                    # Each word of a text tells once.
                    _, first = np.unique(np.stack([row[told].astype(np.uint64), values[0][told]]), axis=1, return_index=True)
                    told = told[first]
                    np.multiply.at(clean, row[told], 1 - share[told])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[part.column(c) for c in keep], pa.array(1.0 - clean)], names=schema.names)

    schema = T.StructType().add("doc_id", docs.schema[id].dataType)
    for c in keep:
        schema = schema.add(c, docs.schema[c].dataType)
    schema = schema.add("score", T.DoubleType())
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), *[c for c in keep if c != "text"]).mapInArrow(run, schema)


def fold(id, folds=3):
    """crc32 of an id's text modulo ``folds``; null without an id."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % folds


def fit(docs, labels, id="doc_id", text="text", label="toxic", out=1, learn_rows=LEARN_ROWS):
    """Character model over all texts, and the evidence of labelled texts outside fold ``out``.

    At most ``learn_rows`` labels are used, those with the least hash of their
    id, so what is shipped to the texts is bounded. Null ids, null labels and
    labels without a text teach nothing.
    """
    model = Model(count_characters(docs, text))
    chosen = labels.select(F.col(id).alias("doc_id"), F.col(label).cast("long").alias("toxic")).dropna().filter(fold("doc_id") != out)
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(learn_rows)
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).dropna().join(F.broadcast(chosen), "doc_id")
    return model, learn(rows.select("text", "toxic"), model)


def predictions(docs, labels, id="doc_id", text="text", label="toxic", threshold=THRESHOLD):
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    ``score`` is the chance that at least one word of the text makes it toxic,
    0 to 1; ``predicted`` is 1 from ``threshold`` on. A null or empty text has
    the least score. Without labels of both kinds all scores are the share of
    toxic labels. A null id is not held out and teaches nothing. Rows are judged
    one by one, so repeats are kept; other columns are not read.
    """
    found = score(docs, *fit(docs, labels, id, text, label), id, text)
    return found.select(
        "doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def clean(docs, labels, text="text", id="doc_id", label="toxic", threshold=THRESHOLD):
    """The rows of ``docs`` under ``threshold``, with all their columns."""
    model, evidence = fit(docs, labels, id, text, label)
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text).alias("text"))
    return score(packed, model, evidence, "row", "text").filter(F.col("score") < threshold).select("doc_id.*")

"""Secret scans: three patterns, and a battery of randomness tests for what no pattern names.

A candidate is a run of key characters with a letter, or a part of one between
the signs / - _ and +. Its encoding is the smallest alphabet that holds it.
Against "drawn uniformly from that alphabet" stand three tests: chi-squared of
the symbol counts, runs above and below the alphabet's middle, and correlation
of neighbours; their p-values are combined by Fisher's method, and a candidate
that fails them is structured text. Against "ordinary text" stands the
likelihood ratio of uniform draws to the corpus's own pairs of neighbours, half
with their case and half without; under such text a ratio of r has a chance of
1 / r at most. Benjamini-Hochberg over the candidates of a text bounds the
share of false discoveries.

The pairs are counted over all texts; only 128 * 128 sums reach the driver.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import bytes_of, slices

# The three patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}")
PART = re.compile(r"[A-Za-z0-9]{16,}")
#: Least combined p-value of the battery, and the share of false discoveries in a text.
BATTERY_LEAST, FALSE_SHARE = 0.001, 0.01

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings from the smallest alphabet to the largest.
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "hex-upper": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "base36-upper": _DIGITS + _UPPER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64-url": _UPPER + _LOWER + _DIGITS + "-_",
}


def encoding(token):
    """Name of the smallest alphabet that holds ``token``; None for digits alone, or for no alphabet."""
    used = set(token)
    if not used & set(_UPPER + _LOWER):
        return None
    return next((name for name, alphabet in ENCODINGS.items() if used <= set(alphabet)), None)


def _two_sided(z):
    return math.erfc(abs(z) / math.sqrt(2))


def _pairs(n, q):
    """Mean and deviation of the number of ordered equal pairs among ``n`` draws from ``q``."""
    s2, s3 = float((q**2).sum()), float((q**3).sum())
    spread = 2 * n * (n - 1) * (s2 - s2 * s2) + 4 * n * (n - 1) * (n - 2) * (s3 - s2 * s2)
    return n * (n - 1) * s2, math.sqrt(max(spread, 1e-12))


def battery(token, alphabet):
    """p-values of chi-squared uniformity, runs and serial correlation under uniform draws."""
    x = np.array([alphabet.index(c) for c in token])
    n, a = len(x), len(alphabet)
    counts = np.bincount(x, minlength=a)
    # Chi-squared of the counts in its exact mean and spread: a shift of the number of equal pairs.
    mean, deviation = _pairs(n, np.full(a, 1 / a))
    uniform = _two_sided((float((counts * (counts - 1)).sum()) - mean) / deviation)
    side = x >= a / 2
    n1, n0 = int(side.sum()), int((~side).sum())
    if n1 and n0 and n > 2:
        runs = 1 + int((side[1:] != side[:-1]).sum())
        mean = 2 * n1 * n0 / n + 1
        deviation = math.sqrt(max(2 * n1 * n0 * (2 * n1 * n0 - n) / (n * n * (n - 1)), 1e-12))
        alternation = _two_sided((runs - mean) / deviation)
    else:
        alternation = 2.0 ** (1 - n)
    centred = x - x.mean()
    power = float((centred**2).sum())
    serial = _two_sided(float((centred[1:] * centred[:-1]).sum()) / power * math.sqrt(n)) if power else 0.0
    return uniform, alternation, serial


def combined(values):
    """Fisher's combination of independent p-values."""
    half = -sum(math.log(max(v, 1e-300)) for v in values)
    term, total = 1.0, 1.0
    for k in range(1, len(values)):
        term *= half / k
        total += term
    return min(1.0, math.exp(-half) * total)


class Ordinary:
    """Ordinary text: pairs of neighbours as in the rest of the corpus, within an alphabet."""

    def __init__(self, counts, strength=2.0):
        plain, fold = np.arange(128), np.arange(128)
        fold[65:91] += 32
        folded = np.zeros_like(counts)
        np.add.at(folded, (fold[:, None], fold[None, :]), counts)
        self.strength, self.tables = strength, {}
        for name, alphabet in ENCODINGS.items():
            codes = np.array([ord(c) for c in alphabet])
            both = self.tables[name] = []
            for n, to in ((counts, plain), (folded, fold)):
                inside = np.unique(to[codes])
                pairs = np.zeros((128, 128))
                pairs[np.ix_(inside, inside)] = n[np.ix_(inside, inside)]
                first = (pairs.sum(axis=0) + 1) / (pairs.sum() + len(inside))
                # A folded letter stands for as many symbols of the alphabet.
                both.append((to, pairs, pairs.sum(axis=1), first, np.log(np.maximum(np.bincount(to[codes], minlength=128), 1))))

    def __call__(self, token, name):
        """p-value at most: ordinary text being as much likelier under uniform draws."""
        code = np.frombuffer(token.encode(), np.uint8)
        said = []
        for to, pairs, rows, first, symbols in self.tables[name]:
            x = to[code].astype(np.int64)
            a, b = x[:-1], x[1:]
            # The token's own pairs are no evidence of its being ordinary.
            _, at, own = np.unique(a * 128 + b, return_inverse=True, return_counts=True)
            n = np.maximum(pairs[a, b] - own[at], 0) + self.strength * first[b]
            then = np.log(n / (np.maximum(rows[a] - np.bincount(a, minlength=128)[a], 0) + self.strength))
            said.append(math.log(first[x[0]]) + float(then.sum()) - float(symbols[x].sum()))
        text = np.logaddexp(*said) - math.log(2)
        return math.exp(min(0.0, float(text) + len(code) * math.log(len(ENCODINGS[name]))))


def discoveries(values, share=FALSE_SHARE):
    """Benjamini-Hochberg: which p-values are discoveries."""
    order = sorted(range(len(values)), key=values.__getitem__)
    last = max((k for k, i in enumerate(order, 1) if values[i] <= share * k / len(values)), default=0)
    return {order[k] for k in range(last)}


def base_spans(text):
    """``(start, kind number, end)`` of the three patterns."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text):
    """``(start, end)`` of the runs of key characters, and of their parts between signs."""
    for m in CANDIDATE.finditer(text):
        yield m.span()
        yield from (p.span() for p in PART.finditer(text, *m.span()) if p.span() != m.span())


def random_spans(text, base, ordinary):
    """Spans of the battery that touch none of ``base``; of a run and its part, both found, the run."""
    found, values = [], []
    for start, end in candidates(text):
        token = text[start:end]
        kind = encoding(token)
        if kind and not any(s < end and start < e for s, _, e in base):
            value = ordinary(token, kind)
            # Beyond FALSE_SHARE nothing is a discovery.
            if value > FALSE_SHARE or combined(battery(token, ENCODINGS[kind])) >= BATTERY_LEAST:
                found.append((start, 3, end))
                values.append(value)
    out, until = [], -1
    for start, kind, end in sorted((found[i] for i in discoveries(values)), key=lambda x: (x[0], -x[2])):
        if end > until:
            out.append((start, kind, end))
            until = end
    return out


def printed(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def neighbours(docs, text="text"):
    """Occurrences of the pairs of ASCII characters beside each other in all texts."""

    def count(batches):
        total = np.zeros(128 * 128, np.int64)
        for batch in batches:
            for part in slices(batch):
                data, offsets = bytes_of(part.column("text"))
                pairs = data[:-1].astype(np.int64) * 128 + data[1:]
                inside = (data[:-1] < 128) & (data[1:] < 128)
                edges = offsets[1:-1] - 1
                inside[edges[(edges >= 0) & (edges < len(inside))]] = False
                total += np.bincount(pairs[inside], minlength=128 * 128)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["c", "n"])

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "c int, n long").groupBy("c").sum("n").collect()
    out = np.zeros(128 * 128)
    for c, n in counts:
        out[c] = n
    return out.reshape(128, 128)


def scan(docs, id="doc_id", text="text"):
    """Secrets of every text: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    Spans are ``kind:start:end`` in code points with the end exclusive, by start
    and kind, comma-joined; ``base_sha256`` digests those of the three patterns.
    The battery adds spans of kind ``random`` beside them. A null or empty text
    has none; rows are judged one by one, so repeats and null ids are kept;
    other columns are not read.
    """
    q = Ordinary(neighbours(docs, text))

    def run(batches):
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                said = value.as_py() or ""
                base = base_spans(said)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                digest = hashlib.sha256(printed(base).encode()).hexdigest()
                rows.append((*counts, digest, printed(base + random_spans(said, base, q))))
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    schema = T.StructType().add("doc_id", docs.schema[id].dataType)
    for name in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("base_sha256", T.StringType()).add("spans", T.StringType())
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def masked(docs, text="text", mark="[secret]"):
    """``docs`` with every secret in the text replaced by ``mark``; other columns and null texts stay."""
    q = Ordinary(neighbours(docs, text))

    def hide(said):
        base = base_spans(said)
        out, at = [], 0
        for start, _, end in sorted(base + random_spans(said, base, q)):
            if start >= at:
                out += [said[at:start], mark]
            at = max(at, end)
        return "".join([*out, said[at:]])

    def run(batches):
        for batch in batches:
            new = [None if v is None else hide(v) for v in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string())], names=["row", "text"])

    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("row"), F.col(text).alias("text"))
    schema = T.StructType().add("row", packed.schema["row"].dataType).add("text", T.StringType())
    out = packed.mapInArrow(run, schema)
    return out.select(*[F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in names])

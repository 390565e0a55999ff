"""Language identification by rank-order profiles.

A profile is the list of the most frequent letter n-grams (one to three letters,
words padded by a space) in descending frequency. A document's own list is
compared with every language's by the out-of-place distance: the sum over its
n-grams of how far their ranks differ, a missing one costing the profile's length.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices

#: n-grams in a profile of a language or document.
LENGTH = 300
_BITS, _SPACE = 21, 32
_letters: list[np.ndarray] = []


def letters():
    """Which code points are letters, by number."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _letters[0]


def grams(text):
    """Numbers of all n-grams of a text, with repeats: 21 bits a letter, a space around words."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where(letters()[codes], codes, _SPACE)
    # One space between words.
    codes = codes[np.append(True, (codes[1:] != _SPACE) | (codes[:-1] != _SPACE))]
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    two = codes[:-1] << _BITS | codes[1:]
    # A space in the middle joins two words, and a space alone is no n-gram.
    three = (two[:-1] << _BITS | codes[2:])[codes[1:-1] != _SPACE]
    return np.concatenate([codes[codes != _SPACE], two, three])


def counts(values):
    """Distinct values and how often they occur."""
    values = np.sort(values)
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[at], np.diff(np.append(at, len(values)))


def ranked(values, length=LENGTH):
    """The ``length`` most frequent n-grams, ties by their number."""
    keys, n = counts(values)
    if len(keys) > length:
        least = np.partition(n, len(n) - length)[len(n) - length]
        more = np.flatnonzero(n > least)
        at = np.concatenate([more, np.flatnonzero(n == least)[: length - len(more)]])
        at.sort()
        keys, n = keys[at], n[at]
    return keys[np.argsort(-n, kind="stable")]


def fit(docs, text="text", lang="lang", length=LENGTH):
    """Profiles of all languages that occur in ``docs``: ``{language: n-grams by rank}``.

    Every text with a language counts in full. n-grams are added up inside a
    task before they are shuffled, and the most frequent ones leave by rank in
    each group. ``length`` numbers for each language reach the driver.
    """

    def add(batches):
        for batch in batches:
            by: dict = {}
            for part in slices(batch):
                own: dict = {}
                for said, name in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                    own.setdefault(name, []).append(grams(said))
                for name, found in own.items():
                    by.setdefault(name, []).append(counts(np.concatenate(found)))
            for name, found in by.items():
                keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([n for _, n in found]), minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(n)], names=["lang", "gram", "n"])

    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    total = rows.mapInArrow(add, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = total.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= length)
    out: dict = {}
    for name, gram, _ in sorted(top.select("lang", "gram", "rank").collect(), key=lambda r: (r[0], r[2])):
        out.setdefault(name, []).append(gram)
    return {name: np.array(g, np.int64) for name, g in out.items()}


class Judge:
    """All profiles as one sorted table of n-grams with a rank for each language."""

    def __init__(self, profiles, length=LENGTH):
        self.names, self.length = sorted(profiles), length
        self.grams = np.unique(np.concatenate([profiles[n] for n in self.names])) if self.names else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, profiles[name]), k] = np.arange(len(profiles[name]))

    def __call__(self, text):
        """``(language, score)``: how much nearer the best is than the next, as a share of the largest distance."""
        own = ranked(grams(text or ""), self.length)
        if not len(own) or not self.names:
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.grams, own), max(len(self.grams) - 1, 0))
        at = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[at]
        places = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, self.length, places).sum(axis=0)
        best = int(distance.argmin())
        most = self.length * len(own)
        rest = np.delete(distance, best)
        gap = (int(rest.min()) if len(rest) else most) - int(distance[best])
        return self.names[best], gap / most


def predict(docs, profiles, id="doc_id", text="text", length=LENGTH):
    """``doc_id, lang_pred, score`` for each row; ``und`` with score 0 for a null text or one without letters.

    Ties between languages go to the first by name. Rows are judged one by one,
    so repeats and null ids are kept; without profiles everything is ``und``;
    other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(Judge(profiles, length))

    def run(batches):
        judge = shipped.value
        for batch in batches:
            for part in slices(batch):
                said = [judge(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([a for a, _ in said], pa.string()), pa.array([b for _, b in said], pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    schema = T.StructType().add("doc_id", docs.schema[id].dataType).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def held_out_predictions(docs, folds=5, out=0, id="doc_id", text="text", lang="lang"):
    """Profiles from rows whose crc32 of the id leaves another remainder than ``out``; predictions for all rows.

    A null id has no remainder: such a row is not held out, and is not learned from.
    """
    fold = F.crc32(F.col(id).cast("string").cast("binary")) % folds
    profiles = fit(docs.filter(fold != out), text, lang)
    found = predict(docs, profiles, id, text)
    return found.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == out, F.lit(False)).alias("held_out"), "lang_pred", "score")

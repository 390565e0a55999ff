import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import heavy, trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rem(a, b):
    return a - b * int(a / b)


def conversations(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(v)] for c, v in said.items()}


def rebuild(said):
    out = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = said.get(c - rem(c, 20), [])[:h] + own[h:]
    return out


def brute(said):
    members = defaultdict(list)
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(members[p]) - 1) * words(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(said[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def got(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=lambda r: (r[0], r[1]))


def make(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "a", "b", "w", "block", "node", "t1", "n", "depth", "gid", "part"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 90), 60):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 20])):
            rows.append((c, turn, rng.choice(["user", "user", None, ""]), rng.choice(["a b", "a b", "c", None, " x y\n z"])))
    for turn in range(4):
        rows += [(c, turn, "user", "same words") for c in range(100, 140)]
    return rows


ODD = [
    (None, 0, "user", "lost"), (None, None, None, None), (1, None, None, None), (1, None, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
    (2, 0, None, ""), (2, 1, "x" * 50_000, "y " * 50_000), (3, -5, "ab", "c"), (3, 7, "a", "bc"), (5, 3_000, "u", "late"), (5, 0, "u", "first"),
    (5, None, "u", "before"), (-20, 0, "s", "p"), (-20, 1, "s", "q"), (-7, 0, "s", "p"), (-7, 1, "t", "q"), (-7, 2, "t", "q"), (-7, 3, "t", "q"),
]


@pytest.mark.parametrize("rows", [random_rows(1), ODD], ids=["random", "odd"])
def test_every_node_of_rebuilt_conversations(spark, rows):
    assert got(trie.rebuilt_prefixes(make(spark, rows))) == brute(rebuild(conversations(rows)))


def test_long_conversations_in_narrow_blocks(spark, monkeypatch):
    for name in ("TURNS", "BLOCKS", "ENDS"):
        monkeypatch.setattr(trie, name, 4)
    monkeypatch.setattr(heavy, "SHARE", 3)
    rows = [(c, turn, "u", f"w {turn}" if turn < 3 * c else f"x{c % 2}") for c in range(12) for turn in range(5 * (c % 4) + 1)]
    assert got(trie.prefixes(make(spark, rows), width=2)) == brute(conversations(rows))


def test_conversations_without_turns(spark):
    # 1 and 3 lose all their turns to a base that is not there.
    rows = [(c, 0, "u", "gone") for c in range(1, 20)]
    said = rebuild(conversations(rows))
    assert any(not t for t in said.values())
    assert got(trie.rebuilt_prefixes(make(spark, rows))) == brute(said)
    bare = [(c, 0, "u", "gone") for c, t in said.items() if not t]
    assert got(trie.rebuilt_prefixes(make(spark, bare))) == brute({c: [] for c, *_ in bare})


def test_no_conversations(spark):
    assert trie.rebuilt_prefixes(make(spark, [])).count() == 0
    assert trie.prefixes(make(spark, [(None, 1, "u", "t")])).count() == 0


def test_heavy_keys_are_looked_up_without_their_shuffle(spark):
    many = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + list(range(2, 40)) + [None, 99])], "k long, i long")
    one = spark.createDataFrame([(k, k * 10) for k in range(1, 30)], "k long, v long")
    out = heavy.lookup(many, one, "k", share=4)
    expected = sorted((str(r.k), r.i, r.k * 10 if r.k and r.k < 30 else None) for r in many.collect())
    assert sorted((str(r.k), r.i, r.v) for r in out.collect()) == expected

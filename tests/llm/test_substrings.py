import hashlib
import random

from millrace.llm import substrings


def brute(rows, width=20):
    """Words left by the rule, text by text."""
    order = lambda i: (i is not None, i or 0)
    words = [(t or "").split() for _, t in rows]
    first = {}
    for k, w in enumerate(words):
        for s in range(len(w) - width + 1):
            first.setdefault(tuple(w[s : s + width]), []).append((order(rows[k][0]), s, k))
    out = []
    for k, w in enumerate(words):
        gone = set()
        for s in range(len(w) - width + 1):
            here = order(rows[k][0])
            if any(o < here or (j == k and t < s) for o, t, j in first[tuple(w[s : s + width])]):
                gone |= set(range(s, s + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((rows[k][0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus():
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for k in range(60):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 120))]
        at = rng.randrange(len(w))
        if k % 2:
            a = rng.randrange(40)
            w[at:at] = passage[a : a + rng.randrange(15, 45)]
        if k % 7 == 0:
            w += w[: rng.randrange(10, 60)]
        rows.append((k, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(100 + k, rows[k][1]) for k in range(0, 60, 5)] + [(200, "one " * 100), (201, "one " * 30), (202, "one\t" * 19)]
    return rows


def test_words_left_match_brute_force(make, odd):
    rows = corpus() + [(i and i + 1000, t) for i, t in odd if t is None or len(t) < 1000]
    got = substrings.dedup(make(rows, extra=True))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_other_widths(make):
    rows = corpus()
    for width in (5, 8):
        assert sorted(map(tuple, substrings.dedup(make(rows), window=width).collect())) == sorted(brute(rows, width))


def test_rows_of_one_id_do_not_remove_each_other(make):
    said = " ".join(f"w{i}" for i in range(40))
    rows = [(1, said), (1, said), (1, said + " more"), (2, said)]
    got = sorted(map(tuple, substrings.dedup(make(rows)).collect()))
    assert got == sorted(brute(rows))
    assert [r[2] for r in got] == [0, 0, 0, 40]


def test_long_texts_and_empty_tables(make):
    rows = [(5, "x" * 200_000), (6, "a b " * 20_000)]
    got = {r.doc_id: r for r in substrings.dedup(make(rows)).collect()}
    assert got[5].n_removed == 0
    assert (got[6].n_words, got[6].n_removed) == (40_000, 39_998)
    assert substrings.dedup(make([])).count() == 0

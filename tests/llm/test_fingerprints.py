import collections
import hashlib
import random

from millrace.llm import fingerprints


def edit(rows):
    """Edited texts by the rule; rows in order of id, then as given."""
    out = {}
    for k, (i, t) in enumerate(rows):
        said, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(said) // 4
        out[i] = said[: len(said) - q] + after[:q]
    return out


def jaccard(a, b):
    a, b = collections.Counter(a.split()), collections.Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_edits_and_likeness(make):
    rng = random.Random(8)
    rows = [(k * 3, " ".join(rng.choice(["é", "日本", "😀x"]) + str(rng.randrange(60)) for _ in range(rng.randrange(30, 200)))) for k in range(60)]
    rows += [(500, ""), (501, None), (502, "   "), (503, rows[0][1])]
    got = {r.doc_id: r for r in fingerprints.compare(make(rows, extra=True)).collect()}
    want = edit(rows)
    assert {i: r.edited_sha256 for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert all(got[i].n_chars == len(t or "") for i, t in rows)
    assert got[0].fingerprint == got[503].fingerprint != got[3].fingerprint
    assert got[500].fingerprint == got[501].fingerprint == got[502].fingerprint
    assert (got[500].near_edited, got[500].near_next, got[502].near_next) == (1.0, 1.0, 0.0)
    off = [got[i].near_edited - jaccard(t or "", want[i]) for i, t in rows[:60]]
    assert abs(sum(off) / len(off)) < 0.05 and max(map(abs, off)) < 0.4


def test_weights_count(make):
    rows = [(2 * k + i, " ".join([f"a{k}"] * a + [f"b{k}"] * b)) for k in range(60) for i, (a, b) in enumerate([(9, 1), (3, 3)])]
    cells = {r.doc_id: r.text for r in fingerprints.signatures(make(rows), ["doc_id"], ["text"]).collect()}
    likes = [sum(x == y for x, y in zip(cells[2 * k], cells[2 * k + 1])) / len(cells[0]) for k in range(60)]
    # min(9, 3) + min(1, 3) over max(9, 3) + max(1, 3)
    assert abs(sum(likes) / 60 - 4 / 12) < 0.05


def test_odd_rows(make, odd):
    got = fingerprints.compare(make(odd)).collect()
    key = lambda x: (x is None, x)
    assert sorted((r.doc_id for r in got), key=key) == sorted((i for i, _ in odd), key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_single_and_no_document(make):
    (row,) = fingerprints.compare(make([(7, "abcdefgh")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0
    assert fingerprints.compare(make([])).count() == 0

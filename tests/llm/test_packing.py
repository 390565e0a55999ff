import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing

TOKENIZER = Tokenizer.from_file(packing.MODEL)


def cut(text, capacity):
    ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END]
    return [(i, ids[i : i + capacity]) for i in range(0, len(ids), capacity)]


def best_fit(lengths, capacity):
    """How full best-fit decreasing makes its sequences, one piece at a time."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= n]
        if fits:
            min(fits, key=lambda b: capacity - sum(b)).append(n)
        else:
            bins.append([n])
    return Counter(map(sum, bins))


def filled(runs, counts, capacity):
    """Sequences laid out by the runs: each piece in turn, with gaps and overlaps refused."""
    rows = sorted(map(tuple, runs.tolist()))
    bins = defaultdict(list)
    for (n, rank, each, sequence, offset), nxt in zip(rows, rows[1:] + [(None,) * 5]):
        end = nxt[1] if nxt[0] == n else counts[n]
        for k in range(end - rank):
            bins[sequence + k // each].append((offset + k % each * n, n))
    assert sorted(bins) == list(range(len(bins)))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    return Counter(sum(n for _, n in b) for b in bins.values())


@pytest.mark.parametrize("seed", range(60))
def test_runs_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 16, 33, 100])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else rng.randint(1, max(1, capacity // 5)) for _ in range(rng.randint(0, 300))]
    counts = Counter(lengths)
    assert filled(packing.layout(counts, capacity), counts, capacity) == best_fit(lengths, capacity)


def test_many_equal_pieces_take_few_runs():
    counts = {n: 10**9 + n for n in range(1, 2049)}
    runs = packing.layout(counts)
    assert len(runs) < 20_000
    assert (np.bincount(runs[:, 0])[1:] > 0).all()


def check(spark, df, texts, capacity, extra=""):
    packed = packing.pack(df, capacity=capacity, keep=True)
    rows = [r.asDict() for r in packed.collect()]
    expected = Counter((i, k, a, tuple(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, t in texts for k, (a, ids) in enumerate(cut(t, capacity)))
    assert Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"]), r["ids_crc32"]) for r in rows) == expected
    assert all(r["length"] == len(r["ids"]) for r in rows)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
    for b in bins.values():
        at = 0
        for offset, n, _ in sorted(b):
            assert offset == at
            at += n
        assert at <= capacity
    assert Counter(sum(n for _, n, _ in b) for b in bins.values()) == best_fit([r["length"] for r in rows], capacity)
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert {k: (sum((list(p[2]) for p in sorted(b)), []), [p[1] for p in sorted(b)]) for k, b in bins.items()} == {
        k: (list(r["ids"]), list(r["lengths"])) for k, r in whole.items()
    }
    assert all(r["n_ids"] == len(r["ids"]) and r["n_pieces"] == len(r["lengths"]) for r in whole.values())


def test_documents_are_packed_by_best_fit(spark, make, odd):
    rng = random.Random(5)
    words = ["tree", "Straße", "İstanbul", "x1y2", "don't", "😀", "été", "<|endoftext|>", "\u0085", "á", "中文字"]
    texts = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 40, 90])))) for i in range(400)]
    texts += [(i + 400, "same few words here") for i in range(300)] + [t for t in odd if t[1] is None or len(t[1]) < 50_000]
    check(spark, make(texts, extra=True).repartition(7), texts, 64)


def test_long_texts(spark, make):
    texts = [(1, "a b " * 20_000), (2, "x" * 200_000), (3, "1" * 5_000), (4, " \n\t " * 3_000)]
    check(spark, make(texts), texts, packing.CAPACITY)


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 5)
    encoder = packing.Encoder(TOKENIZER.to_str())
    import pyarrow as pa

    for n in range(20):
        texts = [f"word{n} and {k} " + "y" * 70 for k in range(4)] + [None, ""]
        flat, offsets = encoder.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [cut(t, 10**6)[0][1] for t in texts]


def test_no_documents(spark, make):
    packed = packing.pack(make([]), keep=True)
    assert packed.count() == 0 and packing.sequences(packed).count() == 0

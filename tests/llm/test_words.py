import random
import re

import numpy as np
import pyarrow as pa

from millrace.llm.arrow import Words, slices, whole, windows

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(n=300):
    rng = random.Random(3)
    return [None, ""] + ["".join(rng.choice("aBé 1\n\t.ß日😀-") for _ in range(rng.randrange(40))) for _ in range(n)]


def test_words_are_those_of_the_patterns():
    for kind, find in (("plain", lambda t: PLAIN.findall(t.translate(LOW))), ("blank", BLANK.findall)):
        column = texts()
        words = Words(pa.array(column), kind)
        ends = words.end()
        said = [words.data[a:b].tobytes().decode() for a, b in zip(words.start, ends)]
        want = [find(t or "") for t in column]
        assert said == [w for row in want for w in row]
        assert words.counts.tolist() == [len(r) for r in want]
        by = {}
        for w, h in zip(said, words.hash):
            assert by.setdefault(w, h) == h
        assert len(set(by.values())) == len(by)


def test_windows_are_equal_where_words_are():
    words = Words(pa.array(["a b c a b c", "x a b c", "a b"]), "plain")
    h = windows(words.hash, 3)
    ok = whole(words.first, 3, len(h))
    assert ok.tolist() == [True, True, True, True, False, False, True, True, False, False]
    assert h[0] == h[3] == h[7] != h[1]


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "x" * 100, ""] * 5)], names=["text"])
    parts = list(slices(batch, limit=10))
    assert sum(p.num_rows for p in parts) == 20
    assert [v for p in parts for v in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert list(slices(batch.slice(0, 0))) == []
    assert np.all([p.num_rows > 0 for p in parts])

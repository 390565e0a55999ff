import hashlib
import random
import re

from millrace.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").lower())
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(str(item))
    out = []
    for i, text in docs:
        w = WORD.findall((text or "").lower())
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    found |= windows[tuple(w[s : s + n])]
                    hit |= set(range(s, s + n))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def case():
    rng = random.Random(6)
    items = [(k, " ".join(f"b{rng.randrange(40)}" for _ in range(rng.randrange(1, 50)))) for k in range(30)]
    items += [(100, None), (101, ""), (102, items[3][1]), (3, items[3][1])]
    docs = []
    for k in range(80):
        w = [f"b{rng.randrange(40)}" if rng.random() < 0.6 else f"w{rng.randrange(9)}" for _ in range(rng.randrange(60))]
        if k % 3 == 0:
            said = rng.choice(items)[1] or ""
            at = rng.randrange(len(w) + 1)
            w[at:at] = said.upper().replace(" ", ", ").split(" ")[rng.randrange(5) :]
        docs.append((k, " ".join(w)))
    return docs, items


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_marks_match_brute_force(spark, make, odd):
    docs, items = case()
    docs = docs + [(i and i + 1000, t) for i, t in odd if t is None or len(t) < 1000]
    got = decontaminate.report(make(docs, extra=True), table(spark, items))
    assert key(map(tuple, got.drop("longest").collect())) == key(brute(docs, items))


def test_blocks_of_the_benchmark_add_up(spark, make):
    docs, items = case()
    whole = decontaminate.report(make(docs), table(spark, items)).collect()
    parts = decontaminate.report(make(docs), table(spark, items), block_bytes=400).collect()
    assert key(map(tuple, parts)) == key(map(tuple, whole))


def test_clean_rows_stay_with_all_columns(spark, make, odd):
    docs, items = case()
    df = make(docs + [(i and i + 1000, t) for i, t in odd], extra=True)
    kept = decontaminate.clean(df, table(spark, items))
    assert kept.columns == df.columns
    want = [r[0] for r in brute(docs, items) if not r[5]] + [i and i + 1000 for i, t in odd]
    assert key([(r.doc_id,) for r in kept.collect()]) == key([(i,) for i in want])


def test_longest_match(spark, make):
    said = " ".join(f"b{i}" for i in range(40))
    docs = [(1, "x " + " ".join(f"b{i}" for i in range(5, 30)) + " y"), (2, said), (3, "nothing at all")]
    got = {r.doc_id: r.longest for r in decontaminate.report(make(docs), table(spark, [(1, said)])).collect()}
    assert got == {1: 25, 2: 40, 3: 0}


def test_empty_tables(spark, make):
    docs, items = case()
    assert decontaminate.report(make([]), table(spark, items)).count() == 0
    assert decontaminate.report(make(docs), table(spark, [])).filter("contaminated").count() == 0

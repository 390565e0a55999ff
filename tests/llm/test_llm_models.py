import random
import zlib

import numpy as np
import pytest

from millrace.llm import langid, pieces, toxicity


def test_languages_of_held_out_texts(spark, odd):
    rng = random.Random(4)
    words = {"aa": "ra ro ri tan ton mar", "bb": "shu she sho kli klo bren", "cc": "éla élo zur zir vön vän"}
    rows = [(k, " ".join(rng.choice(words[lang].split()) for _ in range(rng.randrange(5, 60))), lang) for k, lang in enumerate(list(words) * 60)]
    rows += [(1000, None, "aa"), (1001, "123 !!!", "bb"), (1002, "ra ro ri", None), (None, "shu she sho kli", "bb"), (1003, "x" * 100_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.held_out_predictions(df).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows if i is not None)
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:180])
    assert (got[1000].lang_pred, got[1001].lang_pred, got[1002].lang_pred) == ("und", "und", "aa")
    assert got[None].lang_pred == "bb" and not got[None].held_out
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.held_out_predictions(df.limit(0)).count() == 0


def test_ranked_grams_match_counting():
    import collections

    said = "Der Hund, der alte Hund!"
    padded = [f" {w} " for w in "der hund der alte hund".split()]
    count = collections.Counter()
    for w in padded:
        count.update(c for c in w if c != " ")
        count.update(w[i : i + 2] for i in range(len(w) - 1))
        count.update(w[i : i + 3] for i in range(len(w) - 2))
    number = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    want = sorted(count, key=lambda g: (-count[g], number(g)))
    assert langid.ranked(langid.grams(said), 10_000).tolist() == [number(g) for g in want]
    assert langid.ranked(langid.grams(said), 7).tolist() == [number(g) for g in want[:7]]


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces()


def samples():
    rng = random.Random(6)
    out = ["", " ", "  ", "Hello  wörld\n\nx \t日本 😀", "\x00\x01 tést", "a" * 300, " " * 90, "ab" * 40, "internationalization of tokenizers", "\n\n\n", "ﷺ ½ Ａ"]
    for letters in ("ab", "ab \n-=0", "abcdefghijklmnopqrstuvwxyz ", "the quick", "ñéüß日 a", "().{}[];=+ \t\n01"):
        out += ["".join(rng.choice(letters) for _ in range(rng.randrange(90))) for _ in range(40)]
    return out


def test_ids_are_those_of_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = samples()
    assert model.encode(texts) == library.encode(texts)
    assert model.decode(model.encode(texts)) == texts
    assert model.decode(model.encode(["a▁b"])) == ["a b"]


def test_units_by_merges_alone_agree(model):
    said = "▁internationalization"
    codes = pieces._codes(said)
    assert model._plain(codes) == model.units(codes.reshape(1, -1))[0]


def test_coded_rows(make, odd):
    rows = [(100 + k, t) for k, t in enumerate(samples()) if "\x00" not in t] + odd
    got = pieces.encode(make(rows, extra=True)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.decoded) for r in got), key=key) == sorted(rows, key=key)
    assert all((r.ids is None) == (r.decoded is None) for r in got)
    assert pieces.encode(make([])).count() == 0


CLEAN = "the garden was green and the river ran slowly past our old stone house in the evening light".split()
TOXIC = ["idiot", "moron", "stupid"]


def toxic_rows(n=400):
    rng = random.Random(7)
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(CLEAN) for _ in range(rng.randrange(15, 60))]
        bad = k % 4 == 0
        if bad:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(TOXIC)
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxic_texts_and_their_disguises(spark, make, odd):
    rows, labels = toxic_rows()
    hidden = {5001: "you 1d10t , the m0r0n of the house", 5002: "what a stuuuupid , s t u p i d garden", 5003: "an i.d.i.o.t and a m-o-r-o-n", 5004: "the g4rden was gr33n"}
    df = make(rows + list(hidden.items()) + [(i and i + 9000, t) for i, t in odd], extra=True)
    table = spark.createDataFrame(labels + [(None, 1), (3, None), (99_999, 1)], "doc_id long, toxic long")
    got = {r.doc_id: r for r in toxicity.predictions(df, table).collect()}
    assert [got[i].predicted for i, _ in rows] == [t for _, t in labels]
    assert [got[i].predicted for i in hidden] == [1, 1, 1, 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in got.values()) and got[9001].score == got[9002].score == min(r.score for r in got.values())
    kept = toxicity.clean(df, table)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_disguises_anywhere_in_a_word(spark, make):
    rows, labels = toxic_rows()
    bad = ["idioot", "m o   r   o n", "i\u00a0d\u00a0i\u00a0o\u00a0t", "m:o:r:o:n", "i~d~i~o~t", "m#o#r#o#n", "i;d;i;o;t", "m\u00b7o\u00b7r\u00b7o\u00b7n",
           "i d ! o t", "s t u p ! d", "id iot", "st up id", "stup id", "id:iot", "mor\u00a0on", "stup1d", "m0ron", "idio7"]
    hidden = {5000 + k: f"the garden was {x} and the river ran slowly" for k, x in enumerate(bad)}
    clean = {6000 + k: f"the garden was {x} and the river ran slowly" for k, x in enumerate(["green", "old", "i n", "ho use", "hous3", "st one"])}
    table = spark.createDataFrame(labels, "doc_id long, toxic long")
    got = {r.doc_id: r.predicted for r in toxicity.predictions(make(rows + list((hidden | clean).items())), table).collect()}
    assert [x for k, x in enumerate(bad) if not got[5000 + k]] == []
    assert [k for k in clean if got[k]] == []


def test_all_tested_words_count(spark):
    """The bound rises with the words tested, beyond any number of them."""
    words = ["".join("abcdefghijklmnopqrstuvwxyzabcdef"[2 * p + (k >> p & 1)] for p in range(16)) for k in range(40_000)]
    model = toxicity.Model(np.zeros(28**4))

    def learned(words):
        rows = [(" ".join(words) + f" bad {k}", 1) for k in range(15)] + [(f"kind {k}", 0) for k in range(15)]
        return len(toxicity.learn(spark.createDataFrame(rows, "text string, toxic long"), model)[0])

    # Fifteen of fifteen at a rate of one half: an excess of 15 log 2 = 10.4, under log 40000 = 10.6, over log 20000 = 9.9.
    assert learned(words) == 0
    assert learned(words[:5]) > 5


def test_held_out_labels_teach_nothing(spark, make):
    rows, labels = toxic_rows(200)
    table = spark.createDataFrame([x for x in labels if zlib.crc32(str(x[0]).encode()) % 3 == 1], "doc_id long, toxic long")
    assert toxicity.predictions(make(rows), table).filter("predicted = 1").count() == 0
    assert toxicity.predictions(make([]), table).count() == 0


def test_viterbi_takes_the_likeliest_path():
    counts = np.zeros(28**4)
    for w in ["idiot"] * 9 + ["lady"] * 9:
        x = toxicity.symbols(w)
        for a, b, c, d in zip(x, x[1:], x[2:], x[3:]):
            counts[((a * 28 + b) * 28 + c) * 28 + d] += 1
    read = toxicity.Model(counts).decode
    assert read("1d10t") == "idiot" and read("!4dy").strip() == "lady" and read("idioooot") == "idiot" and read("l a d y") == "lady"


def lattice_paths(span, whole):
    """Every reading of ``span`` with the cost of its signs, by plain enumeration."""
    blank, joined = (toxicity._KEPT, toxicity._NOTHING) if whole else (toxicity._END, toxicity._JOIN)
    paths, before = [("", 0.0)], ""
    for c in span:
        if c.isalpha():
            options = [(c, toxicity._KEPT)]
        else:
            letters = toxicity.SIGNS.get(c, "")
            sign = bool(letters) and c not in toxicity._SEPARATORS
            options = [(x, toxicity._SIGN - np.log(len(letters))) for x in letters]
            options += [(" ", toxicity._END if sign else blank), ("", toxicity._NOTHING if sign else joined)]
        if c == before and (c.isalpha() or c in toxicity.SIGNS):
            options.append(("", toxicity._STRETCH))
        paths = [(said + x, cost + y) for said, cost in paths for x, y in options]
        before = c
    return paths


def spoken(model, said):
    """Log-probability of a reading, ends in a row as one."""
    x = toxicity.symbols(said)
    return sum(model.log[a, b, c, d] for a, b, c, d in zip(x, x[1:], x[2:], x[3:]))


def trained(words):
    counts = np.zeros(28**4)
    for w in words:
        x = toxicity.symbols(w)
        np.add.at(counts, ((x[:-3] * 28 + x[1:-2]) * 28 + x[2:-1]) * 28 + x[3:], 1)
    return toxicity.Model(counts)


@pytest.mark.parametrize("whole", [False, True])
def test_readings_are_the_best_of_all_lattice_paths(whole):
    model, rng = trained(["idiot", "lady", "illegal", "bees", "élan", "a zoo"] * 5), random.Random(11)
    spans = ["".join(rng.choice("ab1i0!$*e .-éz") for _ in range(rng.randrange(0, 7))) for _ in range(150)]
    for span, got in zip(spans, model.readings(spans, whole)):
        paths = {}
        for said, cost in lattice_paths(span, whole):
            paths[said] = max(paths.get(said, -np.inf), cost + spoken(model, said))
        assert got in paths and paths[got] >= max(paths.values()) - 1e-9, span
    assert [model.decode(s, whole) for s in spans] == model.readings(spans, whole)


def test_a_long_mixed_token_settles_on_its_way(monkeypatch):
    model, rng = trained(["idiot", "lady", "illegal", "bees"] * 5), random.Random(12)
    kept = []
    settle = toxicity._settle
    monkeypatch.setattr(toxicity, "_settle", lambda back, states: (settle(back, states), kept.append(len(back)))[0])
    long = "".join(rng.choice("abdegilsty10!") for _ in range(10_000))
    got = model.decode(long)
    assert len(kept) == 10_000 // toxicity._SETTLE and max(kept) < 200
    monkeypatch.setattr(toxicity, "_SETTLE", 1 << 30)
    assert model.decode(long) == got
    monkeypatch.setattr(toxicity, "_ALONE", 1 << 30)
    assert model.decode(long) == got
    assert len(model.decode("ab1" * 20_000)) > 40_000

import hashlib
import random
import re

from millrace.llm import licenses, secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)


def secrets(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))


def noisy():
    rng = random.Random(9)
    parts = ["password: hunter22", "TOKEN = 'x.y-z/1='", "token: token: abcdefgh", "api_key=abc", "AKIA" + "A1" * 8, "AKIASHORT", "é😀", "deadbeef" * 4,
             "ab" * 11, "passwd  \"= \"qwertyuiop", "secret", "ſecret: 1234567"]
    return [(k, " ".join(rng.choice(parts) for _ in range(rng.randrange(8)))) for k in range(200)]


def test_patterns_match_brute_force(make, odd):
    rows = noisy() + [(i and i + 1000, t) for i, t in odd]
    got = secret_scan.scan(make(rows, extra=True)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    want = [(i, *[secrets(t or "").count(k + ":") for k in ("assign", "access", "hex")], hashlib.sha256(secrets(t or "").encode()).hexdigest()) for i, t in rows]
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert set(filter(None, secrets(dict(rows).get(r.doc_id) or "").split(","))) <= set(r.spans.split(",")) or r.doc_id is None


def test_battery_finds_keys_and_leaves_words(make):
    rng = random.Random(1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(40)]
    prose = ["the quick brown fox jumps over the lazy dog and internationalization2024 goes on " * 3] * 200
    rows = [(k, f"see {v} there") for k, v in enumerate(keys)] + [(1000 + k, t) for k, t in enumerate(prose)]
    rows += [(5000, "a1a1a1a1a1a1a1a1a1a1a1a1a1a1 aaaaaaaaaaaaaaaaaaaaaaa1 build-2024-01-01-release-notes-v2")]
    got = {r.doc_id: r.spans for r in secret_scan.scan(make(rows)).collect()}
    assert sum("random:4:44" in got[k] for k in range(40)) >= 36
    assert not any("random" in got[k] for k in got if k >= 1000)


def test_battery_finds_short_keys(make):
    rng = random.Random(4)
    prose = "the quick brown fox jumps over the lazy dog and Internationalization2024 of INCOMPREHENSIBILITIES goes on in src/main/python " * 3
    up, low, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    rows = [(k, prose) for k in range(200)]
    keys = {}
    for alphabet in (up + low + digits, low + digits, up + digits, up + "234567", up + low):
        for n in (16, 20):
            for _ in range(20):
                keys[1000 + len(keys)] = "".join(rng.choice(alphabet) for _ in range(n))
    rows += [(k, f"see {v} there") for k, v in keys.items()] + [(5000, "see path/to/the/place/" + keys[1000] + "-final there")]
    got = {r.doc_id: r.spans for r in secret_scan.scan(make(rows)).collect()}
    assert sum(f"random:4:{4 + len(v)}" in got[k] for k, v in keys.items()) >= 180
    assert "random" in got[5000] and not any(got[k] for k in range(200))


def test_masks(make, odd):
    df = make([(1, "token = abcdef1 and AKIA" + "B2" * 8 + "."), (2, "clean"), *odd], extra=True)
    out = secret_scan.masked(df)
    assert out.columns == df.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert (1, "[secret] and [secret].") in got and (2, "clean") in got
    assert all(row in got for row in odd)


def test_discoveries_are_bounded():
    assert secret_scan.discoveries([0.001, 0.5, 0.004, 0.9]) == {0, 2}
    assert secret_scan.discoveries([0.02, 0.5]) == set()
    assert secret_scan.discoveries([]) == set()


def phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    found = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_phrases_match_brute_force(make, odd):
    rng = random.Random(3)
    parts = ["MIT", "License", "apache-license", "the GNU General Public License", "mit license mit license", "Ünder", "x"]
    rows = [(k, " ".join(rng.choice(parts) for _ in range(rng.randrange(9)))) for k in range(150)] + [(i and i + 1000, t) for i, t in odd]
    got = licenses.scan(make(rows, extra=True)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(((i, *phrases(t or "")) for i, t in rows), key=key)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_templates(make):
    said = {
        1: "Foo. Released under the MIT License. Bar",
        2: "Licensed under CC BY-NC 4.0.",
        3: "This work is licensed under the GNU General Public License, version 3.",
        4: "This work is licensed under the GNU Public License",
        5: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version.",
        6: "Copyright 2024 Some Firm, Inc. All rights reserved.",
        7: "released under the mit",
    }
    got = {r.doc_id: (r.labels, r.score, r.accepted) for r in licenses.scan(make(list(said.items()))).collect()}
    assert got[1] == ("mit", 1.0, "mit:1:6")
    assert got[2] == ("cc-by-nc", 1.0, "cc-by-nc:0:7")
    assert got[3] == ("gpl", 1.0, "gpl:0:12")
    assert got[4] == ("", 0.0, "")
    assert got[5][:2] == ("gpl", 1.0)
    assert got[6] == ("proprietary", 1.0, "proprietary:0:8")
    assert got[7] == ("", 0.0, "")


def test_automata_against_expanded_wordings():
    """All wordings of a small template, and only those, are accepted."""
    template = "a [[b {{x:0-2}}]] c|d [[e]] {{n:1-2:[0-9]+}}"
    accepted = set()
    for first in [[], ["b"], ["b", "?"], ["b", "?", "?"]]:
        for second in ("c", "d"):
            for third in ([], ["e"]):
                for fourth in (["1"], ["1", "1"]):
                    accepted.add(tuple(["a", *first, second, *third, *fourth]))
    machine = licenses.Automaton(template)
    alphabet = ["a", "b", "c", "d", "e", "1", "?"]
    rng = random.Random(2)
    tried = [[rng.choice(alphabet) for _ in range(rng.randrange(1, 8))] for _ in range(3000)] + [list(x) for x in accepted]
    for words in tried:
        states = machine.start
        for w in words:
            states = machine.step(states, w, lambda w=w: w)
        fits = any(len(words) == len(t) and all(x == y or x == "?" for x, y in zip(t, words)) for t in accepted)
        assert bool(states & machine.accept) == fits, words


def test_scans_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, kind string")
    for found in (licenses.scan(none), secret_scan.scan(none)):
        assert found.columns[0] == "doc_id" and found.collect() == []
    assert secret_scan.masked(none).collect() == []

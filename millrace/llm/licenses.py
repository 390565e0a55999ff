"""License scans by templates with optional and replaceable regions, compiled to token automata.

Markup of a template: words stand for themselves, ``a|b`` for either word,
``[[ ... ]]`` is an optional region and ``{{name:least-most}}`` a replaceable one
of so many words; ``{{name:least-most:pattern}}`` admits words of a pattern
only. A template is accepted where its mandatory wording stands word for word.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import Words, slices

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, template). Wording without case and punctuation.
TEMPLATES = [
    ("mit", "released|licensed|distributed under the [[terms of the]] mit license"),
    (
        "mit",
        """permission is hereby granted free of charge to any person obtaining a copy of this software
        and associated documentation files the software to deal in the software without restriction including without
        limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
        and to permit persons to whom the software is furnished to do so subject to the following conditions the above
        copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or
        substantial portions of the software [[the software is provided as is without warranty of any kind express or
        implied including but not limited to the warranties of merchantability fitness for a particular purpose and
        noninfringement]]""",
    ),
    ("apache", "licensed under the apache license version 2 0 [[the license you may not use this file except in compliance with the license]]"),
    ("gpl", "[[this {{work:1-3}} is]] licensed|released under the gnu general public license [[version {{number:1-2:[0-9]+}}]] [[or any later version]]"),
    (
        "gpl",
        """this {{work:1-3}} is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]]
        general public license as published by the free software foundation either version {{number:1-2:[0-9]+}} of the
        license or at your option any later version""",
    ),
    (
        "bsd",
        """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met [[1]] redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright
        notice this list of conditions and the following disclaimer in the documentation and or other materials provided
        with the distribution [[3 neither the name of {{holder:1-12}} nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission]]""",
    ),
    (
        "isc",
        """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies""",
    ),
    ("mpl", "this {{form:1-4}} is subject to the terms of the mozilla public license [[v]] {{number:1-2:[0-9]+}}"),
    ("cc-by", "licensed under [[a|the]] cc by {{number:1-2:[0-9]+}} [[international]] [[license]]"),
    ("cc-by-sa", "licensed under [[a|the]] cc by sa {{number:1-2:[0-9]+}} [[international]] [[license]]"),
    ("cc-by-nc", "licensed under [[a|the]] cc by nc {{number:1-2:[0-9]+}} [[international]] [[license]]"),
    ("cc-by-nd", "licensed under [[a|the]] cc by nd {{number:1-2:[0-9]+}} [[international]] [[license]]"),
    ("cc0", "to the extent possible under law {{author:1-12}} has waived all copyright and related or neighboring rights to {{work:1-12}}"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "copyright {{holder:1-12}} all rights reserved"),
]


class Automaton:
    """States of one template as bits: ``step`` reads a word, ``accept`` is the end.

    State ``i`` waits for element ``i``; skips lead over optional regions.
    """

    def __init__(self, template):
        parts = re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\s\[\]{}]+", template)
        self.words: dict[str, int] = {}
        self.any, self.patterns, n = 0, [], 0
        skips: list[tuple[int, int]] = []
        opened: list[int] = []
        for part in parts:
            if part == "[[":
                opened.append(n)
            elif part == "]]":
                skips.append((opened.pop(), n))
            elif part.startswith("{{"):
                bits = part[2:-2].split(":", 2)
                least, most = map(int, bits[1].split("-"))
                for k in range(most):
                    if k >= least:
                        skips.append((n, n + most - k))
                    if len(bits) > 2:
                        self.patterns.append((n, re.compile(bits[2])))
                    else:
                        self.any |= 1 << n
                    n += 1
            else:
                for word in part.split("|"):
                    self.words[word] = self.words.get(word, 0) | 1 << n
                n += 1
        self.accept = 1 << n
        reach = [1 << i for i in range(n + 1)]
        for i in reversed(range(n + 1)):
            for a, b in skips:
                if a == i:
                    reach[i] |= reach[b]
        self.reach = reach
        self.start = reach[0]
        if self.start & (self.any | self.accept | sum(1 << i for i, _ in self.patterns)):
            raise ValueError("a template must begin with a word")

    def closed(self, states):
        out = 0
        while states:
            low = states & -states
            out |= self.reach[low.bit_length() - 1]
            states ^= low
        return out

    def step(self, states, word, text):
        """States after a word; ``text()`` gives its letters where a pattern asks for them."""
        moved = states & (self.any | self.words.get(word, 0))
        for i, pattern in self.patterns:
            if states >> i & 1 and pattern.fullmatch(text()):
                moved |= 1 << i
        return self.closed(moved << 1)

    def longest(self, words, at, stop, text):
        """End of the longest accepted stretch from ``at``; 0 if there is none."""
        states, end = self.start, 0
        while states and at < stop:
            states = self.step(states, words[at], lambda: text(at))
            at += 1
            if states & self.accept:
                end = at
        return end


class Scanner:
    """Phrases and templates over the numbered words of a slice of rows."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.automata = [(label, Automaton(t)) for label, t in templates]
        known = sorted({w for _, a in self.automata for w in a.words} | {w for p in phrases for w in p.split()})
        words = Words(pa.array([" ".join(known)], pa.large_string()), "plain")
        order = np.argsort(words.hash)
        self.hashes, self.names = words.hash[order], [known[i] for i in order]
        number = {w: i + 1 for i, w in enumerate(self.names)}
        self.phrases = [([number[w] for w in p.split()], label) for p, label in phrases.items()]
        for _, a in self.automata:
            a.words = {number[w]: bits for w, bits in a.words.items()}
        self.begins = [np.array([w for w, bits in a.words.items() if bits & a.start]) for _, a in self.automata]

    def numbers(self, hashes):
        found = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[found] == hashes, found + 1, 0)

    def rows(self, column):
        """For each row: ``(n_words, n_base, first, last, base labels, labels, template spans)``."""
        words = Words(column, "plain")
        number, first, row = self.numbers(words.hash), words.first, words.row()
        ends = words.end()
        text = lambda i: words.data[words.start[i] : ends[i]].tobytes().decode("utf-8", "replace")
        places: dict[int, list] = {}
        for phrase, label in self.phrases:
            n = len(number) - len(phrase) + 1
            if n > 0:
                hit = np.all([number[k : n + k] == w for k, w in enumerate(phrase)], axis=0)
                for at in np.flatnonzero(hit & (row[:n] == row[len(phrase) - 1 :])):
                    places.setdefault(int(row[at]), []).append((int(at - first[row[at]]), label))
        accepted: dict[int, list] = {}
        for (label, automaton), begins in zip(self.automata, self.begins):
            until, last = -1, -1
            for at in np.flatnonzero(np.isin(number, begins)):
                if row[at] != last:
                    until, last = -1, row[at]
                if at >= until and (end := automaton.longest(number, int(at), int(first[row[at] + 1]), text)):
                    accepted.setdefault(int(row[at]), []).append((int(at - first[row[at]]), int(end - first[row[at]]), label))
                    until = end
        for i, n in enumerate(words.counts):
            base, more = places.get(i, []), sorted(accepted.get(i, []))
            named = {label for _, label in base}
            starts = [at for at, _ in base]
            yield int(n), len(base), min(starts, default=None), max(starts, default=None), sorted(named), sorted(named | {x[2] for x in more}), more


def scan(docs, id="doc_id", text="text", templates=TEMPLATES, phrases=PHRASES):
    """License wording of every text.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, accepted``. ``n_base`` counts all places of the base phrases,
    ``first_word`` and ``last_word`` are the least and greatest start (null
    without one). ``labels`` adds those of accepted templates, listed in
    ``accepted`` as ``label:first word:word after``. ``score`` is 1 with an
    accepted template, 0.5 with a base phrase alone, else 0. A null text is
    empty; rows are judged one by one, so repeats and null ids are kept; other
    columns are not read.
    """

    def run(batches):
        scanner = Scanner(templates, phrases)
        for batch in batches:
            for part in slices(batch):
                columns = [[] for _ in range(8)]
                for n, n_base, low, high, base, labels, more in scanner.rows(part.column("text")):
                    shown = ",".join(f"{label}:{s}:{e}" for s, e, label in more)
                    values = (n, n_base, low, high, ",".join(base), ",".join(labels), 1.0 if more else 0.5 if base else 0.0, shown)
                    for column, value in zip(columns, values):
                        column.append(value)
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]], names=schema.names
                )

    schema = T.StructType().add("doc_id", docs.schema[id].dataType)
    for name in ("n_words", "n_base", "first_word", "last_word"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("base_labels", T.StringType()).add("labels", T.StringType()).add("score", T.DoubleType()).add("accepted", T.StringType())
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)

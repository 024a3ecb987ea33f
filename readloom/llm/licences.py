"""Licence texts in documents, by a generalised suffix automaton of their words.

All templates and phrases go into one automaton over words. A text is streamed
through it word by word: at each word the longest run of words that ends there
and stands in some template is known (the matching statistics). Runs that cannot
be made longer are matches; matches of one template are chained, in the order of
text and template, to the chain that covers most of the template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from readloom.llm.common import table

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}

#: The base phrases, label and words.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

#: Notices and opening passages of public licences, label and text.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
)

#: A template is found where a chain covers this share of its words.
FOUND = 0.8
#: Matches of fewer words are not chained.
SHORTEST = 3


def words_of(text: str | None) -> list[str]:
    """The words of a text; a null text has none."""
    return _WORD.findall(text.translate(_LOWER)) if isinstance(text, str) else []


@dataclass
class Span:
    """A template found at words first to last of a text, with the share of its words that is covered."""

    label: str
    first: int
    last: int
    covered: float


@dataclass
class Automaton:
    """A generalised suffix automaton of the templates' words, and of phrases that must stand whole."""

    templates: tuple = TEMPLATES
    phrases: tuple = PHRASES
    longest: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    step: list[dict] = field(default_factory=lambda: [{}])

    def __post_init__(self) -> None:
        self.texts = [(label, words_of(t)) for label, t in self.templates]
        self.short = [(label, words_of(t)) for label, t in self.phrases]
        self.ids = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in self.texts + self.short for w in ws))}
        self.ends: dict[int, list] = {}
        for number, (_, ws) in enumerate(self.texts):
            at = 0
            for place, w in enumerate(ws):
                at = self._extend(at, self.ids[w])
                self.ends.setdefault(at, []).append((number, place))
        last = []
        for _, ws in self.short:
            at = 0
            for w in ws:
                at = self._extend(at, self.ids[w])
            last.append(at)
        below: list[list[int]] = [[] for _ in self.link]
        for state, up in enumerate(self.link):
            if up >= 0:
                below[up].append(state)
        self._below = below
        # The phrases that are endings of a state's runs: those of its ancestors, and its own where the run is long enough.
        self.own: list[list[int]] = [[] for _ in self.link]
        self.above: list[tuple] = [()] * len(self.link)
        for number, (_, ws) in enumerate(self.short):
            if ws:
                at = 0
                for w in ws:
                    at = self.step[at][self.ids[w]]
                self.own[at].append(number)
        todo = [0]
        while todo:
            s = todo.pop()
            for c in below[s]:
                self.above[c] = self.above[s] + tuple(self.own[s])
                todo.append(c)

    def _new(self, longest: int, link: int, step: dict) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.step.append(step)
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._new(self.longest[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = clone
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        """The state of the word ``c`` behind the text that ends in ``last``; texts may share states."""
        q = self.step[last].get(c)
        if q is not None:
            return q if self.longest[q] == self.longest[last] + 1 else self._split(last, q, c)
        new, p = self._new(self.longest[last] + 1, 0, {}), last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[new] = q if self.longest[q] == self.longest[p] + 1 else self._split(p, q, c)
        return new

    def places(self, state: int) -> list[tuple[int, int]]:
        """(template, place) of all ends of the state's runs in the templates."""
        out, todo = [], [state]
        while todo:
            s = todo.pop()
            out += self.ends.get(s, ())
            todo += self._below[s]
        return out

    def stream(self, words: list[str]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Places (phrase, first word) of phrases and the matches (last word, length, state) that cannot be made longer."""
        phrases, matches = [], []
        state = size = 0
        get, ids, step, longest = self.ids.get, self.ids, self.step, self.longest
        for i, w in enumerate(words):
            if w not in ids:
                if size >= SHORTEST:
                    matches.append((i - 1, size, state))
                state = size = 0
                continue
            c = get(w)
            if c not in step[state]:
                if size >= SHORTEST:
                    matches.append((i - 1, size, state))
                while state > 0 and c not in step[state]:
                    state = self.link[state]
                    size = longest[state]
            if c in step[state]:
                state, size = step[state][c], size + 1
            for k in self.above[state]:
                phrases.append((k, i - len(self.short[k][1]) + 1))
            for k in self.own[state]:
                if len(self.short[k][1]) <= size:
                    phrases.append((k, i - len(self.short[k][1]) + 1))
        if size >= SHORTEST:
            matches.append((len(words) - 1, size, state))
        return phrases, matches

    def spans(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        """For each template the chains of matches that cover FOUND of its words or more, apart from each other, and its best one below that."""
        by_template: dict[int, list] = {}
        for last, size, state in matches:
            for number, place in self.places(state):
                by_template.setdefault(number, []).append((last - size + 1, last, place - size + 1, place))
        out = []
        for number, found in by_template.items():
            label, ws = self.texts[number]
            found.sort()
            score, start = [], []
            for k, (w0, w1, t0, t1) in enumerate(found):
                best, first = t1 - t0 + 1, w0
                for j in range(k - 1, -1, -1):
                    v0, v1, s0, s1 = found[j]
                    if w0 - v0 > 3 * len(ws):
                        break
                    if v0 < w0 and v1 < w1 and s0 < t0 and s1 < t1 and w1 - start[j] < 2 * len(ws):
                        cover = score[j] + min(t1 - max(t0 - 1, s1), w1 - max(w0 - 1, v1))
                        if cover > best:
                            best, first = cover, start[j]
                score.append(best)
                start.append(first)
            taken: list[tuple[int, int]] = []
            for k in sorted(range(len(found)), key=lambda k: (-score[k], start[k], found[k][1])):
                span = (start[k], found[k][1])
                if all(span[1] < a or b < span[0] for a, b in taken):
                    if taken and score[k] < FOUND * len(ws):
                        break
                    taken.append(span)
                    out.append(Span(label, *span, score[k] / len(ws)))
        return out


def scan(texts: list[str | None], automaton: Automaton) -> list[dict]:
    """Words, base phrases, labels, score and spans of each text.

    ``score`` is the largest covered share of a template; a phrase that stands
    whole counts as covered. ``labels`` are those of phrases and of templates
    covered to FOUND or more. Null and empty texts have neither.
    """
    rows = []
    for text in texts:
        words = words_of(text)
        phrases, matches = automaton.stream(words)
        spans = automaton.spans(matches)
        base = {automaton.short[k][0] for k, _ in phrases}
        at = [i for _, i in phrases]
        found = [s for s in spans if s.covered >= FOUND]
        rows.append(
            {
                "n_words": len(words), "n_base": len(at), "first_word": min(at, default=None), "last_word": max(at, default=None),
                "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | {s.label for s in found})),
                "score": 1.0 if at else max((s.covered for s in spans), default=0.0),
                "spans": [(s.label, s.first, s.last, s.covered) for s in sorted(found, key=lambda s: (s.first, s.last, s.label))],
            }
        )
    return rows


_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, first: long, last: long, covered: double>>"
)


def scan_licences(docs: DataFrame, templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text) with its licence phrases, labels, score and template spans.

    Each task builds the automaton once. Rows with null doc_id or text and
    repeated rows each give a row; an empty table gives none.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(templates, phrases)
        for pdf in batches:
            for at in range(0, len(pdf), 200):
                some = pdf.iloc[at : at + 200]
                out = pd.DataFrame(scan(some["text"].tolist(), automaton))
                for c in ("first_word", "last_word"):
                    out[c] = out[c].astype("Int64")
                out.insert(0, "doc_id", some["doc_id"].astype("Int64").to_numpy() if some["doc_id"].notna().all() else pd.array([None if pd.isna(x) else int(x) for x in some["doc_id"]], dtype="Int64"))
                yield out

    return docs.select("doc_id", "text").mapInPandas(judge, _SCHEMA)


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, labels and score of every document's whole text."""
    return scan_licences(table(spark, sf_dir, "documents")).drop("spans")

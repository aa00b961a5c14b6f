"""License scans by template markup.

A template is the wording of a license or notice in which ``[[ ... ]]`` is an
optional region and ``{{n}}`` a replaceable one of up to ``n`` words; all
other words are mandatory and must match exactly, in order.  Templates are
compiled into automata over words: a state set advances word by word, with
empty moves around optional regions and counted moves through replaceable
ones.  A text is accepted where a run of its words takes an automaton to
its end.

Words are those of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing
A-Z, so punctuation, case and line breaks never matter.  Every template
starts with mandatory words; their fingerprints find the places, in NumPy,
where its automaton is started, so other text costs nothing.

``score`` is 1 where a template accepts, 0.5 where only a base phrase
occurs, else 0.

Defined results: null and empty texts have no words, no labels and score 0;
repeated rows are scanned alike; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.common import parts_of, texts_of
from vecspark.llm.words import ALNUM, PART_BYTES, Words

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license wordings as templates.
TEMPLATES = {
    "mit-notice": "released under the mit license",
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
        "notice and this permission notice [[ including the next paragraph ]] shall be included in all copies or "
        "substantial portions of the software [[ the software is provided as is without warranty of any kind express "
        "or implied {{80}} ]]"),
    "isc-text": (
        "permission to use copy modify and [[ or ]] distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met [[ 1 ]] redistributions of source code must retain the above copyright notice "
        "this list of conditions and the following disclaimer [[ 2 ]] redistributions in binary form must reproduce the "
        "above copyright notice this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution [[ 3 ]] [[ neither the name of {{20}} nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission ]]"),
    "apache-2.0-notice": "licensed under the apache license version 2 0",
    "apache-2.0-header": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at {{12}} unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis without warranties or "
        "conditions of any kind either express or implied"),
    "gpl-notice": "licensed under the [[ terms of the ]] gnu [[ lesser ]] [[ affero ]] general public license",
    "gpl-3.0-notice": "licensed under the [[ terms of the ]] gnu general public license [[ as published by the free "
                      "software foundation either ]] version 3",
    "gpl-2.0-notice": "licensed under the [[ terms of the ]] gnu general public license [[ as published by the free "
                      "software foundation either ]] version 2",
    "gpl-header": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version {{1}} of the license or [[ at your "
        "option ]] any later version"),
    "lgpl-header": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu {{1}} general "
        "public license as published by the free software foundation"),
    "mpl-2.0-header": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 [[ if a copy of the mpl was "
        "not distributed with this file you can obtain one at {{8}} ]]"),
    "cc-by-notice": "licensed under [[ a ]] [[ the ]] cc by [[ sa ]] [[ nc ]] [[ nd ]] [[ {{2}} ]]",
    "cc-by-nc-notice": "licensed under [[ a ]] [[ the ]] cc by nc",
    "cc-by-text": ("licensed under [[ a ]] [[ the ]] [[ terms of the ]] creative commons attribution [[ noncommercial ]] "
                   "[[ sharealike ]] [[ noderivatives ]] [[ share alike ]] {{3}} license"),
    "spdx-identifier": "spdx license identifier {{1}}",
    "public-domain": "this is free and unencumbered software released into the public domain",
}
_PARTS = re.compile(r"\[\[|\]\]|\{\{\d+\}\}|[a-z0-9]+")


class Automaton:
    """Word automaton of a template.

    ``moves[s]`` maps a word's fingerprint to the next state, ``any[s]`` is
    the state after any word, ``empty[s]`` the states reached without one.
    """

    def __init__(self, template: str, word_id):
        self.moves: list[dict[int, int]] = [{}]
        self.any: list[int | None] = [None]
        self.empty: list[list[int]] = [[]]
        self.lead: list[int] = []
        opened, state, mandatory_start = [], 0, True
        for part in _PARTS.findall(template):
            if part == "[[":
                opened.append(state)
                mandatory_start = False
            elif part == "]]":
                self.empty[opened.pop()].append(state)
            elif part[0] == "{":
                for _ in range(int(part[2:-2])):
                    after = self._state()
                    self.any[state] = after
                    self.empty[state].append(after)
                    state = after
                mandatory_start = mandatory_start and int(part[2:-2]) == 0
            else:
                after = self._state()
                self.moves[state][word_id(part)] = after
                state = after
                if mandatory_start:
                    self.lead.append(word_id(part))
            # an optional region begins in a state of its own, so that leaving it out cannot re-enter another
            if part == "[[" or part == "]]":
                after = self._state()
                self.empty[state].append(after)
                if part == "[[":
                    opened[-1] = state
                state = after
        if not self.lead:
            raise ValueError("a template starts with mandatory words")
        self.end = state

    def _state(self) -> int:
        self.moves.append({})
        self.any.append(None)
        self.empty.append([])
        return len(self.moves) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def accepts(self, words) -> int:
        """Words read at the first acceptance from the first word on, or -1."""
        states = self._closed({0})
        for i, w in enumerate(words):
            if self.end in states:
                return i
            after = {self.moves[s][w] for s in states if w in self.moves[s]}
            after |= {self.any[s] for s in states if self.any[s] is not None}
            if not after:
                return -1
            states = self._closed(after)
        return len(words) if self.end in states else -1


def _fingerprint(word: str) -> int:
    return int(Words([word.encode()], ALNUM).hash[0])


def _places(words: np.ndarray, lead: list[int]) -> np.ndarray:
    """Positions where the words of ``lead`` stand one after the other."""
    n = len(words) - len(lead) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    found = np.flatnonzero(words[:n] == np.uint64(lead[0]))
    for j, w in enumerate(lead[1:], 1):
        found = found[words[found + j] == np.uint64(w)]
    return found


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.phrases = {p: [_fingerprint(w) for w in p.split()] for p in PHRASES}
        self.automata = {label: Automaton(t, _fingerprint) for label, t in templates.items()}

    def scan(self, w: Words, n: int) -> list[tuple]:
        """``(n_words, n_base, first, last, base labels, labels, score)`` of ``n`` consecutive texts."""
        starts = [[] for _ in range(n)]
        base = [set() for _ in range(n)]
        method = [set() for _ in range(n)]
        for phrase, words in self.phrases.items():
            for at, text in self._inside(w, _places(w.hash, words), len(words)):
                starts[text].append(at - int(w.first[text]))
                base[text].add(PHRASES[phrase])
        for label, automaton in self.automata.items():
            for at, text in self._inside(w, _places(w.hash, automaton.lead), len(automaton.lead)):
                if label not in method[text] and automaton.accepts(_Lazy(w.hash, at, int(w.first[text + 1]))) >= 0:
                    method[text].add(label)
        out = []
        for i in range(n):
            s = starts[i]
            out.append((int(w.first[i + 1] - w.first[i]), len(s), min(s, default=None), max(s, default=None),
                        ",".join(sorted(base[i])), ",".join(sorted(base[i] | method[i])),
                        1.0 if method[i] else 0.5 if s else 0.0))
        return out

    @staticmethod
    def _inside(w: Words, places: np.ndarray, size: int):
        """Places whose words are all of one text, with that text."""
        text = np.searchsorted(w.first, places, side="right") - 1
        for at, t in zip(places.tolist(), text.tolist(), strict=True):
            if at + size <= w.first[t + 1]:
                yield at, t


class _Lazy:
    """Words of a range, read one at a time."""

    def __init__(self, words, a, b):
        self.words, self.a, self.b = words, a, b

    def __len__(self):
        return self.b - self.a

    def __iter__(self):
        for i in range(self.a, self.b):
            yield int(self.words[i])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row."""

    def run(batches):
        own = Scanner(templates or TEMPLATES)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            rows = []
            for a, b in parts_of(texts, PART_BYTES):
                rows.extend(own.scan(Words(texts[a:b], ALNUM), b - a))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                "base_labels string, labels string, score double")


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    return scan(table(spark, sf_dir, "documents"))


def _regex(template: str) -> str:
    """The template as a regular expression over words each followed by a space."""
    out = []
    for part in _PARTS.findall(template):
        if part == "[[":
            out.append("(?:")
        elif part == "]]":
            out.append(")?")
        elif part[0] == "{":
            out.append(f"(?:[^ ]+ ){{0,{part[2:-2]}}}")
        else:
            out.append(f"{part} ")
    return " " + "".join(out)


def _sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
    labels = ", ".join(f"CASE WHEN regexp_matches(t, '{_regex(x)}') THEN '{label}' END" for label, x in TEMPLATES.items())
    return f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '{word}') AS w FROM documents),
p(phrase, label, n) AS (VALUES {phrases}),
b AS (SELECT doc_id, label, i - 1 AS pos FROM d, p, unnest(range(1, len(w) - n + 2)) AS t(i)
  WHERE array_to_string(w[i:i + n - 1], ' ') = phrase),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS ls FROM b GROUP BY doc_id),
m AS (SELECT doc_id, list_filter([{labels}], lambda x: x IS NOT NULL) AS ms
  FROM (SELECT doc_id, ' ' || array_to_string(w, ' ') || ' ' AS t FROM d))
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(ls), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(ls, []), ms))), ','), '') AS labels,
  CASE WHEN len(ms) > 0 THEN 1.0::DOUBLE WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN m USING (doc_id)"""


OP3_SQL = _sql()

"""Licence scans: matching statistics against a generalised suffix automaton of licence texts.

Phrases and notice templates are the sequences of the automaton. Each text
streams through it; a place where a whole phrase is a suffix of the match is a
base place of its label. Long matches that follow one another in a template
are chained, and a template of which chains cover enough gives its label too.

Defined results: a null or empty text has no words, no places, empty labels
and score 0; other columns are ignored; every row is scanned by itself.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .batches import Rows, map_batches
from .words import word_bytes

# Phrases that name a licence, and its label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of public licences and of the notices that refer to them, by label.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
}

#: Words of a match that is long enough to be chained.
LONG_MATCH = 5
#: Words a chain may leave out between two matches, in the text and in the template.
MAX_GAP = 8
#: Share of a template that chains must cover for its label.
MIN_COVERAGE = 0.6


class Templates:
    """The automaton with what is needed to place its matches in templates."""

    def __init__(self) -> None:
        self.automaton = SuffixAutomaton()
        self.phrases: dict[int, str] = {}
        self.labels: dict[int, str] = {}
        self.words: dict[int, list[int]] = {}
        self.places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for phrase, label in PHRASES.items():
            self.phrases[self.automaton.add(word_bytes(phrase))] = label
        for label, texts in TEMPLATES.items():
            for words in map(word_bytes, texts):
                number = self.automaton.add(words)
                symbols = [self.automaton.vocabulary[w] for w in words]
                self.labels[number], self.words[number] = label, symbols
                for at in range(len(symbols) - LONG_MATCH + 1):
                    self.places.setdefault(tuple(symbols[at : at + LONG_MATCH]), []).append((number, at))
        self.automaton.close()


@lru_cache(maxsize=1)
def templates() -> Templates:
    return Templates()


def covered(chains: list[tuple[int, int, int]], size: int) -> float:
    """Share of a template that one chain covers; matches are (place in text, place in template, words)."""
    best: list[tuple[int, int, int]] = []  # (text end, template end, words covered)
    most = 0
    for at, place, length in sorted(chains):
        start = 0
        for text_end, template_end, words in best:
            if 0 <= at - text_end <= MAX_GAP and 0 <= place - template_end <= MAX_GAP:
                start = max(start, words)
        most = max(most, start + length)
        best = [b for b in best if at - b[0] <= MAX_GAP] + [(at + length, place + length, start + length)]
    return most / size


def scan_words(words: list[bytes], known: Templates) -> tuple[list[tuple[int, str]], dict[str, float]]:
    """Base places (first word, label) in order, and the best coverage of each label's templates."""
    automaton = known.automaton
    base: list[tuple[int, str]] = []
    matches: dict[int, list[tuple[int, int, int]]] = {}
    for start, symbols in automaton.runs(words, automaton.shortest):
        steps = list(automaton.stream(symbols))
        for end, (state, length) in enumerate(steps, 1):
            for size, number in automaton.whole[state]:
                if size <= length and number in known.phrases:
                    base.append((start + end - size, known.phrases[number]))
            grows = end < len(steps) and steps[end][1] == length + 1
            if length >= LONG_MATCH and not grows:  # the match can't be lengthened to the right
                first = end - length
                for number, at in known.places.get(tuple(symbols[first : first + LONG_MATCH]), ()):
                    if known.words[number][at : at + length] == symbols[first:end]:
                        matches.setdefault(number, []).append((start + first, at, length))
    share: dict[str, float] = {}
    for number, found in matches.items():
        label = known.labels[number]
        share[label] = max(share.get(label, 0.0), covered(found, len(known.words[number])))
    return sorted(base), share


def scan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_coverage: float = MIN_COVERAGE
) -> DataFrame:
    """One row per document: doc_id, n_words, places (first word, label), shares by label, labels, score."""

    def task():
        known = templates()

        def work(rows: Rows) -> Rows:
            out: Rows = {"n_words": [], "places": [], "shares": [], "labels": [], "score": []}
            for body in rows["_text"]:
                words = word_bytes(body)
                base, share = scan_words(words, known)
                named = {label for _, label in base}
                out["n_words"].append(len(words))
                out["places"].append([{"word": at, "label": label} for at, label in base])
                out["shares"].append(sorted(share.items()))
                out["labels"].append(sorted(named | {k for k, v in share.items() if v >= min_coverage}))
                out["score"].append(1.0 if named else min(1.0, max(share.values(), default=0.0)))
            return out

        return work

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    schema = (
        "n_words long, places array<struct<word: bigint, label: string>>, shares map<string, double>, "
        "labels array<string>, score double"
    )
    return map_batches(thin, schema, task, keep=["doc_id"])

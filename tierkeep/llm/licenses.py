"""License scans by matching statistics over a generalised suffix automaton of licence templates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkeep.llm.batches import texts_as_bytes

# Phrases whose every place counts, with their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Passages by which licences are stated, with their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0"),
    ("cc0-1.0", "released under cc0 1 0 universal"),
)

#: Words of a match that counts, words that may lie between matches of a chain, and the share of a
#: template that a chain must cover to give its label.
MATCH, GAP, COVERAGE = 3, 4, 0.8

# A-Z become a-z; digits, a-z and every byte of a longer character stay; all else parts words.
_FOLD = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """All substrings of several word sequences; a state holds those that end at the same places.

    ``ends`` lists these places per state as (sequence, index of the last word).
    """

    def __init__(self, sequences: Sequence[Sequence[bytes]]):
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, words in enumerate(sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extended(last, word)
                self.ends[last].add((number, place))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def _state(self, length: int, link: int, step: dict[bytes, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, word: bytes, child: int) -> int:
        """The state of the strings through ``state`` and ``word`` alone, parted from longer ones."""
        if self.length[child] == self.length[state] + 1:
            return child
        parted = self._state(self.length[state] + 1, self.link[child], dict(self.step[child]))
        self.link[child] = parted
        while state >= 0 and self.step[state].get(word) == child:
            self.step[state][word] = parted
            state = self.link[state]
        return parted

    def _extended(self, last: int, word: bytes) -> int:
        if word in self.step[last]:
            return self._split(last, word, self.step[last][word])
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.step[state][word])
        return new

    def statistics(self, words: Iterable[tuple[int, bytes]]):
        """(place, state, length) of the longest match that ends at each place; places must rise.

        Words without a transition from the root may be left out: a jump in places ends a match.
        """
        state = length = 0
        expected = 0
        for place, word in words:
            if place != expected:
                state = length = 0
            expected = place + 1
            while state and word not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.step[state]:
                state = self.step[state][word]
                length += 1
            yield place, state, length


@dataclass(frozen=True)
class Scanner:
    """An automaton of phrases and templates, and what its sequences stand for."""

    automaton: Automaton
    sequences: tuple[tuple[bytes, ...], ...]
    labels: tuple[str, ...]
    n_base: int
    base_ends: tuple[tuple[tuple[int, int], ...], ...]

    def scan(self, text: bytes) -> dict[str, object]:
        """Counts, places, labels and template spans of one whole text."""
        words = words_of(text)
        known = self.automaton.step[0]
        stream = [(i, w) for i, w in enumerate(words) if w in known]
        places: list[tuple[int, int]] = []  # (start, base phrase)
        matches: list[tuple[int, int, int]] = []  # (end, state, length), none of which can be extended
        before = (-1, 0, 0)
        for place, state, length in self.automaton.statistics(stream):
            if before[2] >= MATCH and not (place == before[0] + 1 and length == before[2] + 1):
                matches.append(before)
            before = (place, state, length)
            for number, end in self.base_ends[state]:
                if length > end:
                    places.append((place - end, number))
        if before[2] >= MATCH:
            matches.append(before)
        spans = self._spans(matches)
        base = {self.labels[number] for _, number in places}
        more = {label for label, _, _, covered in spans if covered >= COVERAGE}
        starts = [start for start, _ in places]
        whole = 1.0 if places else 0.0
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | more)),
            "score": max([whole, *(covered for *_, covered in spans)]),
            "spans": [s for s in spans if s[3] >= COVERAGE],
        }

    def _spans(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Chains of matches in template order, as (label, first word, last word, share covered).

        One chain per template is open at a time; a match joins it if it lies at most ``GAP`` words
        behind in the text and further on in the template, else the chain ends and a new one starts.
        So the work grows with the number of matches, however often a licence is repeated.
        """
        done: list[tuple[str, int, int, float]] = []
        chains: dict[int, list[int]] = {}  # template: first word, last word, last template place, words covered

        def close(number: int) -> None:
            first, last, _, covered = chains.pop(number)
            done.append((self.labels[number], first, last, covered / len(self.sequences[number])))

        for end, state, length in matches:
            start = end - length + 1
            options: dict[int, list[int]] = {}
            for number, place in self.automaton.ends[state]:
                if number >= self.n_base:
                    options.setdefault(number, []).append(place)
            for number, found in options.items():
                chain = chains.get(number)
                if chain is not None:
                    # matches may overlap in the text or in the template: only what is new counts
                    further = [p for p in found if p > chain[2]]
                    if start - chain[1] - 1 <= GAP and further and end > chain[1]:
                        place = min(further)
                        new = min(length, place - chain[2], end - chain[1])
                        chains[number] = [chain[0], end, place, chain[3] + new]
                        continue
                    close(number)
                chains[number] = [start, end, min(found), length]
        for number in list(chains):
            close(number)
        return sorted(done, key=lambda s: (s[1], s[2], s[0]))


def built(base: Mapping[str, str] = BASE_PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES) -> Scanner:
    """A scanner for base phrases (with labels) and templates (label, passage); its size is that of these texts."""
    named = [(label, phrase) for phrase, label in base.items()] + list(templates)
    sequences = tuple(tuple(words_of(phrase.encode())) for _, phrase in named)
    automaton = Automaton(sequences)
    ends: list[set[tuple[int, int]]] = [set() for _ in automaton.link]
    for state in sorted(range(1, len(ends)), key=automaton.length.__getitem__):
        # a whole phrase may be a suffix of what the state holds
        own = {(n, e) for n, e in automaton.ends[state] if n < len(base) and e == len(sequences[n]) - 1 < automaton.length[state]}
        ends[state] = own | ends[automaton.link[state]]
    return Scanner(automaton, sequences, tuple(label for label, _ in named), len(base), tuple(tuple(sorted(e)) for e in ends))


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    """The scanner of the fixed phrases and templates, built once per worker."""
    return built()


_SPAN = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("coverage", T.DoubleType()),
    ]
)
SCAN = T.StructType(
    [
        *(T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(_SPAN)),
    ]
)


@F.arrow_udf(SCAN)
def _scan(texts: pa.Array) -> pa.Array:
    found = scanner()
    rows = [found.scan(t) for t in texts_as_bytes(texts)]
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("coverage", pa.float64())])
    keys = ("label", "first_word", "last_word", "coverage")
    columns = {
        **{k: pa.array([r[k] for r in rows], pa.int64()) for k in ("n_words", "n_base", "first_word", "last_word")},
        **{k: pa.array([r[k] for r in rows], pa.string()) for k in ("base_labels", "labels")},
        "score": pa.array([r["score"] for r in rows], pa.float64()),
        "spans": pa.array([[dict(zip(keys, s)) for s in r["spans"]] for r in rows], pa.list_(span)),
    }
    return pa.StructArray.from_arrays(list(columns.values()), names=list(columns))


def scanned(docs: DataFrame, name: str = "scan") -> DataFrame:
    """``docs`` with a struct of what the whole ``text`` says about its licence.

    ``n_base`` counts every place of a base phrase, ``first_word`` and ``last_word`` are the
    smallest and largest of their starts (NULL without any); ``base_labels`` and ``labels`` (with
    the templates') are distinct, sorted and comma-joined, empty if there are none; ``score`` is
    the largest share of a template, or of a base phrase, that was found; ``spans`` lists chains
    that cover at least 80 % of a template. NULL and empty texts have no words. Documents are
    scanned where they lie; nothing is shuffled. No documents give no rows.
    """
    return docs.withColumn(name, _scan(F.col("text")))

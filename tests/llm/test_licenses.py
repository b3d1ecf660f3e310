from __future__ import annotations

import random
import re

from tierkeep.llm import licenses
from tierkeep.llm.licenses import Automaton, built, scanned, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def places(text: str) -> list[tuple[int, str]]:
    words = WORD.findall(lower(text))
    return [
        (i, label)
        for phrase, label in licenses.BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]


def test_words_are_those_of_the_pattern():
    text = "Ab-c Ünï_9 İx\x00y…z ÀÉ a,b"
    assert [w.decode() for w in words_of(text.encode())] == WORD.findall(lower(text))


def test_matching_statistics_equal_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        sequences = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 4))]
        text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)]
        parts = {tuple(s[i:j]): None for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        automaton = Automaton(sequences)
        for place, state, length in automaton.statistics(enumerate(text)):
            longest = max((n for n in range(place + 2) if tuple(text[place + 1 - n : place + 1]) in parts), default=0)
            assert length == longest
            if length:
                found = text[place + 1 - length : place + 1]
                ends = {(k, e) for k, s in enumerate(sequences) for e in range(len(s)) if s[max(0, e + 1 - length) : e + 1] == found}
                assert automaton.ends[state] == ends


def test_base_counts_equal_brute_force():
    rng = random.Random(2)
    vocabulary = "cc by general public license all rights reserved the gnu mit licensed under version 3 nc x".split()
    scan = built()
    for _ in range(300):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
        got, wanted = scan.scan(text.encode()), places(text)
        starts = [i for i, _ in wanted]
        assert got["n_base"] == len(wanted)
        assert (got["first_word"], got["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert got["base_labels"] == ",".join(sorted({label for _, label in wanted}))
        assert set(got["base_labels"].split(",")) <= set(got["labels"].split(",")) | {""}
        assert 0 <= got["score"] <= 1


def test_templates_with_gaps():
    got = built().scan(b"foo. Licensed under the (well known) Apache License, Version 2.0! bar")
    assert got["labels"] == "apache-2.0" and got["base_labels"] == ""
    assert built().scan(b"the apache license")["labels"] == ""
    assert built().scan(b"This work is licensed under the GNU General Public License, version 3.")["labels"] == "gpl,gpl-3.0"


def test_edges(spark, edge, nothing):
    rows = scanned(edge, "found").collect()
    assert len(rows) == edge.count()
    by = {(r.doc_id, r.text): r.found for r in rows}
    assert by[(3, None)].n_words == 0 and by[(4, "")].labels == "" and by[(4, "")].first_word is None
    assert by[(None, "All rights reserved. Grüße an alle")].labels == "reserved"
    assert scanned(nothing, "found").count() == 0


def test_whole_table(spark, read):
    for row in scanned(read("documents"), "found").collect():
        assert row.found.n_base == len(places(row.text or ""))

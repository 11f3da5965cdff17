"""The fuzzy search against edit distances counted over every stretch of words; neighbouring and partial notices."""

import random

import pytest

from docsift.llm import licenses as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, before + (x != y))
    return row[-1]


def close(joined, phrase, edits):
    """Whether a stretch of whole words is at most ``edits`` from the phrase."""
    starts = [i for i in range(len(joined)) if i == 0 or joined[i - 1] == " "]
    ends = [j for j in range(1, len(joined) + 1) if j == len(joined) or joined[j] == " "]
    return any(abs(j - i - len(phrase)) <= edits and distance(joined[i:j], phrase) <= edits for i in starts for j in ends if j > i)


def mangled(rng, text, n):
    for _ in range(n):
        i, kind = rng.randrange(len(text)), rng.randrange(3)
        text = text[:i] + rng.choice("abcxyz 1")[:kind > 0] + text[i + (kind < 2):]
    return text


@pytest.mark.parametrize("seed", range(6))
def test_fuzzy_labels_are_those_of_edit_distances(seed):
    rng = random.Random(seed)
    short = {p: v for p, v in L.FUZZY.items() if len(p) < 40}
    for _ in range(12):
        parts = [mangled(rng, p, rng.randint(0, 3)) if rng.random() < 0.7 else rng.choice(["the", "license", "general public", "mit"])
                 for p in rng.sample(sorted(short), 3)]
        words = L.alnum_words(" ".join(parts).encode())
        joined = b" " + b" ".join(words) + b" "
        found = {s.label for s in L.fuzzy_spans(joined)}
        long = {label for p, (label, e) in L.FUZZY.items() if p not in short and close(joined.decode(), p, e)}
        assert found == {label for p, (label, e) in short.items() if close(joined.decode(), p, e)} | long, joined


@pytest.mark.parametrize("text, labels", [
    ("released under the ISC license", {"isc"}), ("SPDX-License-Identifier: LGPL-2.1", {"lgpl"}), ("GPLv3 or later", {"gpl"}),
    ("// SPDX-License-Identifier: Apache-2.0", {"apache"}), ("Mozila Public Licence", {"mpl"}), ("a general licence", set()),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", {"mit"})])
def test_usual_notices(text, labels):
    assert {s.label for s in L.scan(text.encode())[2]} == labels


def test_neighbouring_notices_are_all_reported():
    _, base, fuzzy = L.scan(b"apche license apache license")
    assert [(s.start_word, s.edits) for s in fuzzy] == [(0, 1), (2, 0)] and [s.start_word for s in base] == [2]


def test_spans_are_part_of_the_report(spark):
    df = spark.createDataFrame([(1, "x mit licence y"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in L.report(df).collect()}
    assert got == {1: [("mit", 1, 2, 1, "mit licence")], 2: []}

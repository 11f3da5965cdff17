"""License scan: exact phrases, and fuzzy ones by pigeonhole seeds and bounded-error matching.

Words are lower-cased alphanumeric runs, joined by single spaces. A *base* place is
where a phrase's words stand consecutively. For the fuzzy search a phrase of which
``edits`` characters may differ is cut into ``edits + 1`` pieces: whatever match
there is holds one piece unchanged, so exact searches for the pieces find all
candidates; the ``regex`` library then matches the phrase with at most that many
errors around each candidate, and reports the span and its edits.

Defined cases: null or empty text has no words, no places, empty labels and score
0; null doc_id, repeated rows and other columns pass untouched; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.words import alnum_words, small, utf8

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Short notices, their label and the edits allowed in them.
FUZZY = {
    "gnu general public license": ("gpl", 2),
    "gplv2": ("gpl", 0),
    "gplv3": ("gpl", 0),
    "lesser general public license": ("lgpl", 2),
    "library general public license": ("lgpl", 2),
    "lgplv2": ("lgpl", 0),
    "lgplv3": ("lgpl", 0),
    "affero general public license": ("agpl", 2),
    "agplv3": ("agpl", 0),
    "apache license": ("apache", 2),
    "licensed under the apache license version 2 0": ("apache", 3),
    "mit license": ("mit", 1),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 4),
    "bsd 3 clause": ("bsd", 1),
    "bsd 2 clause": ("bsd", 1),
    "redistribution and use in source and binary forms with or without modification are permitted": ("bsd", 4),
    "isc license": ("isc", 1),
    "permission to use copy modify and or distribute this software for any purpose": ("isc", 4),
    "mozilla public license": ("mpl", 2),
    "eclipse public license": ("epl", 2),
    "european union public licence": ("eupl", 2),
    "common development and distribution license": ("cddl", 3),
    "boost software license": ("boost", 2),
    "zlib license": ("zlib", 1),
    "artistic license": ("artistic", 1),
    "free and unencumbered software released into the public domain": ("unlicense", 4),
    "creative commons attribution": ("cc-by", 2),
    "attribution sharealike": ("cc-by-sa", 2),
    "attribution noncommercial": ("cc-by-nc", 2),
    "cc0 1 0 universal": ("cc0", 1),
    "all rights reserved": ("proprietary", 1),
}
#: Identifiers after ``SPDX-License-Identifier:``, as words, and their labels.
SPDX = {
    "agpl 3 0": "agpl",
    "apache 2 0": "apache",
    "artistic 2 0": "artistic",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "bsl 1 0": "boost",
    "cc by 4 0": "cc-by",
    "cc by nc 4 0": "cc-by-nc",
    "cc by sa 4 0": "cc-by-sa",
    "cc0 1 0": "cc0",
    "cddl 1 0": "cddl",
    "epl 2 0": "epl",
    "eupl 1 2": "eupl",
    "gpl 2 0": "gpl",
    "gpl 3 0": "gpl",
    "isc": "isc",
    "lgpl 2 1": "lgpl",
    "lgpl 3 0": "lgpl",
    "mit": "mit",
    "mpl 2 0": "mpl",
    "unlicense": "unlicense",
    "zlib": "zlib",
}
FUZZY |= {f"spdx license identifier {name}": (label, 0) for name, label in SPDX.items()}


class Span(NamedTuple):
    label: str
    start_word: int
    n_words: int
    edits: int
    text: str


_SPAN = pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64()),
                   ("text", pa.string())])


def seeds(phrase: str, edits: int) -> list[tuple[bytes, int]]:
    """``edits + 1`` pieces that make up the phrase, with their offsets."""
    bounds = [len(phrase) * i // (edits + 1) for i in range(edits + 2)]
    return [(phrase[a:b].encode(), a) for a, b in zip(bounds, bounds[1:])]


@cache
def _fuzzy() -> list:
    return [(phrase, label, edits, seeds(phrase, edits),
             regex.compile(rb"(?e)(?<![^ ])(?:%s){e<=%d}(?![^ ])" % (phrase.encode(), edits)))
            for phrase, (label, edits) in FUZZY.items()]


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Starts in ``joined`` (words with a space before and after each) of the phrase's places."""
    out, at = [], joined.find(b" " + phrase + b" ")
    while at >= 0:
        out.append(at + 1)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return out


def _word(joined: bytes, at: int) -> int:
    return joined.count(b" ", 0, at) - 1


def exact_spans(joined: bytes) -> list[Span]:
    return [Span(label, _word(joined, at), phrase.count(" ") + 1, 0, phrase)
            for phrase, label in BASE.items() for at in places(joined, phrase.encode())]


def fuzzy_spans(joined: bytes) -> list[Span]:
    out = []
    for phrase, label, edits, pieces, pattern in _fuzzy():
        windows = []
        for piece, offset in pieces:
            at = joined.find(piece)
            while at >= 0:
                windows.append((max(0, at - offset - edits - 1), at - offset + len(phrase) + edits + 1))
                at = joined.find(piece, at + 1)
        windows.sort()
        end = -1
        for i, (a, b) in enumerate(windows):
            if i + 1 < len(windows) and windows[i + 1][0] <= b:     # joined to the next
                windows[i + 1] = (a, max(b, windows[i + 1][1]))
                continue
            for m in pattern.finditer(joined, max(a, end), min(b, len(joined))):
                text = m.group()
                start = m.start() + len(text) - len(text.lstrip())
                out.append(Span(label, _word(joined, start), len(text.split()), sum(m.fuzzy_counts),
                                text.strip().decode(errors="replace")))
                end = m.end()
    return out


def scan(text: bytes) -> tuple[int, list[Span], list[Span]]:
    """Number of words, base spans, fuzzy spans."""
    words = alnum_words(text)
    joined = b" " + b" ".join(words) + b" "
    return len(words), exact_spans(joined), fuzzy_spans(joined)


def _score(base: list[Span], fuzzy: list[Span]) -> float:
    if base:
        return 1.0
    return max((1 - s.edits / max(1, len(s.text)) for s in fuzzy), default=0.0)


def _labels(spans: list[Span]) -> str:
    return ",".join(sorted({s.label for s in spans}))


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        rows = []
        for text in utf8(batch["text"]):
            n, base, fuzzy = scan(text)
            starts = [s.start_word for s in base]
            rows.append((n, len(base), min(starts, default=None), max(starts, default=None),
                         _labels(base), _labels(base + fuzzy), _score(base, fuzzy), [s._asdict() for s in fuzzy]))
        columns = list(zip(*rows)) or [()] * 8
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(_SPAN)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its base places, labels and score, and the spans of the fuzzy search with their edits."""
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(
        _report, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                 "base_labels string, labels string, score double, "
                 "spans array<struct<label string, start_word bigint, n_words bigint, edits bigint, text string>>")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        found = [[{"kind": kind, **s._asdict()} for kind, spans in zip(("base", "fuzzy"), scan(text)[1:])
                  for s in spans] for text in utf8(batch["text"])]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("start_word", pa.int64()),
                                   ("n_words", pa.int64()), ("edits", pa.int64()), ("text", pa.string())]))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, kind)], ["doc_id", "spans"])


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, kind (base or fuzzy), label, start_word, n_words, edits, text of every span found."""
    found = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(
        _spans, "doc_id bigint, spans array<struct<kind string, label string, start_word bigint, n_words bigint, "
                "edits bigint, text string>>")
    return found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")

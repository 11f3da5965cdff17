"""Rule, extractor and rule-bank specs.

A rule is a *trigger* over the requested field (name and description) plus the
id of an *extractor* over the document text. Triggers never look at the text and
extractors never look at the field, so the per-field work is a cheap string
test and each extractor runs at most once per document, however many fields
share it.

An extractor is data, not code: an ordered list of regex alternatives (the first
that matches wins) with optional gates. The engine turns it into one Spark
expression so that every regex is evaluated at most once per row and only when
the earlier alternatives found nothing (:mod:`docsift.operators.engine`).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

Trigger = Callable[["FieldView"], Column]


@dataclass(frozen=True)
class FieldView:
    """Case-folded views of one requested field, computed once per field."""

    lower: Column
    upper: Column
    desc_upper: Column
    desc: Column


@dataclass(frozen=True)
class Alt:
    """One regex alternative.

    ``group``: capture group returned (0 = whole match). ``gate``: ``(pattern, flags)``
    that must occur in the text for this alternative to be tried (tested lazily,
    only when the earlier alternatives missed). ``many``: all matches, left to right
    (``re.findall``), handed to ``finish``. ``strip``: Python ``str.strip()`` on the
    value. ``finish``: Column -> Column applied last (to the array when ``many``).

    ``java``: the same matches written so that Java's engine loops instead of
    recursing: greedy repetition of a group costs Java a stack frame per repetition,
    and a long enough run would end the executor; possessive repetition does not.
    """

    pattern: str
    flags: str = ""
    group: int = 1
    gate: tuple[str, str] | None = None
    many: bool = False
    strip: bool = False
    finish: Callable[[Column], Column] | None = None
    java: str | None = None


def whole_word(pattern: str, first: str = "") -> str:
    r"""For Java (see ``Alt.java``): ``\b…\b`` around a pattern that begins and ends with a word character in every match.

    There a boundary is a word's end that looks one way only. ``first``: what every match begins with, looked at first.
    """
    assert pattern.startswith(r"\b") and pattern.endswith(r"\b")
    return (f"(?={first})" if first else "") + rf"(?<!\w){pattern[2:-2]}(?!\w)"


@dataclass(frozen=True)
class Extractor:
    """Ordered alternatives; ``gate`` must occur for any of them to be tried."""

    alts: tuple[Alt, ...]
    gate: tuple[str, str] | None = None


@dataclass(frozen=True)
class Rule:
    name: str
    trigger: Trigger
    extractor: str          # id of an entry in the extractor registry


@dataclass(frozen=True)
class RuleBank:
    """An ordered trigger cascade: the first rule whose trigger holds owns the field.

    Once a rule owns a field, later rules of the same bank are not tried even if
    its extractor finds nothing (the generic bank may still fill the field).
    ``label_keyword`` routes documents to the bank (``None`` for the generic bank).
    """

    family: str
    label_keyword: str | None
    rules: tuple[Rule, ...]


def name_has_any(*words: str) -> Trigger:
    """Lower-cased field name contains any of ``words`` (substring test, not LIKE)."""

    def trig(f: FieldView) -> Column:
        out = f.lower.contains(words[0])
        for w in words[1:]:
            out = out | f.lower.contains(w)
        return out

    return trig


def name_has_all(*words: str, without: tuple[str, ...] = ()) -> Trigger:
    """Lower-cased field name contains every word in ``words`` and none in ``without``."""

    def trig(f: FieldView) -> Column:
        out = f.lower.contains(words[0])
        for w in words[1:]:
            out = out & f.lower.contains(w)
        for w in without:
            out = out & ~f.lower.contains(w)
        return out

    return trig


def both(a: Trigger, b: Trigger) -> Trigger:
    return lambda f: a(f) & b(f)

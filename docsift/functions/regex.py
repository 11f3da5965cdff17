"""Regex helpers that keep extraction inside Spark's built-in string functions.

Rule patterns are written in the notation of Python's ``re`` module, which is
Unicode-aware by default. Java's ``java.util.regex`` (what ``regexp_extract``
runs on) is not, so every pattern gets an inline flag prefix:

* ``U`` - Unicode character classes: ``\\d`` sees non-ASCII digits, and ``(?i)``
  folds ``ç``/``Ç``;
* ``d`` - Unix lines: only ``\\n`` ends a line for ``.`` and ``$``, as in Python;
* ``i`` / ``s`` - ignore case / dot matches newline, when the rule asks for them.

What still differs is written out: Python's word characters are letters, numbers
of any kind and ``_`` (Java's would add combining marks and leave out ``²``), its
``\\b`` is a change between those and anything else, and its ``\\s`` also holds the
separators U+001C..U+001F.

All helpers return ``Column`` expressions; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"\p{L}\p{N}_"
_SPACE = r"\s\x1c-\x1f"
_OUTSIDE = {   # escape -> what it is outside a character class
    "w": f"[{_WORD}]", "W": f"[^{_WORD}]", "s": f"[{_SPACE}]", "S": f"[^{_SPACE}]",
    "b": f"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))",
    "B": f"(?:(?<=[{_WORD}])(?=[{_WORD}])|(?<![{_WORD}])(?![{_WORD}]))",
}
_INSIDE = {"w": _WORD, "s": _SPACE}

# Python's str.strip() removes every character for which str.isspace() holds: the same as \s.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def python_classes(pattern: str) -> str:
    """``pattern`` with Python's ``\\w``, ``\\s`` and ``\\b`` spelled out for Java."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            e = pattern[i + 1]
            if inside and e in "WSB":
                raise ValueError(f"unsupported in a character class: \\{e}")
            out.append((_INSIDE if inside else _OUTSIDE).get(e, c + e))
            i += 2
            continue
        if c == "[" and not inside:
            inside = True
        elif c == "]" and inside:
            inside = False
        out.append(c)
        i += 1
    return "".join(out)


def rx(pattern: str, flags: str = "") -> str:
    """Return ``pattern`` with the Java flag prefix for the given rule flags.

    ``flags`` is a subset of ``"is"`` (ignore case, dot-all).
    """
    bad = set(flags) - set("is")
    if bad:
        raise ValueError(f"unsupported regex flags: {sorted(bad)}")
    return f"(?{''.join(sorted(flags))}Ud){python_classes(pattern)}"


def found(text: Column, pattern: str, flags: str = "") -> Column:
    """True when ``pattern`` occurs anywhere in ``text``."""
    return text.rlike(rx(pattern, flags))


def strip(value: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace.

    Spark's ``trim`` alone removes only the ASCII space, so it is given all these characters.
    A null stays null; whitespace only becomes ``''``, which still counts as found.
    """
    return F.btrim(value, F.lit(_SPACES))

"""Words of whole texts, on UTF-8 bytes: separators are ASCII, so bytes above 0x7F belong to words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc

from docsift.llm.worker import begin

_UPPER = range(0x41, 0x5B)
#: Lower-cases A-Z; every other ASCII byte but digits and letters becomes a space.
ALNUM = bytes(b + 32 if b in _UPPER else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))
#: The same, with digits as spaces too.
LETTERS = bytes(0x20 if 0x30 <= b <= 0x39 else c for b, c in enumerate(ALNUM))
#: Lower-cases A-Z, else as it is.
LOWER = bytes(b + 32 if b in _UPPER else b for b in range(256))


def small(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that few texts are Python objects at a time."""
    begin()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """A text column as UTF-8 bytes, null as empty."""
    return pc.fill_null(column.cast(pa.string()), "").cast(pa.binary()).to_pylist()


def alnum_words(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()

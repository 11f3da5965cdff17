"""What a Python worker keeps from one task to the next: tables, for as long as the tasks of one stage run.

Spark uses its Python workers again for later stages. What a stage kept there would stay, and the workers of
a long job would hold the tables of all its stages; so the first task of another stage gives them up.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark import TaskContext

_kept: dict[Any, Any] = {}
_stage: list[int | None] = [None]


def begin() -> None:
    """To be called where a task's work begins."""
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if stage != _stage[0]:
        _stage[0] = stage
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gave when it was first called for ``key`` in this stage."""
    begin()
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]

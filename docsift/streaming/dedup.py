"""Arrivals with an event time, each once.

A source that delivers at least once repeats jobs now and then. Within ``delay`` of its
event time a repeated arrival is dropped by key. State for a key is given up once the
watermark has passed its event time by ``delay``, so it is bounded by the arrivals of that
time and not by all that ever came. What comes later than the watermark is dropped as
late, repeated or not; so ``delay`` has to cover how late a first arrival can be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_arrivals(stream: DataFrame, key: list[str], event_time: str, delay: str) -> DataFrame:
    """The first arrival of each key; ``event_time``: a timestamp column, ``delay``: an interval such as ``1 hour``."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)

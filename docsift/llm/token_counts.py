"""Token counts with the whole-token shortcut.

Before the job, the driver proves which vocabulary strings encode alone as
exactly one token (``tokens.whole_tokens``; bounded by the vocabulary) and
broadcasts them. In the tasks a pre-token that is such a string counts 1 without
any merging; only the rest goes through the library's merges, once per distinct
unit. One narrow pass, no shuffle.

Defined cases: null text counts as empty (0 bytes, 0 tokens); special strings
inside texts are one token, as the library's default has it; null doc_id,
repeated rows and other columns pass through untouched; empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from docsift.llm import tokens
from docsift.llm.words import small
from docsift.llm.worker import kept

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs(doc_id, text)``."""
    whole = docs.sparkSession.sparkContext.broadcast(tokens.whole_tokens(tokenizer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(("counts", tokenizer), lambda: tokens.ByteLevel(tokenizer, len, dict.fromkeys(whole.value, 1)))
        for batch in small(batches):
            text = pc.fill_null(batch["text"].cast(pa.string()), "")
            texts, counts = text.to_pylist(), []
            for part in tokens.slices(texts):
                counts += map(sum, counter.values(texts[part]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pc.binary_length(text).cast(pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(count, SCHEMA)

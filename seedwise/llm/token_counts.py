"""Token counts at every prefix of every text.

Method: prefix dynamic programming. ``count(text[:i])`` is kept for every code point i
as the step from ``i - 1`` to ``i`` (16 bits); the count at a word's start plus the
count of the word's prefix gives each entry, and long runs are filled by the last-token
recurrence (:class:`seedwise.llm.tokens.RunCounter`). Truncation and budget questions
are then sums and searches over the steps: nothing is encoded again.

One pass, no shuffle: each task holds one Arrow batch and a bounded table of words.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import text_or_empty, utf8_column
from seedwise.llm.tokens import PrefixSteps, groups, per_process

SCHEMA = "n_bytes long, n_chars long, n_tokens long, chars_in_limit long, prefix_steps binary"


def prefix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  limit: int = 2048, vocabulary: str | None = None,
                  keep_steps: bool = True) -> DataFrame:
    """Per row: ``id_col``, ``n_bytes`` (UTF-8), ``n_chars`` (code points), ``n_tokens``,
    ``chars_in_limit`` (longest prefix that no longer prefix within ``limit`` tokens
    exceeds) and ``prefix_steps`` (one signed 16-bit little-endian step per code point;
    null unless ``keep_steps``).

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted one by one,
    a null id is passed on, an empty table gives no rows; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        table = per_process(PrefixSteps, vocabulary)
        for batch in batches:
            raws = utf8_column(batch, "_text")
            for lo, hi in groups(raws):
                rows = []
                for raw, steps in zip(raws[lo:hi], table.of_texts(raws[lo:hi])):
                    counts = np.frombuffer(steps, dtype="<i2")
                    total = int(counts.sum(dtype=np.int64))
                    inside = len(counts) if total <= limit and len(counts) < limit \
                        else longest_within(counts, limit)
                    rows.append((len(raw), len(counts), total, inside,
                                 steps if keep_steps else None))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo)]
                    + [pa.array(c, pa.int64()) for c in cols[:4]]
                    + [pa.array(cols[4], pa.binary())],
                    names=["_id", "n_bytes", "n_chars", "n_tokens", "chars_in_limit",
                           "prefix_steps"])

    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(run, f"_id {id_type}, {SCHEMA}").withColumnRenamed("_id", id_col)


def longest_within(steps, budget: int) -> int:
    """Length in code points of the longest prefix of at most ``budget`` tokens."""
    import numpy as np
    counts = np.cumsum(steps, dtype=np.int64)
    inside = np.flatnonzero(counts <= budget)
    return int(inside[-1]) + 1 if len(inside) else 0


def count_at(steps: bytes, position: int) -> int:
    """Token count of the first ``position`` code points."""
    import numpy as np
    return int(np.frombuffer(steps, dtype="<i2", count=position).sum(dtype=np.int64))


def token_counts(docs: DataFrame, limit: int = 2048, vocabulary: str | None = None) -> DataFrame:
    """Digest of :func:`prefix_counts`: bytes, tokens and whether the text is over ``limit``."""
    counted = prefix_counts(docs, limit=limit, vocabulary=vocabulary, keep_steps=False)
    return counted.select("doc_id", "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"), "chars_in_limit")

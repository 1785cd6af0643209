"""Quality rules on lines: text statistics and cross-document line frequency.

Method: every line with a word is normalised (lower case, digits as 0, words joined by
one space) and hashed; distinct documents are counted per (host, line). Lines in more
documents of a host than the limit are removed, and a document is rejected when too few
of its words are left. Exact copies of a text within a host count as one document, so
the copies of a good page do not reject each other.

One pass of Python turns each text into a small row (counts and its distinct lines as
64-bit hashes); the rest is DataFrame work on these. Counts are pre-aggregated before
each shuffle, so a line in a third of all documents is one key with few partial rows. The frequent lines
are broadcast up to a checked size; above it they are joined with hot lines salted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import stage, text_or_empty, utf8_column
from seedwise.operators.joins import lookup_join

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
WINDOW = 8
_DIGITS = bytes.maketrans(b"0123456789", b"0" * 10)
_SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class LineLimits:
    """A line is removed when it is in more documents of its host than ``documents``, however
    many the host has; a document is rejected when removal leaves fewer than ``kept_share``
    of its words."""
    documents: int = 10
    kept_share: float = 0.3
    min_words: int = 20
    max_repeat_percent: int = 30


def repeated_words(tokens: list[bytes]) -> int:
    """Words inside 8-word windows that occur at least twice in the text."""
    import numpy as np
    n = len(tokens) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, tokens), dtype=np.int64, count=len(tokens)).view(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    key = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        key = key * np.uint64(0xD6E8FEB86659FD93) + h[i:i + n]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(tokens) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def normalised(tokens: list[bytes]) -> bytes:
    return b" ".join(tokens).lower().translate(_DIGITS)


def text_statistics(raw: bytes) -> tuple[tuple[int, ...], dict[int, int]]:
    """The counts of one text, and for each distinct normalised line (64-bit hash) the
    words of all its occurrences."""
    import xxhash
    tokens = raw.split()
    chars = len(b"".join(tokens).decode("utf-8", "replace"))
    seen: set[bytes] = set()
    dup = 0
    lines: dict[int, int] = {}
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            continue
        if line in seen:
            dup += 1
        else:
            seen.add(line)
        h = xxhash.xxh64_intdigest(normalised(own))
        h -= (h >> 63) << 64
        lines[h] = lines.get(h, 0) + len(own)
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return (len(tokens), chars, symbols, dup, repeated_words(tokens)), lines


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               host_col: str = "source") -> DataFrame:
    """One small row per document: id, host, the statistics, a hash of the text, and its
    distinct lines as array<struct<line: long, words: long>>."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        pair = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
        for batch in batches:
            rows, lines, texts = [], [], []
            for raw in utf8_column(batch, "_text"):
                stats, own = text_statistics(raw)
                rows.append(stats)
                lines.append([{"line": h, "words": n} for h, n in own.items()])
                h = xxhash.xxh64_intdigest(raw)
                texts.append(h - ((h >> 63) << 64))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)] + [pa.array(c, pa.int64()) for c in cols]
                + [pa.array(texts, pa.int64()), pa.array(lines, pair)],
                names=["_id", "host", *re.findall(r"(\w+) long", STATS), "text_hash", "lines"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(host_col).cast("string").alias("host"),
                       text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(run, f"_id {id_type}, host string, {STATS}, text_hash long, "
                                "lines array<struct<line: long, words: long>>")


def frequent_lines(table: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """(host, line) found in too many distinct documents of the host."""
    return (table.select("host", "text_hash", F.explode("lines.line").alias("line")).distinct()
            .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
            .where(F.col("n_docs") > limits.documents))


def line_rules(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, and n_removed_words (words on removed lines).

    A null text has no words and fails the base rule; a null source is one host; repeated
    rows are judged each; an empty table gives no rows; other columns are not read.
    """
    table = stage(line_table(docs).withColumn("_row", F.monotonically_increasing_id()), "lines")
    frequent = stage(frequent_lines(table, limits).select("host", "line"), "frequent-lines")
    lines = table.select("_row", "host", F.explode("lines").alias("l")) \
        .select("_row", "host", "l.line", "l.words")
    removed = (lookup_join(lines, frequent, ["host", "line"], frequent.count(), how="inner",
                           null_safe=["host"], salt_from="_row")
               .groupBy("_row").agg(F.sum("words").alias("_removed")))
    out = table.drop("lines").join(removed, "_row", "left")
    n, gone = F.col("n_words"), F.coalesce(F.col("_removed"), F.lit(0))
    failed = (n < limits.min_words) | (F.lit(100) * F.col("n_repeat_words")
                                       > F.lit(limits.max_repeat_percent) * n)
    kept = ~failed & ((n - gone) >= F.lit(limits.kept_share) * n)
    return out.select(F.col("_id").alias("doc_id"), n, "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", failed.alias("base_failed"), kept.alias("kept"),
                      gone.cast("long").alias("n_removed_words"))

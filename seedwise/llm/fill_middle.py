"""Fill-in-the-middle examples by in-place block rotation.

Method: the two cuts (code points, drawn from a hash of the id) are turned into byte
offsets by scanning the text's character starts. The sentinels are inserted into a
bytearray in reading order, ``<P>`` prefix ``<M>`` middle ``<S>`` suffix, and blocks are
exchanged in place, each exchange being three reversals: (middle, suffix) for the form
psm, (prefix and middle, suffix) for spm. Restoring finds the sentinels, undoes the
rotation with the cut on the other side, and takes the sentinels out.

A text that holds a sentinel stays plain, so each sentinel occurs exactly once in an
example and the restored text is exact. Each row is worked on alone: no shuffle, and
memory for one text and its copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import text_or_empty, tidy, utf8_column

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)


@dataclass(frozen=True)
class Shares:
    """Percent of the texts that are transformed, and of these the percent in the form spm."""
    transformed: int = 90
    spm: int = 20
    seed: str = "1:"


def draws(doc_id, seed: str = Shares.seed) -> list[int]:
    """Four unsigned 32-bit numbers from the id (a null id counts as the empty string)."""
    text = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(text[k:k + 8], 16) for k in range(0, 32, 8)]


def character_starts(raw: bytes):
    """Byte offset of every code point, and the length at the end; None where every code
    point is one byte."""
    import numpy as np
    if raw.isascii():
        return None
    units = np.frombuffer(raw, dtype=np.uint8)
    return np.append(np.flatnonzero((units & 0xC0) != 0x80), len(raw))


def rotate(block: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange ``block[lo:mid]`` and ``block[mid:hi]`` in place: each part is reversed,
    then the whole."""
    for a, b in ((lo, mid), (mid, hi), (lo, hi)):
        block[a:b] = block[a:b][::-1]


def encode(raw: bytes, doc_id, shares: Shares = Shares()) -> tuple[bytes, str, int, int, int]:
    """``(output, form, n, prefix_chars, middle_chars)`` of one text; n in code points."""
    starts = character_starts(raw)
    n = len(raw) if starts is None else len(starts) - 1
    h1, h2, h3, h4 = draws(doc_id, shares.seed)
    if not raw or h3 % 100 >= shares.transformed or any(s in raw for s in SENTINELS):
        return raw, "plain", n, -1, -1
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m = (first, last) if starts is None else (int(starts[first]), int(starts[last]))
    block = bytearray(raw)
    block[m:m] = SUFFIX
    block[p:p] = MIDDLE
    block[0:0] = PREFIX
    middle_at, suffix_at = p + len(PREFIX), m + len(PREFIX) + len(MIDDLE)
    spm = h4 % 100 < shares.spm
    rotate(block, 0 if spm else middle_at, suffix_at, len(block))
    return bytes(block), "spm" if spm else "psm", n, first, last - first


def decode(output: bytes, form: str) -> bytes:
    """The text behind one example, from its output and form alone."""
    if form == "plain":
        return output
    block = bytearray(output)
    # the blocks as they stand are (suffix, middle) or (suffix, prefix and middle)
    lo = 0 if form == "spm" else block.index(SUFFIX)
    mid = block.index(PREFIX if form == "spm" else MIDDLE)
    rotate(block, lo, mid, len(block))
    suffix_at = block.index(SUFFIX)
    del block[suffix_at:suffix_at + len(SUFFIX)]
    middle_at = block.index(MIDDLE)
    del block[middle_at:middle_at + len(MIDDLE)]
    del block[:len(PREFIX)]
    return bytes(block)


def fill_in_middle(docs: DataFrame, shares: Shares = Shares(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars, output (the example's text).

    A null or empty text gives the empty plain example; a null id draws as the empty
    string; repeated rows come out each, alike; an empty table gives no rows; other columns
    are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [encode(raw, i, shares) for raw, i in zip(utf8_column(batch, "_text"), ids)]
            output, form, n, prefix, middle = zip(*rows) if rows else [()] * 5
            cut = [f != "plain" for f in form]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array([v if c else None for v, c in zip(prefix, cut)], pa.int64()),
                 pa.array([v if c else None for v, c in zip(middle, cut)], pa.int64()),
                 pa.array(output, pa.binary()).cast(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(tidy(run), f"doc_id {id_type}, n long, form string, "
                                      "prefix_chars long, middle_chars long, output string")


def restore(examples: DataFrame) -> DataFrame:
    """``examples`` with the further column ``restored``: each text again, from ``output``
    and ``form`` alone."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            forms = batch.column("form").to_pylist()
            texts = [decode(raw, f) for raw, f in zip(utf8_column(batch, "output"), forms)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names, "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in examples.schema)
    return examples.mapInArrow(tidy(run), f"{fields}, restored string")


def fim_report(docs: DataFrame, shares: Shares = Shares()) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    done = restore(fill_in_middle(docs, shares))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
h AS (
  SELECT doc_id, text, CAST(n AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle,
         substr(text, b + 1) AS suffix
  FROM f)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

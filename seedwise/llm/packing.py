"""Packing token sequences by vector best-fit.

Method: every bin (sequence) has three capacities, tokens, documents and attention cost
(sum of squared piece lengths). Pieces are taken longest first; each goes to the open
bin chosen by the weighted dot-product of the piece with the bin's residual, or by the
smallest residual norm after placement, among the bins that hold it under every
constraint. Without such a bin a new one is opened.

At scale: pieces of one length are interchangeable, so best-fit runs on the histogram of
lengths (at most ``max_tokens`` entries, whatever the corpus size) with bins kept as
classes of equal bins with a multiplicity. The outcome is a plan of patterns ("m
sequences that hold these lengths"), applied to the pieces by their rank within their
length. Ranks come from hashed buckets: a row number inside (length, bucket) plus the
counts of the earlier buckets, so no task holds all pieces of a common length, and the
same rows get the same places on any rerun.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedwise.llm.common import shuffle_partitions, stage, text_or_empty, tidy, utf8_column
from seedwise.llm.tokens import KEY_BYTES, WordIds, groups, load, per_process

PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long, ids binary"


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence. Attention cost is the sum of squared piece lengths."""
    max_tokens: int = 2048
    max_documents: int = 2048
    max_attention: int = 2048 * 2048


@dataclass(frozen=True)
class Slot:
    """Places for pieces of one length: ranks [first, first + per * bins) go to sequences
    base, base + 1, ..., ``per`` in each, the first of them at ``offset``."""
    length: int
    first: int
    per: int
    bins: int
    base: int
    offset: int


# ------------------------------------------------------------------ pieces
def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = 2048, end_id: int = 0, vocabulary: str | None = None,
                 keep_ids: bool = True, key_bytes: int = KEY_BYTES,
                 keep_table: bool = True) -> DataFrame:
    """Each text as ids plus ``end_id``, cut into pieces of ``max_tokens`` (the last one
    shorter). A null text counts as empty and is the end id alone."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import struct
        import zlib

        import pyarrow as pa
        table = per_process(WordIds, vocabulary, key_bytes) if keep_table \
            else WordIds(load(vocabulary), key_bytes)
        end, step = struct.pack("<I", end_id), 4 * max_tokens
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            raws = utf8_column(batch, "_text")
            encoded = (t for lo, hi in groups(raws) for t in table.of_texts(raws[lo:hi]))
            for key, tokens in zip(ids, encoded):
                tokens += end
                for n, at in enumerate(range(0, len(tokens), step)):
                    part = tokens[at:at + step]
                    rows.append((key, n, at // 4, len(part) // 4, zlib.crc32(part),
                                 part if keep_ids else None))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int32())]
                + [pa.array(c, pa.int64()) for c in cols[2:5]] + [pa.array(cols[5], pa.binary())],
                names=["_id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(tidy(run), f"_id {id_type}, {PIECE_SCHEMA}").withColumnRenamed("_id", id_col)


# ------------------------------------------------------------------ plan
def best_fit_plan(counts: dict[int, int], capacity: Capacity = Capacity(),
                  rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
                  ) -> tuple[list[Slot], int]:
    """Vector best-fit decreasing over a histogram of lengths.

    ``rule`` "norm" takes the bin with the smallest weighted residual norm after
    placement, "dot" the one with the largest weighted dot-product of piece and residual.
    Returns the slots and the number of sequences. Ties go to the fuller, older class.
    """
    import numpy as np
    cap = np.array([capacity.max_tokens, capacity.max_documents, capacity.max_attention], float)
    w = np.array(weights)
    residual = np.empty((64, 3))           # one row per class of equal bins
    many: list[int] = []                   # bins in the class
    held: list[tuple] = []                 # ((length, count), ...) of each bin
    total = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        size = np.array([length, 1, length * length], float)
        if (size > cap).any():
            raise ValueError(f"a piece of {length} tokens fits no empty sequence")
        while left:
            n = len(many)
            rest = residual[:n] - size
            ok = (rest >= 0).all(axis=1) & (np.array(many, dtype=np.int64) > 0) if n else None
            if n and ok.any():
                if rule == "norm":
                    score = -(((rest / cap) ** 2) @ w)
                else:
                    score = ((residual[:n] / cap) * (size / cap)) @ w
                k = int(np.argmax(np.where(ok, score, -np.inf)))
                old, res, start = held[k], residual[k].copy(), many[k]
            else:
                k, old, res, start = None, (), cap, None
            room = int(min((res // size).min(), 1 << 40))
            # a class takes one piece per bin at a time; an empty bin of this length alone
            # is filled at once, which is what placing them one by one would do
            per = 1 if k is not None else max(1, room)
            if k is None:
                bins = -(-left // per) if left % per == 0 else left // per
                if bins == 0:
                    per, bins = left, 1
            else:
                bins = min(left, start)
            if k is not None:
                many[k] -= bins
            new = _with(old, length, per)
            if len(many) == len(residual):
                residual = np.vstack([residual, np.empty_like(residual)])
            residual[len(many)] = res - per * size
            many.append(bins)
            held.append(new)
            left -= per * bins
        if len(many) > 4096:               # forget emptied classes
            live = [i for i, m in enumerate(many) if m]
            residual[:len(live)] = residual[live]
            many, held = [many[i] for i in live], [held[i] for i in live]
    slots, used = [], dict.fromkeys(counts, 0)
    for m, lengths in zip(many, held):
        if not m:
            continue
        offset = 0
        for length, per in lengths:
            slots.append(Slot(length, used[length], per, m, total, offset))
            used[length] += per * m
            offset += per * length
        total += m
    return slots, total


def _with(held: tuple, length: int, per: int) -> tuple:
    if held and held[-1][0] == length:
        return (*held[:-1], (length, held[-1][1] + per))
    return (*held, (length, per))


# ------------------------------------------------------------------ assignment
def assign(pieces: DataFrame, order_cols: list[str], capacity: Capacity = Capacity(),
           rule: str = "norm", buckets: int | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every piece (column ``length``).

    ``order_cols`` identify a piece; rows equal in all of them are interchangeable. The
    driver holds the histogram (at most ``max_tokens`` rows) and the plan only.
    """
    spark = pieces.sparkSession
    histogram = {int(r["length"]): int(r["n"]) for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots, _ = best_fit_plan(histogram, capacity, rule)
    n = buckets or 4 * shuffle_partitions(spark)
    key = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order_cols]
    placed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(n)).cast("int"))
    counts = placed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # at most max_tokens rows in a bucket's window, n in a length's
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*order_cols)
    ranked = (placed.withColumn("_in", F.row_number().over(inside) - 1)
              .join(starts, ["length", "_bucket"])
              .withColumn("_rank", (F.col("_first") + F.col("_in")).cast("long")))
    by_length: dict[int, list[Slot]] = {}
    for s in slots:
        by_length.setdefault(s.length, []).append(s)
    table = {k: ([s.first for s in v], v) for k, v in by_length.items()}

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for lengths, ranks in batches:
            seq, off = [], []
            for length, rank in zip(lengths.to_pylist(), ranks.to_pylist()):
                firsts, own = table[length]
                s = own[bisect.bisect_right(firsts, rank) - 1]
                i, j = divmod(rank - s.first, s.per)
                seq.append(s.base + i)
                off.append(s.offset + j * length)
            yield pa.StructArray.from_arrays([pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                             names=["sequence_id", "offset"])

    from pyspark.sql.functions import arrow_udf
    from pyspark.sql.pandas.functions import ArrowUDFType
    place_udf = arrow_udf(place, "sequence_id long, offset long", ArrowUDFType.SCALAR_ITER)
    out = ranked.withColumn("_place", place_udf("length", "_rank"))
    return out.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         capacity: Capacity = Capacity(), rule: str = "norm", vocabulary: str | None = None,
         keep_ids: bool = True, key_bytes: int = KEY_BYTES, keep_table: bool = True) -> DataFrame:
    """One row per piece: ``id_col``, piece, start, length, ids_crc32, ids (null unless
    ``keep_ids``), sequence_id, offset.

    Null texts count as empty (one end id); repeated rows are packed each; null ids are
    passed on; an empty table gives no rows; other columns are not read. Pieces without
    ids are written to the shared folder once, since ranks need two readings. ``key_bytes``
    bounds each worker's table of words (some 70 bytes of memory each, in all); with
    ``keep_table`` a worker keeps it, and the vocabulary, for its later tasks.
    """
    pieces = token_pieces(docs, id_col, text_col, capacity.max_tokens, 0, vocabulary, keep_ids,
                          key_bytes, keep_table)
    pieces = stage(pieces, "pieces")
    return assign(pieces, [id_col, "piece", "start", "ids_crc32"], capacity, rule)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary, pieces in offset order).
    A sequence is at most ``max_tokens`` ids, so its group is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))

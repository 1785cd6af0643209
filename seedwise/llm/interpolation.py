"""Language-model scoring by deleted interpolation of word bigrams.

Method: P(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1), where the
bucket b is the order of magnitude of c(v). The counts c are maximum-likelihood counts of
the training texts. The weights come from expectation-maximisation on held-out counts:
a tenth of the training texts is deleted, counts of the others give the estimates, and
the deleted texts' events, as a histogram of (bucket, c(v w) / c(v), c(w) / N), the data.

At scale nothing is exploded into rows per token and no count table is broadcast. Texts
become blocks of about ``BLOCK`` bytes: token numbers, and a 64-bit hash per distinct
word. A block asks for the counts of its distinct words and pairs, packed by hash range;
each range is one bounded task that adds up what the blocks counted and answers in the
order asked. A word in every text is asked for once per block, so no key is hot. Blocks
are written once; requests and answers cross the network once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import (id_remainder, shuffle_partitions, stage, text_or_empty, tidy,
                                 utf8_column)

#: Text bytes of one block.
BLOCK = 8 << 20
#: Tokens per hash range: sets the number of ranges from the size of the corpus.
RANGE_TOKENS = 500_000
#: Blocks whose answers one task gathers, in the mean: sets the number of such tasks.
BLOCKS_A_TASK = 4
KEPT, DELETED, HELD_OUT = 0, 1, 2
BUCKETS = 24
_STEPS = 4                       # histogram cells per factor of two
_END = b"\n"                     # no word holds white space
_START = 0x5851F42D4C957F2D      # the context of a text's first token


# ------------------------------------------------------------------ blocks
def _planes(a: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte by byte of significance, compressed."""
    import zstandard
    a = np.ascontiguousarray(a, dtype="<u4")
    return zstandard.ZstdCompressor(level=3).compress(a.view(np.uint8).reshape(-1, 4).T.tobytes())


def _numbers(blob: bytes) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


class _WordHashes(dict):
    def __missing__(self, word):
        import xxhash
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64 and len(self) < 500_000:
            self[word] = value
        return value


def _block_of(raws: list[bytes], hashes: _WordHashes):
    """Tokens of the texts in a row (numbers by falling frequency), tokens per text, and
    the words' hashes. A-Z are read as a-z; every text ends in the end token."""
    flat: list[bytes] = []
    lengths = []
    for raw in raws:
        own = raw.lower().split()
        own.append(_END)
        flat.extend(own)
        lengths.append(len(own))
    h = np.fromiter(map(hashes.__getitem__, flat), dtype=np.uint64, count=len(flat))
    words, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place[inverse], lengths, words[order]


def blocks(docs: DataFrame, role: Column, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per block of texts of one role: block, role, ids, lengths, tokens, words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext
        hashes = _WordHashes()
        held: dict[int, list] = {}
        task, made = TaskContext.get().partitionId(), 0
        id_type = None

        def flush(r):
            nonlocal made
            ids, raws = zip(*held.pop(r)[0])
            tokens, lengths, words = _block_of(raws, hashes)
            made += 1
            name = xxhash.xxh64_intdigest(f"{task}:{made}") >> 1
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.array([r], pa.int32()),
                 pa.array([list(ids)], pa.list_(id_type)),
                 pa.array([lengths], pa.list_(pa.int32())),
                 pa.array([_planes(tokens)], pa.binary()),
                 pa.array([words.tobytes()], pa.binary())],
                names=["block", "role", "ids", "lengths", "tokens", "words"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, r, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                 utf8_column(batch, "_text")):
                own = held.setdefault(r, [[], 0])
                own[0].append((i, raw))
                own[1] += len(raw)
                if own[1] >= BLOCK:
                    yield flush(r)
        for r in sorted(held):
            yield flush(r)

    rows = docs.select(F.col(id_col).alias("_id"), role.cast("int").alias("_role"),
                       text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(tidy(run), f"block long, role int, ids array<{kind}>, lengths array<int>, "
                                "tokens binary, words binary")


@dataclass
class _Block:
    """A block's events: the token, its context (-1: start of a text) and the pair."""
    tokens: np.ndarray
    lengths: np.ndarray
    words: np.ndarray

    @classmethod
    def read(cls, tokens: bytes, lengths, words: bytes) -> "_Block":
        return cls(_numbers(tokens).astype(np.int64), np.asarray(lengths, dtype=np.int64),
                   np.frombuffer(words, dtype=np.uint64))

    def context(self) -> np.ndarray:
        v = np.empty_like(self.tokens)
        v[1:] = self.tokens[:-1]
        v[np.cumsum(self.lengths) - self.lengths] = -1
        return v

    def pairs(self):
        """Distinct pair codes, the pair number of each event, how often each occurs, and
        the 64-bit keys of the pairs."""
        size = len(self.words)
        codes, which, count = np.unique((self.context() + 1) * size + self.tokens,
                                        return_inverse=True, return_counts=True)
        v, w = codes // size - 1, codes % size
        left = np.where(v >= 0, self.words[v], np.uint64(_START))
        key = left * np.uint64(0x9E3779B97F4A7C15) + (self.words[w] ^ (left >> np.uint64(29)))
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return codes, which, count, key ^ (key >> np.uint64(29))


def _range_order(keys: np.ndarray, ranges: int):
    """Range of each key, and the order by range (stable), as requests and answers use it."""
    own = ((keys >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)
    return own, np.argsort(own, kind="stable")


# ------------------------------------------------------------------ counts
def _requests(table: DataFrame, ranges: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for name, role, lengths, tokens, words in zip(
                    *(batch.column(k).to_pylist() for k in
                      ("block", "role", "lengths", "tokens", "words"))):
                b = _Block.read(tokens, lengths, words)
                _, _, pair_count, pair_keys = b.pairs()
                count = np.bincount(b.tokens, minlength=len(b.words))
                for n, keys, c in ((1, b.words, count), (2, pair_keys, pair_count)):
                    own, order = _range_order(keys, ranges)
                    cut = np.flatnonzero(np.diff(own[order])) + 1
                    rows = [(n, int(own[p[0]]), name, role, keys[p].tobytes(),
                             _planes(c[p]) if role != HELD_OUT else None)
                            for p in np.split(order, cut) if len(p)]
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                         pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()),
                         pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.binary())],
                        names=["n", "range", "block", "role", "keys", "counts"])

    return table.select("block", "role", "lengths", "tokens", "words").mapInArrow(
        tidy(run), "n int, range int, block long, role int, keys binary, counts binary")


def _answers(requests: DataFrame, ranges: int) -> DataFrame:
    """Adds up each hash range and answers every request: counts in all training texts and
    in the kept ones, in the order of the request; the range's totals ride on one row."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def work(rows):
            parts = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
            keys, which = np.unique(np.concatenate(parts), return_inverse=True)
            every, kept = np.zeros(len(keys)), np.zeros(len(keys))
            ends = np.cumsum([len(p) for p in parts])
            spans = [which[e - len(p):e] for p, e in zip(parts, ends)]
            for r, own in zip(rows, spans):
                if r[5] is not None:
                    c = _numbers(r[5])
                    every[own] += c          # the keys of one request are distinct
                    if r[3] == KEPT:
                        kept[own] += c
            totals = [every.sum(), (every > 0).sum(), kept.sum(), (kept > 0).sum()]
            for i, (r, own) in enumerate(zip(rows, spans)):
                yield (r[0], r[1], r[2], _planes(every[own]), _planes(kept[own]),
                       *(int(t) if i == 0 else 0 for t in totals))

        def emit(rows):
            cols = list(zip(*work(rows)))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary()),
                 pa.array(cols[4], pa.binary())] + [pa.array(c, pa.int64()) for c in cols[5:]],
                names=["n", "range", "block", "every", "kept", "tokens_all", "types_all",
                       "tokens_kept", "types_kept"])

        rows: list = []
        for batch in batches:
            for r in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if rows and rows[-1][:2] != r[:2]:
                    yield emit(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield emit(rows)

    dealt = requests.repartition(2 * ranges, "n", "range").sortWithinPartitions("n", "range")
    return dealt.mapInArrow(tidy(run), "n int, range int, block long, every binary, kept binary, "
                                 "tokens_all long, types_all long, tokens_kept long, types_kept long")


def _counts(block: _Block, answers: list, ranges: int, field: str):
    """Per event: count of the token, of its context (nan: start) and of the pair."""
    codes, which, _, pair_keys = block.pairs()
    out = {}
    for n, keys in ((1, block.words), (2, pair_keys)):
        own = sorted((a for a in answers if a["n"] == n), key=lambda a: a["range"])
        _, order = _range_order(keys, ranges)
        c = np.zeros(len(keys))
        if own:
            c[order] = np.concatenate([_numbers(a[field]) for a in own])
        out[n] = c
    v = block.context()
    context = np.where(v >= 0, out[1][v], np.nan)
    return out[1][block.tokens], context, out[2][which]


# ------------------------------------------------------------------ weights
@dataclass
class Weights:
    """Mixture weights per context-frequency bucket: columns pair, word, uniform."""
    table: np.ndarray


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)


def learn_weights(cells, uniform: float, rounds: int = 60) -> Weights:
    """EM over histogram cells (bucket, pair cell, word cell, n); cell -1 means probability
    zero, k means 2^(-k / steps). Buckets without events take the weights of all."""
    cells = np.array([tuple(c) for c in cells], dtype=np.int64).reshape(-1, 4)

    def value(k):
        return np.where(k < 0, 0.0, 2.0 ** (-np.maximum(k, 0) / _STEPS))

    def solve(rows):
        p = np.stack([value(rows[:, 1]), value(rows[:, 2]), np.full(len(rows), uniform)], axis=1)
        n = rows[:, 3].astype(float)
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = np.maximum((share * n[:, None]).sum(axis=0) / n.sum(), 1e-6)
            w /= w.sum()
        return w

    everything = solve(cells) if len(cells) else np.array([0.5, 0.4, 0.1])
    table = np.tile(everything, (BUCKETS, 1))
    table[0] = [0.0, *(everything[1:] / everything[1:].sum())]      # an unseen context
    for b in range(1, BUCKETS):
        own = cells[cells[:, 0] == b]
        if len(own):
            table[b] = solve(own)
    return Weights(table)


def _histogram(joined: DataFrame, ranges: int, texts_kept: int, tokens_kept: int) -> DataFrame:
    """(b, q2, q1, n) over the events of deleted texts, by counts of the kept ones. The
    number of cells is bounded by the grid, whatever the corpus."""
    def cell(p):
        k = np.full(len(p), -1, dtype=np.int64)
        k[p > 0] = np.round(-np.log2(p[p > 0]) * _STEPS).astype(np.int64)
        return k

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for lengths, tokens, words, answers in zip(
                    *(batch.column(k).to_pylist() for k in range(4))):
                w, v, pair = _counts(_Block.read(tokens, lengths, words), answers, ranges, "kept")
                v = np.where(np.isnan(v), texts_kept, v)
                seen = v > 0
                rows = np.stack([bucket_of(v[seen]), cell(pair[seen] / v[seen]),
                                 cell(w[seen] / max(1, tokens_kept))], axis=1)
                cells, n = np.unique(rows, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[:, k]) for k in range(3)] + [pa.array(n.astype(np.int64))],
                    names=["b", "q2", "q1", "n"])

    cells = joined.select("lengths", "tokens", "words", "answers").mapInArrow(
        tidy(run), "b long, q2 long, q1 long, n long")
    return cells.groupBy("b", "q2", "q1").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ scores
def role_column(id_col: str = "doc_id", modulus: int = 7, held_out: int = 2,
                delete_every: int = 10) -> Column:
    deleted = F.pmod(F.xxhash64(F.col(id_col)), F.lit(delete_every)) == 0
    return (F.when(id_remainder(modulus, id_col) == held_out, HELD_OUT)
            .when(deleted, DELETED).otherwise(KEPT))


def model_scores(docs: DataFrame, role: Column | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``role`` is 0 for texts to learn counts from, 1 for deleted training texts, 2 for texts
    only to score. Null texts are the end token alone; repeated rows count each; without
    training texts every token has the uniform probability; without deleted ones the
    weights are fixed; an empty table gives no rows; other columns are not read.
    """
    table = stage(blocks(docs, role if role is not None else role_column(id_col), id_col,
                         text_col), "blocks")
    sizes = table.agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"),
        F.sum(F.when(F.col("role") != HELD_OUT, F.size("ids"))).alias("texts"),
        F.sum(F.when(F.col("role") == KEPT, F.size("ids"))).alias("kept"),
        F.count(F.lit(1)).alias("blocks")).first()
    ranges = max(1, math.ceil((sizes["n"] or 0) / RANGE_TOKENS))
    texts, texts_kept = sizes["texts"] or 0, sizes["kept"] or 0
    answers = stage(_answers(_requests(table, ranges), ranges), "answers")
    sums = answers.where("n = 1").agg(*[F.sum(c).alias(c) for c in (
        "tokens_all", "types_all", "tokens_kept", "types_kept")]).first().asDict()
    sums = {k: v or 0 for k, v in sums.items()}
    n = max(shuffle_partitions(docs.sparkSession), math.ceil(sizes["blocks"] / BLOCKS_A_TASK))
    grouped = answers.repartition(n, "block").groupBy("block").agg(     # answers to one block
        F.collect_list(F.struct("n", "range", "every", "kept")).alias("answers"))
    cells = _histogram(table.where(F.col("role") == DELETED).join(grouped, "block"), ranges,
                       texts_kept, sums["tokens_kept"]).collect()
    weights = learn_weights(cells, 1.0 / (sums["types_kept"] + 1)).table
    total, types = sums["tokens_all"], sums["types_all"]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for r, ids, lengths, tokens, words, own in zip(
                    *(batch.column(k).to_pylist() for k in range(6))):
                block = _Block.read(tokens, lengths, words)
                w, v, pair = _counts(block, own, ranges, "every")
                v = np.where(np.isnan(v), texts, v)
                mix = weights[bucket_of(v)]
                p = (mix[:, 0] * pair / np.maximum(v, 1) + mix[:, 1] * w / max(1, total)
                     + mix[:, 2] / (types + 1))
                base = np.log10((w + 1) / (total + types + 1))
                at = np.cumsum(block.lengths) - block.lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field(1).type.value_type),
                     pa.array([r == HELD_OUT] * len(ids)), pa.array(block.lengths),
                     pa.array(np.add.reduceat((w > 0).astype(np.int64), at)),
                     pa.array(np.full(len(ids), total, dtype=np.int64)),
                     pa.array(np.add.reduceat(base, at)),
                     pa.array(np.add.reduceat(np.log10(p), at))],
                    names=["_id", "held_out", "n_tokens", "n_known", "train_tokens",
                           "base_score", "score"])

    joined = table.join(grouped, "block").select(
        "role", "ids", "lengths", "tokens", "words",
        F.transform("answers", lambda a: F.struct(a["n"], a["range"], a["every"])).alias("answers"))
    out = joined.mapInArrow(tidy(run), f"_id {kind}, held_out boolean, n_tokens long, n_known long, "
                                 "train_tokens long, base_score double, score double")
    return out.withColumnRenamed("_id", id_col)

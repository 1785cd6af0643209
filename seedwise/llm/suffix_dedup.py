"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes when it is covered by a string of ``length`` bytes (200) that also starts
somewhere else, in the same text or another; strings never cross texts.

1. Bucketing without loss. Every window of 200 bytes has an anchor, the leftmost least
   hash of its 40-byte grams. Equal windows have equal anchors at equal places, so a
   window can only repeat where its anchor's gram repeats. Windows of one anchor form a
   unit, about 1 per 80 bytes; only units whose gram occurs twice go on.
2. Units with equal content (all their windows) repeat as a whole; they are counted,
   pre-aggregated, and one of each kind goes on.
3. Suffix buckets, the kinds of one gram, are sorted in blocks of bounded size. Suffixes
   are ordered by their first 31 bytes; the ranks of a difference-cover sample (positions
   whose residue modulo 31 is in a perfect difference set of 6), computed before, resolve
   the long ties: for any two suffixes some shift below 31 brings both onto the sample,
   so that first bytes, the sample rank at the shift and the last 31 bytes decide whether
   all 200 bytes agree. Memory is bounded by the block, not by the corpus.
4. A gram with more kinds than ``BUCKET`` (a passage's edge in very many texts) is not
   gathered: its windows are counted by 128-bit digest, in packed ranges, over all tasks.

Rows of a gram or content found very often never meet in one task: these few keys are
broadcast, and only the others' rows are shuffled to meet theirs (``_matched``).

Texts cross the network twice, compressed, each time to meet small per-document lists.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import (shuffle_partitions, slices, stage, text_or_empty, tidy,
                                 utf8_column)

LENGTH = 200
GRAM = 40
#: Kinds of one gram that are sorted in one block.
BUCKET = 512
#: Windows in one range of digests, for fuller grams.
RANGE_WINDOWS = 500_000
#: A key with more rows than this, and than a share of 1 / ``HOT_KEYS`` of all, is hot.
HOT_ROWS = 10_000
#: There are fewer hot keys than this, so they are broadcast.
HOT_KEYS = 10_000
#: Bytes of one sorted block.
BLOCK = 1 << 19
#: Texts are hashed in stretches of this many bytes; a task holds some 100 bytes for each.
STRETCH = 1 << 17
# A perfect difference set modulo 31 (every residue is a difference).
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)

_BASE = 0x9E3779B97F4A7C15 | 1
_POS = 22                       # low bits of an anchor key that hold its position


class _Hasher:
    """Polynomial hashes modulo 2^64 of all substrings of a stretch, from prefix sums."""

    def __init__(self, seed: int = 7):
        import numpy as np
        def powers(base):
            factors = np.full(STRETCH + LENGTH + 1, base, dtype=np.uint64)
            factors[0] = 1
            return np.cumprod(factors, dtype=np.uint64)

        self.up, self.down = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
        values = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64)
        self.values = values * np.uint64(2) + np.uint64(1)

    def prefix(self, x):
        import numpy as np
        out = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(self.values[x] * self.down[:len(x)], out=out[1:])
        return out

    def between(self, prefix, a, b):
        return _mixed((prefix[b] - prefix[a]) * self.up[a])


def _mixed(h):
    import numpy as np
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _sliding_min(key, width: int):
    """Minimum of every ``width`` neighbours, from block-wise running minima."""
    import numpy as np
    n = len(key)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = key
    grid = padded.reshape(-1, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n - width + 1], head[width - 1:n])


def units(x, ends, hasher: _Hasher, length: int = LENGTH, gram: int = GRAM):
    """Units of a stretch ``x`` (bytes as uint8) of texts that end at ``ends``: arrays of
    first window, last window, anchor, gram hash and content hash (XXH3 of all its bytes,
    seeded by the anchor's place)."""
    import numpy as np
    import xxhash
    empty = np.zeros(0, dtype=np.int64)
    if len(x) < length:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    prefix = hasher.prefix(x)
    at = np.arange(len(x) - gram + 1)
    grams = hasher.between(prefix, at, at + gram)
    key = (grams >> np.uint64(_POS) << np.uint64(_POS)) | at.astype(np.uint64)
    least = _sliding_min(key, length - gram + 1)
    anchor = (least & np.uint64((1 << _POS) - 1)).astype(np.int64)
    window = np.arange(len(anchor))
    valid = np.ones(len(anchor), dtype=bool)
    edge = np.zeros(len(anchor) + 1, dtype=np.int32)     # windows that cross an end
    for e in ends:
        lo, hi = max(0, e - length + 1), min(e, len(anchor))
        if lo < hi:
            edge[lo] += 1
            edge[hi] -= 1
    valid = np.cumsum(edge[:-1]) == 0
    window, anchor = window[valid], anchor[valid]
    if not len(window):
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    new = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(window) != 1)) + 1
    first = window[np.concatenate([[0], new])]
    last = window[np.concatenate([new - 1, [len(window) - 1]])]
    own = anchor[np.concatenate([[0], new])]
    raw = x.tobytes()
    content = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b], seed=k) for a, b, k in zip(
        first.tolist(), (last + length).tolist(), (own - first).tolist())),
        dtype=np.uint64, count=len(first))
    return first, last, own, grams[own], content


def _stretches(raws: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """Groups of (row, offset in its text) whose bytes are joined; long texts are cut into
    overlapping parts so that every window is in exactly one part."""
    rows, parts, size = [], [], 0
    for i, raw in enumerate(raws):
        if len(raw) < length:
            continue
        step = STRETCH - length
        for at in range(0, max(1, len(raw) - length + 1), step):
            part = raw[at:at + step + length - 1]
            if size + len(part) > STRETCH and parts:
                yield rows, parts
                rows, parts, size = [], [], 0
            rows.append((i, at))
            parts.append(part)
            size += len(part)
    if parts:
        yield rows, parts


def unit_table(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per unit: key columns, g (gram), c (content), w (first window, windows after
    it and anchor offset in one long)."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        hasher = _Hasher()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            hashes = batch.column(1).to_numpy(zero_copy_only=False)
            for rows, parts in _stretches(utf8_column(batch, "_text"), length):
                x = np.frombuffer(b"".join(parts), dtype=np.uint8)
                ends = np.cumsum([len(p) for p in parts])
                a, b, s, g, c = units(x, ends[:-1], hasher, length)
                which = np.searchsorted(ends, a, side="right")
                row = np.array([r for r, _ in rows], dtype=np.int64)[which]
                start = np.array([o for _, o in rows], dtype=np.int64)[which]
                begin = np.concatenate([[0], ends[:-1]])[which]
                w = ((a - begin + start) << 20) | ((b - a) << 10) | (s - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(hashes[row]), pa.array(g.view(np.int64)),
                     pa.array(c.view(np.int64)), pa.array(w)], names=["_id", "_h", "g", "c", "w"])

    return texts.select("_id", "_h", "_text").mapInArrow(
        tidy(run), "_id long, _h int, g long, c long, w long")


# ------------------------------------------------------------------ one block of suffixes
def repeated_windows(contents: list[bytes], buckets, anchors, length: int = LENGTH):
    """For the units of one block, a boolean array per unit: which of its windows occur in
    another unit of the block too. ``buckets`` numbers each unit's gram, ``anchors`` is the
    anchor's offset in the unit's content."""
    import numpy as np
    sizes = np.array([len(c) for c in contents])
    many = sizes - length + 1
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    x = np.frombuffer(b"".join(contents) + bytes(length + 8), dtype=np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(x, 8)
    word = np.ascontiguousarray(words[:len(x) - 8]).view(">u8").ravel()
    unit = np.repeat(np.arange(len(sizes)), many)
    offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    pos = begin[unit] + offset
    # bucket: gram and the place of the anchor in the window
    bucket = np.asarray(buckets, dtype=np.int64)[unit] * 1024 + (np.asarray(anchors)[unit] - offset)

    def ranks(p, depth: int, first=None):
        """Dense ranks of ``depth`` bytes at ``p`` (within equal ``first``)."""
        steps = [*range(0, depth - 8, 8), depth - 8]
        keys = [word[p + k].astype(np.uint64) for k in steps]
        if first is not None:
            keys.insert(0, first)
        order = np.lexsort(keys[::-1])
        differ = np.zeros(len(p), dtype=bool)
        for k in keys:
            sorted_k = k[order]
            differ[1:] |= sorted_k[1:] != sorted_k[:-1]
        out = np.empty(len(p), dtype=np.int64)
        out[order] = np.cumsum(differ)
        return out

    tie = ranks(pos, PERIOD, bucket.astype(np.uint64))      # order by the first bytes
    tied = np.bincount(tie)[tie] > 1
    found = np.zeros(len(pos), dtype=bool)
    if tied.any():
        rows = np.flatnonzero(tied)
        depth = length - PERIOD
        last = ranks(pos[rows] + depth, PERIOD)
        residue = np.isin(np.arange(PERIOD), COVER)
        sample = np.flatnonzero(residue[np.arange(len(x) - length) % PERIOD])
        near = np.zeros(len(x) + 1, dtype=np.int64)         # only samples some tie can reach
        np.add.at(near, pos[rows], 1)
        np.add.at(near, pos[rows] + PERIOD, -1)
        sample = sample[np.cumsum(near)[sample] > 0]
        rank = np.full(len(x), -1, dtype=np.int64)
        rank[sample] = ranks(sample, depth)                 # cover-sample ranks
        own = pos[rows]
        for shift in range(PERIOD):
            on = np.flatnonzero(residue[(own + shift) % PERIOD])
            if len(on) < 2:
                continue
            keys = (rank[own[on] + shift], last[on], tie[rows[on]])
            order = np.lexsort(keys)
            same = np.ones(len(on) - 1, dtype=bool)
            for k in keys:
                k = k[order]
                same &= k[1:] == k[:-1]
            hit = on[order]
            found[rows[hit[1:][same]]] = True
            found[rows[hit[:-1][same]]] = True
    return np.split(found, np.cumsum(many)[:-1])


def _runs(flags) -> list[tuple[int, int]]:
    """[first, last] of every run of true values."""
    import numpy as np
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def _sorted_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """Marks (key, first window, last window) of the kinds in ``contexts``, block by block."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def work(rows):
            numbers: dict[int, int] = {}
            buckets = [numbers.setdefault(r[0], len(numbers)) for r in rows]
            flags = repeated_windows([r[4] for r in rows], buckets,
                                     [r[3] & 1023 for r in rows], length)
            out = [(r[1], r[2], (r[3] >> 20) + a, (r[3] >> 20) + b)
                   for r, f in zip(rows, flags) for a, b in _runs(f)]
            cols = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                names=["_id", "_h", "a", "b"])

        rows, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size > BLOCK and rows[-1][0] != r[0]:
                    yield work(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[4])
        if rows:
            yield work(rows)

    n = shuffle_partitions(contexts.sparkSession)
    ordered = contexts.select("g", "_id", "_h", "w", "content").repartition(n, "g") \
        .sortWithinPartitions("g")
    return ordered.mapInArrow(tidy(run), "_id long, _h int, a long, b long")


def _digest_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """The same marks for grams of very many kinds: windows counted by 128-bit digest.

    Kinds are gathered in packs of bounded size; a pack asks, for each range of digests and
    in one row, which of its digests occur twice anywhere. It names each digest once and says
    whether it holds it twice, so a window in very many texts is one entry per pack."""
    total = contexts.agg(F.sum(F.length("content") - (length - 1))).first()[0] or 0
    ranges = max(1, -(-int(total) // RANGE_WINDOWS))
    packs = stage(_packs(contexts, length), "packs")
    asked = packs.select("pack", "one", "two").mapInArrow(
        lambda batches: _ask(batches, ranges),
        "range int, pack long, one binary, two binary, again binary")
    dealt = asked.repartition(ranges, "range").sortWithinPartitions("range")
    answers = stage(dealt.mapInArrow(_answer, "range int, pack long, twice binary"), "twice")
    own = answers.groupBy("pack").agg(F.collect_list(F.struct("range", "twice")).alias("answers"))
    return packs.join(own, "pack").select(
        "ids", "hs", "firsts", "many", "one", "two", "answers").mapInArrow(
        lambda batches: _told(batches, ranges), "_id long, _h int, a long, b long")


def _packs(contexts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext
        task, made = TaskContext.get().partitionId(), 0

        def work(rows):
            nonlocal made
            made += 1
            many = [len(r[3]) - length + 1 for r in rows]
            digests = np.frombuffer(b"".join(
                xxhash.xxh3_128_digest(r[3][k:k + length]) for r, n in zip(rows, many)
                for k in range(n)), dtype=np.uint64)
            one, two = digests[::2], digests[1::2]
            name = xxhash.xxh64_intdigest(f"{task}:{made}") >> 1
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
                 pa.array([[r[1] for r in rows]], pa.list_(pa.int32())),
                 pa.array([[r[2] >> 20 for r in rows]], pa.list_(pa.int64())),
                 pa.array([many], pa.list_(pa.int32())),
                 pa.array([one.tobytes()], pa.binary()), pa.array([two.tobytes()], pa.binary())],
                names=["pack", "ids", "hs", "firsts", "many", "one", "two"])

        rows, size = [], 0
        for batch in batches:
            for r in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if size + len(r[3]) > BLOCK and rows:
                    yield work(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[3])
        if rows:
            yield work(rows)

    return contexts.select("_id", "_h", "w", "content").mapInArrow(
        tidy(run), "pack long, ids array<long>, hs array<int>, firsts array<long>, many array<int>, "
             "one binary, two binary")


def _distinct(one, two):
    """Distinct digests in order, how often each occurs, and the number of each entry's."""
    import numpy as np
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.ones(len(one), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.cumsum(new) - 1
    which = np.empty(len(one), dtype=np.int64)
    which[order] = number
    return a[new], b[new], np.bincount(number), which


def _by_range(one, ranges: int):
    import numpy as np
    own = ((one >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    cut = np.flatnonzero(np.diff(own[order])) + 1
    return [(int(own[p[0]]), p) for p in np.split(order, cut) if len(p)]


def _ask(batches: Iterator, ranges: int) -> Iterator:
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        for name, one, two in zip(*(batch.column(k).to_pylist() for k in range(3))):
            one, two, count, _ = _distinct(np.frombuffer(one, np.uint64),
                                           np.frombuffer(two, np.uint64))
            parts = _by_range(one, ranges)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in parts], pa.int32()), pa.array([name] * len(parts), pa.int64()),
                 pa.array([one[p].tobytes() for _, p in parts], pa.binary()),
                 pa.array([two[p].tobytes() for _, p in parts], pa.binary()),
                 pa.array([np.packbits(count[p] > 1).tobytes() for _, p in parts], pa.binary())],
                names=["range", "pack", "one", "two", "again"])


def _answer(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    def work(rows):
        one = np.concatenate([np.frombuffer(r[2], np.uint64) for r in rows])
        two = np.concatenate([np.frombuffer(r[3], np.uint64) for r in rows])
        sizes = [len(r[2]) // 8 for r in rows]
        again = np.concatenate([np.unpackbits(np.frombuffer(r[4], np.uint8), count=n)
                                for r, n in zip(rows, sizes)])
        _, _, packs, which = _distinct(one, two)
        total = packs + np.bincount(which, weights=again, minlength=len(packs))
        parts = np.split(total[which] > 1, np.cumsum(sizes)[:-1])
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([np.packbits(t).tobytes() for t in parts], pa.binary())],
            names=["range", "pack", "twice"])

    rows: list = []
    for batch in batches:
        for r in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if rows and rows[-1][0] != r[0]:
                yield work(rows)
                rows = []
            rows.append(r)
    if rows:
        yield work(rows)


def _told(batches: Iterator, ranges: int) -> Iterator:
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        for ids, hs, firsts, many, one, two, answers in zip(
                *(batch.column(k).to_pylist() for k in range(7))):
            one, _, _, which = _distinct(np.frombuffer(one, np.uint64),
                                         np.frombuffer(two, np.uint64))
            told = {a["range"]: a["twice"] for a in answers}
            found = np.zeros(len(one), dtype=bool)
            for r, p in _by_range(one, ranges):
                found[p] = np.unpackbits(np.frombuffer(told[r], np.uint8), count=len(p)) > 0
            found = found[which]
            out = [(i, h, first + a, first + b) for i, h, first, flags in
                   zip(ids, hs, firsts, np.split(found, np.cumsum(many)[:-1]))
                   for a, b in _runs(flags)]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                names=["_id", "_h", "a", "b"])


# ------------------------------------------------------------------ whole operator
def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.withColumn("_text", text).withColumn("_id", F.xxhash64(F.col(id_col))) \
        .withColumn("_h", F.hash("_text"))


def _packed(rows: DataFrame) -> DataFrame:
    """(_id, _h, _z): the compressed text."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([pack.compress(r) for r in utf8_column(batch, "_text")], pa.binary())],
                names=["_id", "_h", "_z"])

    return rows.select("_id", "_h", "_text").mapInArrow(tidy(run), "_id long, _h int, _z binary")


def _matched(table: DataFrame, found: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """``table`` joined to the staged ``found``, which holds each key once. ``size`` is at least
    the key's number of rows in ``table``, at most ``total`` over all keys: hot keys are fewer than
    ``HOT_KEYS``, so they are broadcast and their rows stay where they are."""
    limit = max(HOT_ROWS, total // HOT_KEYS)
    hot = found.where(F.col(size) > limit)
    if hot.isEmpty():
        return table.join(found, on)
    rest = table.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rest.join(found.where(F.col(size) <= limit), on).unionByName(
        table.join(F.broadcast(hot), on))


def repeated_marks(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(_id, _h, marks): per text, arrays of [a, b] runs of window starts that repeat."""
    table = stage(unit_table(rows, length), "units")
    total = table.count()
    twice = stage(table.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "twice-grams")
    table = stage(_matched(table, twice, ["g"], "n", total).drop("n"), "repeated-grams")
    kinds = stage(table.groupBy("g", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("_id", "_h", "w")).alias("one")), "kinds")
    whole = kinds.where("n > 1").select("g", "c", "n")
    w = F.col("w")
    first = F.shiftright(w, 20)
    last = first + F.shiftright(w, 10).bitwiseAND(1023)
    marks = _matched(table, whole, ["g", "c"], "n", total).select(
        "_id", "_h", first.alias("a"), last.alias("b"))
    of_gram = stage(kinds.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
                    .where("kinds > 1 and least = 1").select("g", "kinds"), "kinds-of-gram")
    asked = _matched(kinds, of_gram, ["g"], "kinds", total).select("one._id", "one._h", F.struct(
        "g", "one.w", (F.col("kinds") > BUCKET).alias("full")).alias("ask"))
    asked = asked.groupBy("_id", "_h").agg(F.collect_list("ask").alias("asks"))   # per document
    contexts = stage(_contexts(_packed(rows).join(asked, ["_id", "_h"]), length), "contexts")
    marks = marks.unionByName(_sorted_buckets(contexts.where("not full"), length))
    full = contexts.where("full")
    if not full.isEmpty():
        marks = marks.unionByName(_digest_buckets(full, length))
    return marks.groupBy("_id", "_h").agg(F.collect_list(F.struct("a", "b")).alias("marks"))


def _contexts(asked: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i, h, z, asks in zip(*(batch.column(k).to_pylist() for k in range(4))):
                raw = unpack.decompress(z)
                at = [(a["w"] >> 20, a["w"] >> 10 & 1023) for a in asks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(asks), pa.int64()), pa.array([h] * len(asks), pa.int32()),
                     pa.array([a["g"] for a in asks], pa.int64()),
                     pa.array([a["w"] for a in asks], pa.int64()),
                     pa.array([a["full"] for a in asks], pa.bool_()),
                     pa.array([raw[a:a + n + length] for a, n in at], pa.binary())],
                    names=["_id", "_h", "g", "w", "full", "content"])

    return asked.select("_id", "_h", "_z", "asks").mapInArrow(
        tidy(run), "_id long, _h int, g long, w long, full boolean, content binary")


def covered(marks, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal removed runs [start, end) of bytes from runs of window starts."""
    out: list[list[int]] = []
    for a, b in sorted((m["a"], m["b"]) for m in (() if marks is None else marks)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(raw[at:a])
        at = b
    parts.append(raw[at:])
    return b"".join(parts)


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256.

    A null text is empty; texts below ``length`` bytes keep all; two rows of equal text
    repeat each other, whatever their ids; an empty table gives no rows; other columns are
    not read.
    """
    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for z, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw, runs = unpack.decompress(z), covered(marks, length)
                out.append((len(raw), sum(b - a for a, b in runs), len(runs),
                            hashlib.sha256(_kept(raw, runs)).hexdigest()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64()) for c in cols[:3]]
                + [pa.array(cols[3], pa.string())],
                names=["_doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _keyed(docs.select(id_col, text_col), id_col, text_col)
    marks = repeated_marks(rows, length)
    kind = docs.schema[id_col].dataType.simpleString()
    packed = _with_id(rows, id_col).join(marks, ["_id", "_h"], "left")
    out = packed.select("_doc", "_z", "marks").mapInArrow(
        tidy(run), f"_doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("_doc", id_col)


def _with_id(rows: DataFrame, id_col: str) -> DataFrame:
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3],
                 pa.array([pack.compress(r) for r in utf8_column(batch, "_text")], pa.binary())],
                names=["_id", "_h", "_doc", "_z"])

    return rows.select("_id", "_h", F.col(id_col).alias("_doc"), "_text").mapInArrow(
        tidy(run), f"_id long, _h int, _doc {kind}, _z binary")


def _cut_column(length: int):
    """An Arrow UDF (text, marks) -> the text without its repeated bytes; null without text."""
    from pyspark.sql.functions import arrow_udf
    from pyspark.sql.pandas.functions import ArrowUDFType

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for texts, marks in batches:
            for part in slices(len(texts), 256):
                raws, runs = texts[part].cast(pa.binary()).to_pylist(), marks[part].to_pylist()
                yield pa.array([r if r is None else _kept(r, covered(m, length)).decode("utf-8", "ignore")
                                for r, m in zip(raws, runs)], pa.string())

    return arrow_udf(tidy(run), "string", ArrowUDFType.SCALAR_ITER)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text (a code point that loses part
    of its bytes goes whole). Rows whose text is removed entirely are dropped; a column
    ``n_chars`` is set to the new length. Null and short texts stay as they are."""
    cut = _cut_column(length)
    rows = _keyed(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                              F.col(id_col), F.col(text_col)), id_col, text_col)
    # the text crosses the network once, inside its row
    joined = rows.select("_row", "_id", "_h").join(
        repeated_marks(rows, length), ["_id", "_h"], "left")
    hit = F.col("marks").isNotNull()
    text = text_or_empty(f"_row.`{text_col}`")
    joined = joined.withColumn("_new", F.when(hit, cut(F.when(hit, text), "marks"))) \
        .where("marks is null or _new != ''")
    out = {text_col: F.when(hit, F.col("_new")).otherwise(F.col(f"_row.`{text_col}`"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(hit, F.char_length("_new").cast(docs.schema["n_chars"].dataType)) \
            .otherwise(F.col("_row.n_chars"))
    return joined.select(*[out.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])

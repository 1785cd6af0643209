"""Periodic runs of words: suffix-tree longest common extensions and Lyndon roots.

Method: over the words of a document, Ukkonen's algorithm builds the suffix tree, and a
second one of the reversal. An Euler tour of a tree leaves the string depths between
neighbouring leaves; the depth of the lowest common ancestor of two leaves is a range
minimum over them, answered in constant time by blocks and a sparse table. So the longest
common extension of any two positions, to the right and to the left, costs constant time.
Every run holds, under one of the two orders of the alphabet, a longest Lyndon word that
starts in it and is its root: from the tour's leaf order the longest Lyndon word at each
position follows, and each of these roots is extended in both directions.

A run asked for here repeats ``RunRule.repeats`` (4) times at least, so all of its words
behind the first period occur again within the period. ``stretches`` finds, by the distance
of each word to its last occurrence, the parts of a document in which that can hold; the
proof that every such run lies whole in one of them, and ends there as it does in the
document, is at that function. Trees are built of these parts alone: prose without runs
needs none. Memory follows the longest such part of one document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import text_or_empty, tidy, utf8_column, words

#: Range minima: leaves per block of the sparse table.
BLOCK = 32
#: Documents are screened together up to about so many words.
SCREEN_WORDS = 50_000


@dataclass(frozen=True)
class RunRule:
    """Runs of at least ``repeats`` periods and ``least`` words; ``repeats`` is 2 or more."""
    repeats: int = 4
    least: int = 6


# ------------------------------------------------------------------ suffix tree
class SuffixTree:
    """Ukkonen's suffix tree of a list of numbers >= 1; the end is marked by 0.

    Edges are one dictionary keyed by (node, first symbol); node 0 is the root.
    """

    def __init__(self, symbols: list[int]):
        self.text = text = [*symbols, 0]
        self.n = n = len(text)
        self.base = base = max(text) + 1
        start, end, link = [0], [0], [0]         # of the edge into each node
        edges: dict[int, int] = {}
        active, edge, length, left = 0, 0, 0, 0
        for i in range(n):
            symbol = text[i]
            left += 1
            last = 0
            while left:
                if not length:
                    edge = i
                at = active * base + text[edge]
                child = edges.get(at)
                if child is None:
                    edges[at] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if last:
                        link[last] = active
                        last = 0
                else:
                    first = start[child]
                    span = (end[child] if end[child] <= i else i + 1) - first
                    if length >= span:           # walk down
                        edge += span
                        length -= span
                        active = child
                        continue
                    if text[first + length] == symbol:
                        length += 1
                        if last:
                            link[last] = active
                        break
                    split = len(start)
                    start += [first, i]
                    end += [first + length, n]
                    link += [0, 0]
                    edges[at] = split
                    edges[split * base + symbol] = split + 1
                    start[child] = first + length
                    edges[split * base + text[first + length]] = child
                    if last:
                        link[last] = split
                    last = split
                left -= 1
                if active:
                    active = link[active]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self.start, self.end, self.edges = start, end, edges

    def tours(self, orders=(False, True)):
        """Euler tours of the tree, children in ascending or (``True``) descending order of
        their first symbol, the end mark first in both. Per tour: the leaves (suffix
        starts) as met, and the string depth of the lowest common ancestor of each leaf and
        the next, which is the least depth that the tour passes between the two."""
        import numpy as np
        n, count = self.n, len(self.start)
        keys = np.fromiter(self.edges.keys(), dtype=np.int64, count=len(self.edges))
        child = np.fromiter(self.edges.values(), dtype=np.int64, count=len(self.edges))
        length = np.asarray(self.end, dtype=np.int64) - np.asarray(self.start, dtype=np.int64)
        parent, symbol = np.divmod(keys, self.base)
        span = length.tolist()
        for down in orders:
            # the stack gives the last child first
            rank = np.where(symbol == 0, -1, self.base - symbol if down else symbol)
            order = np.lexsort((-rank, parent))
            kids = child[order].tolist()
            at = np.searchsorted(parent[order], np.arange(count + 1)).tolist()
            leaves, between = [], []
            stack, depths, low = [0], [0], 0
            while stack:
                node = stack.pop()
                depth = depths.pop()
                lo, hi = at[node], at[node + 1]
                if lo == hi:
                    leaves.append(n - depth)
                    if depths:
                        # the tour goes back up to the parent of the next node
                        low = depths[-1] - span[stack[-1]]
                        between.append(low)
                else:
                    for k in range(lo, hi):
                        c = kids[k]
                        stack.append(c)
                        depths.append(depth + span[c])
            yield np.array(leaves, dtype=np.int64), np.array(between, dtype=np.int64)


class RangeMinimum:
    """Minima of any range of an array in constant time: a sparse table over blocks, minima
    from and to the block ends, and a scan of at most a block."""

    def __init__(self, values):
        import numpy as np
        size = max(len(values), 1)
        blocks = -(-size // BLOCK)
        self.size = size
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        padded[:len(values)] = values
        grid = padded.reshape(blocks, BLOCK)
        self.flat = padded
        self.up_to = np.minimum.accumulate(grid, axis=1).ravel()
        self.from_on = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [grid.min(axis=1)]
        while 2 << len(self.table) - 1 <= blocks:
            last, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-step], last[step:]))

    def between(self, lo, hi):
        """Minima of ``values[lo:hi]`` for arrays ``lo < hi``."""
        import numpy as np
        hi = hi - 1
        a, b = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.from_on[lo], self.up_to[hi])
        inner = np.flatnonzero(b - a > 1)
        if len(inner):
            x, y = a[inner] + 1, b[inner]
            level = np.log2(y - x).astype(np.int64)
            for k in np.unique(level):
                some = level == k
                row = self.table[k]
                rows = inner[some]
                out[rows] = np.minimum(out[rows], np.minimum(row[x[some]], row[y[some] - (1 << k)]))
        same = np.flatnonzero(a == b)
        if len(same):
            x, y = lo[same], hi[same]
            least = self.flat[x].copy()
            for step in range(1, int((y - x).max()) + 1):
                np.minimum(least, self.flat[np.minimum(x + step, y)], out=least)
            out[same] = least
        return out


class Extensions:
    """Longest common extensions to the right of any two positions of a text."""

    def __init__(self, tour):
        import numpy as np
        leaves, between = tour
        self.rank = np.empty(len(leaves), dtype=np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.minima = RangeMinimum(between)

    def common(self, i, j):
        """For arrays of positions i != j."""
        import numpy as np
        a, b = self.rank[i], self.rank[j]
        return self.minima.between(np.minimum(a, b), np.maximum(a, b))


def lyndon_lengths(rank: list[int], n: int):
    """Length of the longest Lyndon word at each of the n positions, from the order of the
    suffixes: it ends where the next smaller suffix starts."""
    import numpy as np
    out = np.empty(n, dtype=np.int64)
    smaller: list[int] = []
    for i in range(n - 1, -1, -1):
        own = rank[i]
        while smaller and rank[smaller[-1]] > own:
            smaller.pop()
        out[i] = (smaller[-1] if smaller else n) - i
        smaller.append(i)
    return out


def all_runs(symbols: list[int], rule: RunRule = RunRule()) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a list of numbers >= 1, by start and
    period: the rule holds, and no neighbour extends it."""
    import numpy as np
    n = len(symbols)
    if n < rule.least:
        return []
    up, down = SuffixTree(symbols).tours()
    right = Extensions(up)
    left = Extensions(next(SuffixTree(symbols[::-1]).tours((False,))))
    other = np.empty(n + 1, dtype=np.int64)
    other[down[0]] = np.arange(n + 1)
    found = []
    for rank in (right.rank, other):
        period = lyndon_lengths(rank.tolist(), n)
        i = np.flatnonzero(np.arange(n) + period < n)
        j = i + period[i]
        ahead = right.common(i, j)
        behind = np.zeros(len(i), dtype=np.int64)
        inner = np.flatnonzero(i > 0)
        if len(inner):
            behind[inner] = left.common(n - i[inner], n - j[inner])
        length = ahead + behind + period[i]
        whole = (length >= rule.repeats * period[i]) & (length >= rule.least)
        found.append(np.stack([(i - behind)[whole], length[whole], period[i][whole]], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)
    order = np.lexsort((runs[:, 2], runs[:, 0]))
    return [tuple(r) for r in runs[order].tolist()]


# ------------------------------------------------------------------ documents
def last_distances(tokens: list, never: int) -> list[int]:
    """Distance of each word to its last occurrence before it; ``never`` where there is none."""
    seen: dict = {}
    out = []
    for i, w in enumerate(tokens):
        out.append(i - seen.get(w, i - never))
        seen[w] = i
    return out


def stretches(distance, never: int, rule: RunRule = RunRule()):
    """``(reach, begin, end)`` arrays: parts [begin - reach, end) that hold every run whole.

    The first word of a document has distance ``never``, so several documents can stand
    behind each other. With c = ``rule.repeats``: a run [s, e) of period q has distance <= q
    at all of its e - s - q >= (c - 1) q words from s + q on. So these lie in one stretch of
    words whose distances are at most 1 / (c - 1) of its length m. Stretches are cut at the
    words beyond that bound, and again, until none is cut. In a final stretch [b, t), with
    reach r = m // (c - 1) >= q: word t, if any, differs from the one q before it, for its
    distance was beyond a bound >= q; so the run ends at t at the latest. In the same way
    word b - 1 is not among the run's words from s + q on, so s >= b - q >= b - r. A run
    found in [b - r, t) with s >= b - q cannot go on outside, by the same two arguments: its
    period is at most 1 / c of r + m <= c m / (c - 1), so at most m / (c - 1). One with
    s < b - q belongs to a stretch before and may be cut off here; it is found there.
    """
    import numpy as np
    share = rule.repeats - 1
    # words behind the first period: at least (c - 1) q, and least - q
    shortest = min(max(share * q, rule.least - q) for q in range(1, rule.least + 1))
    ok = distance < never
    while True:
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ok, [False]]).astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        long = end - begin >= shortest
        begin, end = begin[long], end[long]
        size = end - begin
        limit = np.zeros(len(distance), dtype=np.int64)
        mark = np.zeros(len(distance) + 1, dtype=np.int64)
        mark[begin] += size // share
        mark[end] -= size // share
        limit = np.cumsum(mark)[:-1]
        kept = distance <= limit
        if len(begin) == 0 or (kept == ok).all():
            return size // share, begin, end
        ok = kept


def numbered(tokens: list) -> list[int]:
    """Words as numbers from 1, alike words alike."""
    code: dict = {}
    return [code.setdefault(w, len(code) + 1) for w in tokens]


def document_runs(documents: list[list], rule: RunRule = RunRule()) -> list[list[tuple]]:
    """The runs of each document (a list of words), by start and period."""
    import numpy as np
    out: list[list[tuple]] = [[] for _ in documents]
    if not documents:
        return out
    never = 1 << 40
    distance = np.array([d for tokens in documents for d in last_distances(tokens, never)],
                        dtype=np.int64)
    if not len(distance):
        return out
    starts = np.cumsum([0] + [len(t) for t in documents])
    for reach, begin, end in zip(*(a.tolist() for a in stretches(distance, never, rule))):
        k = int(np.searchsorted(starts, begin, "right")) - 1
        lo = max(begin - reach, int(starts[k])) - int(starts[k])
        part = documents[k][lo:end - int(starts[k])]
        out[k] += [(lo + s, length, period) for s, length, period in all_runs(numbered(part), rule)
                   if lo + s + period >= begin - int(starts[k])]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(tokens: list, runs: list[tuple]) -> list:
    """The words that are not in a run behind its first period."""
    import numpy as np
    if not runs:
        return tokens
    edge = np.zeros(len(tokens) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, c in zip(tokens, np.cumsum(edge[:-1]).tolist()) if not c]


def planted(tokens: list, doc_id) -> list:
    """The words of one text as the registered query takes them: where crc32 of the id is
    a multiple of 10, the words from a place on repeat. A null id counts as the empty
    string."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(tokens), h // 10
    if h % 10 or not n:
        return tokens
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return tokens[:a] + [tokens[a + k % p] for k in range(n - a)]



def periodic_runs(docs: DataFrame, rule: RunRule = RunRule(), change=None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, runs (array of start, length, period; by start, then period) and
    collapsed (the words not in a run behind its first period, joined by a space).

    ``change(words, doc_id)`` may replace the words first. A null text has no words;
    repeated rows come out each; an empty table gives no rows; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        triple = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                     ("period", pa.int64())]))

        def block(ids, documents):
            runs = document_runs(documents, rule)
            rest = [b" ".join(collapsed(t, r)) for t, r in zip(documents, runs)]
            as_rows = [[{"start": s, "length": m, "period": q} for s, m, q in r] for r in runs]
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(as_rows, triple), pa.array(rest, pa.binary()).cast(pa.string())],
                names=["doc_id", "runs", "collapsed"])

        for batch in batches:
            documents, size, begin = [], 0, 0
            ids = batch.column(0).to_pylist() if change else None
            for k, raw in enumerate(utf8_column(batch, "_text")):
                tokens = words(raw)
                documents.append(change(tokens, ids[k]) if change else tokens)
                size += len(tokens)
                if size >= SCREEN_WORDS:
                    yield block(batch.column(0).slice(begin, len(documents)), documents)
                    documents, size, begin = [], 0, k + 1
            if documents:
                yield block(batch.column(0).slice(begin, len(documents)), documents)

    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(tidy(run), f"doc_id {id_type}, runs array<struct<start: long, "
                                      "length: long, period: long>>, collapsed string")


def run_report(docs: DataFrame, rule: RunRule = RunRule(), change=planted) -> DataFrame:
    """Per row: doc_id, n_runs, start, length, period and exponent_milli of the strongest
    run (nulls without one), runs_sha256, collapsed_sha256."""
    found = periodic_runs(docs, rule, change)
    # exact comparison of length / period by cross products; ties fall to the earlier run
    best = F.aggregate(
        "runs", F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(""))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

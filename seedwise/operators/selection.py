"""The k best rows of a large table by histogram refinement.

A sort of every row, or k rows kept per task and merged in one, is not needed to find the
k-th best score: one aggregate counts rows per bucket between the least and the greatest
score, the bucket that holds the k-th is known, and the next aggregate splits that one.
Every aggregate sends at most ``BUCKETS`` rows per task and score; after a few of them
the k-th score is known exactly, and the rows follow by a filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


@dataclass(frozen=True)
class Wanted:
    """The ``k`` rows of the highest ``score`` (a double) among the rows for which ``among``
    holds. Rows whose score is null, NaN or infinite are counted as ``odd`` and not searched."""
    score: Column
    k: int
    among: Column | None = None


@dataclass
class Cut:
    """Every row with a score above ``hi`` is wanted (``above`` rows), none below ``lo``, and
    ``k - above`` of the ``inside`` rows in [lo, hi]. ``lo`` is None when no row is there."""
    k: int
    lo: float | None
    hi: float | None
    above: int
    inside: int
    odd: int

    @property
    def exact(self) -> bool:
        return self.lo is None or self.lo == self.hi or self.above + self.inside <= self.k

    @property
    def covered(self) -> int:
        return self.above + self.inside


def _long(df: DataFrame, wanted: Sequence[Wanted]) -> DataFrame:
    """(_i, _s): the score of every row for every wanted it is among."""
    pairs = F.array(*[F.when(F.lit(True) if w.among is None else w.among,
                             F.struct(F.lit(i).alias("i"), w.score.cast("double").alias("s")))
                      for i, w in enumerate(wanted)])
    return (df.select(F.explode(F.filter(pairs, lambda p: p.isNotNull())).alias("_p"))
            .select(F.col("_p.i").alias("_i"), F.col("_p.s").alias("_s")))


def _finite(s: Column) -> Column:
    return s.isNotNull() & ~F.isnan(s) & (F.abs(s) != F.lit(float("inf")))


def _magnitude(s: Column) -> Column:
    """A number that rises with ``s``, by sign and power of two; null for odd scores."""
    power = F.floor(F.log2(F.abs(s))) + F.lit(1100)
    return F.when(~_finite(s), None).when(s == 0, F.lit(0)).otherwise(
        F.signum(s).cast("int") * power.cast("int"))


def _enter(cut: Cut, buckets: list) -> None:
    """Narrow ``cut`` to the bucket that holds its k-th row."""
    for r in sorted(buckets, key=lambda r: -r["_b"]):
        if cut.above + r["n"] >= cut.k:
            cut.lo, cut.hi, cut.inside = r["lo"], r["hi"], r["n"]
            return
        cut.above += r["n"]
    # fewer than k rows: all of them
    cut.lo, cut.hi = min(r["lo"] for r in buckets), max(r["hi"] for r in buckets)
    cut.above, cut.inside = 0, sum(r["n"] for r in buckets)


def cuts(df: DataFrame, wanted: Sequence[Wanted], slack: int = 0) -> list[Cut]:
    """Where the k-th best score of each wanted lies. Refinement ends when the cut is one
    score, or when at most ``k + slack`` rows lie in or above it. All wanted share the
    aggregates; ``df`` is read once per level: powers of two first, then equal parts of the
    bucket that holds the k-th."""
    rows = _long(df, wanted)
    s = F.col("_s")

    def histogram(kept: DataFrame, bucket: Column) -> list:
        return kept.groupBy("_i", bucket.alias("_b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_s").alias("lo"), F.max("_s").alias("hi")).collect()

    table = histogram(rows, _magnitude(s))
    out = []
    for i, w in enumerate(wanted):
        own = [r for r in table if r["_i"] == i and r["_b"] is not None]
        odd = sum(r["n"] for r in table if r["_i"] == i and r["_b"] is None)
        out.append(Cut(max(0, w.k), None, None, 0, 0, odd))
        if own and w.k > 0:
            _enter(out[-1], own)
    while True:
        open_ones = [i for i, c in enumerate(out) if not c.exact and c.covered > c.k + slack]
        if not open_ones:
            return out
        bucket = F.lit(None).cast("int")
        inside = F.lit(False)
        for i in open_ones:
            lo, hi = out[i].lo, out[i].hi
            here = (F.col("_i") == i) & (s >= F.lit(lo)) & (s <= F.lit(hi))
            # of one sign and power: the difference is exact
            share = (s - F.lit(lo)) / F.lit(hi - lo)
            bucket = F.when(here, F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
                            .cast("int")).otherwise(bucket)
            inside = inside | here
        table = histogram(rows.where(inside), bucket)
        for i in open_ones:
            _enter(out[i], [r for r in table if r["_i"] == i])

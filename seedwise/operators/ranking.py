"""Top-k, full ranking and preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwise.operators.numbering import ordered_index
from seedwise.operators.selection import Wanted, cuts


def rank_order(score: str = "score", id_col: str = "user_id") -> list[Column]:
    """Highest score first; ties by id ascending (the reference's ties fall in
    collect order, which is not stable across runs)."""
    return [F.col(score).desc(), F.col(id_col).asc()]


# Largest k served by ``TakeOrderedAndProject``, where every task keeps k rows and
# one task merges them; a larger k is selected by histogram refinement.
TAKE_ORDERED_MAX = 10_000


def top_k(scored: DataFrame, k: int, score: str = "score", id_col: str = "user_id") -> DataFrame:
    """The ``k`` best rows; ``k <= 0`` means every row.

    Small k: ``orderBy().limit(k)`` (``TakeOrderedAndProject``). k above
    ``TAKE_ORDERED_MAX``: a few aggregates find the k-th score (and, among rows of that
    score, the id that ends the list); a filter and a sort of k rows follow. Every row: a
    range-partitioned global sort.
    """
    order = rank_order(score, id_col)
    if k <= 0:
        return scored.orderBy(*order)
    if k <= TAKE_ORDERED_MAX:
        return scored.orderBy(*order).limit(k)
    return _selected(scored, k, score, id_col).orderBy(*order)


def _selected(scored: DataFrame, k: int, score: str, id_col: str) -> DataFrame:
    """The k best rows in any order. ``scored`` is read once per aggregate."""
    s = F.col(score).cast("double")
    cut = cuts(scored, [Wanted(s, k)])[0]
    if cut.odd:                         # null, NaN or infinite scores: number every row
        r = ordered_index(scored, [], rank_order(score, id_col), idx_col="_r")
        return r.where(F.col("_r") < k).drop("_r")
    if cut.lo is None or cut.covered <= k:
        return scored if cut.lo is None else scored.where(s >= F.lit(cut.lo))
    ties, left = scored.where(s == F.lit(cut.lo)), k - cut.above
    return scored.where(s > F.lit(cut.lo)).unionByName(_first_ids(ties, left, id_col))


def _first_ids(ties: DataFrame, k: int, id_col: str) -> DataFrame:
    """``k`` rows of the smallest ids, of more than k rows. Integral ids are selected by
    their high and then their low 32 bits, which doubles hold exactly; others are numbered."""
    if dict(ties.dtypes)[id_col] not in ("bigint", "int", "smallint", "tinyint") \
            or ties.where(F.col(id_col).isNull()).limit(1).count():
        r = ordered_index(ties, [], [F.col(id_col).asc()], idx_col="_r")
        return r.where(F.col("_r") < k).drop("_r")
    long = F.col(id_col).cast("bigint")
    out, rest = None, ties
    for part in (F.shiftright(long, 32), long.bitwiseAND(F.lit(0xFFFFFFFF))):
        small = -part.cast("double")
        cut = cuts(rest, [Wanted(small, k)])[0]
        if cut.covered <= k:
            chosen = rest.where(small >= F.lit(cut.lo))
            return chosen if out is None else out.unionByName(chosen)
        before = rest.where(small > F.lit(cut.lo))
        out = before if out is None else out.unionByName(before)
        rest, k = rest.where(small == F.lit(cut.lo)), k - cut.above
    return out.unionByName(rest.limit(k))       # rows of one id and one score: any of them


def all_ranked(scored: DataFrame, score: str = "score", id_col: str = "user_id",
               rank_col: str = "rank") -> DataFrame:
    """T1 with a 1-based ``rank`` over all rows, numbered without a single-task window."""
    r = ordered_index(scored, [], rank_order(score, id_col), idx_col="_r")
    return r.withColumn(rank_col, (F.col("_r") + 1).cast("bigint")).drop("_r")


def preview(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows after an explicit sort."""
    return df.orderBy(*order).limit(n)

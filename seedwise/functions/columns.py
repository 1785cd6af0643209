"""Column expressions: delimited tokens, membership, date keys, hot arrays, hashing.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def token_array(col: str | Column, sep: str = ",") -> Column:
    """split a delimited string and drop empty tokens (F5); NULL stays NULL.
    ``sep`` is plain text, not a pattern."""
    return F.filter(F.split(_c(col), rf"\Q{sep}\E"), non_empty)


def tokens_or_empty(col: str | Column, sep: str = ",") -> Column:
    """F1 with NULL read as no tokens."""
    return F.coalesce(token_array(col, sep), F.array().cast("array<string>"))


def wrap_tokens(arr: str | Column, sep: str = ",") -> Column:
    """Render an array as a delimiter-wrapped string ``,a,b,``; empty or NULL -> NULL."""
    a = _c(arr)
    return F.when(F.size(a) > 0, F.concat(F.lit(sep), F.array_join(a, sep), F.lit(sep)))


def has_token(col: str | Column, token: str | int, sep: str = ",", wrapped: bool = True) -> Column:
    """Does the delimited string hold ``token``?

    ``wrapped=True`` is the plain substring test for ``,token,``: 7 never matches 17,
    and an unwrapped ``"7"`` does not match. ``wrapped=False`` tests the token array,
    which also matches an unwrapped value.
    """
    if wrapped:
        return F.coalesce(_c(col).contains(f"{sep}{token}{sep}"), F.lit(False))
    return F.coalesce(F.array_contains(token_array(col, sep), str(token)), F.lit(False))


def non_empty(col: str | Column) -> Column:
    """not NULL and not the empty string."""
    c = _c(col)
    return c.isNotNull() & (F.length(c) > 0)


def date_key(d: str | Column, days_back: int = 0) -> Column:
    """``yyyyMMdd`` of a date ``days_back`` days earlier, as bigint."""
    return F.date_format(F.date_sub(F.to_date(_c(d)), days_back), "yyyyMMdd").cast("bigint")


def multi_hot(idx: str | Column, n: int) -> Column:
    """0/1 int array of width ``n`` with ones at the given indices.
    NULL or empty indices give all zeros; ``n == 0`` gives an empty array."""
    if n <= 0:
        return F.array().cast("array<int>")
    given = F.filter(F.coalesce(_c(idx), F.array().cast("array<int>")),
                     lambda i: i.between(0, n - 1))
    hot = F.array_sort(F.array_distinct(given))

    def block(i: Column, k: Column) -> Column:
        # the zeros since the position before, then the one: linear in the width
        before = F.when(k > 0, F.get(hot, k - 1)).otherwise(F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0), i - before - 1), F.array(F.lit(1)))

    last = F.coalesce(F.get(hot, F.size(hot) - 1), F.lit(-1))
    return F.concat(F.flatten(F.transform(hot, block)),
                    F.array_repeat(F.lit(0), F.lit(n - 1) - last))


def binarise(score: str | Column, threshold: float = 0.5) -> Column:
    """1.0 when ``score > threshold`` (strict), else 0.0."""
    return F.when(_c(score) > F.lit(threshold), F.lit(1.0)).otherwise(F.lit(0.0))


def hash_unit(col: str | Column, seed: int) -> Column:
    """A number in [0, 2^32) from the first 32 bits of md5("<value>#<seed>").

    It depends only on the value, never on partitioning or row order, so a hash
    sample or split picks the same rows on every run and every cluster size.
    """
    text = F.concat(_c(col).cast("string"), F.lit(f"#{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_below(col: str | Column, fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the distinct values of ``col``."""
    return hash_unit(col, seed) < F.lit(float(fraction) * _TWO_32)


def two_32() -> float:
    return _TWO_32

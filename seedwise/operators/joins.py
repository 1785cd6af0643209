"""Join helpers: broadcast only behind a size check, else a shuffle whose hot keys, found by
a frequency sketch, are salted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest look-up side that is broadcast: rows, and bytes where the caller knows them
# (a dictionary of long strings can be large at few rows).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# A key with more rows than this on the big side is hot: one task gets about so many of it.
HOT_ROWS = 500_000
# Keys that the sketch reports; one beyond them holds at most about 1 / 1000 of the rows.
HOT_KEYS = 1024
# Counters of the sketch (a few hundred KB a task).
SKETCH_ITEMS = 16_384
# Most copies of a hot entry of a look-up side that cannot be broadcast.
DEFAULT_SALT_BUCKETS = 1024


def bounded_broadcast(df: DataFrame, n_rows: int,
                      max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its known row count fits, else ``df`` unchanged
    (Spark then shuffles both sides; AQE may still switch at run time)."""
    return F.broadcast(df) if n_rows <= max_rows else df


def _condition(left: DataFrame, right: DataFrame, keys: Sequence[str],
               null_safe: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k]) if k in null_safe else left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


def _key_hash(df: DataFrame, keys: Sequence[str], like: DataFrame | None = None) -> Column:
    """Hash of the keys, on values of the types that they have in ``like``."""
    types = dict((like if like is not None else df).dtypes)
    own = dict(df.dtypes)
    values = [df[k] if own[k] == types[k] else df[k].try_cast(types[k]) for k in keys]
    return F.xxhash64(*[x for v in values for x in (v, v.isNull())])


def heavy_hitters(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> dict[int, int]:
    """Hash of ``keys`` -> about its number of rows, for keys of more than ``rows`` rows
    (``HOT_ROWS``): one pass with a frequency sketch, at most ``HOT_KEYS`` entries."""
    rows = HOT_ROWS if rows is None else rows
    top = (df.select(_key_hash(df, keys).alias("h"))
           .agg(F.expr(f"approx_top_k(h, {HOT_KEYS}, {SKETCH_ITEMS})").alias("t")).first()["t"])
    return {r["item"]: r["count"] for r in top or [] if r["count"] > rows}


def _copies(df: DataFrame, keys: Sequence[str], hot: dict[int, int], most: int,
            like: DataFrame | None = None) -> Column:
    """Tasks over which the rows of a key are spread: a power of two by its rows, 1 for a key
    that is not hot."""
    sizes: dict[int, list[int]] = {}
    for h, n in hot.items():
        n_tasks = min(most, 1 << max(1, (max(n, 1) // max(HOT_ROWS, 1)).bit_length()))
        sizes.setdefault(n_tasks, []).append(h)
    h, out = _key_hash(df, keys, like), F.lit(1)
    for n_tasks, hashes in sorted(sizes.items()):
        out = F.when(h.isin(hashes), n_tasks).otherwise(out)
    return out


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], small_rows: int,
                how: str = "left", null_safe: Sequence[str] = (),
                salt_from: str | Sequence[str] | None = None, small_bytes: int | None = None,
                max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Join a big table to a look-up table on ``keys`` and keep the big side's
    columns plus the small side's non-key columns.

    A look-up of known size, at most ``max_rows`` rows and ``MAX_BROADCAST_BYTES``
    bytes (``small_bytes``; unknown counts as 64 a row), is broadcast: no shuffle of
    the big side, and its partitioning survives the join. A larger look-up is joined on
    (keys, salt): the entries of hot keys (:func:`heavy_hitters`, one pass over the big
    side) are copied, at most ``salt_buckets`` times, in proportion to the key's rows, and
    those rows are dealt by a hash of ``salt_from``; every other key has one salt and one
    copy. Rows equal in the key and in all of ``salt_from`` stay together. Rows with a NULL
    key count as a key too.
    """
    s = small.alias("_lk")
    b = big.alias("_bg")
    extra = [c for c in small.columns if c not in keys]
    size = small_bytes if small_bytes is not None else 64 * small_rows
    fits = small_rows <= max_rows and size <= MAX_BROADCAST_BYTES
    if fits or salt_from is None:
        cond = _condition(b, s, keys, null_safe)
        right = F.broadcast(s) if fits else s
        return b.join(right, cond, how).select(
            *[b[c] for c in big.columns], *[s[c] for c in extra])
    hot = heavy_hitters(big, keys)
    dealt = [salt_from] if isinstance(salt_from, str) else list(salt_from)
    salted_big = b.withColumn("_salt", F.pmod(
        F.xxhash64(*[F.col(c) for c in dealt], F.lit("salt")),
        _copies(b, keys, hot, salt_buckets)).cast("int"))
    salted_small = s.withColumn("_salt", F.explode(
        F.sequence(F.lit(0), _copies(s, keys, hot, salt_buckets, b) - 1)))
    cond = _condition(salted_big, salted_small, keys, null_safe) & (
        salted_big["_salt"] == salted_small["_salt"])
    return salted_big.join(salted_small, cond, how).select(
        *[salted_big[c] for c in big.columns], *[salted_small[c] for c in extra])

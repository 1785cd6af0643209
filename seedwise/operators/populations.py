"""Seed and candidate populations: N1, N2, P1, P3, P10, A1, A10, A11, M1, M2, U1.

Seeds arrive as strings (a seed file or an id column). The reference compares
ids as strings, so ``"007"`` never matches user 7. ``seed_keys`` keeps exactly the
seeds that are the canonical decimal text of a bigint and turns them into bigint
keys, which is the same match as the string compare but joins on 8 bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwise.constants import NEGATIVES_PER_POSITIVE, SAMPLE_SEED, SPLIT_SEED  # noqa: F401
from seedwise.functions.columns import has_token, hash_below, hash_unit, two_32
from seedwise.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast


def seed_keys(seeds: DataFrame, col: str = "id") -> DataFrame:
    """Distinct bigint keys ``user_id`` of the seeds that can equal an id's text."""
    k = F.col(col).try_cast("bigint")
    return (seeds.where(k.isNotNull() & (k.cast("string") == F.col(col)))
                 .select(k.alias("user_id")).distinct())


class SeedSet:
    """Seed keys plus their checked size, so joins broadcast only when it fits."""

    def __init__(self, keys: DataFrame, n_keys: int | None = None,
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS):
        self.keys = keys
        self.n_keys = n_keys if n_keys is not None else keys.count()
        self.max_broadcast_rows = max_broadcast_rows

    @classmethod
    def from_lines(cls, seeds: DataFrame, col: str = "id", **kw) -> "SeedSet":
        return cls(seed_keys(seeds, col), **kw)

    def side(self) -> DataFrame:
        return bounded_broadcast(self.keys, self.n_keys, self.max_broadcast_rows)


def seed_users(users: DataFrame, seeds: SeedSet, id_col: str = "user_id") -> DataFrame:
    """Users whose id is a seed (every matching row; no cycle filter)."""
    return users.join(seeds.side().withColumnRenamed("user_id", id_col), id_col, "left_semi")


def non_seed_users(users: DataFrame, seeds: SeedSet, id_col: str = "user_id") -> DataFrame:
    """Users whose id is not a seed."""
    return users.join(seeds.side().withColumnRenamed("user_id", id_col), id_col, "left_anti")


def in_list(col: str | Column, codes: Sequence[int]) -> Column:
    """Code column (stored as text) cast to int and tested against the list."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.try_cast("int").isin(*codes), F.lit(False))


def code_filter(df: DataFrame, col: str, codes: Sequence[int]) -> DataFrame:
    """P1 on a frame: an integer code column is compared as is, so the ``In``
    predicate reaches the Parquet scan (``PushedFilters``); a text code keeps
    the cast-to-int semantics of the source table (``"07"`` matches 7)."""
    from pyspark.sql import types as T
    dt = df.schema[col].dataType
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return df.where(F.col(col).isin(*codes))
    return df.where(in_list(col, codes))


def in_cycle(cycle_col: str, token: int) -> Column:
    """P3 on the activity-window column."""
    return has_token(cycle_col, token)


def candidates(users: DataFrame, seeds: SeedSet, cycle_token: int, inclusive: bool,
               cycle_col: str = "cycle") -> DataFrame:
    """P10: users inside the cycle; without the seeds unless ``inclusive``."""
    cyc = users.where(in_cycle(cycle_col, cycle_token))
    return cyc if inclusive else non_seed_users(cyc, seeds)


def flag_seeds(users: DataFrame, seeds: SeedSet, id_col: str = "user_id") -> DataFrame:
    """Left join with the distinct seed keys, adding ``is_seed boolean``."""
    flags = seeds.side().withColumnRenamed("user_id", id_col).withColumn("is_seed", F.lit(True))
    return (users.join(flags, id_col, "left")
                 .withColumn("is_seed", F.coalesce(F.col("is_seed"), F.lit(False))))


def population_counts(users: DataFrame, seeds: SeedSet, cycle_token: int,
                      cycle_col: str = "cycle") -> DataFrame:
    """A1 in one pass: ``seeds`` (seed rows, any cycle), ``others`` (cycle rows that
    are not seeds), ``candidates`` (cycle rows), ``seeds_in_cycle``."""
    f = flag_seeds(users, seeds)
    cyc = in_cycle(cycle_col, cycle_token)
    return f.agg(
        F.count_if(F.col("is_seed")).alias("seeds"),
        F.count_if(cyc & ~F.col("is_seed")).alias("others"),
        F.count_if(cyc).alias("candidates"),
        F.count_if(cyc & F.col("is_seed")).alias("seeds_in_cycle"))


def sampling_ratio(n_seeds: int, n_others: int,
                   per_positive: int = NEGATIVES_PER_POSITIVE) -> float:
    """``min(1, per_positive * seeds / others)``; no others -> 1, no seeds -> error."""
    if n_seeds <= 0:
        raise ValueError("no seed matched a user; nothing to learn from")
    if n_others <= 0:
        return 1.0
    return min(1.0, float(per_positive) * n_seeds / n_others)


def negative_sample(others: DataFrame, ratio: float, seed: int = SAMPLE_SEED,
                    method: str = "hash", id_col: str = "user_id") -> DataFrame:
    """M1: about ``ratio`` of the rows, without replacement.

    ``hash`` (default) keeps a row when md5 of its id falls below the ratio: the
    same rows on every run whatever the partitioning. ``bernoulli`` is Spark's
    ``sample`` with a seed (changes with partitioning).
    """
    if ratio >= 1.0:
        return others
    if method == "bernoulli":
        return others.sample(False, ratio, seed)
    return others.where(hash_below(id_col, ratio, seed))


def hash_split(df: DataFrame, fraction: float = 0.5, seed: int = SPLIT_SEED,
               id_col: str = "user_id") -> DataFrame:
    """M2: ``half`` = 0 for about ``fraction`` of ids, else 1 (deterministic)."""
    cut = F.lit(float(fraction) * two_32())
    return df.withColumn("half", F.when(hash_unit(id_col, seed) < cut, 0).otherwise(1))


def training_set(positives: DataFrame, negatives: DataFrame,
                 cols: Sequence[str] = ("user_id",)) -> DataFrame:
    """U1 + P6: positives labelled 1.0, negatives 0.0, union by name."""
    pos = positives.select(*cols, F.lit(1.0).alias("label"))
    neg = negatives.select(*cols, F.lit(0.0).alias("label"))
    return pos.unionByName(neg)


def seed_coverage(users: DataFrame, seed_lines: DataFrame, seeds: SeedSet | None = None,
                  id_col: str = "id", seed_col: str = "id", distinct: bool = False) -> DataFrame:
    """``matched`` user rows whose id is a seed (a user row counts each
    time it appears), ``seed_size`` = seed lines (blank and repeated lines
    count), ``rate = matched / seed_size`` (NULL when there are no lines).

    ``distinct=True`` counts distinct non-blank seed lines instead."""
    if distinct:
        seed_lines = (seed_lines.where(F.length(F.col(seed_col)) > 0)
                                .select(seed_col).distinct())
    seeds = seeds or SeedSet.from_lines(seed_lines, seed_col)
    keyed = users.select(F.col(id_col).try_cast("bigint").alias("user_id"),
                         F.col(id_col).alias("_txt"))
    keyed = keyed.where(F.col("user_id").cast("string") == F.col("_txt"))
    matched = seed_users(keyed, seeds).agg(F.count(F.lit(1)).alias("matched"))
    size = seed_lines.agg(F.count(F.lit(1)).alias("seed_size"))
    # Both sides are one-row aggregates; the join key is a constant.
    return (matched.withColumn("_k", F.lit(1))
                   .join(size.withColumn("_k", F.lit(1)), "_k").drop("_k")
                   .withColumn("rate", F.try_divide(F.col("matched").cast("double"),
                                                    F.col("seed_size").cast("double"))))


def ratio_column(seeds_col: str, others_col: str,
                 per_positive: int = NEGATIVES_PER_POSITIVE) -> Column:
    """A11 as an expression over a counts row: NULL-safe, 1 when there are no others."""
    r = F.try_divide(F.lit(float(per_positive)) * F.col(seeds_col).cast("double"),
                     F.col(others_col).cast("double"))
    return F.least(F.lit(1.0), r)

"""Ordered numbering and prefix sums without a single-task window.

``row_number() over (order by x)`` with no partition key, or with a key that holds
most rows, puts every row in one task. Here the rows are range-partitioned on
(group, order) into buckets and sorted inside each bucket, the bucket of each
row is fixed by a reliable checkpoint, and each bucket is numbered on its own:
by row id for a plain index (no second shuffle), by a per-bucket window when
prefix sums are asked for. A tiny per-bucket table of counts and sums (at most
buckets + groups rows) supplies the offsets. When a checked count bounds the
rows of every group, a plain window per group is used instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwise.session import cut_lineage


def _shuffle_partitions(df: DataFrame) -> int:
    try:
        return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    except Exception:  # noqa: BLE001
        return 8


# Largest row count that one window task may number on its own (checked count or
# proven bound); above it the range-bucketed path is used.
SINGLE_TASK_ROWS = 2_000_000


def ordered_index(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                  idx_col: str = "idx", sum_cols: Sequence[str] = (),
                  buckets: int | None = None, max_rows: int | None = None) -> DataFrame:
    """Add ``idx_col``: 0-based position of the row inside its group, ordered by
    ``order_cols`` (sort-order columns such as ``F.col("v").asc_nulls_last()``).

    For every ``c`` in ``sum_cols`` also add ``c_before``: the sum of ``c`` over the
    rows of the group that come earlier. Ties in ``order_cols`` are numbered in an
    arbitrary but fixed order, so feed distinct rows when a dense index is meant.
    The group columns must not be NULL.

    ``max_rows`` is a known upper bound on the row count (a checked count, or a
    bound such as trees * leaves). When it is at most ``SINGLE_TASK_ROWS`` the
    numbering is a plain window per group: no sampling job and no checkpoint.
    """
    group_cols = list(group_cols)
    if max_rows is not None and max_rows <= SINGLE_TASK_ROWS:
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        out = df.withColumn(idx_col, (F.row_number().over(w) - 1).cast("bigint"))
        for c in sum_cols:
            prev = F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1))
            out = out.withColumn(f"{c}_before", F.coalesce(prev, F.lit(0)))
        return out
    n = buckets or _shuffle_partitions(df)
    keys = [F.col(g) for g in group_cols] + list(order_cols)
    bucketed = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                  .withColumn("_bucket", F.spark_partition_id()))
    bucketed = cut_lineage(bucketed)
    if not sum_cols:
        return _index_from_row_ids(bucketed, df.columns, group_cols, idx_col)

    w_local = Window.partitionBy("_bucket", *group_cols).orderBy(*order_cols)
    before = w_local.rowsBetween(Window.unboundedPreceding, -1)
    local = bucketed.withColumn("_pos", F.row_number().over(w_local) - 1)
    for c in sum_cols:
        local = local.withColumn(f"_pre_{c}", F.coalesce(F.sum(c).over(before), F.lit(0)))

    totals = bucketed.groupBy("_bucket", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    w_off = (Window.partitionBy(*group_cols).orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        "_bucket", *group_cols,
        F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"),
        *[F.coalesce(F.sum(f"_tot_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}")
          for c in sum_cols])

    # ``offsets`` has one row per (bucket, group) present: at most buckets + groups.
    out = local.join(F.broadcast(offsets), ["_bucket", *group_cols])
    out = out.withColumn(idx_col, (F.col("_off") + F.col("_pos")).cast("bigint"))
    for c in sum_cols:
        out = out.withColumn(f"{c}_before", F.col(f"_off_{c}") + F.col(f"_pre_{c}"))
    keep = [c for c in df.columns] + [idx_col] + [f"{c}_before" for c in sum_cols]
    return out.select(*keep)


def _index_from_row_ids(bucketed: DataFrame, columns: Sequence[str], group_cols: Sequence[str],
                        idx_col: str) -> DataFrame:
    """Dense index without a second shuffle: each checkpointed bucket is sorted,
    so ``monotonically_increasing_id`` (bucket << 33 | row in bucket) orders the
    rows, and a group's rows in a bucket are contiguous. The index is the rows of
    the group in earlier buckets plus the distance to the group's first row here."""
    rid = bucketed.withColumn("_rid", F.monotonically_increasing_id())
    firsts = rid.groupBy("_bucket", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_first"))
    w_off = (Window.partitionBy(*group_cols).orderBy("_bucket")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = firsts.select("_bucket", *group_cols, "_first",
                            F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    # one row per (bucket, group) present: at most buckets + groups rows
    out = rid.join(F.broadcast(offsets), ["_bucket", *group_cols])
    idx = (F.col("_off") + F.col("_rid") - F.col("_first")).cast("bigint")
    return out.withColumn(idx_col, idx).select(*columns, idx_col)

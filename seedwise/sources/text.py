"""Line-oriented text sources, read by the executors (no driver-side reader)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwise.constants import NULL_WORD

# A trim removes every code point up to and including the space at both ends.
_TRIM_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"


def java_trim(col: Column) -> Column:
    return F.regexp_replace(col, _TRIM_EDGES, "")


def id_lines(spark: SparkSession, path: str) -> DataFrame:
    """One id per line. A line equal to ``null`` is dropped *before* trimming,
    so `` null `` survives as ``null``; blank and duplicate lines are kept (they
    count in a coverage denominator). Output: ``id string``."""
    raw = spark.read.text(path)
    return raw.where(F.col("value") != F.lit(NULL_WORD)).select(
        java_trim(F.col("value")).alias("id"))


def column_lines(spark: SparkSession, path: str) -> DataFrame:
    """One column name per line; trimmed first, then ``null`` and blank lines
    are dropped. Output: ``col_name string``."""
    t = spark.read.text(path).select(java_trim(F.col("value")).alias("col_name"))
    return t.where((F.col("col_name") != F.lit(NULL_WORD)) & (F.length("col_name") > 0))


def read_column_list(spark: SparkSession, path: str) -> list[str]:
    """S5 as a Python list to parameterise a projection. The list is a handful of
    column names, never data rows; file order is kept."""
    rows = (spark.read.text(path)
            .select(F.monotonically_increasing_id().alias("n"),
                    java_trim(F.col("value")).alias("c"))
            .where((F.col("c") != F.lit(NULL_WORD)) & (F.length("c") > 0))
            .orderBy("n").collect())
    return [r["c"] for r in rows]


def write_lines(df: DataFrame, col: str, path: str) -> None:
    """Write one column as text lines (used by tests and round trips)."""
    df.select(F.col(col).cast("string")).write.mode("overwrite").text(path)

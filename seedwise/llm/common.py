"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwise.session import scratch_path

#: A word is a run of characters other than space and \\t \\n \\v \\f \\r.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def id_remainder(n: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n (a null id counts as the empty string)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: later steps do not
    recompute it, and a lost executor cannot change what it holds. The folder goes when
    the session ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def hash_sample(df: DataFrame, most: int, key: list[Column]) -> DataFrame:
    """At most ``most`` distinct rows of ``df``, those of the least hash of ``key``, with all
    columns and ``_copies``, the number of such rows.

    The rows are counted first and cut to a hash below ``most`` / count and a margin, so what
    the tasks send on is about ``most`` rows in all, not so many each; rows that repeat are
    added up before that, however many there are.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    n = df.count()
    if n > most:
        # the number of rows below the share is binomial: eight deviations beyond the mean
        share = min(1.0, (most + 8 * most ** 0.5 + 64) / n)
        unit = F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(1 << 32))
        df = df.where(unit < F.lit(int(share * (1 << 32))))
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
            .orderBy(F.xxhash64(*key, F.lit("sample")), *key).limit(most))


def slices(n: int, most: int = 1024):
    """Parts of a batch: what a task makes of texts stays small."""
    for lo in range(0, n, most):
        yield slice(lo, min(n, lo + most))


def tidy(run):
    """``run``, giving freed memory back at the end of a task: a worker process is kept for
    later tasks, and what its allocators hold would count against the executor."""
    def wrapped(batches):
        import ctypes

        import pyarrow as pa
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):      # not this C library
                pass
    return wrapped


def words(raw: bytes) -> list[bytes]:
    """Words of a UTF-8 text; ``bytes.split`` cuts at exactly space and \\t \\n \\v \\f \\r."""
    return raw.split()


def utf8_column(batch, name: str) -> list[bytes]:
    """A string column of an Arrow batch as UTF-8 bytes; null becomes empty."""
    import pyarrow as pa
    return [v or b"" for v in batch.column(name).cast(pa.binary()).to_pylist()]

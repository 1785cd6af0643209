"""Table sources: profile scan (S1), caller SQL (S2), latest non-empty partition
(S3), id column of a table (S7), encoded-feature scan (S8)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwise.functions.columns import date_key


def _frame(spark: SparkSession | None, source: DataFrame | str) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if spark is None:
        raise ValueError("a table name needs a session")
    return spark.table(source)


def profile_scan(source: DataFrame | str, features: Sequence[str], *,
                 id_col: str = "user_id", cycle_col: str = "cycle",
                 reader_col: str = "reader", spark: SparkSession | None = None) -> DataFrame:
    """S1 + P7: ``select id, cycle, <features…>, reader`` with the column list
    chosen at run time; id as bigint, cycle and reader as strings. Only these
    columns reach the Parquet/Hive scan."""
    df = _frame(spark, source)
    missing = [c for c in [id_col, cycle_col, reader_col, *features] if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.select(
        F.col(id_col).cast("bigint").alias("user_id"),
        F.col(cycle_col).cast("string").alias("cycle"),
        *[F.col(c) for c in features],
        F.col(reader_col).cast("string").alias("reader"),
    )


def sql_scan(spark: SparkSession, query: str) -> DataFrame:
    """Run the caller's SQL; column 0 must be bigint (the id), column 1 a
    string. Returns ``(id string, value string)``."""
    df = spark.sql(query)
    fields = df.schema.fields
    if len(fields) < 2:
        raise ValueError("the query must return at least two columns")
    if not isinstance(fields[0].dataType, T.LongType):
        raise ValueError(f"column 0 must be bigint, got {fields[0].dataType.simpleString()}")
    if not isinstance(fields[1].dataType, T.StringType):
        raise ValueError(f"column 1 must be string, got {fields[1].dataType.simpleString()}")
    # by position: the names may repeat or hold dots
    named = df.toDF(*[f"c{i}" for i in range(len(fields))])
    return named.select(F.col("c0").cast("string").alias("id"), F.col("c1").alias("value"))


def seed_from_table(source: DataFrame | str, id_col: str = "user_id",
                    spark: SparkSession | None = None) -> DataFrame:
    """The id column of a table as the seed list (strings, like a seed file)."""
    df = _frame(spark, source)
    return df.select(F.col(id_col).cast("string").alias("id"))


def _key(d: dt.date) -> int:
    return d.year * 10_000 + d.month * 100 + d.day


def latest_partition(df: DataFrame, as_of: dt.date, *, part_col: str = "stat_date",
                     where: Column | None = None, max_lookback_days: int | None = None,
                     probe: bool = True) -> tuple[int | None, DataFrame]:
    """S3: the newest ``part_col`` (``yyyyMMdd`` bigint) before ``as_of`` whose rows,
    after ``where``, are not empty; returns (key, rows of that partition).

    Probing goes back in windows of 1, 2, 4, … days, so a daily table whose
    newest partition is yesterday costs one pruned scan of one partition, and a
    gap of g days costs about log2(g) small scans. Each probe is one aggregate
    job returning a single scalar. The search goes back to the first day there is;
    ``max_lookback_days`` bounds it. No data gives ``(None, <empty frame>)``. ``probe=False`` runs a single ``max`` instead.
    """
    pred = where if where is not None else F.lit(True)
    floor = (dt.date(1, 1, 1) if max_lookback_days is None
             else as_of - dt.timedelta(days=max_lookback_days))
    floor_key = _key(floor)
    if not probe:
        # One aggregate over every candidate partition: better when the key is a
        # derived column (no partition pruning to gain from probing).
        found = (df.where((F.col(part_col) < _key(as_of)) & (F.col(part_col) >= floor_key) & pred)
                   .agg(F.max(part_col).alias("k")).first()["k"])
        if found is None:
            return None, df.where(F.lit(False))
        return int(found), df.where((F.col(part_col) == int(found)) & pred)
    hi = as_of - dt.timedelta(days=1)
    span = 1
    while hi >= floor:
        lo = floor if span > (hi - floor).days else hi - dt.timedelta(days=span - 1)
        found = (df.where((F.col(part_col) >= _key(lo)) & (F.col(part_col) <= _key(hi)) & pred)
                   .agg(F.max(part_col).alias("k")).first()["k"])
        if found is not None:
            key = int(found)
            return key, df.where((F.col(part_col) == key) & pred)
        if lo == floor:
            break
        hi = lo - dt.timedelta(days=1)
        span *= 2
    return None, df.where(F.lit(False))


def partition_days(spark: SparkSession, path: str | None = None, table: str | None = None,
                   part_col: str = "stat_date") -> list[int]:
    """Days of a partitioned table, newest first, from metadata alone: the catalogue's
    partition list, or the names of the folders below ``path``."""
    if table is not None:
        specs = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        values = [p.split("=", 1)[1] for spec in specs for p in spec.split("/")
                  if p.split("=", 1)[0] == part_col]
        return sorted({int(v) for v in values if v.isdigit()}, reverse=True)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = set()
    for entry in fs.listStatus(root) if fs.exists(root) else []:
        name, _, value = entry.getPath().getName().partition("=")
        if entry.isDirectory() and name == part_col and value.isdigit():
            days.add(int(value))
    return sorted(days, reverse=True)


def _holds_files(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(not e.getPath().getName().startswith(("_", ".")) for e in fs.listStatus(path))


def latest_day(spark: SparkSession, as_of: dt.date, *, path: str | None = None,
               table: str | None = None, fmt: str = "parquet", part_col: str = "stat_date",
               where: Column | None = None, max_lookback_days: int | None = None
               ) -> tuple[int | None, DataFrame | None]:
    """S3 on a stored table: the newest day before ``as_of`` that has rows passing ``where``;
    (key, those rows), or ``(None, None)``.

    The candidate days come from the partition list (:func:`partition_days`). Each is probed
    on its own, newest first, for one passing row, so only files of probed days are read,
    however many days the table has.
    """
    pred = where if where is not None else F.lit(True)
    floor = None if max_lookback_days is None else _key(as_of - dt.timedelta(days=max_lookback_days))
    for day in partition_days(spark, path, table, part_col):
        if day >= _key(as_of):
            continue
        if floor is not None and day < floor:
            break
        if table is not None:
            rows = spark.table(table)
        else:
            folder = f"{path.rstrip('/')}/{part_col}={day}"
            if not _holds_files(spark, folder):
                continue
            rows = spark.read.format(fmt).option("basePath", path).load(folder)
        rows = rows.withColumn(part_col, F.col(part_col).cast("bigint")) \
            .where((F.col(part_col) == day) & pred)
        if not rows.isEmpty():
            return day, rows
    return None, None


def with_date_key(df: DataFrame, ts_col: str, out: str = "stat_date") -> DataFrame:
    """Add the ``yyyyMMdd`` partition key of a timestamp/date column."""
    return df.withColumn(out, date_key(ts_col))


def encoded_scan(df: DataFrame) -> DataFrame:
    """S8 projection: ``(user_id, feature_size, feature, cycle)`` of an encoded table;
    decode with :func:`seedwise.functions.vectors.positions_to_vector`."""
    return df.select(F.col("user_id").cast("bigint"), F.col("feature_size").cast("int"),
                     "feature", F.col("cycle").cast("string"))

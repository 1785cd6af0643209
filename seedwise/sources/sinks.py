"""Sinks K1-K5 and the model source/sink S9, all with distributed writers."""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwise.constants import TREE_SCORE_SEP

PART_COL = "stat_date"


def day_key(day: dt.date, days_back: int = 0) -> int:
    return int((day - dt.timedelta(days=days_back)).strftime("%Y%m%d"))


@contextmanager
def _conf(spark, key: str, value: str):
    """A session setting for the length of one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_day_partition(df: DataFrame, path: str | None, key: int, fmt: str = "parquet",
                        table: str | None = None) -> None:
    """K1: replace one ``stat_date`` partition and leave the others alone.

    With ``table`` the rows go to a catalog table (created partitioned at ``path`` on
    first use, then inserted by position); otherwise to ``path``.

    The overwrite is dynamic: tasks write into a staging folder beside the day, and the old
    day gives way by a rename when the whole job has succeeded. A job that fails midway
    leaves the day as it was. A job without rows writes no file, which the names of the
    day's files show (every job's are new); the day is then emptied in a second step.
    """
    spark = df.sparkSession
    if table is not None and not spark.catalog.tableExists(table):
        first = (df.withColumn(PART_COL, F.lit(key).cast("bigint")).limit(0).write.format(fmt)
                 .partitionBy(PART_COL))
        (first.option("path", path) if path else first).saveAsTable(table)
    folder = f"{path if table is None else _location(spark, table)}/{PART_COL}={key}"
    before = _files(spark, folder)
    if table is None:
        (df.withColumn(PART_COL, F.lit(key).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(PART_COL).format(fmt).save(path))
    else:
        _insert_day(df, table, f"({PART_COL})", f"*, CAST({key} AS BIGINT)", "dynamic")
    if _files(spark, folder) == before:
        if table is None:
            df.limit(0).write.mode("overwrite").format(fmt).save(folder)
        else:
            _insert_day(df.limit(0), table, f"({PART_COL} = {key})", "*", "static")


def _location(spark, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")


def _files(spark, folder: str) -> set[str]:
    """Names of the files in a folder of a table (none if it is missing)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()


def _insert_day(df: DataFrame, table: str, partition: str, columns: str, mode: str) -> None:
    spark = df.sparkSession
    view = f"seedwise_day_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        with _conf(spark, "spark.sql.sources.partitionOverwriteMode", mode):
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION {partition} "
                      f"SELECT {columns} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def read_day_partitions(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a day-partitioned folder back; the key is bigint whatever discovery infers."""
    df = spark.read.format(fmt).load(path)
    return df.withColumn(PART_COL, F.col(PART_COL).cast("bigint"))


def leaf_feature_rows(df: DataFrame, onehot: str = "onehot") -> DataFrame:
    """K2 shape: ``(user_id, feature "0,1,0,…")`` from an int array column."""
    return df.select("user_id", F.array_join(F.col(onehot), ",").alias("feature"))


def write_scores_table(df: DataFrame, path: str | None, as_of: dt.date, fmt: str = "parquet",
                       table: str | None = None) -> int:
    """K3: ``(user_id, score)`` into the partition of the day before ``as_of``."""
    key = day_key(as_of, 1)
    write_day_partition(df.select(F.col("user_id").cast("bigint"), F.col("score").cast("double")),
                        path, key, fmt, table)
    return key


def write_score_file(ranked: DataFrame, path: str, sep: str = TREE_SCORE_SEP,
                     order: list[Column] | None = None) -> None:
    """K4: ``id<sep>score`` lines, highest score first. The sort is a range
    partitioned distributed sort, so part files are in rank order."""
    order = order or [F.col("score").desc(), F.col("user_id").asc()]
    (ranked.select("user_id", "score").orderBy(*order)
           .write.mode("overwrite").option("sep", sep).csv(path))


def write_id_file(ranked: DataFrame, path: str,
                  order: list[Column] | None = None) -> None:
    """K5: the ids alone, same order, at ``<path>``."""
    order = order or [F.col("score").desc(), F.col("user_id").asc()]
    (ranked.orderBy(*order).select(F.col("user_id").cast("string").alias("value"))
           .write.mode("overwrite").text(path))


def save_model(model, path: str) -> None:
    """S9 sink: persist a fitted Spark ML model."""
    model.write().overwrite().save(path)


def load_gbt_model(path: str):
    """S9 source: a saved boosted-tree regression model."""
    from pyspark.ml.regression import GBTRegressionModel
    return GBTRegressionModel.load(path)


def load_lr_model(path: str):
    """S9 source: a saved logistic regression model."""
    from pyspark.ml.classification import LogisticRegressionModel
    return LogisticRegressionModel.load(path)

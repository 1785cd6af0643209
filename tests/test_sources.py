"""Sources and sinks: text lists, caller SQL, latest partition, partition overwrite."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from seedwise.sources import sinks, tables, text


def _write(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(content)


def test_id_lines_semantics(spark, tmp_dir):
    p = f"{tmp_dir}/seeds.txt"
    _write(p, "7\nnull\n null \n\n7\n007\n\t12 \n")
    got = [r["id"] for r in text.id_lines(spark, p).collect()]
    # exact "null" dropped before trimming; " null " survives as "null"; blanks kept
    assert sorted(got) == sorted(["7", "null", "", "7", "007", "12"])


def test_column_lines_semantics(spark, tmp_dir):
    p = f"{tmp_dir}/cols.txt"
    _write(p, "sex\n null \n\n  marriage_status\nnull\nintr1\n")
    assert text.read_column_list(spark, p) == ["sex", "marriage_status", "intr1"]
    assert sorted(r["col_name"] for r in text.column_lines(spark, p).collect()) == \
        ["intr1", "marriage_status", "sex"]


def test_sql_scan_types(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").createOrReplaceTempView("t_ok")
    out = tables.sql_scan(spark, "SELECT k, v FROM t_ok")
    assert out.dtypes == [("id", "string"), ("value", "string")]
    spark.createDataFrame([(1, "a")], "k int, v string").createOrReplaceTempView("t_bad")
    with pytest.raises(ValueError):
        tables.sql_scan(spark, "SELECT k, v FROM t_bad")


def test_latest_partition_probe_and_pruning(spark, tmp_dir):
    rows = [(1, "a", 20240110), (2, "b", 20240110), (3, "a", 20240112), (4, "b", 20240115)]
    df = spark.createDataFrame(rows, "id long, kind string, stat_date long")
    path = f"{tmp_dir}/parts"
    df.write.partitionBy("stat_date").parquet(path)
    t = sinks.read_day_partitions(spark, path)
    # newest day before 2024-01-16 holding kind = 'a' is the 12th (15th only has 'b')
    key, rows_df = tables.latest_partition(t, dt.date(2024, 1, 16), where=F.col("kind") == "a")
    assert key == 20240112 and [r["id"] for r in rows_df.collect()] == [3]
    key2, _ = tables.latest_partition(t, dt.date(2024, 1, 16), where=F.col("kind") == "a",
                                      probe=False)
    assert key2 == 20240112
    none_key, empty = tables.latest_partition(t, dt.date(2024, 1, 5), max_lookback_days=30)
    assert none_key is None and empty.count() == 0
    plan = spark.read.parquet(path).where(F.col("stat_date") == 20240112)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "20240112" in plan


def test_day_partition_overwrite_keeps_other_days(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    a = spark.createDataFrame([(1, 0.5)], "user_id long, score double")
    b = spark.createDataFrame([(2, 0.7)], "user_id long, score double")
    sinks.write_day_partition(a, path, 20240101)
    sinks.write_day_partition(a, path, 20240102)
    sinks.write_day_partition(b, path, 20240101)
    got = sorted((r["user_id"], r["stat_date"]) for r in sinks.read_day_partitions(spark, path).collect())
    assert got == [(1, 20240102), (2, 20240101)]


def test_score_and_id_files(spark, tmp_dir):
    ranked = spark.createDataFrame([(3, 0.9), (1, 0.2), (2, 0.9)], "user_id long, score double")
    sinks.write_score_file(ranked, f"{tmp_dir}/scores")
    lines = []
    for name in sorted(os.listdir(f"{tmp_dir}/scores")):
        if name.startswith("part-"):
            with open(f"{tmp_dir}/scores/{name}") as f:
                lines += f.read().splitlines()
    assert lines == ["2\u00010.9", "3\u00010.9", "1\u00010.2"]
    sinks.write_id_file(ranked, f"{tmp_dir}/ids")
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_dir}/ids").collect()) == ["1", "2", "3"]


def test_score_table_is_yesterday(spark, tmp_dir):
    df = spark.createDataFrame([(1, 0.25)], "user_id long, score double")
    key = sinks.write_scores_table(df, f"{tmp_dir}/st", dt.date(2024, 3, 1))
    assert key == 20240229


def test_day_partition_table_mode(spark):
    spark.sql("DROP TABLE IF EXISTS seedwise_scores_t")
    a = spark.createDataFrame([(1, 0.5)], "user_id long, score double")
    b = spark.createDataFrame([(2, 0.7), (3, 0.1)], "user_id long, score double")
    sinks.write_day_partition(a, None, 20240101, table="seedwise_scores_t")   # created
    sinks.write_day_partition(a, None, 20240102, table="seedwise_scores_t")   # inserted
    sinks.write_day_partition(b, None, 20240101, table="seedwise_scores_t")   # replaced
    got = sorted((r["user_id"], r["stat_date"]) for r in spark.table("seedwise_scores_t").collect())
    assert got == [(1, 20240102), (2, 20240101), (3, 20240101)]
    spark.sql("DROP TABLE seedwise_scores_t")

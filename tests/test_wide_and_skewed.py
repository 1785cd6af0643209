"""Wide vectors, compacted leaf codes, hot keys in look-ups, days from the partition list."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seedwise.functions import vectors
from seedwise.operators import encode, joins, trees
from seedwise.plans import jobs
from seedwise.sources import sinks, tables


def test_vector_of_fifty_million_slots(spark):
    width = 50_000_000
    df = spark.createDataFrame([(1, "5,1,49999999,5"), (2, ""), (3, None)], "id int, p string")
    vec = vectors.positions_to_vector(df, "p", width, "features")
    got = {r.id: r.features for r in vec.collect()}
    assert {v.size for v in got.values()} == {width}
    assert list(got[1].indices) == [1, 5, 49999999] and list(got[1].values) == [1.0] * 3
    assert got[2].numNonzeros() == got[3].numNonzeros() == 0
    slots = vec.select("id", F.explode(vectors.set_slots("features")).alias("e")).select("id", "e.*")
    assert sorted(map(tuple, slots.collect())) == [(1, 1, 1.0), (1, 5, 1.0), (1, 49999999, 1.0)]
    with pytest.raises(Exception, match="outside the width"):
        vectors.positions_to_vector(spark.createDataFrame([(str(width),)], "p string"),
                                    "p", width).collect()


def test_both_vector_builders_agree(spark, monkeypatch):
    df = spark.createDataFrame([(i, ",".join(str((i * k) % 40) for k in range(1, 5)))
                                for i in range(60)], "id int, p string")
    narrow = vectors.positions_to_vector(df, "p", 40, "v").collect()
    monkeypatch.setattr(vectors, "VOCABULARY_MAX", 0)
    assert vectors.positions_to_vector(df, "p", 40, "v").collect() == narrow
    arrays = df.withColumn("p", F.split("p", ",").cast("array<int>"))
    assert [r.v for r in vectors.positions_to_vector(arrays, "p", 40, "v").collect()] == \
        [r.v for r in narrow]


def _encoded(spark, stretch: int, width: int):
    rows = [(i, width, ",".join(str(p * stretch) for p in sorted({i % 7, 7 + i % 3, 10 + i % 4})),
             ",7,", "1") for i in range(400)]
    return spark.createDataFrame(
        rows, "user_id long, feature_size int, feature string, cycle string, reader string")


def test_leaf_job_on_a_wide_table_equals_the_narrow_one(spark):
    args = dict(reader_codes=None, gbt_params=dict(max_iter=3, max_depth=3))
    narrow = jobs.leaf_job(_encoded(spark, 1, 14), width=14, **args)
    wide = jobs.leaf_job(_encoded(spark, 14_000, 200_000), width=200_000, **args)
    assert wide.model.numFeatures == 14 and narrow.code.positions is None
    assert wide.code.positions == [p * 14_000 for p in range(14)]
    expect = sorted(map(tuple, narrow.features.collect()))
    assert sorted(map(tuple, wide.features.collect())) == expect

    # a later, wider day with positions that training never set, by the saved code
    code = trees.LeafCode.from_json(wide.code.to_json())
    later = _encoded(spark, 14_000, 300_000).withColumn(
        "feature", F.concat("feature", F.lit(",5,299999")))
    again = jobs.leaf_job(later, width=300_000, model=wide.model, code=code, **args)
    assert sorted(map(tuple, again.features.collect())) == expect
    with pytest.raises(ValueError, match="leaf code"):
        jobs.leaf_job(later, width=300_000, model=wide.model, **args)
    for lf in (narrow, wide, again):
        lf.release()


def _skewed(spark):
    """A third of the rows share a value, a third share the null id; one value is null."""
    return spark.range(24_000).select(
        F.when(F.col("id") % 3 != 1, F.col("id")).alias("user_id"),
        F.when(F.col("id") % 3 != 2, F.lit("hot"))
        .when(F.col("id") % 500 != 2, F.concat(F.lit("v"), F.col("id") % 900)).alias("val"),
        F.col("id").alias("_row"))


def test_hot_keys_are_found_in_one_pass(spark):
    big = _skewed(spark)
    hot = joins.heavy_hitters(big, ["val"], rows=5_000)
    key = {r.val: r.h for r in big.select("val", joins._key_hash(big, ["val"]).alias("h")).distinct()
           .where("val = 'hot' or val is null").collect()}
    assert hot == {key["hot"]: 16_000}
    assert joins.heavy_hitters(big, ["val"], rows=20_000) == {}
    assert joins.heavy_hitters(big.limit(0), ["val"], rows=1) == {}


def test_hot_look_up_is_spread_and_complete(spark, monkeypatch):
    big = _skewed(spark)
    small = big.select("val").distinct().where("val is null or val != 'v2'") \
        .withColumn("idx", F.xxhash64("val"))
    expect = joins.lookup_join(big, small, ["val"], small_rows=400, null_safe=["val"])
    monkeypatch.setattr(joins, "HOT_ROWS", 500)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for how in ("left", "inner"):
            got = joins.lookup_join(big, small, ["val"], small_rows=400, null_safe=["val"], how=how,
                                    salt_from=["user_id", "_row"], max_rows=1)
            assert "BroadcastHash" not in got._jdf.queryExecution().executedPlan().toString()
            rows = expect if how == "left" else expect.where("val is null or val != 'v2'")
            assert got.exceptAll(rows).isEmpty() and rows.exceptAll(got).isEmpty()
            tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert max(tasks) < 4_500            # 16,000 in one task without the salt
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_hot_key_of_another_type(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    big = spark.range(200).select((F.col("id") % 2).cast("int").alias("k"), F.col("id").alias("r"))
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1 << 40, "c")], "k long, v string")
    got = joins.lookup_join(big, small, ["k"], small_rows=3, salt_from="r", max_rows=1)
    assert got.count() == 200 and got.where("v is null").isEmpty()


def test_only_hot_entries_are_copied(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 500)
    big = _skewed(spark)
    hot = joins.heavy_hitters(big, ["val"])
    small = big.select("val").distinct()
    copies = {r.val: r.n for r in small.select("val", joins._copies(
        small, ["val"], hot, joins.DEFAULT_SALT_BUCKETS).alias("n")).collect()}
    assert copies.pop("hot") == 64 and set(copies.values()) == {1}


def test_encoding_with_a_hot_value_and_a_hot_id(spark, monkeypatch):
    df = _skewed(spark).select("user_id", "val", (F.col("_row") % 1000).alias("other"))
    layout = [encode.Feature("val", False), encode.Feature("other", False)]
    enc = encode.fit_encoding(df, layout)
    expect = encode.onehot_features(df, enc, keep=(), inline=False)
    expect = sorted(map(str, expect.collect()))
    monkeypatch.setattr(joins, "HOT_ROWS", 1_000)
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 1)
    assert sorted(map(str, encode.onehot_features(df, enc, keep=(), inline=False).collect())) == expect


@pytest.mark.parametrize("stored", ["folder", "table"])
def test_latest_day_reads_only_the_probed_days(spark, tmp_dir, stored):
    path, table = f"{tmp_dir}/days", None
    rows = [(i, "a" if d != 15 else "b", 20240100 + d) for i, d in enumerate([3, 9, 12, 12, 15, 20])]
    df = spark.createDataFrame(rows, "id long, kind string, stat_date long")
    writer = df.write.partitionBy("stat_date")
    if stored == "table":
        table = "latest_day_table"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        writer.option("path", path).saveAsTable(table)
    else:
        writer.parquet(path)
    assert tables.partition_days(spark, path=None if table else path, table=table) == \
        [20240120, 20240115, 20240112, 20240109, 20240103]
    # the days that must not be read hold no valid file
    for day in (20240103, 20240109, 20240120):
        with open(f"{path}/stat_date={day}/part-0.parquet", "wb") as f:
            f.write(b"no parquet file")
    args = dict(table=table) if table else dict(path=path)
    key, got = tables.latest_day(spark, dt.date(2024, 1, 16), where=F.col("kind") == "a", **args)
    assert key == 20240112 and sorted(r.id for r in got.collect()) == [2, 3]
    assert got.select("stat_date").distinct().collect()[0][0] == 20240112
    assert all("stat_date=20240112" in f for f in got.where("true").inputFiles()) or table
    assert tables.latest_day(spark, dt.date(2024, 1, 16), where=F.col("kind") == "a",
                             max_lookback_days=3, **args) == (None, None)
    assert tables.latest_day(spark, dt.date(2024, 1, 1), **args) == (None, None)
    if table:
        spark.sql(f"DROP TABLE {table}")


def test_latest_day_skips_emptied_and_foreign_folders(spark, tmp_dir):
    import os
    path = f"{tmp_dir}/days"
    df = spark.createDataFrame([(1, "x")], "id long, v string")
    sinks.write_day_partition(df, path, 20240110)
    sinks.write_day_partition(df, path, 20240111)
    sinks.write_day_partition(df.limit(0), path, 20240111)
    os.makedirs(f"{path}/stat_date=20240112")
    os.makedirs(f"{path}/stat_date=__HIVE_DEFAULT_PARTITION__")
    os.makedirs(f"{path}/_temporary")
    key, rows = tables.latest_day(spark, dt.date(2024, 2, 1), path=path)
    assert key == 20240110 and rows.count() == 1
    assert tables.latest_day(spark, dt.date(2024, 2, 1), path=f"{tmp_dir}/none") == (None, None)

"""Sessions, sinks, wide tables, leaf maps and plans at their limits."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from seedwise.functions.columns import multi_hot, token_array
from seedwise.functions.vectors import positions_to_vector
from seedwise.operators import encode, evaluate, joins, trees
from seedwise.operators.populations import SeedSet
from seedwise.plans import jobs, runs
from seedwise.sources import sinks, tables, text

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SUBMITTED = """
import sys
sys.path.insert(0, %r)
from seedwise.session import build_session, checkpoint_dir
s = build_session()
print("GOT", s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"),
      s.conf.get("spark.sql.adaptive.enabled"), s.sparkContext.getConf().get("spark.driver.memory"))
s.stop()
"""


def test_submitted_settings_stay(tmp_path):
    job = tmp_path / "job.py"
    job.write_text(SUBMITTED % ROOT)
    import pyspark
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    env = {k: v for k, v in os.environ.items() if k != "SEEDWISE_MASTER"}
    out = subprocess.run(
        [submit, "--master", "local[3]", "--driver-memory", "700m", "--conf", "spark.ui.enabled=false",
         "--conf", "spark.sql.shuffle.partitions=777", "--conf", "spark.sql.adaptive.enabled=false",
         str(job)], capture_output=True, text=True, timeout=120, env=env | {
             "PYSPARK_PYTHON": sys.executable})
    assert "GOT local[3] 777 false 700m" in out.stdout, out.stdout + out.stderr[-2000:]


def test_separator_is_plain_text(spark):
    row = spark.range(1).select(token_array(F.lit("a|b||c"), "|").alias("t")).first()
    assert row.t == ["a", "b", "c"]


def test_multi_hot_is_linear_and_exact(spark):
    df = spark.createDataFrame([([3, 0, 3, 7, -1],), ([],), (None,), ([4],)], "i array<int>")
    got = [r.h for r in df.select(multi_hot("i", 5).alias("h")).collect()]
    assert got == [[1, 0, 0, 1, 0], [0] * 5, [0] * 5, [0, 0, 0, 0, 1]]


def test_position_outside_the_width_is_an_error(spark):
    df = spark.createDataFrame([("0,5",)], "p string")
    with pytest.raises(Exception, match="outside the width"):
        positions_to_vector(df, "p", 3).collect()


def test_sql_scan_with_repeated_names(spark):
    got = tables.sql_scan(spark, "SELECT 1L AS id, 'x' AS id").first()
    assert tuple(got) == ("1", "x")


def test_latest_partition_however_old(spark):
    import datetime as dt
    df = spark.createDataFrame([(19990704, 1), (20200101, 2)], "stat_date bigint, v int")
    for probe in (True, False):
        key, rows = tables.latest_partition(df, dt.date(2019, 5, 5), probe=probe)
        assert key == 19990704 and rows.count() == 1
        assert tables.latest_partition(df, dt.date(1998, 1, 1), probe=probe)[0] is None
        assert tables.latest_partition(df, dt.date(2019, 5, 5), probe=probe,
                                       max_lookback_days=30)[0] is None


@pytest.mark.parametrize("mode", ["path", "table"])
def test_an_empty_day_replaces_only_itself(spark, tmp_dir, mode):
    table = "day_test" if mode == "table" else None
    path = f"{tmp_dir}/days"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, feature string")
    sinks.write_day_partition(df, path, 20240101, table=table)
    sinks.write_day_partition(df, path, 20240102, table=table)
    sinks.write_day_partition(df.limit(0), path, 20240101, table=table)
    back = spark.table(table) if table else sinks.read_day_partitions(spark, path)
    assert sorted((r.user_id, r.stat_date) for r in back.collect()) == [(1, 20240102), (2, 20240102)]
    if table:
        spark.sql(f"DROP TABLE {table}")


def test_wide_table_keeps_a_rare_slot(spark):
    """A slot far beyond 100,000 that only the positives set decides the score."""
    width, rare = 200_000, 199_999
    rows = spark.range(3000).select(
        F.col("id").alias("user_id"), F.lit(width).alias("feature_size"),
        F.when(F.col("id") < 4, F.concat_ws(",", (F.col("id") % 50).cast("string"), F.lit(str(rare))))
        .otherwise(F.concat_ws(",", (F.col("id") % 50).cast("string"), (F.col("id") + 1000)
                               .cast("string"))).alias("feature"),
        F.lit(",7,").alias("cycle"))
    seeds = SeedSet.from_lines(spark.createDataFrame([(str(i),) for i in range(4)], "id string"))
    exp = jobs.expand(rows, seeds, width=width, reader_codes=None, inclusive=True, per_positive=400,
                      gbt_params={"max_iter": 2})
    score = {r.user_id: r.score for r in exp.scores.collect()}
    assert min(score[i] for i in range(4)) > 0.99
    assert max(v for i, v in score.items() if i >= 4) < 0.01
    exp.release()


def test_leaf_map_with_two_rows_of_one_id(spark):
    rows = [(i // 2, [float(i % 2), float(i % 3)], float(i % 2)) for i in range(60)]
    from seedwise.functions.vectors import dense_to_vector
    df = spark.createDataFrame(rows, "user_id long, a array<double>, label double") \
        .withColumn("features", dense_to_vector("a")).drop("a")
    model = trees.fit_gbt(df, max_iter=3, max_depth=2)
    per_leaf = trees.tree_leaves(model, df).select("user_id", "features", "tree_leaves")
    values = trees.leaf_value_map(model, df.select("user_id", "features"), per_leaf, max_entries=12)
    both = trees.tree_scores(model, per_leaf)
    for r in both.collect():
        for t, (leaf, v) in enumerate(zip(r.tree_leaves, r.tree_scores)):
            assert values[(t, leaf)] == v
    code = trees.LeafCode.by_leaf_index(model, df.select("user_id", "features"), per_leaf)
    again = trees.LeafCode.from_json(code.to_json())
    assert again.slots == code.slots and again.widths == code.widths


def test_salted_index_join_beyond_the_limits(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 5) for i in range(50)], "id long, v int")
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 1)
    monkeypatch.setattr(encode, "inline_ok", lambda enc: False)
    out, _ = encode.index_single(df, "v", ["id"])
    plan = out._jdf.queryExecution().toString()
    assert "_salt" in plan and "Broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.id, r.idx) for r in out.collect()) == [(i, i % 5) for i in range(50)]


def test_report_reads_its_input_once_and_equals_its_parts(spark):
    rows = [(0.5, 1.0), (0.9, 1.0), (0.2, 0.0), (0.7, 0.0), (0.5, 0.0), (0.1, 1.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    r = evaluate.training_report(df).first().asDict()
    assert {k: r[k] for k in ("tp", "fp", "fn", "tn")} == evaluate.confusion_matrix(df).first().asDict()
    assert r["auc"] == pytest.approx(evaluate.auc(df).first().auc)
    assert r["auc_binarised"] == pytest.approx(evaluate.auc_binarised(df).first().auc_binarised)


def test_expansion_run_scores_once_and_reports(spark, tmp_dir):
    import datetime as dt
    df = spark.range(200).select(
        F.col("id").alias("user_id"), F.lit(4).alias("feature_size"),
        F.when(F.col("id") % 4 == 0, "0,2").otherwise("1,3").alias("feature"),
        F.lit(",7,").alias("cycle"), F.lit("1").alias("reader"))
    day = dt.date(2024, 1, 10)
    sinks.write_day_partition(df, f"{tmp_dir}/features", sinks.day_key(dt.date(2010, 1, 1)))
    text.write_lines(spark.createDataFrame([(str(i),) for i in range(0, 80, 4)], "id string"), "id",
                     f"{tmp_dir}/seeds")
    exp = runs.run_expansion(spark, f"{tmp_dir}/features", f"{tmp_dir}/seeds", f"{tmp_dir}/out", day,
                             [1], gbt_params={"max_iter": 2}, scores_table="score_test", holdout=0.3)
    plan = exp.ranked._jdf.queryExecution().toString() + exp.scores._jdf.queryExecution().toString()
    assert "UDF" not in plan and exp.summary["expansion_size"] >= 0
    held = exp.summary["tp"] + exp.summary["fp"] + exp.summary["fn"] + exp.summary["tn"]
    assert held == exp.holdout.count() > 0
    assert spark.table("score_test").count() == exp.scores.count() == 180
    spark.sql("DROP TABLE score_test")
    first = runs.run_leaf_build(spark, f"{tmp_dir}/features", f"{tmp_dir}/leaf", day, [1],
                                gbt_params={"max_iter": 2}, save_to=f"{tmp_dir}/model")
    runs.run_leaf_build(spark, f"{tmp_dir}/features", f"{tmp_dir}/leaf2", day, [1],
                        model_path=f"{tmp_dir}/model")
    a, b = (sorted(map(tuple, sinks.read_day_partitions(spark, f"{tmp_dir}/{p}").collect()))
            for p in ("leaf", "leaf2"))
    assert first == 20240110 and a == b and len(a) == 200

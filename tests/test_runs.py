"""Storage-to-storage jobs and the command line, on sf0.001 with small models."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from seedwise import cli
from seedwise.plans import catalog as C
from seedwise.plans import profile as P
from seedwise.plans import runs
from seedwise.sources import sinks

AS_OF = dt.date(2024, 2, 1)


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_daily_jobs_end_to_end(spark, tmp_dir):
    prof = C._profile(spark, SF_SMALL)
    _write(f"{tmp_dir}/cols.txt", list(P.ONEHOT_COLUMNS) + ["null", ""])
    key = runs.run_onehot_build(spark, prof, f"{tmp_dir}/cols.txt", f"{tmp_dir}/features",
                                AS_OF - dt.timedelta(days=3))
    assert key == 20240129
    feats = sinks.read_day_partitions(spark, f"{tmp_dir}/features")
    assert feats.count() == prof.count()

    seeds = [r["id"] for r in P.seed_lines(spark, SF_SMALL).collect()]
    _write(f"{tmp_dir}/seeds.txt", seeds + ["null", "007"])
    exp = runs.run_expansion(spark, f"{tmp_dir}/features", f"{tmp_dir}/seeds.txt",
                             f"{tmp_dir}/scores", AS_OF, P.READER_CODES, target_size=10,
                             gbt_params={"max_iter": 3}, scores_path=f"{tmp_dir}/score_table")
    st = sinks.read_day_partitions(spark, f"{tmp_dir}/score_table")
    assert st.count() == exp.scores.count()
    assert {r["stat_date"] for r in st.select("stat_date").distinct().collect()} == {20240131}
    back = spark.read.option("sep", "\u0001").schema("user_id bigint, score double") \
        .csv(f"{tmp_dir}/scores").collect()
    assert len(back) == 10
    ids = [r["value"] for r in spark.read.text(f"{tmp_dir}/scores_1w").collect()]
    assert sorted(ids) == sorted(str(r["user_id"]) for r in back)

    lkey = runs.run_leaf_build(spark, f"{tmp_dir}/features", f"{tmp_dir}/leaves", AS_OF,
                               P.READER_CODES, gbt_params={"max_iter": 3})
    leaves = sinks.read_day_partitions(spark, f"{tmp_dir}/leaves")
    assert leaves.where(F.col("stat_date") == lkey).count() > 0

    _write(f"{tmp_dir}/singles.txt", list(P.CATEGORICAL_SINGLES))
    _write(f"{tmp_dir}/multis.txt", list(P.CATEGORICAL_MULTIS))
    runs.run_categorical_build(spark, prof, f"{tmp_dir}/singles.txt", f"{tmp_dir}/multis.txt",
                               f"{tmp_dir}/cat", AS_OF)
    assert sinks.read_day_partitions(spark, f"{tmp_dir}/cat").count() == prof.count()


def test_seedcheck_cli(spark, tmp_dir, capsys):
    P.table(spark, SF_SMALL, "orders").createOrReplaceTempView("cli_orders")
    seeds = [r["id"] for r in P.seed_lines(spark, SF_SMALL).collect()]
    _write(f"{tmp_dir}/seeds.txt", seeds)
    assert cli.main(["seedcheck", "--seeds", f"{tmp_dir}/seeds.txt",
                     "--sql", "SELECT o_custkey, o_orderstatus FROM cli_orders"]) == 0
    out = capsys.readouterr().out
    assert "matched=" in out and f"seed_size={len(seeds)}" in out


def test_onehot_and_expand_cli(spark, tmp_dir, capsys):
    C._profile(spark, SF_SMALL).createOrReplaceTempView("cli_profile")
    _write(f"{tmp_dir}/cols.txt", list(P.ONEHOT_COLUMNS))
    seeds = [r["id"] for r in P.seed_lines(spark, SF_SMALL).collect()]
    _write(f"{tmp_dir}/seeds.txt", seeds)
    assert cli.main(["onehot", "--profile", "cli_profile", "--columns", f"{tmp_dir}/cols.txt",
                     "--out", f"{tmp_dir}/oh", "--as-of", "2024-01-30"]) == 0
    codes = ",".join(str(c) for c in P.READER_CODES)
    assert cli.main(["expand", "--features", f"{tmp_dir}/oh", "--seeds", f"{tmp_dir}/seeds.txt",
                     "--out", f"{tmp_dir}/scores", "--codes", codes, "--as-of", "2024-02-01",
                     "--model", "lr", "--target", "5"]) == 0
    back = spark.read.option("sep", ",").schema("user_id bigint, score double") \
        .csv(f"{tmp_dir}/scores").collect()
    assert len(back) == 5 and all(0.0 <= r["score"] <= 1.0 for r in back)

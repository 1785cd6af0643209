"""Seeds, populations, sampling and coverage."""

import pytest

from seedwise.operators import populations as pop
from seedwise.operators.populations import SeedSet


def _users(spark):
    rows = [(7, ",7,"), (8, ",1,7,"), (9, ",17,"), (10, "7"), (11, None), (12, ",7,12,")]
    return spark.createDataFrame(rows, "user_id long, cycle string")


def _seeds(spark, ids):
    return spark.createDataFrame([(s,) for s in ids], "id string")


def test_seed_strings_match_exact_text(spark):
    seeds = SeedSet.from_lines(_seeds(spark, ["7", "007", "", "null", "8", "8", "+9", "x"]))
    assert seeds.n_keys == 2
    got = sorted(r["user_id"] for r in pop.seed_users(_users(spark), seeds).collect())
    assert got == [7, 8]


def test_cycle_token_is_delimited(spark):
    users = _users(spark)
    got = sorted(r["user_id"] for r in users.where(pop.in_cycle("cycle", 7)).collect())
    assert got == [7, 8, 12]      # 17 and the unwrapped "7" do not match


def test_counts_candidates_and_ratio(spark):
    seeds = SeedSet.from_lines(_seeds(spark, ["7", "9"]))
    c = pop.population_counts(_users(spark), seeds, 7).first().asDict()
    assert c == {"seeds": 2, "others": 2, "candidates": 3, "seeds_in_cycle": 1}
    excl = sorted(r["user_id"] for r in pop.candidates(_users(spark), seeds, 7, False).collect())
    incl = sorted(r["user_id"] for r in pop.candidates(_users(spark), seeds, 7, True).collect())
    assert excl == [8, 12] and incl == [7, 8, 12]
    assert pop.sampling_ratio(2, 2) == 1.0
    assert pop.sampling_ratio(1, 100) == pytest.approx(0.1)
    assert pop.sampling_ratio(3, 0) == 1.0
    with pytest.raises(ValueError):
        pop.sampling_ratio(0, 10)


def test_hash_sample_ignores_partitioning(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "user_id")
    a = {r["user_id"] for r in pop.negative_sample(df, 0.2).collect()}
    b = {r["user_id"] for r in pop.negative_sample(df.repartition(7), 0.2).collect()}
    assert a == b and 800 < len(a) < 1200
    s1 = {r["user_id"]: r["half"] for r in pop.hash_split(df).collect()}
    s2 = {r["user_id"]: r["half"] for r in pop.hash_split(df.repartition(3)).collect()}
    assert s1 == s2 and 2300 < sum(s1.values()) < 2700


def test_seed_coverage_counts_rows_and_lines(spark):
    users = spark.createDataFrame([("7", "a"), ("7", "b"), ("8", "c"), ("9", "d")],
                                  "id string, value string")
    lines = _seeds(spark, ["7", "7", "", "8", "007"])
    r = pop.seed_coverage(users, lines).first()
    assert (r["matched"], r["seed_size"]) == (3, 5) and r["rate"] == pytest.approx(0.6)
    d = pop.seed_coverage(users, lines, distinct=True).first()
    assert (d["matched"], d["seed_size"]) == (3, 3) and d["rate"] == pytest.approx(1.0)


def test_training_set_labels(spark):
    pos = spark.createDataFrame([(1,)], "user_id long")
    neg = spark.createDataFrame([(2,), (3,)], "user_id long")
    got = sorted((r["user_id"], r["label"]) for r in pop.training_set(pos, neg).collect())
    assert got == [(1, 1.0), (2, 0.0), (3, 0.0)]


def test_seed_join_is_broadcast_when_small(spark):
    seeds = SeedSet.from_lines(_seeds(spark, ["7"]))
    plan = pop.seed_users(_users(spark), seeds)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    big = SeedSet(seeds.keys, n_keys=10, max_broadcast_rows=5)
    assert big.side() is big.keys

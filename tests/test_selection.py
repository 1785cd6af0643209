"""Selection of the k best rows by histogram refinement."""

import random

import pytest
from pyspark.sql import functions as F

from seedwise.operators import ranking
from seedwise.operators.selection import Wanted, cuts


def scored(spark, rows, parts=4):
    return spark.createDataFrame(rows, "user_id long, score double").coalesce(parts)


def spread(rnd, kind, n):
    return {"even": lambda: [rnd.random() for _ in range(n)],
            "ties": lambda: [rnd.choice([0.0, 0.5, 0.25, -1.0]) for _ in range(n)],
            "one": lambda: [0.125] * n,
            "steep": lambda: [2.0 ** -rnd.randint(0, 900) for _ in range(n)],
            "wide": lambda: [rnd.choice([-1, 1]) * 10.0 ** rnd.randint(-300, 308) for _ in range(n)],
            }[kind]()


@pytest.mark.parametrize("kind", ["even", "ties", "one", "steep", "wide"])
def test_equals_the_full_sort(spark, monkeypatch, kind):
    monkeypatch.setattr(ranking, "TAKE_ORDERED_MAX", 0)
    rnd = random.Random(kind)
    ids = [rnd.randint(-2 ** 62, 2 ** 62) for _ in range(250)] + rnd.sample(range(1000), 250)
    rows = list(zip(ids, spread(rnd, kind, 500)))
    df = scored(spark, rows).cache()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    for k in (1, 37, 250, 499, 9999):
        assert [tuple(r) for r in ranking.top_k(df, k).collect()] == want[:k]


def test_odd_scores_text_ids_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(ranking, "TAKE_ORDERED_MAX", 0)
    odd = scored(spark, [(1, float("nan")), (2, None), (3, float("inf")), (4, 1.0), (5, float("-inf"))])
    assert [r[0] for r in ranking.top_k(odd, 4).collect()] == [1, 3, 4, 5]
    text = scored(spark, [(i, i % 3 / 3) for i in range(60)]).withColumn(
        "user_id", F.concat(F.lit("u"), F.format_string("%03d", "user_id")))
    assert [r[0] for r in ranking.top_k(text, 25).collect()] == \
        [f"u{i:03d}" for i in [*range(2, 60, 3), *range(1, 15, 3)]]
    again = scored(spark, [(7, 1.0)] * 30 + [(None, 1.0), (8, 2.0)])
    assert [r[0] for r in ranking.top_k(again, 5).collect()] == [8, None, 7, 7, 7]
    again = scored(spark, [(7, 1.0)] * 30 + [(8, 2.0), (9, 0.0)])
    assert [r[0] for r in ranking.top_k(again, 5).collect()] == [8, 7, 7, 7, 7]
    assert ranking.top_k(again.limit(0), 5).collect() == []


def test_sorts_only_the_chosen_rows(spark, monkeypatch):
    """No checkpoint, no sort below the filter, no rows kept per task."""
    monkeypatch.setattr(ranking, "TAKE_ORDERED_MAX", 10)
    monkeypatch.setattr(ranking, "ordered_index", None)
    df = spark.range(20_000).select(F.col("id").alias("user_id"),
                                    (F.col("id") % 9973 / 9973).alias("score"))
    best = ranking.top_k(df, 1500)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and plan.count("Sort") == 1 and plan.lstrip().startswith("Sort")
    assert best.count() == 1500


def test_several_at_once_and_slack(spark):
    df = spark.range(5000).select("id", F.rand(3).alias("a")).cache()
    a = sorted((r.a for r in df.collect()), reverse=True)
    first, low, none = cuts(df, [Wanted(F.col("a"), 40), Wanted(-F.col("a"), 7, F.col("id") % 2 == 0),
                                 Wanted(F.col("a"), 5, F.lit(False))])
    assert first.exact and first.above < 40 <= first.covered and first.lo == a[39]
    even = sorted(r.a for r in df.collect() if r.id % 2 == 0)
    assert low.lo == -even[6] and none.lo is None and none.covered == 0
    loose = cuts(df, [Wanted(F.col("a"), 40)], slack=100)[0]
    assert 40 <= loose.covered <= 140 and loose.lo <= a[39]

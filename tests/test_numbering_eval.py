"""Distributed numbering, exact AUC, confusion matrix, ranking."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from seedwise.operators import evaluate, ranking
from seedwise.operators.numbering import ordered_index


def _brute_index(rows):
    out = {}
    for g in {r[0] for r in rows}:
        vals = sorted(r[1] for r in rows if r[0] == g)
        for i, v in enumerate(vals):
            out[(g, v)] = i
    return out


@pytest.mark.parametrize("max_rows", [None, 10_000])
def test_ordered_index_both_paths(spark, max_rows):
    rnd = random.Random(5)
    rows = list({(rnd.randrange(3), rnd.randrange(100000)) for _ in range(3000)})
    df = spark.createDataFrame(rows, "g int, v int")
    got = ordered_index(df, ["g"], [F.col("v").asc()], "idx", buckets=7, max_rows=max_rows)
    assert {(r["g"], r["v"]): r["idx"] for r in got.collect()} == _brute_index(rows)


def test_prefix_sum_no_group(spark):
    rows = [(i, float(i % 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, w double")
    got = ordered_index(df, [], [F.col("k").asc()], "idx", sum_cols=["w"], buckets=5)
    m = {r["k"]: (r["idx"], r["w_before"]) for r in got.collect()}
    run = 0.0
    for k, w in rows:
        assert m[k] == (k, run)
        run += w


def test_auc_matches_evaluator_with_ties(spark):
    rnd = random.Random(1)
    rows = [(round(rnd.random(), 2), float(rnd.random() < 0.3)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "score double, label double")
    ours = evaluate.auc(df).first()["auc"]
    ref = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                        metricName="areaUnderROC", numBins=0).evaluate(df)
    assert ours == pytest.approx(ref, abs=1e-12)
    # brute force: pairs (pos, neg) with pos score higher, ties one half
    pos = [s for s, y in rows if y == 1]
    neg = sorted(s for s, y in rows if y == 0)
    import bisect
    tot = sum(bisect.bisect_left(neg, s) + 0.5 * (bisect.bisect_right(neg, s) - bisect.bisect_left(neg, s))
              for s in pos)
    assert ours == pytest.approx(tot / (len(pos) * len(neg)), abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.2, 1.0)], "score double, label double")
    assert evaluate.auc(df).first()["auc"] is None


def test_confusion_and_thresholds(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.5, 0.0), (0.7, 1.0), (0.2, 1.0), (0.1, 0.0)],
                               "score double, label double")
    cm = evaluate.confusion_matrix(df).first().asDict()
    assert cm == {"tp": 2, "fp": 1, "fn": 1, "tn": 1}          # >= 0.5
    assert evaluate.threshold_count(df).first()[0] == 1        # > 0.5
    pr = evaluate.precision_recall(df).first()
    assert pr["precision"] == pytest.approx(2 / 3) and pr["recall"] == pytest.approx(2 / 3)
    none = evaluate.precision_recall(df.where("score < 0.5")).first()
    assert none["precision"] is None
    ab = evaluate.auc_binarised(df).first()[0]
    # binarised at > 0.5: only 0.7 is 1
    assert ab == pytest.approx(((1 + 0.5 * 2) * 1 + 0.5 * 2 * 2) / 6)


def test_top_k_and_rank(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(40)], "user_id long, score double")
    top = [(r["user_id"], r["score"]) for r in ranking.top_k(df, 5).collect()]
    assert top == [(3, 3.0), (7, 3.0), (11, 3.0), (15, 3.0), (19, 3.0)]
    ranked = ranking.all_ranked(df).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 41))
    scores = [r["score"] for r in ranked]
    assert scores == sorted(scores, reverse=True)
    assert ranking.top_k(df, 0).count() == 40


def test_top_k_large_k_path(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(200)], "user_id long, score double")
    small = [tuple(r) for r in ranking.top_k(df, 50).collect()]
    monkeypatch.setattr(ranking, "TAKE_ORDERED_MAX", 10)
    big = ranking.top_k(df, 50)
    assert "TakeOrderedAndProject" not in big._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in big.collect()] == small

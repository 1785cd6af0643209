"""Model evaluation on (score, label) rows: A6-A9, P4, L5.

Everything is an aggregate. The exact AUC groups rows by distinct score first
(partial aggregation, so a score shared by a third of all rows is one row after
the map side), then needs a running count of negatives in score order; that
prefix sum is the distributed ``ordered_index``, never a single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwise.functions.columns import binarise
from seedwise.operators.numbering import ordered_index

from seedwise.constants import THRESHOLD


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def confusion_matrix(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``tp, fp, fn, tn`` in one pass."""
    s, y = F.col(score), F.col(label)
    pos = s >= F.lit(THRESHOLD)
    return scored.agg(
        F.count_if(pos & (y == 1)).alias("tp"),
        F.count_if(pos & (y == 0)).alias("fp"),
        F.count_if(~pos & (y == 1)).alias("fn"),
        F.count_if(~pos & (y == 0)).alias("tn"))


def precision_recall(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``precision = tp/(tp+fp)``, ``recall = tp/(tp+fn)``; NULL on a zero denominator."""
    cm = confusion_matrix(scored, score, label)
    return cm.select(_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def auc(scored: DataFrame, score: str = "score", label: str = "label",
        out: str = "auc") -> DataFrame:
    """Exact area under the ROC curve (ties count one half), one row.

    Equal to ``BinaryClassificationEvaluator(numBins=0)``; NULL when a class is missing.
    """
    y = F.col(label).cast("double")
    g = scored.groupBy(F.col(score).alias("_s")).agg(
        F.sum(y).alias("_p"), F.sum(F.lit(1.0) - y).alias("_n"))
    ranked = ordered_index(g, [], [F.col("_s").asc()], idx_col="_i", sum_cols=["_n"])
    num = F.sum(F.col("_p") * (F.col("_n_before") + F.col("_n") / F.lit(2.0)))
    den = F.sum("_p") * F.sum("_n")
    return ranked.agg(F.try_divide(num, den).alias(out))


def auc_binarised(scored: DataFrame, score: str = "score", label: str = "label",
                  out: str = "auc_binarised") -> DataFrame:
    """AUC of the 0/1 score ``score > 0.5``: two groups, so one aggregate is enough."""
    y = F.col(label).cast("double")
    above = binarise(score, THRESHOLD) == 1.0
    sums = scored.agg(F.sum(F.when(above, y)).alias("_p1"), F.sum(F.when(above, 1 - y)).alias("_n1"),
                      F.sum(y).alias("_p"), F.sum(1 - y).alias("_n"))
    return sums.select(_two_group_auc().alias(out))


def _two_group_auc() -> Column:
    """AUC from the positives and negatives above the threshold (_p1, _n1) and in all."""
    p1, n1 = F.coalesce("_p1", F.lit(0.0)), F.coalesce("_n1", F.lit(0.0))
    p0, n0 = F.col("_p") - p1, F.col("_n") - n1
    return F.try_divide(p1 * (n0 + n1 / 2.0) + p0 * n0 / 2.0, F.col("_p") * F.col("_n"))


def threshold_count(scored: DataFrame, score: str = "score", out: str = "expansion_size") -> DataFrame:
    """Number of rows with ``score > 0.5``."""
    return scored.agg(F.count_if(F.col(score) > F.lit(THRESHOLD)).alias(out))


def training_report(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Confusion matrix, precision, recall and both AUCs in one row.

    ``scored`` is read once: everything follows from its positives and negatives per
    distinct score.
    """
    y = F.col(label).cast("double")
    g = scored.groupBy(F.col(score).alias("_s")).agg(
        F.sum(y).alias("_p"), F.sum(F.lit(1.0) - y).alias("_n"))
    ranked = ordered_index(g, [], [F.col("_s").asc()], idx_col="_i", sum_cols=["_n"])
    at, over = F.col("_s") >= F.lit(THRESHOLD), F.col("_s") > F.lit(THRESHOLD)

    def total(cond: Column, col: str) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0.0)).cast("bigint")

    r = ranked.agg(
        total(at, "_p").alias("tp"), total(at, "_n").alias("fp"),
        total(~at, "_p").alias("fn"), total(~at, "_n").alias("tn"),
        F.sum(F.col("_p") * (F.col("_n_before") + F.col("_n") / F.lit(2.0))).alias("_num"),
        F.sum(F.when(over, F.col("_p"))).alias("_p1"), F.sum(F.when(over, F.col("_n"))).alias("_n1"),
        F.sum("_p").alias("_p"), F.sum("_n").alias("_n"))
    return r.select("tp", "fp", "fn", "tn",
                    _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                    F.try_divide(F.col("_num"), F.col("_p") * F.col("_n")).alias("auc"),
                    _two_group_auc().alias("auc_binarised"))

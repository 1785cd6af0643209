"""Logistic regression expansion model: L3, L4."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.constants import LR_MAX_ITER, LR_REG_PARAM, LR_TOL


def fit_lr(train: DataFrame, features: str = "features", label: str = "label",
           max_iter: int = LR_MAX_ITER, reg_param: float = LR_REG_PARAM,
           tol: float = LR_TOL) -> LogisticRegressionModel:
    """L3: binary logistic regression, L2 only, with intercept."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=reg_param, elasticNetParam=0.0, tol=tol,
                            fitIntercept=True, family="binomial")
    return lr.fit(train)


def score_lr(model: LogisticRegressionModel, df: DataFrame, features: str = "features",
             out: str = "score", hard: bool = False) -> DataFrame:
    """L4: probability of class 1 (default) or the hard 0/1 class (``hard=True``)."""
    m = model.copy().setFeaturesCol(features).setPredictionCol("_pred").setProbabilityCol("_prob")
    m = m.setRawPredictionCol("_raw")
    scored = m.transform(df)
    val = F.col("_pred") if hard else vector_to_array("_prob")[1]
    return scored.withColumn(out, val.cast("double")).drop("_pred", "_prob", "_raw")


def _weights(model: LogisticRegressionModel, spark) -> DataFrame:
    """(slot, _w): the coefficients, which the fitted model holds on the driver anyway."""
    vector = model.coefficients
    pairs = list(zip(vector.indices.tolist(), vector.values.tolist())) if hasattr(vector, "indices") \
        else list(enumerate(vector.toArray().tolist()))
    return spark.createDataFrame(pairs or [(-1, 0.0)], "slot int, _w double")


def margins(model: LogisticRegressionModel, rows: DataFrame, id_col: str = "user_id",
            positions: str = "positions") -> DataFrame:
    """L4 without a vector: ``id_col, margin``, the intercept and the coefficients at a row's hot
    positions, added up. The hard class is 1 where the margin is positive. Ids are distinct; a
    row without positions, or with null ones, has the intercept; a repeated position counts once.
    """
    sums = (rows.select(id_col, F.explode(F.array_distinct(positions)).alias("slot"))
            .join(_weights(model, rows.sparkSession), "slot")
            .groupBy(id_col).agg(F.sum("_w").alias("_s")))
    return rows.select(id_col).join(sums, id_col, "left").select(
        id_col, (F.lit(float(model.intercept)) + F.coalesce("_s", F.lit(0.0))).alias("margin"))


def lr_gradient(model: LogisticRegressionModel, rows: DataFrame, positions: str = "positions",
                label: str = "label", score: str = "score") -> DataFrame:
    """L3: the gradient of the penalised loss at the fitted coefficients, per slot:
    ``slot, n_set, positives, gradient``; slot -1 is the intercept.

    ``rows`` are the training rows: hot positions (``array<int>``), label, and the model's
    probability. With x in {0, 1}, the loss falls by mean((p - y) x) and the penalty, which
    Spark puts on standardised coefficients, by lambda * var(x) * w. All of it follows from
    sums over set positions; no dense vector is built. Slots that no row sets have a gradient
    of 0 at a coefficient of 0, and no row here. The coefficients (one number per slot, which
    the fitted model holds on the driver anyway) are looked up by a join.
    """
    spark = rows.sparkSession
    y, miss = F.col(label).cast("double"), F.col(score) - F.col(label)
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("y"), F.sum(miss).alias("d")).first()
    n = float(total["n"])
    weights = _weights(model, spark)
    per_slot = (rows.select(y.alias("_y"), miss.alias("_d"),
                            F.explode(F.array_distinct(positions)).alias("slot"))
                .groupBy("slot").agg(F.count(F.lit(1)).alias("n_set"), F.sum("_y").alias("positives"),
                                     F.sum("_d").alias("_d")))
    c = F.col("n_set").cast("double")
    variance = (c - c * c / n) / max(n - 1.0, 1.0)
    gradient = F.col("_d") / n + F.lit(float(model.getRegParam())) * variance * F.coalesce("_w", F.lit(0.0))
    slots = per_slot.join(weights, "slot", "left").select("slot", "n_set", "positives",
                                                          gradient.alias("gradient"))
    intercept = spark.createDataFrame([(-1, int(n), total["y"], (total["d"] or 0.0) / max(n, 1.0))],
                                      "slot int, n_set long, positives double, gradient double")
    return slots.unionByName(intercept)

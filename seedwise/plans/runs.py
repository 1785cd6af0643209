"""Whole jobs from storage to storage, one function per original job.

Each reads its inputs from tables or text files, runs the lazy plan of
:mod:`seedwise.plans.jobs`, and writes with the distributed writers. They are
what a scheduler calls once a day (see :mod:`seedwise.cli`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from seedwise.constants import CYCLE_TOKEN, LINEAR_SCORE_SEP, TREE_SCORE_SEP
from seedwise.operators import populations, ranking, trees
from seedwise.operators.populations import SeedSet
from seedwise.plans import jobs
from seedwise.session import scratch_path
from seedwise.sources import sinks, tables, text


def _profile(spark, source, columns, id_col, cycle_col, reader_col) -> DataFrame:
    return tables.profile_scan(source, columns, id_col=id_col, cycle_col=cycle_col,
                               reader_col=reader_col, spark=spark)


def run_onehot_build(spark: SparkSession, profile_source: DataFrame | str, columns_path: str,
                     out_path: str, as_of: dt.date, *, id_col: str = "user_id",
                     cycle_col: str = "cycle", reader_col: str = "reader",
                     table: str | None = None) -> int:
    """Column list file -> one-hot feature table, partition ``as_of``."""
    columns = text.read_column_list(spark, columns_path)
    prof = _profile(spark, profile_source, columns, id_col, cycle_col, reader_col)
    features, enc = jobs.onehot_job(prof, columns)
    key = sinks.day_key(as_of)
    sinks.write_day_partition(features, out_path, key, table=table)
    return key


def run_categorical_build(spark: SparkSession, profile_source: DataFrame | str,
                          singles_path: str, multis_path: str, out_path: str, as_of: dt.date, *,
                          id_col: str = "user_id", cycle_col: str = "cycle",
                          reader_col: str = "reader", table: str | None = None) -> int:
    """Single and multi column lists -> categorical feature table."""
    singles = text.read_column_list(spark, singles_path)
    multis = text.read_column_list(spark, multis_path)
    prof = _profile(spark, profile_source, singles + multis, id_col, cycle_col, reader_col)
    features, enc = jobs.categorical_job(prof, singles, multis)
    key = sinks.day_key(as_of)
    sinks.write_day_partition(features, out_path, key, table=table)
    return key


def load_features(spark: SparkSession, features_path: str, as_of: dt.date,
                  reader_codes: Sequence[int], max_lookback_days: int | None = None
                  ) -> tuple[int, DataFrame]:
    """S3 + P1 + P2 + S8: the newest non-empty day before ``as_of`` of an encoded
    table, rows passing the IN-list, projected to (id, feature_size, feature, cycle)."""
    key, rows = tables.latest_day(spark, as_of, path=features_path,
                                  where=populations.in_list("reader", reader_codes),
                                  max_lookback_days=max_lookback_days)
    if key is None:
        within = "" if max_lookback_days is None else f" within {max_lookback_days} days"
        raise ValueError(f"no non-empty partition{within} before {as_of}")
    return key, tables.encoded_scan(rows)


def run_expansion(spark: SparkSession, features_path: str, seed_path: str, out_path: str,
                  as_of: dt.date, reader_codes: Sequence[int], *, model: str = "gbt",
                  target_size: int = 0, inclusive: bool = False, id_file: bool = True,
                  sep: str | None = None, cycle_token: int = CYCLE_TOKEN,
                  gbt_params: dict | None = None, lr_params: dict | None = None,
                  scores_path: str | None = None, scores_table: str | None = None,
                  sample_method: str = "hash", max_lookback_days: int | None = None,
                  holdout: float = 0.0, report: bool = True) -> jobs.Expansion:
    """J3 (``model="gbt"``) / J4 (``model="lr"``): seeds file + encoded table ->
    ranked ``id<sep>score`` file and, optionally, the id-only file ``<out>_1w``.

    The model scores each candidate once: the scores are written to the shared folder, and
    the files, the score table (K3: ``scores_path``, or catalogue table ``scores_table``,
    partition of the day before ``as_of``), the expansion size and the evaluation (L5, on
    ``holdout`` of the training rows if given) come from there. ``report=True`` fills
    ``Expansion.summary``."""
    _, features = load_features(spark, features_path, as_of, reader_codes, max_lookback_days)
    width = jobs.feature_width(features)
    seeds = SeedSet.from_lines(text.id_lines(spark, seed_path))
    exp = jobs.expand(features, seeds, model=model, target_size=target_size,
                      inclusive=inclusive, width=width, cycle_token=cycle_token,
                      reader_codes=None, gbt_params=gbt_params, lr_params=lr_params,
                      sample_method=sample_method, holdout=holdout)
    stored = scratch_path(spark, "scores")
    exp.scores.write.parquet(stored)
    exp.scores = spark.read.parquet(stored)
    ranked_path = scratch_path(spark, "ranked")
    ranking.top_k(exp.scores, target_size).write.parquet(ranked_path)
    exp.ranked = spark.read.parquet(ranked_path)
    sep = sep if sep is not None else (TREE_SCORE_SEP if model == "gbt" else LINEAR_SCORE_SEP)
    sinks.write_score_file(exp.ranked, out_path, sep=sep)
    if id_file:
        sinks.write_id_file(exp.ranked, f"{out_path}_1w")
    if scores_path is not None or scores_table is not None:
        sinks.write_scores_table(exp.scores, scores_path, as_of, table=scores_table)
    if report:
        exp.summary = {**exp.expansion_size().first().asDict(),
                       **jobs.expansion_report(exp).first().asDict()}
    exp.release()
    return exp


def run_leaf_build(spark: SparkSession, features_path: str, out_path: str, as_of: dt.date,
                   reader_codes: Sequence[int], *, cycle_token: int = CYCLE_TOKEN,
                   gbt_params: dict | None = None, table: str | None = None,
                   max_lookback_days: int | None = None, model_path: str | None = None,
                   save_to: str | None = None) -> int:
    """Encoded table -> tree-leaf feature table, partition ``as_of``.

    ``save_to`` keeps the fitted trees and their leaf code; ``model_path`` uses such a
    saved pair instead of training, so the slots mean the same on every day."""
    _, features = load_features(spark, features_path, as_of, reader_codes, max_lookback_days)
    model = code = None
    if model_path is not None:
        model = sinks.load_gbt_model(f"{model_path}/trees")
        code = trees.LeafCode.from_json(spark.read.text(f"{model_path}/code", wholetext=True)
                                        .first()["value"])
    lf = jobs.leaf_job(features, cycle_token=cycle_token, reader_codes=None,
                       gbt_params=gbt_params, model=model, code=code)
    if save_to is not None:
        sinks.save_model(lf.model, f"{save_to}/trees")
        (spark.createDataFrame([(lf.code.to_json(),)], "value string").coalesce(1)
              .write.mode("overwrite").text(f"{save_to}/code"))
    key = sinks.day_key(as_of)
    sinks.write_day_partition(lf.features, out_path, key, table=table)
    lf.release()
    return key


def run_seed_check(spark: SparkSession, seed_path: str, query: str):
    """Coverage of a seed file over the rows of the caller's SQL (one row)."""
    users = tables.sql_scan(spark, query)
    return jobs.seed_check(users, text.id_lines(spark, seed_path)).first()

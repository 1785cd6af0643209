"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from seedwise.llm import (cotraining, fill_middle, interpolation, line_dedup, line_rules, mixing,
                          packing, periodic_runs, simhash, spotsigs, suffix_dedup, token_counts,
                          toxicity)
from seedwise.llm.common import documents, labels


def op1_simhash_near_dedup(spark, sf):
    return simhash.near_duplicates(documents(spark, sf))


def op2_best_fit_packing(spark, sf):
    packed = packing.pack(documents(spark, sf), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_spotsigs(spark, sf):
    return spotsigs.edited_likeness(documents(spark, sf))


def op4_source_mixing(spark, sf):
    return mixing.mix_report(documents(spark, sf))


def op5_toxicity(spark, sf):
    return toxicity.toxicity_scores(documents(spark, sf), labels(spark, sf))


def op6_suffix_dedup(spark, sf):
    return suffix_dedup.removal_report(documents(spark, sf))


def op7_deleted_interpolation(spark, sf):
    return interpolation.model_scores(documents(spark, sf))


def op8_quality_classifier(spark, sf):
    return cotraining.quality_scores(documents(spark, sf), labels(spark, sf))


def op9_token_counts(spark, sf):
    return token_counts.token_counts(documents(spark, sf))


def op10_line_rules(spark, sf):
    return line_rules.line_rules(documents(spark, sf))


def op11_fill_in_middle(spark, sf):
    return fill_middle.fim_report(documents(spark, sf))


def op12_periodic_runs(spark, sf):
    return periodic_runs.run_report(documents(spark, sf))


def op13_line_dedup(spark, sf):
    return line_dedup.line_report(documents(spark, sf))


QUERIES = {f.__name__: f for f in (op1_simhash_near_dedup, op2_best_fit_packing, op3_spotsigs,
                                   op4_source_mixing, op5_toxicity, op6_suffix_dedup,
                                   op7_deleted_interpolation, op8_quality_classifier, op9_token_counts,
                                   op10_line_rules, op11_fill_in_middle, op12_periodic_runs,
                                   op13_line_dedup)}

SQL = {"op4_source_mixing": mixing.SQL, "op11_fill_in_middle": fill_middle.SQL,
       "op13_line_dedup": line_dedup.SQL}

"""Every operator on awkward rows and on an empty table."""

import pytest

from helpers import awkward, label_rows
from seedwise.llm import (cotraining, interpolation, line_rules, mixing, packing, simhash,
                          spotsigs, suffix_dedup, token_counts, toxicity)

OPERATORS = {
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "packing": lambda s, d: packing.pack(d).where("piece = 0"),
    "spotsigs": lambda s, d: spotsigs.edited_likeness(d),
    "spot_classes": lambda s, d: spotsigs.near_classes(spotsigs.fingerprints(d)),
    "mixing": lambda s, d: mixing.mix_report(d),
    "toxicity": lambda s, d: toxicity.toxicity_scores(d, label_rows(s, range(18), {15})),
    "suffix": lambda s, d: suffix_dedup.removal_report(d),
    "language_model": lambda s, d: interpolation.model_scores(d),
    "quality": lambda s, d: cotraining.quality_scores(d, label_rows(s, range(18))),
    "tokens": lambda s, d: token_counts.token_counts(d),
    "prefixes": lambda s, d: token_counts.prefix_counts(d),
    "lines": lambda s, d: line_rules.line_rules(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_result_per_row_and_none_for_no_rows(spark, name):
    docs = awkward(spark)
    rows = OPERATORS[name](spark, docs).collect()
    assert len(rows) == docs.count()
    assert sum(r[0] is None for r in rows) == 1       # the null id is passed on
    assert OPERATORS[name](spark, docs.limit(0)).collect() == []


def test_filters_keep_the_columns(spark):
    docs = awkward(spark)
    for out in (simhash.keep_one_of_each(docs), suffix_dedup.remove_repeats(docs),
                mixing.mix(docs), cotraining.keep_good(docs, label_rows(spark, range(18)))):
        assert out.columns == docs.columns
        assert all(r["fp"] == "clash" for r in out.collect())
        assert out.schema == docs.schema or [f.dataType for f in out.schema] == [
            f.dataType for f in docs.schema]
    empty = docs.limit(0)
    for out in (simhash.keep_one_of_each(empty), suffix_dedup.remove_repeats(empty),
                mixing.mix(empty), cotraining.keep_good(empty, label_rows(spark, []))):
        assert out.columns == docs.columns and out.count() == 0


def test_no_usable_labels(spark):
    docs = awkward(spark)
    none = label_rows(spark, []).limit(0)
    assert len({r.score for r in cotraining.quality_scores(docs, none).collect()}) == 1
    scored = toxicity.toxicity_scores(docs, none).collect()
    assert all(0 <= r.score <= 1 for r in scored)

"""The five stages of the pipeline, run whole."""

import collections
import os
import tempfile

import numpy as np
import pytest

import corpus_pipeline
from helpers import awkward, label_rows, remainder, words
from seedwise.llm import cotraining, packing, simhash, suffix_dedup
from seedwise.llm.common import documents, labels, stage

SF = "/root/testdata/sf0.001"


def stages(spark, docs, sf):
    """(name, input, output) of every stage, each written as the next one's input."""
    out = []
    for name, step in corpus_pipeline.STAGES:
        made = stage(step(spark, docs, sf), f"test-{name}")
        out.append((name, docs, made))
        docs = made
    return out


@pytest.fixture(scope="module")
def run_of(spark):
    return stages(spark, documents(spark, SF), SF)


def key(r):
    return r.doc_id, r.text, r.lang, r.source, r.n_chars


def test_names_and_columns(run_of):
    assert [n for n, _, _ in run_of] == ["quality", "near_duplicates", "repeats", "mixed", "packed"]
    for _, docs, made in run_of[:-1]:
        assert made.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_good_rows(spark, run_of):
    _, docs, made = run_of[0]
    kept = {key(r) for r in made.collect()}
    rows = {key(r) for r in docs.collect()}
    assert kept < rows
    scored = {r.doc_id: r.keep for r in cotraining.quality_scores(docs, labels(spark, SF)).collect()}
    assert {k[0] for k in kept} == {i for i, keep in scored.items() if keep}
    good = {r.doc_id for r in labels(spark, SF).where("quality = 1").collect()}
    assert len(good & {k[0] for k in kept}) >= 0.95 * len(good)


def test_one_of_each_group_of_near_duplicates(run_of):
    _, docs, made = run_of[1]
    rows = docs.collect()
    prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in rows}
    top = {i: i for i in prints}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                top[y] = x
    groups = collections.defaultdict(set)
    for i in ids:
        groups[root(i)].add(i)
    kept = [r.doc_id for r in made.collect()]
    assert len(kept) == len(set(kept)) == len(groups)
    assert all(len(own & set(kept)) == 1 for own in groups.values())


def test_repeats_are_cut(run_of):
    _, docs, made = run_of[2]
    rows = [r for r in docs.collect()]
    raws = [(r.text or "").encode() for r in rows]
    seen = collections.Counter(raw[i:i + 200] for raw in raws for i in range(len(raw) - 199))
    want = {}
    for r, raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 199):
            if seen[raw[i:i + 200]] > 1:
                gone[i:i + 200] = True
        left = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        if left or not raw:
            want[r.doc_id] = left if gone.any() else r.text
    assert {r.doc_id: r.text for r in made.collect()} == want


def test_mix_is_near_the_targets(run_of):
    _, docs, made = run_of[3]
    size = collections.Counter()
    for r in docs.collect():
        size[r.source] += len(words(r.text))
    taken = collections.Counter()
    often = collections.Counter()
    for r in made.collect():
        taken[r.source] += len(words(r.text))
        often[r.doc_id] += 1
    assert max(often.values()) <= 2
    total = sum(size.values())
    assert abs(sum(taken.values()) - 1.5 * total) < 0.2 * total


def test_packed_sequences_hold_the_texts(run_of):
    from tokenizers import Tokenizer

    import public_tokenizers
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    _, docs, made = run_of[4]
    want = collections.Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[r.doc_id, tuple(ids[k:k + 2048])] += 1
    rows = made.collect()
    assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()))
                               for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()
        assert sum(n for _, n in own) <= 2048 and len(own) <= corpus_pipeline.CAPACITY.max_documents
    whole = {r.sequence_id: r.ids for r in packing.sequences(made).collect()}
    assert sum(len(v) for v in whole.values()) == 4 * sum(r.length for r in rows)


def written(docs, given):
    sf = tempfile.mkdtemp(prefix="seedwise-test-sf-")
    docs.write.parquet(os.path.join(sf, "documents.parquet"))
    given.write.parquet(os.path.join(sf, "labels.parquet"))
    return sf


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    sf = written(docs, label_rows(spark, range(18)))
    rows = corpus_pipeline.run(spark, sf).collect()
    ids = {r.doc_id for r in docs.collect()}
    assert rows and {r.doc_id for r in rows} <= ids
    empty = written(docs.limit(0), label_rows(spark, []).limit(0))
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_samples_are_bounded_and_fair(spark):
    from pyspark.sql import functions as F

    from seedwise.llm.common import hash_sample
    rows = spark.range(40_000).select((F.col("id") % 30_000).alias("k"), (F.col("id") * 0).alias("v"))
    got = hash_sample(rows, 1000, [F.col("k")]).collect()
    assert 800 < len(got) <= 1000 and all(r["_copies"] == 1 + (r["k"] < 10_000) for r in got)
    assert 0.25 < sum(r["k"] < 10_000 for r in got) / len(got) < 0.42
    hot = spark.range(20_000).select(F.lit(None).cast("long").alias("k"), F.lit(1).alias("v"))
    assert [r["_copies"] for r in hash_sample(hot, 30_000, [F.col("k")]).collect()] == [20_000]
    assert hash_sample(hot, 10, [F.col("k")]).count() <= 1

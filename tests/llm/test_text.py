"""Token counts, packing, mixing, line rules, language model and classifiers."""

import collections
import math
import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers import AWKWARD, awkward, frame, lower, remainder, words
from seedwise.llm import (cotraining, interpolation, line_rules, mixing, packing, queries,
                          token_counts, tokens, toxicity)
from seedwise.llm.common import documents, labels

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# ------------------------------------------------------------------ tokens
HARD = ["a" * 300, "the" * 60, "=-" * 100 + " x  y\n\nz ", "ñéç" * 40, "数据科学" * 40,
        "abc123def" * 20 + "don't" * 10, "<|endoftext|>x" * 10, "a.b.c-d" * 30 + " z",
        "İstanbul" * 20, "ﬁ'sﬁ" * 30, " Á ́ éx Σας ΣΑΣ. <|StartOfText|> it's IT'S x\x85y\x1cz",
        *[t or "" for t in AWKWARD[:10]], *AWKWARD[11:]]


@pytest.mark.parametrize("text", HARD)
def test_count_at_every_prefix(library, text):
    text = text[:600]
    steps = tokens.PrefixSteps(library).of_texts([text.encode()])[0]
    counts = [token_counts.count_at(steps, i) for i in range(len(text) + 1)]
    assert counts == [len(ids(library, text[:i])) for i in range(len(text) + 1)]
    assert np.frombuffer(tokens.WordIds(library).of_texts([text.encode()])[0], "<u4").tolist() == \
        ids(library, text)
    for budget in (0, 1, 5, 10_000):
        cut = token_counts.longest_within(np.frombuffer(steps, "<i2"), budget)
        assert cut == max(i for i, c in enumerate(counts) if c <= budget)


#: Letters whose lower case or normal form is another, longer or shorter string, marks, and
#: forms of compatibility, beside signs, digits and apostrophes.
ODD = ["\u0130", "\u0131", "\u01f0", "\u0149", "\u1e9e", "\u00df", "\ufb01", "\ufb03", "\u212a", "\u212b",
       "\u2126", "\u0301", "\u0307", "\u0344", "\u0340", "\u0374", "\u037e", "\u0387", "\u1fbe", "\u1f71",
       "\u03a3", "\u03c2", "\u0958", "\u09dc", "\u0e33", "\u1100", "\u1161", "\u11a8", "\uac00", "\uf900",
       "\uff21", "\uff11", "\u00b2", "\u00bd", "\u2160", "\u24b6", "\U0001d400", "\u200d", "\ufe0f", "\u0e01"]
SIGNS = [".", ",", "!", "?", ";", ":", "|", "'", "\"", "-", "(", "<|", "|>", "'s", "...", "?!", "1", "42"]


@pytest.mark.parametrize("seed", range(3))
def test_odd_letters_beside_signs(library, seed):
    rnd = random.Random(seed)
    texts = ["M\u0130?", "DE\u011e\u0130L M\u0130?", "\u0130.", "x" * 70 + "\u0130?", "\u0130?" * 40,
             *[a + b + c for a in ODD for b in SIGNS[:8] for c in ("", "a", "\u0130")][seed::3]]
    for _ in range(700):
        size = rnd.choice([2, 4, 8, 60])
        texts.append("".join(rnd.choice(rnd.choice([ODD, ODD, SIGNS, ["a", "B", "e", "the", " "]]))
                             for _ in range(size)))
    raws = [t.encode() for t in texts]
    words_table, steps_table = tokens.WordIds(library), tokens.PrefixSteps(library)
    for t, got, steps in zip(texts, words_table.of_texts(raws), steps_table.of_texts(raws)):
        assert np.frombuffer(got, "<u4").tolist() == ids(library, t), t
        step = np.frombuffer(steps, "<i2")
        assert len(step) == len(t) and step.sum() == len(ids(library, t)), t
        for i in {len(t) // 2, len(t) - 1, max(0, len(t) - 2)}:
            assert step[:i].sum() == len(ids(library, t[:i])), t[:i]


def test_long_runs_by_dynamic_programming(library):
    rnd = random.Random(4)
    run = tokens.RunCounter(library)
    for text in ("b" * 500, "".join(rnd.choice("abcdefghijklmno") for _ in range(300)), "é" * 80):
        assert run.counts(text) == [len(ids(library, text[:i])) for i in range(len(text) + 1)]


def test_small_memory_gives_the_same(library):
    table, steps = tokens.WordIds(library, 50), tokens.PrefixSteps(library, 50)
    for text in ["some words here, some there. " * 3, "and, and other; words", "there some"] * 3:
        got = steps.of_texts([text.encode()])[0]
        assert [token_counts.count_at(got, i) for i in range(len(text) + 1)] == [
            len(ids(library, text[:i])) for i in range(len(text) + 1)]
    for text in ["some words here, some there." * 3, "and, and other; words"] * 3:
        assert np.frombuffer(table.of_texts([text.encode()])[0], "<u4").tolist() == ids(library, text)


def test_token_counts_of_a_table(spark, library):
    docs = documents(spark, SF)
    want = {r.doc_id: (len(r.text.encode()), len(ids(library, r.text))) for r in docs.collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in
           token_counts.token_counts(docs).collect()}
    assert got == {i: (*v, v[1] > 2048) for i, v in want.items()}


# ------------------------------------------------------------------ packing
def check_packing(rows, capacity):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity.max_tokens and len(parts) <= capacity.max_documents
        assert sum(n * n for _, n in parts) <= capacity.max_attention
    return len(by)


def test_packing_of_a_table(spark, library):
    docs = documents(spark, SF)
    want = {}
    for r in docs.collect():
        t = ids(library, r.text) + [0]
        for piece, at in enumerate(range(0, len(t), 2048)):
            part = t[at:at + 2048]
            want[r.doc_id, piece] = (at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    packed = packing.pack(docs)
    rows = packed.collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    total = sum(v[1] for v in want.values())
    assert check_packing(rows, packing.Capacity()) <= -(-total // 2048) + 1
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert joined[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_the_pipeline_ends_in_the_packed_corpus(spark, library):
    import corpus_pipeline
    docs = documents(spark, SF).limit(60)
    want = {r.doc_id: ids(library, r.text) + [0] for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    rows = packed.collect()
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in rows:
        own = np.frombuffer(joined[r.sequence_id], "<u4")[r.offset:r.offset + r.length]
        assert own.tolist() == want[r.doc_id][r.start:r.start + r.length]
    assert sum(r.length for r in rows) == sum(map(len, want.values()))


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(spark, rule):
    rnd = random.Random(8)
    rows = [(i, 0, 0, 0, rnd.randrange(1, 300)) for i in range(400)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, ids_crc32 long, length long")
    capacity = packing.Capacity(1000, 6, 150_000)
    out = packing.assign(pieces, ["doc_id", "piece"], capacity, rule, buckets=3).collect()
    n = check_packing(out, capacity)
    lower_bound = max(sum(r[4] for r in rows) / 1000, 400 / 6, sum(r[4] ** 2 for r in rows) / 150_000)
    assert n <= 1.25 * lower_bound + 2


def test_plan_is_best_fit_one_by_one():
    rnd = random.Random(6)
    capacity = packing.Capacity(100, 5, 6000)
    for rule in ("norm", "dot"):
        lengths = sorted((rnd.randrange(1, 60) for _ in range(80)), reverse=True)
        slots, bins = packing.best_fit_plan(collections.Counter(lengths), capacity, rule)
        held = collections.defaultdict(list)
        for s in slots:
            for b in range(s.bins):
                held[s.base + b] += [s.length] * s.per
        assert sorted(n for h in held.values() for n in h) == sorted(lengths)
        assert len(held) == bins
        for h in held.values():
            assert sum(h) <= 100 and len(h) <= 5 and sum(n * n for n in h) <= 6000


# ------------------------------------------------------------------ mixing
def test_mix_report_and_copies(spark):
    docs = documents(spark, MID)
    report = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    again = {r.doc_id: r for r in mixing.mix_report(docs.repartition(7)).collect()}
    assert report == again
    taken = collections.Counter(r.doc_id for r in mixing.mix(docs).collect())
    by = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in docs.collect():
        q = report[r.doc_id]
        assert q.size == len(words(r.text)) and q.taken == q.size * taken[r.doc_id] <= 2 * q.size
        by[r.source][0] += q.taken
        by[r.source][1] = q.target
        by[r.source][2] = q.source_size
    sources = sorted(by)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    target, budget = {}, 1.5 * sum(v[2] for v in by.values())
    while True:
        rest = [s for s in sources if s not in target]
        share = (budget - sum(target.values())) / sum(weights[s] for s in rest)
        over = [s for s in rest if share * weights[s] > 2 * by[s][2]]
        if not over:
            break
        target.update({s: 2.0 * by[s][2] for s in over})
    target.update({s: share * weights[s] for s in rest})
    for s, (words_taken, t, _) in by.items():
        assert abs(t - target[s]) < 1e-6 * target[s]
        assert abs(words_taken - t) < 0.35 * t
    assert abs(sum(v[0] for v in by.values()) - budget) < 0.05 * budget


# ------------------------------------------------------------------ lines
def brute_statistics(text):
    w = words(text)
    grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit))


def test_line_statistics(spark):
    docs = documents(spark, SF).select("doc_id", "text", "source").unionByName(
        awkward(spark).where("doc_id is not null and doc_id != 6").selectExpr(
            "doc_id + 100000 as doc_id", "text", "source"))
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in line_rules.line_rules(docs).collect():
        stats = brute_statistics(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == stats
        assert r.base_failed == (stats[0] < 20 or 100 * stats[4] > 30 * stats[0])
        assert not (r.base_failed and r.kept)


def test_frequent_lines_deplete(spark):
    own = "a line that only this page number {} has with enough words to stand on its own feet here"
    menu = "home about contact imprint privacy terms shop news 0{}"
    texts = [own.format(f"p{i}q") + "\n" + menu.format(i % 10) for i in range(40)]
    texts += [menu.format(1) + "\nfollow us on every channel or write to the editors\nextra "
              + chr(97 + i % 26) * (1 + i // 26) + " words of this page" for i in range(40)]
    out = {r.doc_id: r for r in line_rules.line_rules(
        frame(spark, texts, sources=["h"] * 80), line_rules.LineLimits(documents=30)).collect()}
    assert all(out[i].kept and out[i].n_removed_words == 9 for i in range(40))
    strict = line_rules.LineLimits(documents=30, kept_share=0.6)
    out = {r.doc_id: r for r in line_rules.line_rules(
        frame(spark, texts, sources=["h"] * 80), strict).collect()}
    assert all(not out[i].kept and not out[i].base_failed for i in range(40, 80))
    copies = {r.kept for r in line_rules.line_rules(
        frame(spark, [own.format("same") + " and more words"] * 50, sources=["h"] * 50)).collect()}
    assert copies == {True}


def test_hot_lines_beyond_the_broadcast_limit(spark, monkeypatch):
    from seedwise.operators import joins
    texts = [f"a menu that every page of the host has on top\nand words of page {'abcdefgh'[i % 8]}"
             f" that only some of its pages have {'xyz'[i % 3] * (1 + i // 24)}" for i in range(240)]
    docs = frame(spark, texts, sources=[None if i % 3 else "h" for i in range(240)])
    expect = sorted(line_rules.line_rules(docs).collect())
    assert {r.n_removed_words for r in expect} == {11}
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 20)
    out = line_rules.line_rules(docs)
    assert "_salt" in out._jdf.queryExecution().toString()
    assert sorted(out.collect()) == expect


def test_limit_does_not_rise_with_the_host(spark):
    """A line in 300 documents of a host of 200,000 goes like one in 11 of a small host."""
    from pyspark.sql import functions as F
    own = "a line of its own with enough words to stand on two feet here {}"
    menu = "home about contact imprint privacy terms shop news and " * 4
    n = 200_000
    number = F.col("id").cast("string")
    big = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("big").alias("source"),
        F.when(F.col("id") < 300, F.concat(F.lit(menu + "\nu"), F.translate(number, "0123456789", "abcdefghij")))
        .otherwise(F.concat(F.lit(own.format("")), F.translate(number, "0123456789", "abcdefghij")))
        .alias("text"))
    small = spark.createDataFrame([(n + i, "small", menu + "\nv" + chr(97 + i)) for i in range(11)]
                                  + [(n + 20 + i, "fewer", menu + "\nv" + chr(97 + i)) for i in range(10)],
                                  "doc_id long, source string, text string")
    out = line_rules.line_rules(big.unionByName(small))
    removed = {r.doc_id: (r.n_removed_words, r.kept) for r in
               out.where(f"doc_id < 300 or doc_id >= {n}").collect()}
    assert removed == {i: (0, False) if i >= n + 20 else (36, False) for i in removed}
    assert out.where(f"doc_id >= 300 and doc_id < {n} and n_removed_words > 0").count() == 0


# ------------------------------------------------------------------ language model
@pytest.mark.parametrize("tokens_per_range", [500_000, 4000])
def test_model_scores(spark, monkeypatch, tokens_per_range):
    monkeypatch.setattr(interpolation, "RANGE_TOKENS", tokens_per_range)
    docs = documents(spark, SF)
    texts = {r.doc_id: [*words(lower(r.text)), None] for r in docs.collect()}
    count = collections.Counter(w for i, t in texts.items() if remainder(i, 7) != 2 for w in t)
    total, types = sum(count.values()), len(count)
    got = {r.doc_id: r for r in interpolation.model_scores(docs).collect()}
    assert len(got) == len(texts)
    better = []
    for i, t in texts.items():
        base = sum(math.log10((count[w] + 1) / (total + types + 1)) for w in t)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            remainder(i, 7) == 2, len(t), sum(count[w] > 0 for w in t), total)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and math.isfinite(r.score)
        if r.held_out:
            better.append(r.score - r.base_score)
    assert sum(better) > 0


def test_model_is_the_interpolation(spark):
    texts = ["a b a c"] * 3 + ["a b d", "d d d e"] * 2 + ["zzz a b"]
    from pyspark.sql import functions as F
    role = F.when(F.col("doc_id") == 7, 2).when(F.col("doc_id").isin(0, 4), 1).otherwise(0)
    docs = frame(spark, texts)
    got = {r.doc_id: r for r in interpolation.model_scores(docs, role).collect()}
    train = [[None, *t.split(), "\n"] for t in texts[:7]]
    one = collections.Counter(w for t in train for w in t[1:])
    two = collections.Counter(p for t in train for p in zip(t, t[1:]))
    before = collections.Counter(p[0] for t in train for p in zip(t, t[1:]))
    total, types = sum(one.values()), len(one)
    kept = [t for i, t in enumerate(train) if i not in (0, 4)]
    k1 = collections.Counter(w for t in kept for w in t[1:])
    k2 = collections.Counter(p for t in kept for p in zip(t, t[1:]))
    kb = collections.Counter(p[0] for t in kept for p in zip(t, t[1:]))
    kn = sum(k1.values())

    def cell(p):
        return -1 if p <= 0 else round(-math.log2(p) * 4)
    cells = collections.Counter()
    for i in (0, 4):
        for v, w in zip(train[i], train[i][1:]):
            if kb[v]:
                cells[int(math.log2(kb[v] + 1)), cell(k2[v, w] / kb[v]), cell(k1[w] / kn)] += 1
    table = interpolation.learn_weights([(*c, n) for c, n in cells.items()], 1 / (len(k1) + 1)).table
    for i, t in enumerate(texts):
        t = [None, *t.split(), "\n"]
        want = 0.0
        for v, w in zip(t, t[1:]):
            l2, l1, l0 = table[int(math.log2(before[v] + 1))]
            want += math.log10(l2 * two[v, w] / max(1, before[v]) + l1 * one[w] / total + l0 / (types + 1))
        assert abs(got[i].score - want) < 1e-9 * abs(want)


def test_em_raises_the_likelihood_of_its_cells():
    cells = [(3, 4, 20, 50), (3, -1, 24, 30), (5, 2, 30, 80), (5, -1, -1, 3)]
    uniform = 1e-4
    table = interpolation.learn_weights(cells, uniform).table

    def likelihood(weights):
        value = [0.0 if k < 0 else 2 ** (-k / 4) for k in (4, -1, 2, -1)]
        word = [0.0 if k < 0 else 2 ** (-k / 4) for k in (20, 24, 30, -1)]
        return sum(n * math.log(w[0] * a + w[1] * b + w[2] * uniform) for (_, _, _, n), a, b, w in
                   zip(cells, value, word, weights))
    learned = likelihood([table[c[0]] for c in cells])
    assert learned > likelihood([[1 / 3] * 3] * 4) and abs(table.sum(axis=1) - 1).max() < 1e-9


# ------------------------------------------------------------------ classifiers
def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    good = np.sum(label)
    return (rank[np.asarray(label) == 1].sum() - good * (good + 1) / 2) / (good * (len(label) - good))


def test_quality_on_held_out_rows(spark):
    given = {r.doc_id: r.quality for r in labels(spark, MID).collect()}
    rows = [r for r in queries.op8_quality_classifier(spark, MID).collect()
            if r.held_out and r.doc_id in given]
    assert all(remainder(r.doc_id, cotraining.HELD_OUT) == 0 for r in rows)
    assert auc([r.score for r in rows], [given[r.doc_id] for r in rows]) > 0.95
    good = [r.keep for r in rows if given[r.doc_id]]
    assert np.mean(good) > 0.95


def test_toxicity_on_held_out_rows(spark):
    given = {r.doc_id: r.toxic for r in labels(spark, MID).collect()}
    every = queries.op5_toxicity(spark, MID).collect()
    rows = [r for r in every if r.held_out and r.doc_id in given]
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in every)
    assert all(r.predicted == int(r.score >= 0.7) for r in every)
    assert auc([r.score for r in rows], [given[r.doc_id] for r in rows]) > 0.85
    clean = [r.predicted for r in rows if not given[r.doc_id]]
    assert np.mean(clean) < 0.05


def test_labels_of_held_out_rows_are_not_read(spark):
    from pyspark.sql import functions as F
    from seedwise.llm.common import id_remainder
    known = labels(spark, SF)
    flipped = known.withColumn("toxic", F.when(id_remainder(3) == 1, 1 - F.col("toxic"))
                               .otherwise(F.col("toxic")))
    docs = documents(spark, SF)
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity_scores(docs, x).collect()}
            for x in (known, flipped))
    assert a == pytest.approx(b)


def test_classifier_learns_posteriors_of_a_sample_drawn_by_hash(spark, monkeypatch):
    from pyspark.sql import functions as F
    seen = {}

    def spy_fit(x, y, **more):
        seen["y"] = y
        return fit(x, y, **more)

    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", spy_fit)
    learning = toxicity.Learning(training=250)       # fewer than the labelled learning rows
    docs, known = documents(spark, MID), labels(spark, MID)
    posteriors = np.array([r.posterior for r in toxicity.toxicity_scores(
        docs, known, learning).collect()])
    assert toxicity.learnable(known).count() > len(seen["y"]) == 250
    assert max(np.abs(posteriors - y).min() for y in seen["y"]) < 1e-9
    noted = docs.select(F.col("doc_id").alias("_id"), F.lit(0).alias("mask"), F.lit(0).alias("hits"),
                        F.lit(0).alias("stats")).join(
        toxicity.learnable(known), F.col("_id") == F.col("_lid"), "left")
    whole = noted.where("label is not null").count() / noted.where("crc32(string(_id)) % 3 != 1").count()
    share = toxicity.training_rows(noted, learning).where("label is not null").count() / 250
    assert abs(share - whole) < 0.1


def test_label_model_finds_accuracies_and_correlation(spark):
    rnd = np.random.default_rng(3)
    voters = toxicity.Voters(["x"], [[0]] * 6, list("abcdef"))
    n = 6000
    y = rnd.random(n) < 0.2
    hi, lo = [.8, .7, .6, .5, .6, .6], [.02, .05, .03, .02, .04, .04]
    votes = np.stack([rnd.random(n) < np.where(y, h, q) for h, q in zip(hi, lo)], axis=1)
    votes[:, 5] = votes[:, 4]                        # one voter repeats another
    masks = (votes * (1 << np.arange(6))).sum(axis=1)
    shown = rnd.random(n) < 0.2
    rows = collections.Counter((int(m), int(t) if s else None) for m, t, s in zip(masks, y, shown))
    patterns = spark.createDataFrame([(m, t, c) for (m, t), c in rows.items()],
                                     "mask long, label int, n long")
    model = toxicity.fit_label_model(patterns, voters, toxicity.Learning(rounds=20))
    assert np.abs(model.fires[1, :6] - hi).max() < 0.1 and np.abs(model.fires[0, :6] - lo).max() < 0.05
    assert model.correlation[4, 5] > 0.9 and model.correlation[0, 1] < 0.2
    p = model.posterior(toxicity.bits_of(masks, voters.count))
    assert auc(p, y.astype(int)) > 0.95

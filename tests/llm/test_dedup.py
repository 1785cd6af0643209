"""SimHash, SpotSigs and suffix operators against brute force."""

import collections
import hashlib
import random

import pytest
import xxhash

from helpers import AWKWARD, awkward, frame, lower, words
from seedwise.llm import simhash, spotsigs, suffix_dedup
from seedwise.llm.common import documents
from seedwise.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    w = words(lower(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


def test_simhash_on_a_table(spark):
    docs = documents(spark, SF)
    text = {r.doc_id: r.text for r in docs.collect()}
    fp = {i: brute_fingerprint(t) for i, t in text.items()}
    want = brute_components(sorted(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{fp[i]:016x}", want[i]) for i in fp}


@pytest.mark.parametrize("bucket", [2048, 1])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    rnd = random.Random(3)
    points = set()
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(12):            # a chain of near points around each centre
            points.add(x - ((x >> 63) << 64))
            for _ in range(rnd.randrange(1, 5)):
                x ^= 1 << rnd.randrange(64)
    points = sorted(points)
    bits = {p: p & (2 ** 64 - 1) for p in points}
    want = brute_components(points, lambda a, b: (bits[a] ^ bits[b]).bit_count() <= 3)
    links = simhash.near_links(spark.createDataFrame([(p,) for p in points], "fp long"), 3, bucket)
    got = {r.node: r.root for r in components(links).collect()}
    assert {p: got.get(p, p) for p in points} == want


def test_masks_hide_any_three_bits():
    masks = [m & (2 ** 64 - 1) for m in simhash.covering_masks()]
    rnd = random.Random(1)
    assert len(masks) == 15
    for _ in range(5000):
        d = sum(1 << b for b in rnd.sample(range(64), 3))
        assert any(m & d == 0 for m in masks)


def test_one_row_of_each_component_stays(spark):
    docs = awkward(spark)
    marked = simhash.near_duplicates(docs).collect()
    kept = simhash.keep_one_of_each(docs).collect()
    groups = {r.fingerprint for r in marked}
    assert len(kept) <= len(groups) and len(kept) == len({r.component_id for r in marked})
    assert sum(r.text is None or not (r.text or "").split() for r in kept) == 1


def test_edited_texts_and_next_documents(spark):
    docs = documents(spark, SF)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in spotsigs.edited_likeness(docs, rows_per_range=16).collect()}

    def parts(s):
        return {s[i:i + 8] for i in range(0, len(s), 8)}

    def jaccard(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    above = 0
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[1][:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - jaccard(parts(r.fingerprint), parts(r.edited_fingerprint))) < 1e-9
        assert abs(r.near_next - jaccard(parts(r.fingerprint),
                                         parts(got[following[0]].fingerprint))) < 1e-9
        above += r.near_edited > r.near_next
    assert above > 0.95 * len(rows)
    same = collections.defaultdict(set)
    for i, text in rows:
        same[text].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in same.values())


def _edited_brute(rows):
    """(id, n_chars, edited_sha256, next text) of (id, text) rows, null ids first."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("rows_per_range", [None, 7])
def test_next_document_with_text_ids_null_ids_and_copies(spark, rows_per_range):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab \n数é") for _ in range(rnd.randrange(40))) for _ in range(60)]
    rows = [(None if rnd.random() < 0.3 else f"id{rnd.randrange(120)}", rnd.choice(texts))
            for _ in range(400)] + [("id5", "copy of a row")] * 90 + [(None, "")] * 50
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = spotsigs.edited_likeness(docs, rows_per_range=rows_per_range).collect()
    expect = _edited_brute([(i, t) for i, t in rows])
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expect
    copies = [r for r in got if r.doc_id == "id5" and r.n_chars == 13 and r.near_next == 1.0]
    assert len(copies) >= 89


def test_rows_are_repeated_in_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 4), ("d", 8)], "v string, n long")
    got = spotsigs._times(df, "n", block=4).groupBy("v", "n").count().collect()
    assert all(r["count"] == r.n for r in got) and len(got) == 4


def test_chains_reach_to_the_end_and_no_text_with_words_is_empty(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(7)
    common = ["the", "of", "to", "and", "der", "la"]
    texts = ["Eser thed nt of.", "Edstou reinan ed for.", "This.", "the of and", "of the to", "",
             "!? ...", None, "the first word", "a b", "the " * 30 + "deep sea", "word " * 20]
    texts += [" ".join(rnd.choice(common) if rnd.random() < p else f"w{rnd.randrange(9)}"
                       for _ in range(rnd.randrange(1, 80))) for p in (0.1, 0.5, 0.9) for _ in range(40)]
    spans, wanted = set(), []
    for t in texts:
        w = words(t.lower().translate(str.maketrans(dict.fromkeys(spotsigs.EDGE_SIGNS, " ")))) if t else []
        own = set()
        for i, x in enumerate(w):
            content = [y for y in w[i + 1:] if y not in spotsigs.ANCHORS][:2]
            if x in spotsigs.ANCHORS:
                own |= {(x, *content)} if len(content) == 2 else set()
            elif not any(y in spotsigs.ANCHORS for y in w[i + 1:i + 9]):
                own.add((x,))
        wanted.append(own or {(x,) for x in w})
        spans |= wanted[-1]
    spans = sorted(spans)
    hashed = spark.createDataFrame([(k, list(s)) for k, s in enumerate(spans)], "k int, s array<string>") \
        .select("k", F.when(F.size("s") == 3, F.hash(*[F.get("s", F.lit(j)) for j in range(3)]))
                .otherwise(F.hash(F.get("s", F.lit(0)))).alias("h")).collect()
    number = {spans[r.k]: r.h for r in hashed}
    got = {r.doc_id: r for r in spotsigs.fingerprints(frame(spark, texts)).collect()}
    for i, own in enumerate(wanted):
        assert got[i].signatures == sorted({number[s] for s in own}), texts[i]
    assert [i for i in got if not got[i].fingerprint] == [5, 6, 7]
    assert len({got[i].fingerprint for i in (0, 1, 2, 3)}) == 4


def test_spot_classes_match_all_pairs(spark):
    base = documents(spark, SF).limit(40).collect()
    rnd = random.Random(5)
    texts = []
    for r in base:
        w = r.text.split(" ")
        texts.append(r.text)
        for k in (1, 2, 6, len(w) // 5):
            v = list(w)
            for _ in range(k):
                v[rnd.randrange(len(v))] = "changed"
            texts.append(" ".join(v))
    texts += ["", None, texts[0]]
    prints = spotsigs.fingerprints(frame(spark, texts))
    sets = {r.doc_id: frozenset(r.signatures) for r in prints.collect()}

    def near(a, b):
        a, b = sets[a], sets[b]
        return (len(a & b) >= 0.8 * len(a | b)) if a | b else True
    want = brute_components(sorted(sets), near)
    distinct = set(sets.values())
    links = {s: sum(1 for t in distinct if t != s and s | t and len(s & t) >= 0.8 * len(s | t))
             for s in distinct}
    got = {r.doc_id: (r.class_id, r.links) for r in spotsigs.near_classes(prints).collect()}
    assert got == {i: (want[i], links[sets[i]]) for i in sets}


def brute_removed(texts):
    raws = [(t or "").encode() for t in texts]
    count = collections.Counter(r[p:p + 200] for r in raws for p in range(len(r) - 199))
    out = []
    for r in raws:
        gone = [False] * len(r)
        for p in range(len(r) - 199):
            if count[r[p:p + 200]] > 1:
                gone[p:p + 200] = [True] * 200
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket,hot_rows", [(512, 10_000), (1, 10_000), (512, 2), (1, 2)])
def test_removed_bytes(spark, bucket, hot_rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot_rows)
    rnd = random.Random(9)
    base = "".join(rnd.choice("abcd ") for _ in range(2000))
    texts = list(AWKWARD)
    for _ in range(60):
        t = ""
        while len(t) < rnd.randrange(100, 900):
            i = rnd.randrange(1700)
            t += base[i:i + rnd.randrange(150, 300)] if rnd.random() < .6 else \
                "".join(rnd.choice("éabcdefgh") for _ in range(rnd.randrange(1, 120)))
        texts.append(t)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_removed(texts)))
    kept = suffix_dedup.remove_repeats(frame(spark, texts))
    assert all(r.text is None or r.n_chars == len(r.text) for r in kept.collect())


def test_hot_keys_keep_their_rows_in_place(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 50)
    monkeypatch.setattr(suffix_dedup, "HOT_KEYS", 3)
    rows = spark.range(900).selectExpr("if(id < 600, 0, id div 2) k", "id v")
    found = suffix_dedup.stage(rows.groupBy("k").count().where("count > 1"), "found")
    got = suffix_dedup._matched(rows, found, ["k"], "count", 900)
    assert sorted(tuple(r) for r in got.select("k", "v", "count").collect()) == \
        [(0, v, 600) for v in range(600)] + [(v // 2, v, 2) for v in range(600, 900)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "broadcast" in plan


def test_a_pack_names_each_window_once():
    import numpy as np
    import pyarrow as pa
    rnd = np.random.default_rng(4)
    packs = [rnd.integers(0, 40, 200).astype(np.uint64) << np.uint64(32) for _ in range(3)]
    packs.append(np.arange(100, 130).astype(np.uint64) << np.uint64(32))
    ask = pa.RecordBatch.from_arrays(
        [pa.array(range(4)), pa.array([p.tobytes() for p in packs]),
         pa.array([(p * np.uint64(3)).tobytes() for p in packs])], names=["pack", "one", "two"])
    asked = pa.Table.from_batches(suffix_dedup._ask(iter([ask]), 5)).sort_by("range")
    assert sum(len(b) // 8 for b in asked.column("one").to_pylist()) == \
        sum(len(set(p.tolist())) for p in packs)
    answers = pa.Table.from_batches(suffix_dedup._answer(
        asked.combine_chunks().to_batches())).to_pylist()
    everywhere = collections.Counter(v for p in packs for v in p.tolist())
    for k, p in enumerate(packs):
        told = pa.RecordBatch.from_arrays(
            [pa.array([list(range(len(p)))]), pa.array([[0] * len(p)]), pa.array([[0] * len(p)]),
             pa.array([[1] * len(p)]), pa.array([p.tobytes()]),
             pa.array([(p * np.uint64(3)).tobytes()]),
             pa.array([[{"range": a["range"], "twice": a["twice"]} for a in answers if a["pack"] == k]])],
            names=["ids", "hs", "firsts", "many", "one", "two", "answers"])
        marked = [i for b in suffix_dedup._told(iter([told]), 5) for i in b.column(0).to_pylist()]
        assert marked == [i for i, v in enumerate(p.tolist()) if everywhere[v] > 1]


def test_windows_of_structured_texts_stay_apart(spark):
    """Two strings that cancel in polynomial hashes modulo 2^64, with one common gram."""
    bits = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    texts = [bits, bits.translate(str.maketrans("ab", "ba"))]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_removed(texts)))


def test_texts_longer_than_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 4096)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abcdefghij") for _ in range(9000)) for _ in range(3)]
    texts[1] = texts[1][:3990] + texts[0][5000:5300] + texts[1][4290:]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute_removed(texts)))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in
           components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(30)}}


def test_hashing_takes_little_memory():
    import tracemalloc

    import numpy as np
    raws = [random.Random(k).randbytes(100_000) for k in range(30)]
    tracemalloc.start()
    try:
        hasher = suffix_dedup._Hasher()
        for _, parts in suffix_dedup._stretches(raws, suffix_dedup.LENGTH):
            x = np.frombuffer(b"".join(parts), dtype=np.uint8)
            suffix_dedup.units(x, np.cumsum([len(p) for p in parts])[:-1], hasher)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 32 << 20


def test_texts_to_be_cut_cross_the_network_once(spark):
    texts = [("shared passage " * 20) + str(k) for k in range(4)] + ["short", None]
    cut = suffix_dedup.remove_repeats(frame(spark, texts))
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "_row#" in plan and "_text#" not in plan

"""Fill-in-the-middle, periodic runs and line dedup against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from helpers import AWKWARD, awkward, frame, words
from seedwise.llm import fill_middle, line_dedup, periodic_runs
from seedwise.llm.line_dedup import LineDedup
from seedwise.llm.periodic_runs import RunRule


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# ------------------------------------------------------------------ fill in the middle
def example(text, doc_id):
    text = text or ""
    n = len(text)
    hexed = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(hexed[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


TEXTS = [*AWKWARD, "has <P> in it", "<M>", "<S", "P><", "a<", ">", "<<>>PSM" * 9, "é", "日本語テキスト" * 20,
         "\U0001f600 mixed é́ text\n" * 15]


def test_examples_and_exact_round_trip(spark):
    texts = TEXTS * 6                       # every form meets every text
    ids = list(range(len(texts)))
    ids[3] = None
    docs = frame(spark, texts, ids)
    made = fill_middle.restore(fill_middle.fill_in_middle(docs)).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored)
                  for r in made), key=repr)
    want = sorted(((i, *example(t, i), t or "") for t, i in zip(texts, ids)), key=repr)
    assert got == want
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    report = {r.doc_id: r for r in fill_middle.fim_report(docs).collect()}
    for t, i in zip(texts, ids):
        assert report[i].output_sha256 == sha(example(t, i)[4])
        assert report[i].restored_sha256 == sha(t or "")


def test_rotation_in_place():
    rnd = random.Random(2)
    for _ in range(200):
        raw = bytes(rnd.randrange(256) for _ in range(rnd.randrange(30)))
        lo, mid, hi = sorted(rnd.randrange(len(raw) + 1) for _ in range(3))
        block = bytearray(raw)
        fill_middle.rotate(block, lo, mid, hi)
        assert bytes(block) == raw[:lo] + raw[mid:hi] + raw[lo:mid] + raw[hi:]
        fill_middle.rotate(block, lo, lo + hi - mid, hi)
        assert bytes(block) == raw


# ------------------------------------------------------------------ periodic runs
def brute_runs(s, rule=RunRule()):
    found = set()
    for q in range(1, len(s) // rule.repeats + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= rule.repeats * q and length >= rule.least and all(
                    any(s[i + k] != s[i + k + d] for k in range(length - d)) for d in range(1, q)):
                found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(rnd, n, kinds):
    s = [rnd.randint(1, kinds) for _ in range(n)]
    while n and rnd.random() < .6:
        a = rnd.randrange(n)
        p = rnd.randint(1, max(1, (n - a) // 3))
        e = rnd.randint(a, n)
        for k in range(a + p, e):
            s[k] = s[k - p]
    return s


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    documents = []
    for _ in range(250):
        s = periodic(rnd, rnd.randint(0, 70), rnd.choice([1, 2, 2, 3, 6, 40]))
        for rule in (RunRule(), RunRule(2, 2), RunRule(3, 5)):
            assert periodic_runs.all_runs(s, rule) == brute_runs(s, rule)
            assert periodic_runs.document_runs([s, s[::-1], [], s], rule) == [
                brute_runs(s, rule), brute_runs(s[::-1], rule), [], brute_runs(s, rule)]
        documents.append(s)
    assert periodic_runs.document_runs(documents) == [brute_runs(s) for s in documents]


def test_common_extensions():
    rnd = random.Random(9)
    for n in (1, 2, 31, 33, 200, 1500):
        s = periodic(rnd, n, 2)
        tree = periodic_runs.SuffixTree(s)
        up, down = tree.tours()
        order = up[0].tolist()
        assert [i for i in order if i < n] == sorted(range(n), key=lambda i: s[i:])
        assert [i for i in down[0].tolist() if i < n] == sorted(
            range(n), key=lambda i: [-x for x in s[i:]])
        import numpy as np
        common = periodic_runs.Extensions(up)
        i = np.array([rnd.randrange(n + 1) for _ in range(300)])
        j = np.array([rnd.randrange(n + 1) for _ in range(300)])
        i, j = i[i != j], j[i != j]
        for a, b, c in zip(i, j, common.common(i, j)):
            k = 0
            while max(a, b) + k < n and s[a + k] == s[b + k]:
                k += 1
            assert k == c


def test_long_periodic_text():
    n = 30_000
    s = [1 + i % 7 for i in range(n)]
    assert periodic_runs.all_runs(s) == [(0, n, 7)]
    assert periodic_runs.document_runs([[0, 0, *s, 0]]) == [[(2, n, 7)]]


def report(tokens, doc_id, plant=True):
    n, h = len(tokens), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        tokens = [w if i < a else tokens[a + (i - a) % p] for i, w in enumerate(tokens)]
    runs = brute_runs(tokens)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(tokens) if i not in gone)))


def test_run_report(spark):
    rnd = random.Random(3)
    texts = [*AWKWARD, *(" ".join("abcdefgh"[k - 1] for k in periodic(rnd, 60, 8)) for _ in range(150)),
             *(" ".join(rnd.choice("xyzuvwpqrs") for _ in range(80)) for _ in range(50))]
    ids = list(range(len(texts)))
    ids[7], ids[5] = 6, None
    rows = periodic_runs.run_report(frame(spark, texts, ids)).collect()
    got = sorted(tuple(r) for r in rows if r.doc_id is not None)
    assert got == sorted((i, *report(words(t), i)) for t, i in zip(texts, ids) if i is not None)
    assert [tuple(r) for r in rows if r.doc_id is None] == [(None, *report(words(texts[5]), None))]
    assert any(r.n_runs > 1 for r in rows)


# ------------------------------------------------------------------ line dedup
def brute_lines(texts, ids, rule):
    def key(line):
        k = line.strip(" \t\n\v\f\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)
    rank = [-1 if i is None else i for i in ids]
    holders = defaultdict(set)
    for t, r in zip(texts, rank):
        for line in (t or "").split("\n"):
            if len(key(line)) >= rule.min_chars:
                holders[key(line)].add(r)
    out = []
    for t, i, r in zip(texts, ids, rank):
        lines = (t or "").split("\n")
        left = [x for x in lines if not (len(holders.get(key(x), ())) >= rule.min_documents
                                         and r != max(holders[key(x)]))]
        out.append((i, len(lines), len(lines) - len(left), sha("\n".join(left))))
    return sorted(out, key=repr)


def line_texts(rnd, n):
    pool = [f"line {k} of the pool, " + "x" * rnd.randint(0, 40) for k in range(25)]
    pool += ["É" * 39, "É" * 40, "a" * 39, "a" * 40, "", " "]
    texts = []
    for _ in range(n):
        lines = [rnd.choice(pool) for _ in range(rnd.randint(0, 9))]
        lines = [f"{rnd.choice(['', ' ', chr(9)])}{x.upper() if rnd.random() < .2 and x[:1] != 'É' else x}"
                 f"{rnd.choice(['', chr(13), ' '])}" for x in lines]
        texts.append("\n".join(lines + [f"a line of its own that nobody else has: {rnd.random()}"]))
    return texts


@pytest.mark.parametrize("least", [2, 5])
def test_line_dedup_equals_brute_force(spark, least):
    rnd = random.Random(least)
    texts = [*AWKWARD, *line_texts(rnd, 120), *["the very same line in a lot of documents, word for word"] * 60]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    ids[30], ids[31] = ids[32], None              # two rows of one id, one without
    for k in range(len(ids) - 20, len(ids)):
        ids[k] = None                             # a hot line of rows without an id
    rule = LineDedup(min_documents=least)
    got = sorted((tuple(r) for r in line_dedup.line_report(frame(spark, texts, ids), rule).collect()),
                 key=repr)
    assert got == brute_lines(texts, ids, rule)


def test_a_hash_over_many_partitions(spark):
    """Ranges so small that one line goes over most of them, and one document's part of a line too."""
    line = "one line that nearly every document of this table holds"
    texts = ["\n".join([line] * (1 + i % 4)) for i in range(200)] + ["\n".join([line] * 300)]
    ids = list(range(201))
    rule = LineDedup()
    docs = frame(spark, texts, ids)
    entries = line_dedup.stage(line_dedup.line_entries(docs, rule), "t")
    spread = line_dedup.first_occurrences(entries, rule, partitions=40)
    assert spread.count() == sum(1 + i % 4 for i in range(200))
    assert sorted(map(tuple, spread.collect())) == sorted(
        map(tuple, line_dedup.first_occurrences(entries, rule, partitions=1).collect()))


def test_stream_in_any_batches():
    import pyarrow as pa
    rnd = random.Random(1)
    for _ in range(300):
        rows = sorted((rnd.randint(0, 6), 0, -rnd.randint(0, 9), rnd.randint(0, 3))
                      for _ in range(rnd.randint(1, 80)))
        table = pa.table({"h1": [r[0] for r in rows], "h2": [r[1] for r in rows],
                          "doc_id": [-r[2] for r in rows], "_doc": [b"x"] * len(rows),
                          "pos": [r[3] for r in rows]})
        stream, dropped, open_ones, i = line_dedup._Stream(3), [], [], 0
        while i < len(rows):
            k = rnd.randint(1, 9)
            d, u = stream.take(table.slice(i, k))
            dropped += d.to_pylist()
            open_ones += u.to_pylist()
            i += k
        if stream.held is not None:
            open_ones += stream.held.to_pylist()
        docs = defaultdict(set)
        for h, _, d, _ in rows:
            docs[h].add(-d)
        first, last = rows[0][0], rows[-1][0]
        assert sorted((r["h1"], 0, -r["doc_id"], r["pos"]) for r in dropped) == [
            r for r in rows if len(docs[r[0]]) >= 3 and -r[2] != max(docs[r[0]]) and r[0] != first]
        assert sorted((r["h1"], 0, -r["doc_id"], r["pos"]) for r in open_ones) == [
            r for r in rows if r[0] == first or (r[0] == last and len(docs[last]) < 3)]
        for s in stream.summaries():
            own = docs[s["hash"][0]]
            assert (s["n_docs"], s["first_doc"], s["last_doc"]) == (len(own), max(own), min(own))


def test_bitmaps():
    rnd = random.Random(6)
    for _ in range(200):
        lines = [str(k) for k in range(rnd.randint(1, 50))]
        gone = sorted(rnd.sample(range(len(lines)), rnd.randint(1, len(lines))))
        bits = line_dedup.pack_bits(gone)
        left = [x for k, x in enumerate(lines) if k not in gone]
        assert line_dedup.kept("\n".join(lines).encode(), bits) == (
            len(lines), len(gone), "\n".join(left).encode())
    assert line_dedup.kept(b"", None) == (1, 0, b"")


def test_text_ids(spark):
    texts = ["the same line in all of these documents, long enough"] * 7
    docs = frame(spark, texts).selectExpr("concat('d', doc_id) as doc_id", "text")
    rows = {r.doc_id: r.n_dropped for r in line_dedup.line_report(docs).collect()}
    assert rows == {**{f"d{i}": 1 for i in range(6)}, "d6": 0}
    assert fill_middle.fim_report(docs).count() == periodic_runs.run_report(docs).count() == 7


OPERATORS = {"middle": fill_middle.fim_report, "runs": periodic_runs.run_report,
             "lines": line_dedup.line_report}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_and_empty_tables(spark, name):
    docs = awkward(spark)
    rows = OPERATORS[name](docs).collect()
    assert len(rows) == docs.count()
    assert sum(r[0] is None for r in rows) == 1
    assert OPERATORS[name](docs.limit(0)).collect() == []

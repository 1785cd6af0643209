"""Toxicity scores by weak supervision.

Method: many voters look at a text: word lists, words and shared word beginnings learned from
labelled rows, and patterns. A generative label model with a hidden toxic / clean class estimates
how often each voter fires in either class (expectation-maximisation over all documents,
labelled learning rows held to their label) and how voters correlate within a class; a
voter's evidence is divided by its share of the evidence it repeats. The posterior
labels of the model train a logistic classifier, which scores every document.

One pass of Python over all texts notes the word beginnings found and a few statistics;
everything after it works on these small rows. Votes are counted by pattern before the
label model reads them. Bounded by parameters (:class:`Learning`): the labelled rows that
word beginnings are learned from, and the rows that train the classifier.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import hash_sample, id_remainder, slices, stage, text_or_empty, tidy
from seedwise.llm.linear_model import LinearModel, fit, sigmoid

# Insults by kind, one voter per list.
LEXICONS = {
    "intellect": "idiot idiots moron morons stupid dumb dumbass imbecile cretin brainless "
                 "dummkopf blödmann imbécile crétin estúpido estúpida imbécil tonto".split(),
    "worth": "loser losers worthless pathetic useless trash garbage scum filth vermin versager "
             "abschaum müll ordure minable basura escoria inútil".split(),
    "scorn": "disgusting clown clowns ugly freak creep shameful gross ekelhaft widerlich "
             "dégoûtant dégueulasse asqueroso asquerosa payaso".split(),
    "abuse": "bastard bitch asshole shit fuck fucking damn arschloch scheiße salaud connard "
             "merde cabrón mierda puta".split(),
    "threat": "kill murder destroy hate töten hasse tuer haine matar odio".split(),
}
STEM_LENGTHS = (4, 5, 6, 7)
LEVELS = 3
#: A learned mark this much likelier in toxic rows votes apart from weaker ones.
STRONG = 120.0
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Learning:
    """Bounds and thresholds of what is fitted."""
    labelled: int = 12_000        # labelled rows that word beginnings are learned from
    training: int = 20_000        # rows that train the classifier
    stems: int = 256              # word beginnings kept
    roots: int = 24               # voters made of them, one per common beginning
    least_rows: int = 4           # toxic rows a word beginning must be in
    least_odds: float = 25.0      # and how much likelier it must be in toxic rows,
    least_sure: float = 3.0       # by so many standard errors of the log-odds
    rounds: int = 12              # of expectation-maximisation


HOLD_OUT = 3                      # rows with crc32(id) mod 3 = 1 never show their label
PREDICT_AT = 0.7


# ------------------------------------------------------------------ words of a text
def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def marks_of(words: set[str]) -> list[str]:
    """What a text can be told by: its words ("word$"), and beginnings shared by at least
    1, 2 or 3 of its distinct longer words ("begi1", "begi2", "begi3")."""
    count = Counter([w[:k] for w in words for k in STEM_LENGTHS if len(w) > k])
    return [w + "$" for w in words if len(w) >= STEM_LENGTHS[0]] + [
        f"{b}{level}" for b, c in count.items() for level in range(1, min(c, LEVELS) + 1)]


def statistics(text: str) -> list[float]:
    """Patterns: share of capitals, cries, words of address, length."""
    n = max(1, len(text))
    return [len(_CAPS.findall(text)) / n, min(1.0, text.count("!") / n * 20), min(1.0, len(_YOU.findall(text)) / n * 50),
            float(np.log1p(n) / 10)]


_CAPS = re.compile(r"[A-ZÄÖÜÉÈÀÑÓÍ]")
_YOU = re.compile(r"\b(?:you|your|du|dein|tu|ton|vous|tú|usted)\b", re.IGNORECASE)
N_STATS = 4


# ------------------------------------------------------------------ learning word beginnings
def learn_stems(rows: DataFrame, learning: Learning) -> list[tuple[str, bool]]:
    """Marks typical of toxic rows, and whether strongly so. ``rows``: text, label (0 or 1)."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            count = (Counter(), Counter())
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count[label].update(marks_of(words_of(text)))
            # clean rows matter only for beginnings that toxic rows have too; both are
            # summed over all tasks
            keys = list(count[0].keys() | count[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([count[1][k] for k in keys], pa.int64()),
                 pa.array([count[0][k] for k in keys], pa.int64())], names=["stem", "bad", "good"])

    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad:
        return []
    counts = rows.select("text", "label").mapInArrow(run, "stem string, bad long, good long") \
        .groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = (F.col("bad") + 0.5) / (bad + 1) / ((F.col("good") + 0.5) / (good + 1))
    best = (counts.where(F.col("bad") >= learning.least_rows)
            .withColumn("odds", odds).where(F.col("odds") >= learning.least_odds)
            .where(F.log("odds") >= learning.least_sure * F.sqrt(1 / F.col("bad")
                                                                 + 1 / (F.col("good") + 0.5)))
            .orderBy((F.log("odds") * F.sqrt("bad")).desc(), F.length("stem"), "stem")
            .limit(learning.stems).collect())
    return [(r["stem"], r["odds"] >= STRONG) for r in best]


# ------------------------------------------------------------------ voters
@dataclass
class Voters:
    """Numbers the word lists and learned beginnings (features) and groups them into voters."""
    features: list[str]
    groups: list[list[int]]
    names: list[str]

    @classmethod
    def of(cls, stems: list[tuple[str, bool]], learning: Learning) -> "Voters":
        lists = [(name, sorted(set(ws))) for name, ws in LEXICONS.items()]
        features = [w + "$" for _, ws in lists for w in ws] + [m for m, _ in stems]
        groups, names, at = [], [], 0
        for name, ws in lists:
            groups.append(list(range(at, at + len(ws))))
            names.append(name)
            at += len(ws)
        roots: dict[tuple[str, bool], list[int]] = {}
        for i, (mark, strong) in enumerate(stems):
            roots.setdefault((mark[:STEM_LENGTHS[0]], strong), []).append(at + i)
        ordered = list(roots.items())
        for root, own in ordered[:learning.roots]:
            groups.append(own)
            names.append(root[0] + ("" if root[1] else "?"))
        rest = [i for _, own in ordered[learning.roots:] for i in own]
        groups.append(rest)
        names.append("rest")
        return cls(features, groups, names)

    def finder(self):
        """text -> sorted feature numbers found in it."""
        whole: dict[str, list[int]] = {}
        begin: dict[str, list[int]] = {}      # feature number for each level, or -1
        for i, f in enumerate(self.features):
            if f.endswith("$"):
                whole.setdefault(f[:-1], []).append(i)
            else:
                begin.setdefault(f[:-1], [-1] * (LEVELS + 1))[int(f[-1])] = i
        head = STEM_LENGTHS[0]
        heads = {f[:head] for f in begin}

        def find(text: str) -> list[int]:
            words = words_of(text)
            found = {i for w in words & whole.keys() for i in whole[w]}
            near = [w for w in words if w[:head] in heads]
            if near:
                count = Counter([w[:k] for w in near for k in STEM_LENGTHS if len(w) > k])
                for b in count.keys() & begin.keys():
                    found.update(i for i in begin[b][:count[b] + 1] if i >= 0)
            return sorted(found)

        return find

    def votes(self, hits: list[int], stats: list[float]) -> int:
        """Bit mask of the voters that fire: groups, then patterns."""
        own = set(hits)
        bits = [not own.isdisjoint(g) for g in self.groups]
        bits += [stats[0] > 0.3, stats[1] > 0.1, stats[2] > 0.1, len(own) >= 3]
        return sum(1 << i for i, b in enumerate(bits) if b)

    @property
    def count(self) -> int:
        return len(self.groups) + 4


# ------------------------------------------------------------------ label model
@dataclass
class LabelModel:
    """prior P(toxic), P(fires | clean or toxic) per voter, correlations within the classes.

    Firing and staying silent are both evidence. Each voter's evidence is divided by one
    plus its correlations with the voters that do the same on the row.
    """
    prior: float
    fires: np.ndarray             # 2 x voters
    correlation: np.ndarray       # voters x voters, mean over the classes, not negative

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) of rows of 0 / 1 votes."""
        lo, hi = self.fires
        gain = ((votes / (1 + votes @ self.correlation)) @ np.log(hi / lo)
                + ((1 - votes) / (1 + (1 - votes) @ self.correlation)) @ np.log((1 - hi) / (1 - lo)))
        return sigmoid(np.log(self.prior / (1 - self.prior)) + gain)


def bits_of(masks, count: int) -> np.ndarray:
    return ((np.asarray(masks, dtype=np.int64)[:, None] >> np.arange(count)) & 1).astype(float)


def fit_label_model(patterns: DataFrame, voters: Voters, learning: Learning) -> LabelModel:
    """EM over ``patterns`` (mask, label or null, n). Each round is one small aggregation
    of class-weighted sums and products of votes, never a list of rows."""
    m = voters.count

    def sums(model: LabelModel | None):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa
            total = np.zeros((2, m + 1, m + 1))
            for batch in batches:
                v = bits_of(batch.column(0).to_numpy(), m)
                n = batch.column(2).to_numpy().astype(float)
                label = batch.column(1).to_pandas().to_numpy(dtype=float)
                guess = model.posterior(v) if model else np.clip(v[:, :-4].sum(axis=1), 0, 1) * .8 + .05
                p = np.where(np.isnan(label), guess, label)
                one = np.hstack([v, np.ones((len(v), 1))])
                for y, w in ((0, n * (1 - p)), (1, n * p)):
                    total[y] += (one * w[:, None]).T @ one
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(total.size), pa.int32()), pa.array(total.ravel())],
                names=["i", "s"])
        got = patterns.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
        flat = np.zeros(2 * (m + 1) ** 2)
        for r in got.collect():        # 2 (voters + 1)^2 numbers
            flat[r["i"]] = r["s"]
        return flat.reshape(2, m + 1, m + 1)

    model = None
    for _ in range(learning.rounds):
        total = sums(model)
        size = total[:, -1, -1]
        fires = (total[:, -1, :m] + [[0.02], [0.5]] * np.ones((2, m))) / (size[:, None] + 1.0)
        fires = np.clip(fires, 1e-5, 1 - 1e-5)
        prior = float(np.clip(size[1] / max(1.0, size.sum()), 1e-4, 0.5))
        rho = np.zeros((m, m))
        for y in (0, 1):
            mean = total[y, -1, :m] / max(1.0, size[y])
            cov = total[y, :m, :m] / max(1.0, size[y]) - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            rho += np.where(sd[:, None] * sd > 1e-6, cov / np.outer(sd, sd), 0) / 2
        np.fill_diagonal(rho, 0)
        new = LabelModel(prior, fires, np.clip(rho, 0, 1))
        done = model is not None and np.abs(new.fires - model.fires).max() < 1e-4
        model = new
        if done:
            break
    return model


# ------------------------------------------------------------------ classifier
@dataclass
class Toxicity:
    voters: Voters
    label_model: LabelModel
    model: LinearModel

    def features(self, hits, stats) -> np.ndarray:
        x = np.zeros((len(hits), len(self.voters.features) + len(self.voters.groups) + N_STATS))
        k = len(self.voters.features)
        for i, (h, s) in enumerate(zip(hits, stats)):
            x[i, list(h)] = 1.0
            own = set(h)
            x[i, k:-N_STATS] = [not own.isdisjoint(g) for g in self.voters.groups]
            x[i, -N_STATS:] = s
        return x


def notes(docs: DataFrame, voters: Voters, id_col: str = "doc_id") -> DataFrame:
    """(id, mask, hits, stats) of every row: the one pass over all texts."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        find = voters.finder()
        for batch in batches:
            for part in slices(batch.num_rows):
                texts = batch.column(1)[part].to_pylist()
                hits = [find(t) for t in texts]
                stats = [statistics(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part],
                     pa.array([voters.votes(h, s) for h, s in zip(hits, stats)], pa.int64()),
                     pa.array(hits, pa.list_(pa.int32())), pa.array(stats, pa.list_(pa.float64()))],
                    names=["_id", "mask", "hits", "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty().alias("_text"))
    return rows.mapInArrow(tidy(run), f"_id {kind}, mask long, hits array<int>, stats array<double>")


def learnable(labels: DataFrame, hold_out: int = HOLD_OUT) -> DataFrame:
    """(_lid, label): usable labels outside the held-out rows, one per id (the highest)."""
    return (labels.where(F.col("toxic").isin(0, 1) & (id_remainder(hold_out) != 1))
            .groupBy(F.col("doc_id").alias("_lid")).agg(F.max("toxic").cast("int").alias("label")))


def training_rows(noted: DataFrame, learning: Learning) -> DataFrame:
    """The rows that train the classifier, drawn by a hash alone, never by the label: labelled
    and unlabelled rows have the same share in the sample as in the table, at every size.
    Rows alike in everything come once, with their number as ``_copies``."""
    return hash_sample(noted.where(id_remainder(HOLD_OUT, "_id") != 1), learning.training,
                       [F.col("_id"), F.col("mask"), F.col("hits"), F.col("stats")])


def toxicity_scores(docs: DataFrame, labels: DataFrame, learning: Learning = Learning(),
                    predict_at: float = PREDICT_AT) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and posterior (of the label model).

    Null texts are scored as empty; rows of one id share its label; labels that are null
    or neither 0 nor 1 are ignored, and without any only the word lists and patterns vote;
    an empty table gives no rows. Language, source and id are no input of a score.
    """
    known = learnable(labels)
    picked = hash_sample(known, learning.labelled, [F.col("_lid")]).drop("_copies")    # bounded
    sample = docs.select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(picked), F.col("doc_id") == F.col("_lid")).select("text", "label")
    voters = Voters.of(learn_stems(sample, learning), learning)
    noted = notes(docs, voters)
    noted = stage(noted.join(known, F.col("_id") == F.col("_lid"), "left").drop("_lid"), "votes")
    patterns = stage(noted.groupBy("mask", "label").agg(F.count(F.lit(1)).alias("n")), "patterns")
    label_model = fit_label_model(patterns, voters, learning)
    rows = training_rows(noted, learning).collect()
    made = Toxicity(voters, label_model, None)
    x = made.features([r["hits"] for r in rows], [r["stats"] for r in rows])
    y = label_model.posterior(bits_of([r["mask"] for r in rows], voters.count)) \
        if rows else np.zeros(0)
    made.model = fit(x, y, sample_weight=np.array([r["_copies"] for r in rows], float), l2=1.0)
    score = _score_column(made)
    out = noted.withColumn("_s", score("mask", "hits", "stats"))
    return out.select(
        F.col("_id").alias("doc_id"), (id_remainder(HOLD_OUT, "_id") == 1).alias("held_out"),
        F.col("_s.score").alias("score"), (F.col("_s.score") >= predict_at).cast("int").alias("predicted"),
        F.col("_s.posterior").alias("posterior"))


def _score_column(made: Toxicity):
    from pyspark.sql.functions import pandas_udf
    from pyspark.sql.pandas.functions import PandasUDFType

    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        for masks, hits, stats in batches:
            p, q = np.empty(len(masks)), np.empty(len(masks))
            for lo in range(0, len(masks), 1024):
                at = slice(lo, lo + 1024)
                p[at] = made.model.probability(made.features(list(hits[at]), list(stats[at])))
                q[at] = made.label_model.posterior(bits_of(masks[at], made.voters.count))
            yield pd.DataFrame({"score": p, "posterior": q})

    return pandas_udf(run, "score double, posterior double", PandasUDFType.SCALAR_ITER)

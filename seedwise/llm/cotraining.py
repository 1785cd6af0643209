"""Quality classifier by co-training.

Method: two classifiers look at a document through separate views, the text's content
and the page's metadata. Both are fitted on labelled rows. In every round each names the
unlabelled documents it is surest of, good and bad, and these enter the other's training
set as pseudo-labels. At the end each view is calibrated (Platt scaling) on labelled rows
kept apart, and the calibrated log-odds are combined.

One pass over all texts writes the features; everything else reads these. Fitting uses a
bounded sample of labelled rows (``Sample.labelled``, drawn by a hash of the row). The
pseudo-labels of a round come from all unlabelled documents: one pass scores them by both
views, a few aggregates find the scores that the surest lie above, and these rows alone
come to the driver. Documents alike in all features count once there.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import hash_sample, id_remainder, slices, stage, text_or_empty, tidy
from seedwise.llm.linear_model import LinearModel, fit, platt, sigmoid
from seedwise.operators.selection import Wanted, cuts


@dataclass(frozen=True)
class Sample:
    """Bound of the labelled rows that fitting looks at, and the co-training schedule: the
    rows that each view names in a round, among those it is at least so sure of."""
    labelled: int = 12_000
    rounds: int = 6
    per_round: int = 400
    sure: float = 0.9


HELD_OUT = 5          # rows whose crc32(id) mod 5 is 0 are for calibration and tests only
REJECT_BELOW = 0.35
_LETTERS = re.compile(rb"[A-Za-z]")
_UPPER = re.compile(rb"[A-Z]")
_DIGIT = re.compile(rb"[0-9]")
_SIGN = re.compile(rb"[#*$%&|<>!{}\[\]_=~^@\\/+]")


def content_features(raw: bytes) -> list[float]:
    """What the text says and how: word, letter and sign statistics."""
    tokens = raw.split()
    n = max(1, len(tokens))
    size = max(1, len(raw))
    letters = max(1, len(_LETTERS.findall(raw)))
    lower = [t.lower() for t in tokens]
    distinct = len(set(lower))
    signed = sum(1 for t in tokens if not t[-1:].isalnum() and t[-1] < 0x80 and t[-1:] not in b".,;:?")
    pairs = len(set(zip(lower, lower[1:])))
    return [np.log1p(len(tokens)), len(_UPPER.findall(raw)) / letters,
            len(_DIGIT.findall(raw)) / size, len(_SIGN.findall(raw)) / size,
            len(raw.replace(b" ", b"")) / n / 10, distinct / n, pairs / n, signed / n,
            sum(1 for t in tokens if len(t) <= 3) / n, sum(1 for t in tokens if len(t) > 12) / n,
            float(not tokens), raw.count(b"!!") / n, raw.count(b"|") / n]


def layout_features(raw: bytes) -> list[float]:
    """How the page is laid out: length and lines."""
    lines = [x.strip() for x in raw.split(b"\n")]
    full = [x for x in lines if x]
    k = max(1, len(full))
    lengths = [len(x) for x in full] or [0]
    mean = sum(lengths) / k
    ends = sum(1 for x in full if x[-1:] in b".?") / k
    return [np.log1p(len(raw)), np.log1p(len(full)), np.log1p(mean), np.log1p(max(lengths)),
            len(set(full)) / k, ends, sum(1 for x in lengths if x < 30) / k,
            (len(lines) - len(full)) / max(1, len(lines))]


N_CONTENT, N_LAYOUT = len(content_features(b"")), len(layout_features(b""))


@dataclass
class Origins:
    """A number for each language and each source of the fitting sample, and one for all
    others: the metadata view has a weight for each."""
    langs: dict = field(default_factory=dict)
    sources: dict = field(default_factory=dict)

    @classmethod
    def of(cls, langs, sources) -> "Origins":
        return cls(*({v: i + 1 for i, v in enumerate(sorted({x or "" for x in own}))}
                     for own in (langs, sources)))

    @property
    def width(self) -> int:
        return len(self.langs) + len(self.sources) + 2

    def matrix(self, layout: np.ndarray, langs, sources) -> np.ndarray:
        """Layout features and one slot set for the language, one for the source."""
        n = len(layout)
        out = np.zeros((n, N_LAYOUT + self.width))
        out[:, :N_LAYOUT] = layout
        at = np.arange(n)
        out[at, [N_LAYOUT + self.langs.get(v or "", 0) for v in langs]] = 1.0
        out[at, [N_LAYOUT + len(self.langs) + 1 + self.sources.get(v or "", 0)
                 for v in sources]] = 1.0
        return out


@dataclass
class View:
    model: LinearModel
    a: float
    b: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.a * self.model.margin(x) + self.b


@dataclass
class CoTrained:
    content: View
    metadata: View
    origins: Origins
    prior: float
    weights: tuple[float, float]

    def score(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Probability of good quality: the views' log-odds over the prior, weighted."""
        u, v = self.weights
        z = (self.prior + u * (self.content.log_odds(content) - self.prior)
             + v * (self.metadata.log_odds(metadata) - self.prior))
        return sigmoid(z)


@dataclass
class Rows:
    """Feature rows in memory: both views, and the key of each row."""
    content: np.ndarray
    layout: np.ndarray
    langs: list
    sources: list
    keys: list

    @classmethod
    def of(cls, rows: list) -> "Rows":
        return cls(np.array([r["content"] for r in rows], float).reshape(-1, N_CONTENT),
                   np.array([r["layout"] for r in rows], float).reshape(-1, N_LAYOUT),
                   [r["lang"] for r in rows], [r["source"] for r in rows], [r["key"] for r in rows])

    def views(self, origins: Origins) -> tuple[np.ndarray, np.ndarray]:
        return self.content, origins.matrix(self.layout, self.langs, self.sources)


def cotrain(rows: Rows, y: np.ndarray, calibrate: np.ndarray, name_surest=None,
            sample: Sample = Sample()) -> CoTrained:
    """``rows`` are labelled (``y`` is 1 or 0), ``calibrate`` marks those kept apart.

    ``name_surest(models, origins, quotas, used)`` gives, for each of the two views and each
    label, feature rows that the view is surest of among all unlabelled documents, at most
    the quota; ``used[k]`` are the keys that view k has named before. None: no such
    documents.
    """
    train = ~calibrate
    origins = Origins.of([v for v, t in zip(rows.langs, train) if t],
                         [v for v, t in zip(rows.sources, train) if t])
    views = rows.views(origins)
    xs = [[v[train]] for v in views]
    ys = [[y[train]], [y[train]]]
    trust = [[np.ones(int(train.sum()))], [np.ones(int(train.sum()))]]
    used: tuple[set, set] = (set(), set())

    def models():
        return [fit(np.concatenate(xs[k]), np.concatenate(ys[k]), np.concatenate(trust[k]))
                for k in (0, 1)]

    current = models()
    share = float(np.mean(y[train])) if train.any() else 0.5
    quotas = {1: max(1, int(sample.per_round * share)), 0: max(1, int(sample.per_round * (1 - share)))}
    for _ in range(sample.rounds if name_surest and train.any() else 0):
        found = name_surest(current, origins, quotas, used)
        if not any(len(r.keys) for r in found.values()):
            break
        for (k, label), named in found.items():
            if named.keys:
                used[k].update(named.keys)
                xs[1 - k].append(named.views(origins)[1 - k])      # for the other view
                ys[1 - k].append(np.full(len(named.keys), float(label)))
                trust[1 - k].append(np.full(len(named.keys), 0.5))
        current = models()
    c = calibrate
    share = np.clip(np.mean(y) if len(y) else 0.5, 1e-3, 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    done = [View(m, *platt(m.margin(x[c]), y[c])) for m, x in zip(current, views)]
    weights = (1.0, 1.0)
    if c.sum() >= 50 and 0 < y[c].mean() < 1:
        # views overlap, so their evidence is weighted rather than simply added
        z = np.stack([v.log_odds(x[c]) - prior for v, x in zip(done, views)], axis=1)
        m = fit(z, y[c], l2=1.0)
        weights = tuple(float(max(0.0, w)) for w in m.weights / m.scale)
        prior = float(m.bias - (m.weights / m.scale) @ m.mean)
        done = [View(v.model, v.a, v.b - share0 + prior) for v, share0 in
                zip(done, (np.log(share / (1 - share)),) * 2)]
    return CoTrained(done[0], done[1], origins, prior, weights)


def feature_column():
    """An Arrow UDF text -> (content, layout)."""
    from pyspark.sql.functions import arrow_udf
    from pyspark.sql.pandas.functions import ArrowUDFType

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        numbers = pa.list_(pa.float32())
        for texts in batches:
            for part in slices(len(texts)):
                raws = texts[part].cast(pa.binary()).to_pylist()
                yield pa.StructArray.from_arrays(
                    [pa.array([content_features(r) for r in raws], numbers),
                     pa.array([layout_features(r) for r in raws], numbers)], names=["content", "layout"])

    return arrow_udf(tidy(run), "content array<float>, layout array<float>", ArrowUDFType.SCALAR_ITER)


def feature_table(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The one pass over all texts, written: (_row, _id, lang, source, content, layout), where
    ``_row`` holds the columns ``keep`` of each row."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row")
    made = docs.select(row, F.col("doc_id").alias("_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"),
                       feature_column()(text_or_empty()).alias("_f"))
    return stage(made.select("_row", "_id", "lang", "source", "_f.content", "_f.layout"), "features")


def _margins(rows: DataFrame, models, origins: Origins) -> DataFrame:
    """(key, a, b): the margins of the content and of the metadata view."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            n = batch.num_rows
            content = np.array(batch.column("content").to_pylist(), float).reshape(n, N_CONTENT)
            layout = np.array(batch.column("layout").to_pylist(), float).reshape(n, N_LAYOUT)
            metadata = origins.matrix(layout, batch.column("lang").to_pylist(),
                                      batch.column("source").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(models[0].margin(content)),
                 pa.array(models[1].margin(metadata))], names=["key", "a", "b"])

    return rows.mapInArrow(tidy(run), "key long, a double, b double")


def _key_in(keys) -> Column:
    """``key`` is one of a few thousand numbers, given as one expression."""
    return F.expr(f"key IN ({', '.join(map(str, sorted(keys)))})") if keys else F.lit(False)


def _surest(pool: DataFrame, sample: Sample):
    """``name_surest`` of :func:`cotrain` over the staged distinct feature rows ``pool``."""
    least = float(np.log(sample.sure / (1 - sample.sure)))

    def name(models, origins, quotas, used):
        scored = stage(_margins(pool, models, origins), "margins")
        sides = [(k, label, F.col("ab"[k]) * (1 if label else -1)) for k in (0, 1) for label in (1, 0)]
        wanted = [Wanted(s, quotas[label], (s >= least) & ~_key_in(used[k]))
                  for k, label, s in sides]
        among = F.lit(False)
        for w, c in zip(wanted, cuts(scored, wanted, slack=10 * sample.per_round)):
            if c.lo is not None:
                among = among | (w.among & (w.score >= F.lit(c.lo)))
        # some quotas of rows, and rows of equal scores: distinct features, so few
        best = scored.where(among).collect()
        named, rows = {}, {}
        for (k, label, _) in sides:
            sign = 1 if label else -1
            own = [(-sign * r["ab"[k]], r["key"]) for r in best
                   if sign * r["ab"[k]] >= least and r["key"] not in used[k]]
            named[k, label] = [key for _, key in sorted(own)[:quotas[label]]]
        keys = sorted({key for own in named.values() for key in own})
        if keys:
            rows = {r["key"]: r for r in pool.where(_key_in(keys)).collect()}
        return {side: Rows.of([rows[key] for key in own]) for side, own in named.items()}

    return name


def fit_quality(features: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> CoTrained:
    """Fit on a feature table: on at most ``sample.labelled`` labelled rows, drawn by a hash of
    the row, and on the pseudo-labels of all others. Labels that are null or neither 0 nor 1
    are ignored; of several labels of one id the smallest counts. Rows alike in all features
    count once among the unlabelled."""
    given = (labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("_lid"))
             .agg(F.min("quality").cast("double").alias("_y")))
    slim = features.select("_id", "lang", "source", "content", "layout", F.xxhash64(
        "lang", "source", "content", "layout").alias("key"))
    labelled = slim.join(given, F.col("_id") == F.col("_lid")).drop("_lid") \
        .withColumn("_held", id_remainder(HELD_OUT, "_id") == 0)
    got = hash_sample(labelled, sample.labelled, [F.col("_id"), F.col("key")]).collect()
    # a null id has no label: these rows need no join, which would put them into one task
    free = slim.where(F.col("_id").isNotNull()).join(given, F.col("_id") == F.col("_lid"), "left_anti")
    pool = stage(free.unionByName(slim.where(F.col("_id").isNull())).groupBy("key").agg(
        *[F.first(c).alias(c) for c in ("lang", "source", "content", "layout")]), "pool")
    y = np.array([r["_y"] for r in got], float)
    held = np.array([r["_held"] for r in got], bool)
    return cotrain(Rows.of(got), y, held, _surest(pool, sample) if got else None, sample)


def score_column(model: CoTrained):
    """An Arrow UDF (content, layout, lang, source) -> probability of good quality."""
    from pyspark.sql.functions import arrow_udf
    from pyspark.sql.pandas.functions import ArrowUDFType

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for content, layout, langs, sources in batches:
            for part in slices(len(content)):
                c = np.array(content[part].to_pylist(), float)
                m = model.origins.matrix(np.array(layout[part].to_pylist(), float),
                                         langs[part].to_pylist(), sources[part].to_pylist())
                yield pa.array(model.score(c, m))

    return arrow_udf(tidy(run), "double", ArrowUDFType.SCALAR_ITER)


def _scored(docs: DataFrame, labels: DataFrame, sample: Sample, keep: list[str]) -> DataFrame:
    """(_row, quality_score): the columns ``keep`` of each row as one struct, and its score."""
    features = feature_table(docs, keep)
    score = score_column(fit_quality(features, labels, sample))
    return features.select("_row", score("content", "layout", "lang", "source").alias("quality_score"))


def quality_scores(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(),
                   reject_below: float = REJECT_BELOW) -> DataFrame:
    """Per row: doc_id, held_out (kept out of training), score (0 to 1), keep.

    Null texts are scored as empty, null languages and sources as empty strings; without
    usable labels every score is the same; repeated rows are scored each; an empty table
    gives no rows; other columns are not read.
    """
    return _scored(docs, labels, sample, ["doc_id"]).select(
        "_row.doc_id", (id_remainder(HELD_OUT, "_row.doc_id") == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= reject_below).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(),
              reject_below: float = REJECT_BELOW) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, columns as they are. The rows
    are written once beside their features, so that no text is looked at twice."""
    return _scored(docs, labels, sample, docs.columns).where(
        F.col("quality_score") >= reject_below).select("_row.*")

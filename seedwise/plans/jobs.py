"""End-to-end jobs E1-E6, each a lazy DataFrame plan plus a few scalar actions.

Actions that remain (all return scalars or model-sized data to the driver):
dictionary arity (one row per column), the seed-key count, population counts
(one row), the feature width (one row), model fits, and the bounded leaf
dictionary. Scores are ranked and written by the cluster; nothing is
collected row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.functions.columns import hash_below
from seedwise.functions.vectors import positions_to_vector, with_binary_attrs
from seedwise.operators import encode, evaluate, linear, populations, ranking, trees
from seedwise.operators.populations import SeedSet
from seedwise.plans.profile import CYCLE_TOKEN, READER_CODES

HOLDOUT_SEED = 23


# ---------------------------------------------------------------- E1 / E2
def onehot_job(profile: DataFrame, columns: Sequence[str], keep=("cycle", "reader"),
               id_col: str = "user_id") -> tuple[DataFrame, encode.Encoding]:
    """One-hot feature table ``(id, feature_size, feature, cycle, reader)``."""
    layout = encode.onehot_layout(profile, columns)
    enc = encode.fit_encoding(profile, layout, id_col)
    return encode.onehot_features(profile, enc, id_col, keep), enc


def categorical_job(profile: DataFrame, singles: Sequence[str], multis: Sequence[str],
                    keep=("cycle", "reader"), id_col: str = "user_id"
                    ) -> tuple[DataFrame, encode.Encoding]:
    """Categorical feature table ``(id, feature "2:0,…,arity:idx", cycle, reader)``."""
    layout = encode.categorical_layout(profile, singles, multis)
    enc = encode.fit_encoding(profile, layout, id_col)
    return encode.categorical_features(profile, enc, id_col, keep), enc


def feature_width(features: DataFrame) -> int:
    """The single ``feature_size`` of an encoded table (checked, not the first row)."""
    r = features.agg(F.countDistinct("feature_size").alias("n"),
                     F.max("feature_size").alias("w")).first()
    if r["n"] > 1:
        raise ValueError(f"encoded table mixes {r['n']} feature widths")
    return int(r["w"] or 0)


# ---------------------------------------------------------------- E3 / E4
@dataclass
class Expansion:
    scores: DataFrame        # every candidate: user_id, score
    ranked: DataFrame        # top target_size (all when <= 0)
    training: DataFrame      # user_id, label, features, score (training rows)
    model: object
    counts: dict
    ratio: float
    width: int
    cached: list = None
    summary: dict | None = None          # expansion size and evaluation, if asked for
    holdout: DataFrame | None = None     # scored training rows that the fit never saw

    def release(self) -> None:
        """Unpersist the training rows once the scores have been written."""
        for df in self.cached or []:
            df.unpersist()

    def expansion_size(self) -> DataFrame:
        """Candidates scoring above 0.5 (one row, ``expansion_size``)."""
        return evaluate.threshold_count(self.scores)


#: From this width on, training rows are decoded over the slots they set: a slot that is
#: zero in all of them can never be split on, so the model is the same.
COMPACT_FROM = 10_000


def _used_slots(train: DataFrame, width: int) -> list[int] | None:
    """The positions set in at least one training row, ascending; None for narrow tables.
    The learner keeps statistics per slot on the driver anyway, so the list adds little."""
    if width < COMPACT_FROM:
        return None
    tokens = train.select(F.explode(F.split("feature", ",")).alias("t")).where("t != ''")
    return sorted(int(r["t"]) for r in tokens.distinct().collect())


def _decode(df: DataFrame, width: int, binary_attrs: bool,
            slots: list[int] | None = None) -> DataFrame:
    out = positions_to_vector(df, "feature", width, "features", slots)
    n = width if slots is None else len(slots)
    return with_binary_attrs(out, "features", n) if binary_attrs else out


def expand(features: DataFrame, seeds: SeedSet, *, model: str = "gbt", target_size: int = 0,
           inclusive: bool = False, width: int | None = None,
           cycle_token: int = CYCLE_TOKEN, reader_codes: Sequence[int] | None = READER_CODES,
           sample_method: str = "hash", per_positive: int = populations.NEGATIVES_PER_POSITIVE,
           gbt_params: dict | None = None, lr_params: dict | None = None,
           hard_lr: bool = False, binary_attrs: bool = True,
           holdout: float = 0.0) -> Expansion:
    """E3 (``model="gbt"``) / E4 (``model="lr"``) on an encoded feature table.

    Positives: rows passing the IN-list whose id is a seed (any cycle).
    Negatives: rows inside the cycle that are not seeds, hash-sampled to about
    ``per_positive`` per positive. Candidates: the cycle rows, without seeds
    unless ``inclusive``. The cycle filter is a column expression, so it is
    applied before any vector is built. ``reader_codes=None``: the rows were
    already filtered on their code (as :func:`seedwise.plans.runs.load_features` does).
    ``holdout``: share of the training rows, chosen by a hash of the id, that the fit
    never sees and :func:`expansion_report` evaluates on.
    """
    if reader_codes is not None:
        features = populations.code_filter(features, "reader", reader_codes)
    users = features.select("user_id", "feature", "cycle")
    width = width if width is not None else feature_width(features)
    counts = populations.population_counts(users, seeds, cycle_token).first().asDict()
    ratio = populations.sampling_ratio(counts["seeds"], counts["others"], per_positive)

    positives = populations.seed_users(users, seeds)
    others = populations.candidates(users, seeds, cycle_token, inclusive=False)
    negatives = populations.negative_sample(others, ratio, method=sample_method)
    rows = populations.training_set(positives, negatives, ("user_id", "feature"))
    held = None
    if holdout:
        out = hash_below("user_id", holdout, HOLDOUT_SEED)
        held, rows = rows.where(out), rows.where(~out)
    slots = _used_slots(rows, width)
    train = _decode(rows, width, binary_attrs, slots).persist(StorageLevel.MEMORY_AND_DISK)

    if model == "gbt":
        fitted = trees.fit_gbt(train, **(gbt_params or {}))
        score = lambda df: trees.score_gbt(fitted, df)
    elif model == "lr":
        fitted = linear.fit_lr(train, **(lr_params or {}))
        score = lambda df: linear.score_lr(fitted, df, hard=hard_lr)
    else:
        raise ValueError(f"unknown model {model!r}")

    cands = populations.candidates(users, seeds, cycle_token, inclusive)
    scored = score(_decode(cands, width, False, slots)).select("user_id", "score")
    return Expansion(scores=scored, ranked=ranking.top_k(scored, target_size),
                     training=score(train), model=fitted, counts=counts,
                     ratio=ratio, width=width, cached=[train],
                     holdout=None if held is None else score(_decode(held, width, False, slots)))


def expansion_report(exp: Expansion) -> DataFrame:
    """L5 on the held-out rows of an expansion, or without any on its training rows."""
    rows = exp.training if exp.holdout is None else exp.holdout
    return evaluate.training_report(rows.select("score", "label"))


# ---------------------------------------------------------------- E5
@dataclass
class LeafFeatures:
    features: DataFrame      # user_id, feature "0,1,0,…"
    code: trees.LeafCode
    model: object
    per_leaf: DataFrame      # user_id, tree_leaves (Spark leaf index per tree)
    vectors: DataFrame       # user_id, features, label (the training rows)

    def release(self) -> None:
        """Unpersist the working sets once the features have been written."""
        self.per_leaf.unpersist()
        self.vectors.unpersist()


def leaf_job(features: DataFrame, *, width: int | None = None, cycle_token: int = CYCLE_TOKEN,
             reader_codes: Sequence[int] | None = READER_CODES, gbt_params: dict | None = None,
             key: str = "value", binary_attrs: bool = True, label_col: str | None = None,
             model=None, code: trees.LeafCode | None = None) -> LeafFeatures:
    """E5: train trees on a 50/50 hash split of the cycle users (or on ``label_col``), then
    encode each user as the concatenated one-hot of the leaf reached in every tree.

    With a fitted ``model`` nothing is trained; with its ``code`` too, every day's leaves
    take the same slots (a leaf that the code lacks has no hot slot).

    From a width of ``COMPACT_FROM`` on, the model has one feature for each position that a
    training row sets. The code keeps these positions, so that a later day, whatever its
    width, is decoded over the same ones; positions that training never set are left out,
    since no tree can split on them. A model of such a kind needs its code.

    ``key="value"`` slots leaves by their value (equal-valued leaves of a tree
    share a slot); ``key="index"`` uses Spark's leaf index instead.
    """
    width = width if width is not None else feature_width(features)
    if reader_codes is not None:
        features = populations.code_filter(features, "reader", reader_codes)
    users = features.where(populations.in_cycle("cycle", cycle_token))
    if label_col is None:
        split = populations.hash_split(users.select("user_id", "feature"))
        labelled = split.withColumn("label", F.when(F.col("half") == 0, 1.0).otherwise(0.0))
    else:
        labelled = users.select("user_id", "feature", F.col(label_col).cast("double").alias("label"))
    fitted_here = model is None
    if fitted_here:
        slots = _used_slots(labelled, width)
    else:
        slots = None if code is None else code.positions
        n = width if slots is None else len(slots)
        if code is None and model.numFeatures != n:
            raise ValueError(f"the model has {model.numFeatures} features, the table {n}; "
                             "a model of a compacted table needs its leaf code")
    train = _decode(labelled, width, binary_attrs, slots).persist(StorageLevel.MEMORY_AND_DISK)
    if fitted_here:
        model = trees.fit_gbt(train, **(gbt_params or {}))
    vec = train.select("user_id", "features")
    # one leafCol pass gives every tree's leaf index for every row
    per_leaf = trees.tree_leaves(model, vec).select("user_id", "tree_leaves")
    per_leaf = per_leaf.persist(StorageLevel.MEMORY_AND_DISK)
    n_trees = len(model.trees)
    max_entries = n_trees * (2 ** model.getMaxDepth())
    if code is not None:
        pass
    elif key == "value":
        # a model fitted on these rows has a row in every leaf; another one's leaves are looked up
        code = trees.LeafCode.by_leaf_index(model, per_leaf=None if fitted_here else per_leaf,
                                            max_entries=max_entries)
    elif key == "index":
        code = trees.LeafCode.fit(per_leaf, n_trees, col="tree_leaves", max_entries=max_entries)
    else:
        raise ValueError(f"unknown leaf key {key!r}")
    if fitted_here:
        code.positions = slots
    out = per_leaf.select("user_id", F.array_join(code.onehot("tree_leaves"), ",").alias("feature"))
    return LeafFeatures(out, code, model, per_leaf, train)


# ---------------------------------------------------------------- E6
def seed_check(users: DataFrame, seed_lines: DataFrame, distinct: bool = False) -> DataFrame:
    """Coverage of a seed list over the rows of a caller's query."""
    return populations.seed_coverage(users, seed_lines, distinct=distinct)

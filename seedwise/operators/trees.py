"""Boosted regression trees and tree-leaf features: L1, L2, V8, A5, W2, N5, V9.

Training and scoring are Spark ML calls (distributed per tree level). The
tree-leaf dictionary has at most ``trees * 2^depth`` entries whatever the data
size, so it is collected and compiled into literal look-ups: encoding a user is
then one projection, with no shuffle and no join.
"""

from __future__ import annotations

import json

from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwise.constants import GBT_DEPTH, GBT_ITERATIONS, GBT_MIN_INSTANCES, GBT_STEP
from seedwise.operators.numbering import ordered_index
from seedwise.session import scratch_path

GBT_SEED = 2017      # our own choice; any seed gives the same trees without subsampling


def fit_gbt(train: DataFrame, features: str = "features", label: str = "label",
            max_iter: int = GBT_ITERATIONS, max_depth: int = GBT_DEPTH,
            step_size: float = GBT_STEP, min_instances: int = GBT_MIN_INSTANCES,
            seed: int = GBT_SEED) -> GBTRegressionModel:
    """L1: squared-loss boosted regression trees on 0/1 labels."""
    gbt = GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter,
                       maxDepth=max_depth, stepSize=step_size, lossType="squared",
                       minInstancesPerNode=min_instances, seed=seed)
    return gbt.fit(train)


def score_gbt(model: GBTRegressionModel, df: DataFrame, features: str = "features",
              out: str = "score") -> DataFrame:
    """L2: ensemble score (unbounded regression output, not a probability)."""
    m = model.copy().setFeaturesCol(features).setPredictionCol(out)
    return m.transform(df)


def tree_scores(model: GBTRegressionModel, df: DataFrame, features: str = "features",
                out: str = "tree_scores") -> DataFrame:
    """V8: ``out`` = array of each tree's raw leaf value (not weighted), tree order."""
    cols = []
    cur = df
    for i, tree in enumerate(model.trees):
        name = f"_tree{i}"
        t = tree.copy().setFeaturesCol(features).setPredictionCol(name)
        if t.hasParam("leafCol"):
            t = t.setLeafCol("")
        cur = t.transform(cur)
        cols.append(name)
    return cur.withColumn(out, F.array(*[F.col(c) for c in cols])).drop(*cols)


def tree_leaves(model: GBTRegressionModel, df: DataFrame, features: str = "features",
                out: str = "tree_leaves") -> DataFrame:
    """Spark's leaf *index* per tree (``leafCol``) as ``array<double>``."""
    from pyspark.ml.functions import vector_to_array
    m = model.copy().setFeaturesCol(features).setLeafCol("_leaf").setPredictionCol("_pred")
    return (m.transform(df).withColumn(out, vector_to_array("_leaf"))
             .drop("_leaf", "_pred"))


def leaf_values(per_tree: DataFrame, col: str = "tree_scores") -> DataFrame:
    """A5: distinct ``(tree_id, leaf_value)`` observed; partial aggregation first."""
    return (per_tree.select(F.posexplode(col).alias("tree_id", "leaf_value"))
                    .distinct())


def leaf_dictionary(values: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``(tree_id, leaf_value, idx)``, values numbered ascending inside a tree.
    ``max_rows`` (trees * 2^depth) bounds a tree's entries."""
    return ordered_index(values, ["tree_id"], [F.col("leaf_value").asc()], idx_col="idx",
                         max_rows=max_rows).withColumn("idx", F.col("idx").cast("int"))


def model_nodes(model: GBTRegressionModel) -> DataFrame:
    """The node table of a model, read back from its written form: ``tree_id, node,
    prediction, gain, n_rows, left, right, slot, left_categories``. A leaf has no children
    (-1) and no slot. At most ``trees * (2^(depth + 1) - 1)`` rows, whatever the data."""
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "model-nodes")
    model.write().overwrite().save(path)
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree_id"), node["id"].alias("node"),
        node["prediction"].alias("prediction"), node["gain"].alias("gain"),
        node["rawCount"].alias("n_rows"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("slot"),
        node["split"]["leftCategoriesOrThreshold"].alias("left_categories"))


def leaf_value_map(model: GBTRegressionModel, vectors: DataFrame | None = None,
                   per_leaf: DataFrame | None = None, features: str = "features",
                   col: str = "tree_leaves", max_entries: int | None = None
                   ) -> dict[tuple[int, float], float]:
    """(tree, leaf index) -> leaf value, from the model's node table alone.

    Leaves are numbered from left to right, as ``leafCol`` numbers them, by walking the
    links of the nodes; no row of data gives a value. Every leaf of a model holds rows of its
    training set. For a model that meets other rows, ``per_leaf`` (leaf indices per row,
    column ``col``; computed from ``vectors`` if only these are given) keeps the leaves that
    occur there.
    """
    if per_leaf is None and vectors is not None:
        per_leaf = tree_leaves(model, vectors, features, col)
    children, value = {}, {}
    for r in model_nodes(model).select("tree_id", "node", "prediction", "left", "right").collect():
        children[r["tree_id"], r["node"]] = (r["left"], r["right"])
        value[r["tree_id"], r["node"]] = r["prediction"]
    out = {}
    for t in range(len(model.trees)):
        n, path = 0, [0]
        while path:
            node = path.pop()
            left, right = children[t, node]
            if left < 0:
                out[t, float(n)] = value[t, node]
                n += 1
            else:
                path += [right, left]
    if per_leaf is not None:
        # at most trees * 2^depth pairs; partial aggregation first
        seen = {(r["t"], float(r["leaf"])) for r in
                per_leaf.select(F.posexplode(col).alias("t", "leaf")).distinct().collect()}
        out = {k: v for k, v in out.items() if k in seen}
    if max_entries is not None and len(out) > max_entries:
        raise ValueError(f"more than {max_entries} leaves")
    return out


def leaf_table(values: dict[tuple[int, float], float]) -> DataFrame:
    """A5 from the node table: distinct ``(tree_id, leaf_value)`` of a leaf value map."""
    rows = sorted({(t, v) for (t, _), v in values.items()})
    return SparkSession.getActiveSession().createDataFrame(rows, "tree_id int, leaf_value double")


def split_gains(train: DataFrame, positions: str = "positions", label: str = "label",
                min_instances: int = GBT_MIN_INSTANCES) -> DataFrame:
    """L1, first split: the variance gain of every slot over rows of hot positions
    (``array<int>``), as an aggregate: ``slot, n_set, n_unset, mean_set, mean_unset, gain``.

    Only set positions are counted; what is not set follows from the totals, so the cost
    follows the positions and not the width. Slots with fewer than ``min_instances`` rows on
    a side cannot be split on and are left out.
    """
    y = F.col(label).cast("double")
    total = train.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("s")).first()
    n, s = F.lit(total["n"]), F.lit(total["s"])
    per_slot = (train.select(y.alias("_y"), F.explode(F.array_distinct(positions)).alias("slot"))
                .groupBy("slot").agg(F.count(F.lit(1)).alias("n_set"), F.sum("_y").alias("_s1")))
    n1, s1 = F.col("n_set"), F.col("_s1")
    n0, s0 = n - n1, s - s1
    gain = (s0 * s0 / n0 + s1 * s1 / n1 - s * s / n) / n
    return (per_slot.where((n1 >= min_instances) & (n0 >= min_instances) & (n0 > 0))
            .select("slot", "n_set", n0.alias("n_unset"), (s1 / n1).alias("mean_set"),
                    (s0 / n0).alias("mean_unset"), gain.alias("gain")))


def first_split(model: GBTRegressionModel) -> DataFrame:
    """The root of the first tree in the same columns as :func:`split_gains`, from the node
    table. The slots must be marked as two-valued (V7)."""
    nodes = model_nodes(model).where("tree_id = 0")
    root = nodes.where("node = 0 and left >= 0").select(
        "slot", "gain", "left", "right", F.array_contains("left_categories", 1.0).alias("_set_left"))
    left = nodes.select(F.col("node").alias("left"), F.col("n_rows").alias("_nl"),
                        F.col("prediction").alias("_ml"))
    right = nodes.select(F.col("node").alias("right"), F.col("n_rows").alias("_nr"),
                         F.col("prediction").alias("_mr"))
    on, off = F.col("_set_left"), ~F.col("_set_left")
    return root.join(left, "left").join(right, "right").select(
        "slot", F.when(on, F.col("_nl")).otherwise(F.col("_nr")).alias("n_set"),
        F.when(off, F.col("_nl")).otherwise(F.col("_nr")).alias("n_unset"),
        F.when(on, F.col("_ml")).otherwise(F.col("_mr")).alias("mean_set"),
        F.when(off, F.col("_ml")).otherwise(F.col("_mr")).alias("mean_unset"), "gain")


def tree_values_from_leaves(per_leaf: DataFrame, values: dict[tuple[int, float], float],
                            n_trees: int, col: str = "tree_leaves",
                            out: str = "tree_scores") -> DataFrame:
    """V8 from leaf indices: each tree's leaf value through a literal map, so all
    per-tree values come from one ``leafCol`` pass instead of one model call per
    tree and row."""
    per_tree = []
    for t in range(n_trees):
        pairs = sorted((leaf, v) for (tt, leaf), v in values.items() if tt == t)
        m = F.create_map(*[x for leaf, v in pairs for x in (F.lit(leaf), F.lit(v))])
        per_tree.append(F.try_element_at(m, F.element_at(F.col(col), t + 1)))
    return per_leaf.withColumn(out, F.array(*per_tree))


def _is_slot(slot: Column):
    def hit(j: Column) -> Column:
        return F.coalesce((j == slot).cast("int"), F.lit(0))
    return hit


class LeafCode:
    """The collected leaf dictionary: per tree, key -> slot, and block widths.

    The key is what the encoded column holds per tree: the leaf value (V8
    output) or Spark's leaf index. Slots always number distinct keys of the
    dictionary's own kind, ascending; equal-valued leaves share a slot.

    ``positions``: the feature positions behind the model's slots, where it was trained on
    the set ones only (a wide table); None where slot and position are one.
    """

    def __init__(self, rows: list, n_trees: int, widths: list[int] | None = None):
        self.n_trees = n_trees
        self.positions: list[int] | None = None
        self.slots: list[dict[float, int]] = [dict() for _ in range(n_trees)]
        for r in rows:
            self.slots[r["tree_id"]][float(r["leaf_value"])] = int(r["idx"])
        self.widths = widths if widths is not None else [len(s) for s in self.slots]

    @classmethod
    def by_leaf_index(cls, model: GBTRegressionModel, vectors: DataFrame | None = None,
                      per_leaf: DataFrame | None = None, features: str = "features",
                      col: str = "tree_leaves", max_entries: int | None = None) -> "LeafCode":
        """Value-keyed slots addressed by leaf index, from the model's node table (see
        :func:`leaf_value_map`)."""
        n_trees = len(model.trees)
        value = leaf_value_map(model, vectors, per_leaf, features, col, max_entries)
        ordered = [sorted({v for (t, _), v in value.items() if t == tt}) for tt in range(n_trees)]
        slot_of = [{v: i for i, v in enumerate(vals)} for vals in ordered]
        code = cls([], n_trees, widths=[len(vals) for vals in ordered])
        for (t, leaf), v in value.items():
            code.slots[t][leaf] = slot_of[t][v]
        return code

    @classmethod
    def fit(cls, per_tree: DataFrame, n_trees: int, col: str = "tree_scores",
            max_entries: int | None = None) -> "LeafCode":
        entries = leaf_dictionary(leaf_values(per_tree, col), max_entries)
        rows = (entries if max_entries is None else entries.limit(max_entries + 1)).collect()
        if max_entries is not None and len(rows) > max_entries:
            raise ValueError(f"leaf dictionary has more than {max_entries} entries")
        return cls(rows, n_trees)

    def to_json(self) -> str:
        """The code as text, so that a later day's leaves take the same slots."""
        return json.dumps({"widths": self.widths, "slots": [sorted(s.items()) for s in self.slots],
                           "positions": self.positions})

    @classmethod
    def from_json(cls, text: str) -> "LeafCode":
        d = json.loads(text)
        code = cls([], len(d["slots"]), widths=d["widths"])
        code.slots = [{float(k): int(v) for k, v in s} for s in d["slots"]]
        code.positions = d.get("positions")
        return code

    @property
    def width(self) -> int:
        return sum(self.widths)

    def offsets(self) -> list[int]:
        out, run = [], 0
        for w in self.widths:
            out.append(run)
            run += w
        return out

    def _slot(self, t: int, keys: Column) -> Column:
        m = F.create_map(*[x for k, i in sorted(self.slots[t].items())
                           for x in (F.lit(k), F.lit(i))])
        return F.try_element_at(m, F.element_at(keys, t + 1))

    def onehot(self, col: str = "tree_scores") -> Column:
        """Concatenated per-tree one-hot blocks as ``array<int>``."""
        blocks = []
        for t in range(self.n_trees):
            if self.widths[t] == 0:
                continue
            slot = self._slot(t, F.col(col))
            blocks.append(F.transform(F.sequence(F.lit(0), F.lit(self.widths[t] - 1)),
                                      _is_slot(slot)))
        if not blocks:
            return F.array().cast("array<int>")
        return blocks[0] if len(blocks) == 1 else F.concat(*blocks)

    def hot_positions(self, col: str = "tree_scores") -> Column:
        """Sparse form: ``offset(tree) + slot`` for every tree, ``array<int>``."""
        offs = self.offsets()
        return F.array(*[F.lit(offs[t]) + self._slot(t, F.col(col))
                         for t in range(self.n_trees) if self.widths[t] > 0])

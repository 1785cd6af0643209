"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (or data Spark derives from them) in full.
Column names match the oracle SQL in :mod:`seedwise.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedwise.functions.columns import date_key, has_token, multi_hot, tokens_or_empty
from seedwise.functions.vectors import dense_to_vector, positions_to_vector, set_slots
from seedwise.operators import encode, evaluate, linear, populations, ranking, trees
from seedwise.operators.populations import SeedSet
from seedwise.plans import jobs, runs
from seedwise.plans import profile as P
from seedwise.session import scratch_path
from seedwise.sources import sinks, tables, text

# Fixed values of the catalogue queries.
AS_OF = dt.date(2024, 1, 20)
EVENT_TYPE = "purchase"
EVENT_MIN_VALUE = 150.0
TOP_K = 100
PREVIEW_ROWS = 10
DOC_SCORE_SHIFT = 1000.0
ROUND = 6
GRADIENT_TOLERANCE = 1e-4

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ shared inputs
def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return P.profile_with_reader(P.load_profile(spark, sf))


def _seeds(spark: SparkSession, sf: str) -> SeedSet:
    return SeedSet.from_lines(P.seed_lines(spark, sf))


def _reader_users(spark: SparkSession, sf: str) -> DataFrame:
    # the profile's code is the integer nation key, so the IN-list reaches the scan
    return populations.code_filter(_profile(spark, sf), "nation", P.READER_CODES)


def _fixed_score(df: DataFrame) -> DataFrame:
    """A deterministic stand-in score over profile columns (no model)."""
    n_months = F.size(tokens_or_empty("cycle"))
    n_prios = F.size(tokens_or_empty("priorities"))
    s = (n_months * 10 + n_prios).cast("double") + F.col("nation").cast("double") / F.lit(100.0)
    return df.withColumn("score", F.round(s, ROUND))


def _exclusive_scored(spark: SparkSession, sf: str) -> DataFrame:
    cands = populations.candidates(_profile(spark, sf), _seeds(spark, sf), P.CYCLE_TOKEN,
                                   inclusive=False)
    return _fixed_score(cands).select("user_id", "score")


def _doc_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = P.table(spark, sf, "documents").select("doc_id", "n_chars")
    labels = P.table(spark, sf, "labels").select("doc_id", "quality")
    n = F.col("n_chars").cast("double")
    return docs.join(labels, "doc_id").select(
        (n / (n + F.lit(DOC_SCORE_SHIFT))).alias("score"),
        F.col("quality").cast("double").alias("label"))


def _stored_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The derived profile written once to the shared checkpoint folder, as the
    profile table it stands in for; the encoders scan it twice. (A persisted
    frame would also be substituted into later, unrelated queries.)"""
    from seedwise.session import cut_lineage
    return cut_lineage(_profile(spark, sf))


def _onehot(spark: SparkSession, sf: str):
    return jobs.onehot_job(_stored_profile(spark, sf), P.ONEHOT_COLUMNS)


def _categorical(spark: SparkSession, sf: str):
    return jobs.categorical_job(_stored_profile(spark, sf), P.CATEGORICAL_SINGLES,
                                P.CATEGORICAL_MULTIS)


# ------------------------------------------------------------------ sources
def q_profile_scan(spark, sf):
    return tables.profile_scan(_profile(spark, sf), P.ONEHOT_COLUMNS, reader_col="reader")


def q_profile_unpivot(spark, sf):
    return encode.unpivot(_profile(spark, sf), P.ONEHOT_COLUMNS)


def q_sql_scan(spark, sf):
    P.table(spark, sf, "customer").createOrReplaceTempView("seedwise_customer")
    return tables.sql_scan(
        spark, "SELECT c_custkey, c_mktsegment FROM seedwise_customer WHERE c_nationkey < 10")


def q_latest_partition(spark, sf):
    ev = tables.with_date_key(P.table(spark, sf, "events"), "ts")
    pred = (F.col("event_type") == F.lit(EVENT_TYPE)) & (F.col("value") > F.lit(EVENT_MIN_VALUE))
    key, rows = tables.latest_partition(ev, AS_OF, where=pred, probe=False)
    return rows.groupBy("stat_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_latest_partition_table(spark, sf):
    """S3 + P2 on a real day-partitioned table: events are written partitioned
    by ``stat_date`` (K1), then the newest non-empty day before ``AS_OF`` is
    found by probing the days of the partition list, newest first."""
    path = scratch_path(spark, "events-by-day")
    ev = tables.with_date_key(P.table(spark, sf, "events"), "ts")
    ev.write.mode("overwrite").partitionBy("stat_date").parquet(path)
    pred = (F.col("event_type") == F.lit(EVENT_TYPE)) & (F.col("value") > F.lit(EVENT_MIN_VALUE))
    key, rows = tables.latest_day(spark, AS_OF, path=path, where=pred)
    return rows.groupBy("stat_date").agg(F.count(F.lit(1)).alias("n_rows"))


def q_seed_source(spark, sf):
    path = scratch_path(spark, "seeds")
    text.write_lines(P.seed_lines(spark, sf), "id", path)
    return text.id_lines(spark, path)


def q_column_list_source(spark, sf):
    """E1 parameterised by a column-list file (S5): blank, padded and ``null``
    lines are dropped, order is kept, then the whole profile is encoded."""
    path = scratch_path(spark, "columns")
    lines = ["", " null "] + [f"  {c} " for c in P.ONEHOT_COLUMNS] + ["null", ""]
    spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, v string") \
        .orderBy("n").coalesce(1).select("v").write.mode("overwrite").text(path)
    columns = text.read_column_list(spark, path)
    oh, _ = jobs.onehot_job(_profile(spark, sf), columns)
    return oh


def q_seed_from_table(spark, sf):
    c = P.table(spark, sf, "customer").where(F.col("c_acctbal") > F.lit(P.SEED_BALANCE))
    return tables.seed_from_table(c, "c_custkey")


def q_onehot_decode(spark, sf):
    oh, enc = _onehot(spark, sf)
    vec = positions_to_vector(oh, "feature", enc.width, "features")
    return vec.select("user_id", F.explode(set_slots("features")).alias("e")) \
        .select("user_id", "e.slot", "e.value")


# ------------------------------------------------------------------ predicates
def q_in_list_filter(spark, sf):
    return _reader_users(spark, sf).select("user_id", "nation")


def q_token_membership(spark, sf):
    return _profile(spark, sf).select(
        "user_id", has_token("cycle", P.CYCLE_TOKEN).alias("in_cycle"),
        has_token("cycle", P.CYCLE_TOKEN, wrapped=False).alias("in_cycle_tokens"))


def q_token_split(spark, sf):
    toks = tokens_or_empty("priorities")
    return _profile(spark, sf).select("user_id", F.size(toks).alias("n_tokens"),
                                      F.array_join(toks, "|").alias("tokens"))


def q_date_key(spark, sf):
    o = P.table(spark, sf, "orders")
    return o.select("o_orderkey", date_key("o_orderdate").alias("today_key"),
                    date_key("o_orderdate", 1).alias("yesterday_key"))


def q_score_threshold_count(spark, sf):
    return evaluate.threshold_count(_doc_scores(spark, sf))


# ------------------------------------------------------------------ populations
def q_seed_users(spark, sf):
    return populations.seed_users(_profile(spark, sf), _seeds(spark, sf)).select("user_id")


def q_non_seed_users(spark, sf):
    return populations.non_seed_users(_profile(spark, sf), _seeds(spark, sf)).select("user_id")


def q_candidates_inclusive(spark, sf):
    return populations.candidates(_profile(spark, sf), _seeds(spark, sf), P.CYCLE_TOKEN,
                                  inclusive=True).select("user_id")


def q_candidates_exclusive(spark, sf):
    return populations.candidates(_profile(spark, sf), _seeds(spark, sf), P.CYCLE_TOKEN,
                                  inclusive=False).select("user_id")


def q_population_counts(spark, sf):
    return populations.population_counts(_profile(spark, sf), _seeds(spark, sf), P.CYCLE_TOKEN)


def q_seed_coverage(spark, sf):
    P.table(spark, sf, "orders").createOrReplaceTempView("seedwise_orders")
    users = tables.sql_scan(spark, "SELECT o_custkey, o_orderstatus FROM seedwise_orders")
    return jobs.seed_check(users, P.seed_lines(spark, sf))


def q_sampling_ratio(spark, sf):
    counts = populations.population_counts(_reader_users(spark, sf), _seeds(spark, sf),
                                           P.CYCLE_TOKEN)
    return counts.select(populations.ratio_column("seeds", "others").alias("ratio"))


def _negatives(spark, sf, per_positive):
    users = _reader_users(spark, sf)
    seeds = _seeds(spark, sf)
    c = populations.population_counts(users, seeds, P.CYCLE_TOKEN).first()
    ratio = populations.sampling_ratio(c["seeds"], c["others"], per_positive)
    others = populations.candidates(users, seeds, P.CYCLE_TOKEN, inclusive=False)
    return populations.negative_sample(others, ratio).select("user_id")


def q_negative_sample(spark, sf):
    return _negatives(spark, sf, populations.NEGATIVES_PER_POSITIVE)


def q_negative_sample_balanced(spark, sf):
    return _negatives(spark, sf, 1)


def q_hash_split(spark, sf):
    cyc = _reader_users(spark, sf).where(populations.in_cycle("cycle", P.CYCLE_TOKEN))
    return populations.hash_split(cyc).select("user_id", "half")


def q_training_set(spark, sf):
    users = _reader_users(spark, sf)
    seeds = _seeds(spark, sf)
    c = populations.population_counts(users, seeds, P.CYCLE_TOKEN).first()
    ratio = populations.sampling_ratio(c["seeds"], c["others"])
    others = populations.candidates(users, seeds, P.CYCLE_TOKEN, inclusive=False)
    return populations.training_set(populations.seed_users(users, seeds),
                                    populations.negative_sample(others, ratio))


# ------------------------------------------------------------------ dictionaries
def q_category_values(spark, sf):
    return _profile(spark, sf).select(F.col("nation").cast("string").alias("value")).distinct()


def q_token_values(spark, sf):
    return (_profile(spark, sf).select(F.explode(tokens_or_empty("priorities")).alias("value"))
            .distinct())


def q_feature_dictionary(spark, sf):
    _, enc = _onehot(spark, sf)
    return encode.dictionary_frame(enc)


def q_feature_arity(spark, sf):
    _, enc = _onehot(spark, sf)
    return encode.arity_table(enc).select("col_name", "arity")


def q_feature_width(spark, sf):
    _, enc = _onehot(spark, sf)
    return encode.arity_table(enc).agg(F.sum("arity").cast("bigint").alias("width"))


def q_block_offsets(spark, sf):
    _, enc = _onehot(spark, sf)
    return encode.block_offsets(enc)


def _index_single(spark, sf, table_name, col, keys):
    df = P.table(spark, sf, table_name).select(*keys, col)
    out, _ = encode.index_single(df, col, keys)
    return out


def q_single_index(spark, sf):
    return _index_single(spark, sf, "customer", "c_mktsegment", ["c_custkey"])


def q_single_index_int(spark, sf):
    return _index_single(spark, sf, "customer", "c_nationkey", ["c_custkey"])


def q_single_index_bigint(spark, sf):
    return _index_single(spark, sf, "orders", "o_custkey", ["o_orderkey"])


def q_single_index_double(spark, sf):
    return _index_single(spark, sf, "lineitem", "l_discount", ["l_orderkey", "l_linenumber"])


def q_multi_index(spark, sf):
    prof = _stored_profile(spark, sf)
    _, enc = jobs.categorical_job(prof, P.CATEGORICAL_SINGLES, P.CATEGORICAL_MULTIS)
    mi = encode.multi_index(prof, enc, "priorities")
    return mi.select("user_id", F.array_join("idx", ",").alias("idx"))


def q_multi_hot(spark, sf):
    prof = _stored_profile(spark, sf)
    _, enc = jobs.categorical_job(prof, P.CATEGORICAL_SINGLES, P.CATEGORICAL_MULTIS)
    width = enc.arity[[f.name for f in enc.layout].index("priorities")]
    mi = encode.multi_index(prof, enc, "priorities")
    return mi.select("user_id", F.array_join(multi_hot("idx", width), ",").alias("hot"))


def q_onehot_index(spark, sf):
    prof = _stored_profile(spark, sf)
    _, enc = jobs.onehot_job(prof, P.ONEHOT_COLUMNS)
    return encode.onehot_index(prof, enc)


def q_onehot_features(spark, sf):
    oh, _ = _onehot(spark, sf)
    return oh


def q_onehot_features_wide(spark, sf):
    """E1 on domains far above the inline limit: the join path of the encoder."""
    o = P.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("user_id"), "o_custkey",
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"))
    oh, _ = jobs.onehot_job(o, ["o_custkey", "day"], keep=())
    return oh


def q_feature_size_check(spark, sf):
    oh, _ = _onehot(spark, sf)
    return oh.agg(F.countDistinct("feature_size").alias("n_widths"),
                  F.max("feature_size").alias("width"))


def q_categorical_features(spark, sf):
    cat, _ = _categorical(spark, sf)
    return cat


def q_categorical_render(spark, sf):
    cat, _ = _categorical(spark, sf)
    return cat.select("user_id", "feature")


# ------------------------------------------------------------------ evaluation
def q_confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_doc_scores(spark, sf))


def q_precision_recall(spark, sf):
    pr = evaluate.precision_recall(_doc_scores(spark, sf))
    return pr.select(F.round("precision", ROUND).alias("precision"),
                     F.round("recall", ROUND).alias("recall"))


def q_auc_raw(spark, sf):
    return evaluate.auc(_doc_scores(spark, sf)).select(F.round("auc", ROUND).alias("auc"))


def q_auc_binarised(spark, sf):
    a = evaluate.auc_binarised(_doc_scores(spark, sf))
    return a.select(F.round("auc_binarised", ROUND).alias("auc_binarised"))


# ------------------------------------------------------------------ ranking
def q_topk_scores(spark, sf):
    return ranking.top_k(_exclusive_scored(spark, sf), TOP_K)


def q_all_ranked(spark, sf):
    return ranking.all_ranked(_exclusive_scored(spark, sf))


def q_preview(spark, sf):
    oh, _ = _onehot(spark, sf)
    return ranking.preview(oh.select("user_id", "feature"), PREVIEW_ROWS, "user_id")


def q_array_to_vector_rows(spark, sf):
    from pyspark.ml.functions import vector_to_array
    e = P.table(spark, sf, "embeddings")
    v = e.select("vec_id", dense_to_vector("embedding").alias("vec"))
    return v.select("vec_id", F.posexplode(vector_to_array("vec")).alias("position", "value")) \
        .withColumn("value", F.round("value", ROUND))


# ------------------------------------------------------------------ models (rows-only)
def _encoded(spark, sf):
    oh, enc = _onehot(spark, sf)
    from seedwise.session import cut_lineage
    return cut_lineage(oh), enc.width


def _expansion(spark, sf, model, **kw):
    oh, width = _encoded(spark, sf)
    return jobs.expand(oh, _seeds(spark, sf), model=model, width=width, **kw)


def q_gbt_train_score(spark, sf):
    return _expansion(spark, sf, "gbt").scores


def q_lr_train_score(spark, sf):
    return _expansion(spark, sf, "lr").scores


def q_lr_hard_score(spark, sf):
    return _expansion(spark, sf, "lr", hard_lr=True).scores


def q_lr_mean_score(spark, sf):
    """L3: with a free intercept the mean score of the training rows is their mean label."""
    exp = _expansion(spark, sf, "lr")
    return exp.training.agg(F.round(F.avg("label"), ROUND).alias("mean_label"),
                            (F.abs(F.avg("score") - F.avg("label")) < 1e-4).alias("score_agrees"))


def q_training_report_totals(spark, sf):
    """The matrix rows add up to the training labels."""
    r = jobs.expansion_report(_expansion(spark, sf, "gbt"))
    return r.select((F.col("tp") + F.col("fn")).alias("positives"),
                    (F.col("fp") + F.col("tn")).alias("negatives"))


def q_expand_by_trees_ids(spark, sf):
    return _expansion(spark, sf, "gbt").ranked.select("user_id")


def q_expand_by_logistic_ids(spark, sf):
    return _expansion(spark, sf, "lr").ranked.select("user_id")


def q_expand_from_table_ids(spark, sf):
    return q_expand_from_table(spark, sf).select("user_id")


def q_gbt_roundtrip_equal(spark, sf):
    """Users whose score is the same before and after saving the model."""
    r = q_gbt_model_roundtrip(spark, sf)
    return r.where(F.col("score_before") == F.col("score_after")).select("user_id")


def q_tree_scores_add_up(spark, sf):
    """V8, L2: users whose weighted per-tree values add up to the ensemble's score."""
    oh, width = _encoded(spark, sf)
    lf = jobs.leaf_job(oh, width=width)
    both = trees.tree_scores(lf.model, trees.score_gbt(lf.model, lf.vectors))
    weighted = F.aggregate(F.arrays_zip(F.col("tree_scores").alias("v"), F.array(
        *[F.lit(float(w)) for w in lf.model.treeWeights]).alias("w")), F.lit(0.0),
        lambda a, x: a + x["v"] * x["w"])
    return both.where(F.abs(weighted - F.col("score")) < 1e-9).select("user_id")


def q_leaf_onehot_hot(spark, sf):
    """Hot slots per user, one for each tree."""
    return q_leaf_onehot(spark, sf).select("user_id", F.size(F.filter(
        F.split("feature", ","), lambda x: x == "1")).alias("n_hot"))


def q_leaf_sink_users(spark, sf):
    """K2: the users read back from the leaf-feature table."""
    return q_leaf_sink_roundtrip(spark, sf).select("user_id", "stat_date")


def q_training_report(spark, sf):
    return jobs.expansion_report(_expansion(spark, sf, "gbt"))


def q_expand_by_trees(spark, sf):
    return _expansion(spark, sf, "gbt").ranked


def q_expand_by_logistic(spark, sf):
    return _expansion(spark, sf, "lr").ranked


def q_gbt_model_roundtrip(spark, sf):
    exp = _expansion(spark, sf, "gbt")
    path = scratch_path(spark, "gbt-model")
    sinks.save_model(exp.model, path)
    loaded = sinks.load_gbt_model(path)
    oh, width = _encoded(spark, sf)
    cands = positions_to_vector(oh.where(populations.in_list("reader", P.READER_CODES)),
                                "feature", width, "features")
    before = trees.score_gbt(exp.model, cands, out="score_before")
    both = trees.score_gbt(loaded, before, out="score_after")
    return both.select("user_id", "score_before", "score_after")


def _leaf(spark, sf, key="value"):
    oh, width = _encoded(spark, sf)
    return jobs.leaf_job(oh, width=width, key=key)


def _per_tree_values(spark, sf):
    """V8 for every training row: leaf indices from one pass, values by look-up."""
    lf = _leaf(spark, sf)
    n_trees = len(lf.model.trees)
    values = trees.leaf_value_map(lf.model, max_entries=n_trees * 2 ** lf.model.getMaxDepth())
    return trees.tree_values_from_leaves(lf.per_leaf, values, n_trees), lf


def q_tree_scores(spark, sf):
    per, _ = _per_tree_values(spark, sf)
    return per.select("user_id", F.posexplode("tree_scores").alias("tree_id", "leaf_value"))


def q_leaf_values(spark, sf):
    per, _ = _per_tree_values(spark, sf)
    return trees.leaf_values(per)


def q_leaf_dictionary(spark, sf):
    per, lf = _per_tree_values(spark, sf)
    return trees.leaf_dictionary(trees.leaf_values(per), max_rows=sum(lf.code.widths))


def q_leaf_dictionary_agrees(spark, sf):
    """Per tree, whether the leaf values that rows of data get from each tree's own
    model are those of the node table, and whether the dictionary numbers them 0, 1, …,
    ascending."""
    lf = _leaf(spark, sf)
    n_trees = len(lf.model.trees)
    table = trees.leaf_table(trees.leaf_value_map(lf.model))
    scored = trees.leaf_values(trees.tree_scores(lf.model, lf.vectors.select("features")))
    both = (table.withColumn("_t", F.lit(1)).join(scored.withColumn("_s", F.lit(1)),
                                                  ["tree_id", "leaf_value"], "full"))
    same = both.groupBy("tree_id").agg(
        F.count_if(F.col("_t").isNull() | F.col("_s").isNull()).alias("n_unmatched"))
    entries = trees.leaf_dictionary(table, max_rows=n_trees * 2 ** lf.model.getMaxDepth())
    ordered = F.array_sort(F.collect_list(F.struct("leaf_value", "idx")))
    dense = entries.groupBy("tree_id").agg(
        (F.transform(ordered, lambda e: e["idx"]) == F.sequence(F.lit(0), F.count("idx").cast("int") - 1))
        .alias("ascending"))
    return same.join(dense, "tree_id").select("tree_id", "n_unmatched", "ascending")


def _positions(df):
    return df.withColumn("positions", F.transform(tokens_or_empty("feature"), lambda t: t.cast("int")))


def q_gbt_root_split(spark, sf):
    """L1, V7: the first split of the fitted trees, and whether it is the best one that an
    aggregate over the training rows' hot positions finds."""
    exp = _expansion(spark, sf, "gbt")
    gains = trees.split_gains(_positions(exp.training.select("feature", "label")))
    best = gains.orderBy(F.desc("gain"), "slot").limit(1)
    near = [F.abs(F.col(f"m.{c}") - F.col(f"b.{c}")) < 1e-9
            for c in ("n_set", "n_unset", "mean_set", "mean_unset", "gain")]
    agrees = near[0] & near[1] & near[2] & near[3] & near[4]
    return trees.first_split(exp.model).alias("m").join(
        best.alias("b"), F.col("m.slot") == F.col("b.slot"), "left").select(
        "m.slot", "m.n_set", "m.n_unset", F.round("m.mean_set", ROUND).alias("mean_set"),
        F.round("m.mean_unset", ROUND).alias("mean_unset"), F.round("m.gain", ROUND).alias("gain"),
        F.coalesce(agrees, F.lit(False)).alias("agrees"))


def q_lr_gradient(spark, sf):
    """L3: per slot of the training rows and for the intercept (-1), how many rows set it, their
    label sum, and whether the penalised loss is flat there at the fitted coefficients."""
    exp = _expansion(spark, sf, "lr")
    g = linear.lr_gradient(exp.model, _positions(exp.training.select("feature", "label", "score")))
    return g.select("slot", "n_set", "positives",
                    (F.abs("gradient") < GRADIENT_TOLERANCE).alias("at_optimum"))


def q_lr_hard_agrees(spark, sf):
    """L4: the scored users, and whether the hard class is 1 exactly where the margin, added up
    from the coefficients at the user's hot positions, is positive."""
    oh, width = _encoded(spark, sf)
    exp = jobs.expand(oh, _seeds(spark, sf), model="lr", width=width, hard_lr=True)
    sums = linear.margins(exp.model, _positions(oh.select("user_id", "feature")))
    return exp.scores.join(sums, "user_id").select(
        "user_id", (F.col("score") == F.when(F.col("margin") > 0, 1.0).otherwise(0.0)).alias("agrees"))


def q_leaf_text_agrees(spark, sf):
    """Per user, the ones in the leaf text read back from the day's table, and whether the
    text has one 0 or 1 per dictionary entry and its ones are the entries of the values that
    each tree's own model gives the user."""
    lf = _leaf(spark, sf)
    path = scratch_path(spark, "leaf-text")
    sinks.write_day_partition(lf.features, path, sinks.day_key(AS_OF))
    most = len(lf.model.trees) * 2 ** lf.model.getMaxDepth()
    entries = trees.leaf_dictionary(trees.leaf_table(trees.leaf_value_map(lf.model)), max_rows=most)
    # one row per entry, at most ``most`` in all: their places in the text
    places = entries.withColumn("place", F.row_number().over(Window.orderBy("tree_id", "idx")) - 1)
    given = trees.tree_scores(lf.model, lf.vectors).select(
        "user_id", F.posexplode("tree_scores").alias("tree_id", "leaf_value"))
    want = given.join(F.broadcast(places), ["tree_id", "leaf_value"]).groupBy("user_id").agg(
        F.sort_array(F.collect_list("place")).alias("want"))
    signs = F.split("feature", ",")
    ones = F.array_compact(F.transform(signs, lambda s, i: F.when(s == "1", i)))
    whole = F.forall(signs, lambda s: s.isin("0", "1")) & (F.size(signs) == F.lit(entries.count()))
    return sinks.read_day_partitions(spark, path).join(want, "user_id").select(
        "user_id", "stat_date", F.size(ones).alias("n_hot"), (whole & (ones == F.col("want"))).alias("agrees"))


def q_leaf_onehot(spark, sf):
    return _leaf(spark, sf).features


def q_leaf_index_onehot(spark, sf):
    return _leaf(spark, sf, key="index").features


def q_expand_from_table(spark, sf):
    """The tree job from storage to storage: E1 writes a day partition (K1), the
    seed list is a text file (S4), the job finds the newest non-empty day (S3),
    expands (E3), writes the score file (K4) and the id file (K5); the score
    file is read back."""
    base = scratch_path(spark, "storage-to-storage")
    oh, _ = _onehot(spark, sf)
    sinks.write_day_partition(oh, f"{base}/features", sinks.day_key(AS_OF, 1))
    text.write_lines(P.seed_lines(spark, sf), "id", f"{base}/seeds")
    runs.run_expansion(spark, f"{base}/features", f"{base}/seeds", f"{base}/scores", AS_OF,
                       P.READER_CODES)
    return (spark.read.option("sep", "\u0001").schema("user_id bigint, score double")
            .csv(f"{base}/scores"))


# ------------------------------------------------------------------ sinks (round trips)
def q_feature_sink_roundtrip(spark, sf):
    oh, _ = _onehot(spark, sf)
    path = scratch_path(spark, "onehot-table")
    first, second = sinks.day_key(AS_OF), sinks.day_key(AS_OF, 1)
    sinks.write_day_partition(oh, path, first)
    sinks.write_day_partition(oh, path, second)
    sinks.write_day_partition(oh, path, first)      # replaces only its own partition
    third = sinks.day_key(AS_OF, 2)
    sinks.write_day_partition(oh, path, third)
    sinks.write_day_partition(oh.limit(0), path, third)      # an empty result empties the day
    return sinks.read_day_partitions(spark, path)


def q_leaf_sink_roundtrip(spark, sf):
    lf = _leaf(spark, sf)
    path = scratch_path(spark, "leaf-table")
    sinks.write_day_partition(lf.features, path, sinks.day_key(AS_OF))
    return sinks.read_day_partitions(spark, path)


def q_score_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "score-table")
    sinks.write_scores_table(_exclusive_scored(spark, sf), path, AS_OF)
    return sinks.read_day_partitions(spark, path)


def q_score_file_roundtrip(spark, sf):
    path = scratch_path(spark, "score-file")
    sinks.write_score_file(ranking.top_k(_exclusive_scored(spark, sf), TOP_K), path)
    back = spark.read.option("sep", "\u0001").schema("user_id bigint, score double").csv(path)
    return back


def q_id_file_roundtrip(spark, sf):
    path = scratch_path(spark, "id-file")
    sinks.write_id_file(ranking.top_k(_exclusive_scored(spark, sf), TOP_K), path)
    return spark.read.text(path).select(F.col("value").alias("user_id"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

"""Plan shape guards: pruning, pushdown, join strategy, partial aggregation."""

from conftest import SF_SMALL
from seedwise.plans import catalog as C


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_in_list_reaches_the_scan(spark):
    p = _plan(C.QUERIES["in_list_filter"](spark, SF_SMALL))
    assert "PushedFilters: [In(c_nationkey" in p or "In(c_nationkey" in p
    assert "o_orderdate" not in p          # the unused orders aggregate is pruned away


def test_seed_filter_pushed_and_columns_pruned(spark):
    p = _plan(C.QUERIES["seed_users"](spark, SF_SMALL))
    assert "GreaterThan(c_acctbal,9000.0)" in p
    assert "c_name" not in p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_small_domain_encoding_is_one_projection(spark):
    df = C.QUERIES["onehot_features"](spark, SF_SMALL)
    df.collect()
    p = _plan(df)
    assert "Exchange" not in p and "Join" not in p      # dictionary inlined, no shuffle
    assert "c_acctbal" not in p


def test_large_domain_encoding_joins_broadcast_and_aggregates_partially(spark, monkeypatch):
    from seedwise.operators import encode
    monkeypatch.setattr(encode, "INLINE_MAX_ARITY", 0)
    df = C.QUERIES["onehot_features"](spark, SF_SMALL)
    df.collect()
    p = _plan(df)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert p.count("ObjectHashAggregate") >= 2          # partial + final collect_set


def test_profile_reads_only_needed_columns(spark):
    p = _plan(C._profile(spark, SF_SMALL))
    assert "c_acctbal" not in p and "c_name" not in p and "o_orderkey" not in p


def test_top_k_is_take_ordered(spark):
    p = _plan(C.QUERIES["topk_scores"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_latest_partition_prunes(spark):
    df = C.QUERIES["latest_partition_table"](spark, SF_SMALL)
    p = _plan(df)
    assert "PartitionFilters" in p and "stat_date" in p

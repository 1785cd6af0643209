"""The user-profile view over the driver tables, and the seed list.

One row per customer:

- ``user_id``    = ``c_custkey``
- ``cycle``      = comma-wrapped ascending set of order months (``,1,3,7,``)
- ``segment``    = ``c_mktsegment`` (single, string)
- ``nation``     = ``c_nationkey`` (single, int; also the IN-list code ``reader``)
- ``priorities`` = comma-wrapped ascending set of ``o_orderpriority`` over all orders
  (multi; NULL for a customer without orders)
- ``statuses``   = the same for ``o_orderstatus``

Orders are aggregated per customer before the join: the sets are bounded
(12 months, 5 priorities, 3 statuses), so partial aggregation shrinks each map
task to one small row per customer, even for a customer with a third of all
orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwise.constants import CYCLE_TOKEN  # noqa: F401  (users holding month 7)
from seedwise.functions.columns import wrap_tokens

# Values of the test-data stand-ins (our choices for the driver tables).
SEED_BALANCE = 9000             # seeds: customers with a balance above this
READER_CODES = (1, 3, 4, 6, 7, 9, 12, 13, 15, 16, 18, 20, 21, 22)   # literal IN-list on `reader`

ONEHOT_COLUMNS = ("segment", "nation", "priorities", "statuses")
CATEGORICAL_SINGLES = ("segment", "nation")
CATEGORICAL_MULTIS = ("priorities", "statuses")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profile_view(customer: DataFrame, orders: DataFrame) -> DataFrame:
    per_customer = orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.array_sort(F.collect_set(F.month("o_orderdate"))).alias("_m"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("_p"),
        F.array_sort(F.collect_set("o_orderstatus")).alias("_s"))
    cust = customer.select(F.col("c_custkey").alias("user_id"),
                           F.col("c_mktsegment").alias("segment"),
                           F.col("c_nationkey").alias("nation"))
    return cust.join(per_customer, "user_id", "left").select(
        "user_id",
        wrap_tokens(F.transform("_m", lambda m: m.cast("string"))).alias("cycle"),
        "segment", "nation",
        wrap_tokens("_p").alias("priorities"),
        wrap_tokens("_s").alias("statuses"))


def load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_view(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))


def profile_with_reader(profile: DataFrame) -> DataFrame:
    """The profile plus ``reader`` (the IN-list code, as text like the source DDL)."""
    return profile.withColumn("reader", F.col("nation").cast("string"))


def seed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed list as id strings, as a seed file would give them."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") > F.lit(SEED_BALANCE)).select(
        F.col("c_custkey").cast("string").alias("id"))


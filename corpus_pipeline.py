"""The training-corpus pipeline: five stages over ``documents``, each one operator.

Every stage reads what its predecessor kept, from a table written between them; all but
the last return the columns of ``documents``:

1. quality: rows that the co-trained classifier rejects go;
2. near duplicates: of each group within 3 differing SimHash bits one row stays;
3. repeats: bytes covered by a 200-byte string found anywhere else go, and rows that lose
   their whole text;
4. mixing: every row comes out as often as its source's target rate and draw say;
5. packing: the rows become pieces of at most 2048 tokens, with their ids, placed in
   sequences; ``packing.sequences`` joins the pieces of the result to the packed corpus.
"""

from __future__ import annotations

import functools
import os
import re
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seedwise.llm import cotraining, mixing, packing, simhash, suffix_dedup  # noqa: E402
from seedwise.llm.common import documents, labels, stage  # noqa: E402


#: Rows and bytes of one Arrow batch. A worker process lives through all stages, and what the
#: largest batch took stays with it and with its executor.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
         "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


#: Of one sequence. 32 pieces bind where texts are short; the attention cost is that of one
#: piece of full length, which has to fit, so it binds no earlier than the tokens do.
CAPACITY = packing.Capacity(max_tokens=2048, max_documents=32, max_attention=2048 * 2048)


def small_batches(step):
    """``step`` in a session with Arrow batches of at most ``BATCH``. The setting outlives the
    call, since the frame that a stage returns is run later; it changes no result."""
    @functools.wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, most in BATCH.items():
            now = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
            if not now or not 0 < int(now[1]) <= most:
                spark.conf.set(key, str(most))
        return step(spark, docs, sf_dir)
    return run


@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cotraining.keep_good(docs, labels(spark, sf_dir))


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs)


@small_batches
def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(docs)


@small_batches
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


@small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a small table of words, gone after each task: the workers live on
    return packing.pack(docs, capacity=CAPACITY, key_bytes=300_000, keep_table=False)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats),
          ("mixed", mixed), ("packed", packed)]

# Models, hashes of shingles and token ids are outside SQL; the tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Mixing sources to target weights, with DataFrame functions only.

Method: words are summed per source; the targets share ``budget`` times all words by
weight, capped at ``max_repeat`` times a source's words, the excess shared again by
weight among the others until no target is above its cap. Rate = target / source words.
Each document comes out floor(rate) times, plus one copy when a hash of its id falls
below the fraction of the rate.

Per document nothing is shuffled: sums are pre-aggregated, and the rates come back by a
join with one row per source, which Spark broadcasts when its written size is below the
session's threshold and else splits where one source is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import WORD_PATTERN, stage, text_or_empty
from seedwise.operators.numbering import ordered_index

SEED = "mix"


def word_count(text_col: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD_PATTERN)).cast("long")


def draw(id_col: str = "doc_id", seed: str = SEED) -> Column:
    """A number in [0, 1) from the md5 of seed and id: the same on every run and engine."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / (1 << 32)


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0),
                   budget: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, target, rate.

    ``sizes`` has columns source and size. Sources are ordered by code point, null last,
    and take ``weights`` in turn. A source of no words has target and rate 0.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_source = stage(by_source.withColumn("_all", F.lit(1)), "sources")
    ordered = ordered_index(by_source, ["_all"], [F.col("source").asc_nulls_last()],
                            idx_col="_rank", max_rows=by_source.count())
    # counted from 0, as the cycle of the weights
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ordered = stage(ordered.select(
        "source", "source_size",
        F.get(turn, F.col("_rank") % len(weights)).alias("_weight"),
        (F.lit(float(max_repeat)) * F.col("source_size")).alias("_cap")), "source-weights")
    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    full = F.lit(False)
    while total:
        # few rounds: the shares only rise, and the set at its cap only grows
        row = ordered.agg(F.sum(F.when(full, F.col("_cap")).otherwise(0.0)).alias("cap"),
                          F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("weight"),
                          F.count_if(full).alias("n")).first()
        if not row["weight"]:
            break
        share = (budget * total - row["cap"]) / row["weight"]
        full = F.col("_cap") < F.lit(share) * F.col("_weight")
        if ordered.where(full).count() == row["n"]:
            break
    target = F.when(full, F.col("_cap")).otherwise(F.lit(share) * F.col("_weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return ordered.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def with_copies(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every row with the target columns of its source and ``copies``, how often the mix
    takes it (0 or more)."""
    t = targets.withColumnRenamed("source", "_source")
    rate = F.coalesce(F.col("rate"), F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + (draw(id_col) < rate - whole).cast("long")
    return (docs.join(t, docs["source"].eqNullSafe(t["_source"]), "left").drop("_source")
            .withColumn("copies", copies.cast("long")))


def mix(docs: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), budget: float = 1.5,
        max_repeat: float = 2.0) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each row as often as it is taken.

    Null texts have no words; a null source is one source, the last; rows with the same id
    draw alike; an empty table gives an empty mix. Other columns pass through; columns
    named like this module's own are kept apart.
    """
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       "doc_id", "source", word_count().alias("size"))
    targets = source_targets(slim.select("source", "size"), weights, budget, max_repeat)
    taken = with_copies(slim, targets).where("copies > 0")
    taken = taken.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("_row.*")


def mix_report(docs: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), budget: float = 1.5,
               max_repeat: float = 2.0) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words the mix takes)."""
    sizes = stage(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    targets = source_targets(sizes, weights, budget, max_repeat)
    out = with_copies(sizes, targets)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 2.0 * CAST(source_size AS DOUBLE) AS cap,
         CAST([3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]
              AS DOUBLE) AS weight
  FROM s),
r AS (
  SELECT *, 1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_from
  FROM w),
-- with sources in order of cap / weight, those before the first whose cap holds are full
f AS (SELECT (total - cap_before) / weight_from AS share FROM r
      WHERE (total - cap_before) / weight_from * weight <= cap
      ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN cap < (SELECT share FROM f) * weight THEN cap
              ELSE (SELECT share FROM f) * weight END AS target
  FROM r),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
           / 4294967296.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""

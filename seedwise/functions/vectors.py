"""ML vectors from hot positions, without a Python UDF.

V5 turns a list of hot positions into a sparse vector with
``CountVectorizerModel.from_vocabulary(["0", …, "W-1"], binary=True)``: the
position strings are the vocabulary, so token ``"i"`` lands in slot ``i``. The
model is JVM-side; the vocabulary is W short strings (the feature width), not data.
Above ``VOCABULARY_MAX`` slots there is no vocabulary: the vector's own fields (type, size,
indices, values) are made from the set positions and parsed under the vector type's schema,
so the cost follows the set positions and not the width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwise.functions.columns import tokens_or_empty


#: Widest vector built by a vocabulary of position strings.
VOCABULARY_MAX = 100_000


def _from_fields(toks: Column, width: int) -> Column:
    """Binary sparse vector of the positions, from its fields."""
    indices = F.array_sort(F.array_distinct(F.transform(toks, lambda t: t.cast("int"))))
    fields = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"),
                      indices.alias("indices"),
                      F.transform(indices, lambda i: F.lit(1.0)).alias("values"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), schema)["v"]


def set_slots(vector: str | Column) -> Column:
    """The entries of a sparse vector as an array of (slot, value): its stored indices."""
    fields = F.unwrap_udt(vector)
    return F.arrays_zip(fields["indices"].alias("slot"), fields["values"].alias("value"))


def _checked(toks: Column, width: int) -> Column:
    """The tokens, or an error when one is no position in [0, width)."""
    def wrong(t: Column) -> Column:
        i = t.try_cast("int")
        return i.isNull() | (i < 0) | (i >= width)
    bad = F.filter(toks, wrong)
    return F.when(F.size(bad) > 0, F.raise_error(F.concat(
        F.lit("position "), F.get(bad, F.lit(0)), F.lit(f" outside the width {width}")))
        .cast("array<string>")).otherwise(toks)


def positions_to_vector(df: DataFrame, positions: str, width: int,
                        out: str = "features", slots: Sequence[int] | None = None) -> DataFrame:
    """``positions`` is a comma-delimited string ("1,5,9") or an array of
    ints/strings; NULL or empty gives an all-zero vector of size ``width``. A position
    outside [0, width) is an error when the row is computed.

    With ``slots`` the vector has one entry for each of these positions, in their order,
    and the other positions are left out (for slots that training rows never set).
    """
    dtype = dict(df.dtypes)[positions]
    if dtype == "string":
        toks = tokens_or_empty(positions)
    else:
        toks = F.coalesce(F.transform(F.col(positions), lambda x: x.cast("string")),
                          F.array().cast("array<string>"))
    if slots is None and width > VOCABULARY_MAX:
        return df.withColumn(out, _from_fields(_checked(toks, width), width))
    tmp = "_pos_tokens"
    model = CountVectorizerModel.from_vocabulary(
        [str(i) for i in (range(width) if slots is None else slots)], inputCol=tmp, outputCol=out, binary=True)
    return model.transform(df.withColumn(tmp, _checked(toks, width))).drop(tmp)


def with_binary_attrs(df: DataFrame, col: str, width: int) -> DataFrame:
    """V7: mark every slot of vector ``col`` as a 2-valued category, so tree
    learners split on ``in {0}`` / ``in {1}``, whatever the width."""
    if width <= 0:
        return df
    meta = {"ml_attr": {"attrs": {"binary": [{"idx": i, "name": f"f{i}"} for i in range(width)]},
                        "num_attrs": width}}
    return df.withColumn(col, F.col(col).alias(col, metadata=meta))


def dense_to_vector(col: str | Column) -> Column:
    """numeric array -> dense ML vector."""
    return array_to_vector(F.col(col) if isinstance(col, str) else col)

"""Category dictionaries and feature encoders.

Plan shape, independent of the number of feature columns:

1. ``long_values``: one narrow projection + one ``explode`` gives a long table
   ``(user, row key, pos, tpos, val, ord_l, ord_d, ord_s)``: a row per token of a
   multi-valued column and a row per single-valued column (NULL kept as a value).
   The row key is a hash of the row's values: rows of one id stay apart, and rows
   equal in everything are encoded once and joined back, so that every encoder
   gives one output row per input row, whatever the dictionary's size.
2. ``fit_encoding``: ``distinct`` (partial aggregation before the shuffle) and a
   distributed ordered numbering give the dictionary ``(pos, val, idx)``; index
   order is ascending by native value, NULL last. The per-column arity table has
   one row per column and is the only thing collected.
3. Encoders join the long table to the dictionary (broadcast when its checked
   size allows, salted otherwise) and aggregate per row. Columns that only ride
   along are attached once, after that. Hot positions are
   ``offset(column) + idx``; a dense one-hot array is never built.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwise.functions.columns import multi_hot, non_empty
from seedwise.operators.joins import lookup_join
from seedwise.operators.numbering import ordered_index
from seedwise.session import cut_lineage

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class Feature:
    name: str
    multi: bool


def _is_string_like(dt: T.DataType) -> bool:
    return isinstance(dt, T.StringType) or (
        isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StringType))


def _check_single(df: DataFrame, name: str) -> None:
    dt = df.schema[name].dataType
    ok = (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
          *_INTEGRAL, *_FRACTIONAL)
    if not isinstance(dt, ok):
        raise ValueError(f"single-valued column {name!r} has unsupported type {dt.simpleString()}")


def onehot_layout(df: DataFrame, columns: Sequence[str]) -> list[Feature]:
    """V3 rule: string (or array<string>) columns are multi-valued, numbers single."""
    out = []
    for c in columns:
        dt = df.schema[c].dataType
        if _is_string_like(dt):
            out.append(Feature(c, True))
        else:
            _check_single(df, c)
            out.append(Feature(c, False))
    return out


def categorical_layout(df: DataFrame, singles: Sequence[str], multis: Sequence[str]) -> list[Feature]:
    """J2 rule: explicit single and multi lists, singles first (dictionary order)."""
    for c in singles:
        _check_single(df, c)
    for c in multis:
        if not _is_string_like(df.schema[c].dataType):
            raise ValueError(f"multi-valued column {c!r} must be string or array<string>")
    return [Feature(c, False) for c in singles] + [Feature(c, True) for c in multis]


_ORDER = ("ord_l", "ord_d", "ord_s")
# A value is known by its text and its native order columns: two timestamps that share a
# local text at a clock change are two values.
_VALUE = ("pos", "val", *_ORDER)


def _native_order(df: DataFrame, name: str) -> tuple[Column, Column, Column]:
    """(ord_l, ord_d, ord_s): integers and times by a bigint, fractions by a double,
    decimals by a text of fixed width that sorts like the number."""
    dt = df.schema[name].dataType
    c = F.col(name)
    none = (F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string"))
    if isinstance(dt, _INTEGRAL):
        return c.cast("bigint"), none[1], none[2]
    if isinstance(dt, T.BooleanType):
        return c.cast("int").cast("bigint"), none[1], none[2]
    if isinstance(dt, T.DecimalType):
        digits = F.lpad(F.translate(c.cast("string"), "-", ""), 42, "0")
        falling = F.translate(digits, "0123456789", "9876543210")
        return none[0], none[1], F.when(c < 0, F.concat(F.lit("n"), falling)).otherwise(
            F.concat(F.lit("p"), digits))
    if isinstance(dt, _FRACTIONAL):
        return none[0], c.cast("double"), none[2]
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("bigint"), none[1], none[2]
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")), none[1], none[2]
    return none


def with_row_key(df: DataFrame, columns: Sequence[str], id_col: str) -> DataFrame:
    """Add ``_row``: a hash of the row's values (NULLs told apart)."""
    parts = [x for c in dict.fromkeys([id_col, *columns]) for x in (F.col(c), F.col(c).isNull())]
    return df.withColumn("_row", F.xxhash64(*parts))


def _tokens(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    arr = F.split(c, ",") if isinstance(df.schema[name].dataType, T.StringType) else c
    return F.coalesce(F.filter(arr, non_empty), F.array().cast("array<string>"))


def _token_entry(pos: int):
    def entry(t: Column, i: Column) -> Column:
        return F.struct(F.lit(pos).alias("pos"), i.alias("tpos"), t.alias("val"),
                        F.lit(None).cast("bigint").alias("ord_l"),
                        F.lit(None).cast("double").alias("ord_d"),
                        F.lit(None).cast("string").alias("ord_s"))
    return entry


def long_values(df: DataFrame, layout: Sequence[Feature], id_col: str = "user_id",
                keep: Sequence[str] = ()) -> DataFrame:
    """P11 + A3 input: ``(id, keep…, pos, tpos, val, ord_l, ord_d, ord_s)``.

    ``pos`` is the column's place in ``layout``, ``tpos`` the token's place in its
    string. A user with no entry at all keeps one row with NULL ``pos``.
    """
    if not layout:
        raise ValueError("no feature columns")
    parts = []
    for pos, f in enumerate(layout):
        if f.multi:
            parts.append(F.transform(_tokens(df, f.name), _token_entry(pos)))
        else:
            parts.append(F.array(F.struct(
                F.lit(pos).alias("pos"), F.lit(0).alias("tpos"),
                F.col(f.name).cast("string").alias("val"),
                *[o.alias(n) for o, n in zip(_native_order(df, f.name), _ORDER)])))
    entries = parts[0] if len(parts) == 1 else F.concat(*parts)
    return (df.select(id_col, *keep, F.explode_outer(entries).alias("_e"))
              .select(id_col, *keep, "_e.pos", "_e.tpos", "_e.val", *[f"_e.{o}" for o in _ORDER]))


@dataclass
class Encoding:
    """A fitted dictionary for a column layout."""
    layout: list[Feature]
    dictionary: DataFrame           # pos, col_name, val, ord_l, ord_d, ord_s, idx
    arity: list[int] = field(default_factory=list)
    size_bytes: int = 0

    @property
    def width(self) -> int:
        return sum(self.arity)

    def offsets(self, only_multi: bool = False) -> list[int]:
        """F8: start of each column's block (in layout order)."""
        out, run = [], 0
        for f, a in zip(self.layout, self.arity):
            out.append(run)
            if f.multi or not only_multi:
                run += a
        return out

    def multi_width(self) -> int:
        return sum(a for f, a in zip(self.layout, self.arity) if f.multi)

    def arity_frame(self) -> DataFrame:
        """A4: ``(position, col_name, arity)``, one row per column."""
        spark = self.dictionary.sparkSession
        rows = [(i, f.name, a) for i, (f, a) in enumerate(zip(self.layout, self.arity))]
        return spark.createDataFrame(rows, "position int, col_name string, arity long")


def fit_encoding(df: DataFrame, layout: Sequence[Feature], id_col: str = "user_id",
                 long_df: DataFrame | None = None) -> Encoding:
    """A2/A3 + W1: the dictionary of every column in one distributed job.

    The numbering is exact and deterministic (ascending native value, then the
    string, NULL last). The distinct values are counted per column first (the
    arity, one row per column), and that checked count picks the numbering
    path. The small dictionary is written to the checkpoint folder for the encoders.
    """
    layout = list(layout)
    long_df = long_df if long_df is not None else long_values(df, layout, id_col)
    values = (long_df.where(F.col("pos").isNotNull())
                     .select(*_VALUE).distinct()
                     .persist(StorageLevel.MEMORY_AND_DISK))
    # One row per column comes back: the arity, which also bounds the numbering, and the
    # bytes of the texts, which bound a broadcast.
    sizes = values.groupBy("pos").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("val")).alias("b")).collect()
    counts = {r["pos"]: int(r["n"]) for r in sizes}
    numbered = ordered_index(
        values, ["pos"],
        [F.col(c).asc_nulls_last() for c in (*_ORDER, "val")], idx_col="idx",
        max_rows=max(counts.values(), default=0))
    names = F.element_at(F.array(*[F.lit(f.name) for f in layout]), F.col("pos") + 1)
    dictionary = cut_lineage(numbered.withColumn("col_name", names).select(
        "col_name", *_VALUE, F.col("idx").cast("int").alias("idx")))
    values.unpersist()
    return Encoding(layout, dictionary, [counts.get(i, 0) for i in range(len(layout))],
                    size_bytes=sum(int(r["b"] or 0) + 64 * int(r["n"]) for r in sizes))


def _array_literal(values: Sequence, dtype: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{dtype}>")


def _known(idx: Column, val: Column, unseen: str) -> Column:
    """``idx``, or for a value the dictionary lacks an error (``unseen="raise"``) or NULL."""
    if unseen == "skip":
        return idx
    if unseen != "raise":
        raise ValueError(f"unseen must be 'raise' or 'skip', not {unseen!r}")
    said = F.concat(F.lit("value "), F.coalesce(val, F.lit("NULL")), F.lit(" is not in the dictionary"))
    return F.coalesce(idx, F.raise_error(said).cast("int"))


def indexed_long(df: DataFrame, enc: Encoding, id_col: str = "user_id",
                 keep: Sequence[str] = (), long_df: DataFrame | None = None,
                 unseen: str = "skip") -> DataFrame:
    """The long table with each value's dictionary index ``idx``."""
    if long_df is None:
        long_df = long_values(df, enc.layout, id_col, keep)
    j = lookup_join(long_df, enc.dictionary.select(*_VALUE, "idx"), list(_VALUE),
                    small_rows=enc.width, how="left", null_safe=["val", *_ORDER],
                    salt_from=[c for c in long_df.columns if c not in _VALUE], small_bytes=enc.size_bytes or None)
    return j.withColumn("idx", F.when(F.col("pos").isNotNull(),
                                      _known(F.col("idx"), F.col("val"), unseen)))


def _back_to_rows(df: DataFrame, per_row: DataFrame, id_col: str, keep: Sequence[str]) -> DataFrame:
    """One output row per row of ``df``: ``per_row`` has one row per (id, ``_row``)."""
    own = df.select(id_col, "_row", *[k for k in keep if k != id_col])
    r = per_row.withColumnRenamed(id_col, "_rid").withColumnRenamed("_row", "_rrow")
    return own.join(r, (own["_row"] == r["_rrow"]) & own[id_col].eqNullSafe(r["_rid"]))


# Largest per-column dictionary compiled into literal maps (map look-ups on
# literals are linear scans, so only small domains are inlined).
INLINE_MAX_ARITY = 64
# Largest whole dictionary inlined, so the projection and its generated code stay small.
INLINE_MAX_WIDTH = 4096


def inline_ok(enc: Encoding) -> bool:
    """Every column's domain, and the dictionary as a whole, is small enough to
    encode in one projection."""
    return (bool(enc.arity) and max(enc.arity) <= INLINE_MAX_ARITY
            and enc.width <= INLINE_MAX_WIDTH)


def _inline_indices(df: DataFrame, enc: Encoding, unseen: str) -> list[Column] | None:
    """Per column, the ``array<int>`` of dictionary indices of the row's values,
    from literal maps (the collected dictionary has at most
    ``INLINE_MAX_ARITY`` entries per column). None when a text alone does not
    name a value (timestamps at a clock change)."""
    maps: list[dict[str, int]] = [dict() for _ in enc.layout]
    nulls: list[int | None] = [None] * len(enc.layout)
    for r in enc.dictionary.select("pos", "val", "idx").collect():
        if r["val"] is None:
            nulls[r["pos"]] = int(r["idx"])
        elif r["val"] in maps[r["pos"]]:
            return None
        else:
            maps[r["pos"]][r["val"]] = int(r["idx"])
    out = []
    empty = F.array().cast("array<int>")
    for p, f in enumerate(enc.layout):
        m = (F.create_map(*[x for v, i in sorted(maps[p].items()) for x in (F.lit(v), F.lit(i))])
             if maps[p] else None)
        if f.multi:
            idx = F.transform(_tokens(df, f.name), _lookup(m, unseen))
        else:
            c = F.col(f.name)
            known = F.try_element_at(m, c.cast("string")) if m is not None else F.lit(None)
            one = F.when(c.isNull(), F.lit(nulls[p])).otherwise(known).cast("int")
            idx = F.array(_known(one, c.cast("string"), unseen))
        out.append(F.coalesce(F.filter(idx, lambda x: x.isNotNull()), empty))
    return out


def _lookup(m: Column | None, unseen: str):
    def get(t: Column) -> Column:
        found = F.try_element_at(m, t) if m is not None else F.lit(None)
        return _known(found.cast("int"), t, unseen)
    return get


def _plus(offset: int):
    def add(i: Column) -> Column:
        return i + F.lit(offset)
    return add


def _shifted(arrays: list[Column], offsets: list[int], which: list[int]) -> Column:
    parts = [F.transform(arrays[p], _plus(offsets[p])) for p in which]
    if not parts:
        return F.array().cast("array<int>")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _inline(df: DataFrame, enc: Encoding, inline: bool | None, unseen: str) -> list[Column] | None:
    if inline if inline is not None else inline_ok(enc):
        return _inline_indices(df, enc, unseen)
    return None


def onehot_features(df: DataFrame, enc: Encoding, id_col: str = "user_id",
                    keep: Sequence[str] = ("cycle", "reader"), inline: bool | None = None,
                    unseen: str = "raise") -> DataFrame:
    """``(id, feature_size, feature "i,j,k", keep…)``; positions ascending, one
    output row per input row. A value that the dictionary lacks is an error unless
    ``unseen="skip"``.

    Small domains (``inline_ok``): one projection over the profile, no shuffle.
    Otherwise the long table joins the dictionary and one aggregate per row follows.
    """
    size = F.lit(enc.width).cast("int").alias("feature_size")
    arrays = _inline(df, enc, inline, unseen)
    if arrays is not None:
        hot = F.array_sort(F.array_distinct(_shifted(arrays, enc.offsets(),
                                                     list(range(len(enc.layout))))))
        return df.select(id_col, size, F.array_join(hot, ",").alias("feature"), *keep)
    keyed = with_row_key(df, [f.name for f in enc.layout], id_col)
    j = indexed_long(keyed, enc, id_col, ["_row"], unseen=unseen)
    offs = _array_literal(enc.offsets(), "int")
    hot = F.element_at(offs, F.col("pos") + 1) + F.col("idx")
    agg = j.groupBy(id_col, "_row").agg(F.array_sort(F.collect_set(hot)).alias("_hot"))
    return _back_to_rows(keyed, agg, id_col, keep).select(
        id_col, size, F.array_join("_hot", ",").alias("feature"), *keep)


def categorical_features(df: DataFrame, enc: Encoding, id_col: str = "user_id",
                         keep: Sequence[str] = ("cycle", "reader"), inline: bool | None = None,
                         unseen: str = "raise") -> DataFrame:
    """``feature`` = every multi slot as ``2:0``/``2:1`` (multi columns in
    order), then each single column as ``arity:index``; one output row per input row.
    Small domains are encoded in one projection, larger ones through the dictionary
    join. Values that the dictionary lacks as in :func:`onehot_features`."""
    wm = enc.multi_width()
    arrays = _inline(df, enc, inline, unseen)
    if arrays is not None:
        multis = [p for p, f in enumerate(enc.layout) if f.multi]
        mh = _shifted(arrays, enc.offsets(only_multi=True), multis)
        multi_part = F.transform(multi_hot(mh, wm), lambda x: F.concat(F.lit("2:"), x.cast("string")))
        single_parts = [F.concat(F.lit(f"{enc.arity[p]}:"), F.try_element_at(arrays[p], F.lit(1)).cast("string"))
                        for p, f in enumerate(enc.layout) if not f.multi]
        return df.select(id_col, F.concat_ws(",", multi_part, *single_parts).alias("feature"), *keep)
    keyed = with_row_key(df, [f.name for f in enc.layout], id_col)
    j = indexed_long(keyed, enc, id_col, ["_row"], unseen=unseen)
    is_multi = _array_literal([f.multi for f in enc.layout], "boolean")
    moffs = _array_literal(enc.offsets(only_multi=True), "int")
    pos1 = F.col("pos") + 1
    slot = F.when(F.element_at(is_multi, pos1), F.element_at(moffs, pos1) + F.col("idx"))
    singles = [(p, f) for p, f in enumerate(enc.layout) if not f.multi]
    aggs = [F.collect_set(slot).alias("_mh")]
    aggs += [F.max(F.when(F.col("pos") == p, F.col("idx"))).alias(f"_s{p}") for p, _ in singles]
    agg = j.groupBy(id_col, "_row").agg(*aggs)
    multi_part = F.transform(multi_hot("_mh", wm), lambda x: F.concat(F.lit("2:"), x.cast("string")))
    single_parts = [F.concat(F.lit(f"{enc.arity[p]}:"), F.col(f"_s{p}").cast("string"))
                    for p, _ in singles]
    return _back_to_rows(keyed, agg, id_col, keep).select(
        id_col, F.concat_ws(",", multi_part, *single_parts).alias("feature"), *keep)


def index_single(df: DataFrame, col: str, key_cols: Sequence[str],
                 enc: Encoding | None = None, unseen: str = "raise") -> tuple[DataFrame, Encoding]:
    """V1: replace a single-valued column by its category index (``idx int``), row by row."""
    _check_single(df, col)
    enc = enc or fit_encoding(df, [Feature(col, False)], id_col=key_cols[0])
    j = indexed_long(df, enc, key_cols[0], keep=list(key_cols[1:]), unseen=unseen)
    return j.select(*key_cols, "idx"), enc


def multi_index(df: DataFrame, enc: Encoding, col: str, id_col: str = "user_id",
                sort: bool = True, unseen: str = "raise") -> DataFrame:
    """V2: per row, the indices of one multi-valued column. ``sort`` gives the
    ascending list (J2); otherwise token order with repeats (J1).
    Output ``(id, idx array<int>)``; no tokens -> empty array."""
    p = [f.name for f in enc.layout].index(col)
    keyed = with_row_key(df, [f.name for f in enc.layout], id_col)
    j = indexed_long(keyed, enc, id_col, ["_row"], unseen=unseen)
    # rows equal in everything fall into one group: their entries are equal too
    entry = F.when(F.col("pos") == p, F.struct(F.col("tpos"), F.col("idx")))
    agg = j.groupBy(id_col, "_row").agg(F.array_sort(F.collect_set(entry)).alias("_e"))
    idx = F.transform("_e", lambda e: e["idx"])
    if sort:
        idx = F.array_sort(F.array_distinct(idx))
    return _back_to_rows(keyed, agg, id_col, ()).select(id_col, idx.alias("idx"))


def dictionary_frame(enc: Encoding) -> DataFrame:
    """W1 output: ``(col_name, value, idx)``."""
    return enc.dictionary.select("col_name", F.col("val").alias("value"), "idx")


def unpivot(df: DataFrame, columns: Sequence[str], id_col: str = "user_id") -> DataFrame:
    """``(id, position, col_name, value)``, one row per chosen column, values
    as text (NULL kept)."""
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("col_name"),
                                 F.col(c).cast("string").alias("value"))
                        for i, c in enumerate(columns)])
    return df.select(id_col, F.explode(entries).alias("_e")).select(id_col, "_e.*")


def arity_table(enc: Encoding) -> DataFrame:
    """A4 from the dictionary itself: ``(pos, col_name, arity)``, one row per column."""
    return enc.dictionary.groupBy("pos", "col_name").agg(F.count(F.lit(1)).alias("arity"))


def block_offsets(enc: Encoding) -> DataFrame:
    """F8: ``(col_name, offset)``; the running sum runs over one row per column."""
    from pyspark.sql import Window
    w = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return arity_table(enc).select(
        "col_name", F.coalesce(F.sum("arity").over(w), F.lit(0)).cast("bigint").alias("offset"))


def onehot_index(df: DataFrame, enc: Encoding, id_col: str = "user_id",
                 unseen: str = "raise") -> DataFrame:
    """V3 index step: ``(id, col_name, idx)`` with the indices of a column's values
    in token order, repeats kept, joined by commas (columns with no value: no row)."""
    keyed = with_row_key(df, [f.name for f in enc.layout], id_col)
    j = indexed_long(keyed, enc, id_col, ["_row"], unseen=unseen).where(F.col("pos").isNotNull())
    names = F.element_at(F.array(*[F.lit(f.name) for f in enc.layout]), F.col("pos") + 1)
    agg = j.groupBy(id_col, "_row", "pos").agg(
        F.array_sort(F.collect_set(F.struct("tpos", "idx"))).alias("_e"))
    return _back_to_rows(keyed, agg, id_col, ()).select(
        id_col, names.alias("col_name"),
        F.array_join(F.transform("_e", lambda e: e["idx"]), ",").alias("idx"))


def unseen_values(df: DataFrame, enc: Encoding, id_col: str = "user_id") -> DataFrame:
    """Values of ``df`` that a given dictionary does not know: ``(col_name, value)``.

    The encoders raise on such values, or with ``unseen="skip"`` give them no index
    (no hot position or ``arity:index`` entry).
    """
    j = indexed_long(df, enc, id_col).where(F.col("pos").isNotNull() & F.col("idx").isNull())
    names = F.element_at(F.array(*[F.lit(f.name) for f in enc.layout]), F.col("pos") + 1)
    return j.select(names.alias("col_name"), F.col("val").alias("value")).distinct()


def require_known(df: DataFrame, enc: Encoding, id_col: str = "user_id") -> None:
    """Raise ``ValueError`` when ``df`` holds a value the dictionary lacks (one job;
    it stops at the first unseen value found)."""
    first = unseen_values(df, enc, id_col).limit(1).collect()
    if first:
        raise ValueError(f"value {first[0]['value']!r} of column {first[0]['col_name']!r} "
                         "is not in the dictionary")

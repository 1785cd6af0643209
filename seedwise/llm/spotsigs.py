"""Document fingerprints by SpotSigs, with DataFrame functions only.

Method: an anchor is a very common word of the languages at hand. The chain of the next
``CHAIN`` content words (words that are no anchor) behind an anchor, together with it,
is one spot signature; a fingerprint is the set of a text's signatures, as 32-bit hashes
in ascending order, written as 8 hex digits each. Content between anchors that changes
removes a few signatures only; boilerplate, poor in anchors, adds few.

Comparison: Jaccard similarity of two sets, pruned by their sizes (it is at most the
smaller size over the larger one). Near pairs are searched among distinct fingerprints,
partitioned by set length: sets at or above the threshold lie in one length band or in
neighbouring ones, and share one of their rarest signatures.

At scale: signatures are array functions on the row, nothing is exploded for them. The
next document by id is found by numbering slim rows (id, key, length) in ranges and joining
each number to the next; a text then sends its head and its signatures to the row before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwise.llm.common import stage, text_or_empty
from seedwise.llm.components import components
from seedwise.operators.numbering import ordered_index

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auf das dem den der des die ein eine für im ist mit nicht sie sich und von zu "
    "au avec ce dans de du elle en est et il la le les par pas pour que qui sur un une "
    "al como con del el es esta lo los las más no para por se su una y"
).split()
CHAIN = 2
#: A content word without an anchor in so many words behind it stands for itself.
REACH = 8
SPLIT = r"[\x20\x09-\x0D]+"
EDGE_SIGNS = ".,;:!?()\"'|#*$%&<>"


def _tokens(text: Column) -> Column:
    spaced = F.translate(F.lower(text), EDGE_SIGNS, " " * len(EDGE_SIGNS))
    return F.filter(F.split(spaced, SPLIT), lambda w: w != "")


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once and not at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spots(tokens: Column) -> Column:
    marked = F.transform(tokens, lambda w, i: F.struct(w.alias("w"), i.alias("i"),
                                                       w.isin(ANCHORS).alias("anchor")))

    def signatures(anchors: Column, content: Column) -> Column:
        # the j-th anchor, at position i, has i - j content words before it; the c-th
        # content word, at position i, has i - c anchors before it
        chains = F.transform(anchors, lambda s, j: F.when(
            s["i"] - j + CHAIN <= F.size(content),
            F.hash(s["w"], *[F.get(content, s["i"] - j + k)["w"] for k in range(CHAIN)])))
        alone = F.transform(content, lambda s, c: F.when(
            F.coalesce(F.get(anchors, s["i"] - c)["i"] > s["i"] + REACH, F.lit(True)),
            F.hash(s["w"])))
        return F.array_compact(F.concat(chains, alone))

    found = _bound(marked, lambda m: _bound(
        F.filter(m, lambda s: s["anchor"]), lambda anchors: _bound(
            F.filter(m, lambda s: ~s["anchor"]), lambda content: signatures(anchors, content))))
    return _bound(found, lambda f: F.when(F.size(f) > 0, f).otherwise(
        F.transform(tokens, lambda w: F.hash(w))))


def signature_set(text: Column) -> Column:
    """Sorted distinct signature hashes of a text. An anchor's chain is searched to the end of
    the text. A content word with no anchor among the ``REACH`` words behind it stands for
    itself, so tables and lists without common words have signatures too; where a whole text
    yields none, each of its words does. Only a text without words has the empty set."""
    return F.sort_array(F.array_distinct(_bound(_tokens(text), _spots)))


def as_string(signatures: Column) -> Column:
    digits = F.transform(signatures, lambda s: F.lpad(F.lower(F.hex(s.cast("long").bitwiseAND(
        F.lit(0xFFFFFFFF)))), 8, "0"))
    return F.array_join(digits, "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two sorted sets, 1 for two empty ones; 0 without intersecting
    them where their sizes alone keep it below ``at_least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    exact = common / (F.size(a) + F.size(b) - common)
    return (F.when(large == 0, 1.0).when((small == 0) | (small < F.lit(at_least) * large), 0.0)
            .otherwise(exact))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, signatures, fingerprint)."""
    return docs.select(id_col, signature_set(text_or_empty(text_col)).alias("signatures")) \
        .withColumn("fingerprint", as_string("signatures"))


# ------------------------------------------------------------------ near pairs
def near_classes(prints: DataFrame, id_col: str = "doc_id", threshold: float = 0.8) -> DataFrame:
    """Per row of :func:`fingerprints`: id, class_id (smallest id reachable over pairs of
    at least ``threshold`` Jaccard similarity) and links, the number of other distinct
    fingerprints at or above it.

    Equal fingerprints are one class from the start. Empty sets pair with empty sets only.
    Candidates share a length band and one of the rarest signatures that a pair at the
    threshold must share; each candidate is verified exactly.
    """
    sets = prints.groupBy("fingerprint").agg(F.min(id_col).alias("_least"),
                                             F.first("signatures").alias("signatures"))
    sets = stage(sets.withColumn("node", F.xxhash64("fingerprint")), "spot-sets")
    n = F.size("signatures")
    # lengths l and m with l / m >= threshold are at most one band apart
    band = F.floor(F.log(n.cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")
    filled = sets.where(n > 0)
    spots = filled.select("node", n.alias("n"), band.alias("band"),
                          F.explode("signatures").alias("s"))
    often = spots.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "s"))
    prefix = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    rare = stage(spots.join(often, "s").withColumn("r", rank).where(F.col("r") <= prefix)
                 .select("node", "n", "band", "s"), "spot-prefixes")
    right = rare.select(F.col("node").alias("v"), F.col("n").alias("m"), "s",
                        F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    pairs = (rare.join(right, ["s", "band"])
             .where("(m < n or (m = n and v < node))").where(F.col("m") >= threshold * F.col("n"))
             .select(F.col("node").alias("u"), "v").distinct())
    a = filled.select(F.col("node").alias("u"), F.col("signatures").alias("a"))
    b = filled.select(F.col("node").alias("v"), F.col("signatures").alias("b"))
    near = stage(pairs.join(a, "u").join(b, "v")
                 .where(likeness(F.col("a"), F.col("b"), threshold) >= threshold)
                 .select("u", "v"), "spot-links")
    links = near.select(F.col("u").alias("_n")).union(near.select(F.col("v").alias("_n"))) \
        .groupBy("_n").agg(F.count(F.lit(1)).alias("links"))
    roots = components(near).withColumnRenamed("node", "_node")
    rooted = sets.join(roots, sets["node"] == roots["_node"], "left").join(
        links, sets["node"] == links["_n"], "left").select(
        "fingerprint", "_least", F.coalesce("root", "node").alias("root"),
        F.coalesce("links", F.lit(0)).alias("links"))
    least = rooted.groupBy("root").agg(F.min("_least").alias("class_id"))
    out = rooted.join(least, "root").select("fingerprint", "class_id", "links")
    return prints.select(id_col, "fingerprint").join(out, "fingerprint") \
        .select(id_col, "class_id", "links")


# ------------------------------------------------------------------ edited texts
def _key(id_col: Column, text: Column) -> Column:
    """16 bytes that name a row by its id and text; rows equal in both share them."""
    name = id_col.cast("string")
    marked = F.coalesce(F.concat(F.char_length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    return F.unhex(F.md5(F.concat(marked, text)))


def _successions(base: DataFrame, rows_per_range: int | None) -> DataFrame:
    """(_key, _id, _copies, _prev, _need) of each distinct row: the key of the row before it
    (of the last one for the first) and how many code points that row takes from it."""
    slim = stage(base.groupBy("_key").agg(
        F.min("_id").alias("_id"), F.max(F.char_length("_text")).alias("_n"),
        F.count(F.lit(1)).alias("_copies")), "spot-keys")
    order = [F.col("_id").asc_nulls_first()]
    shared = slim.groupBy("_id").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1") \
        .select(F.col("_id").alias("_shared"))
    if not shared.isEmpty():                # only rows that share an id are told by their texts
        ties = base.join(shared, F.col("_id").eqNullSafe(F.col("_shared"))) \
            .groupBy("_key").agg(F.first("_text").alias("_tie"))
        slim = slim.join(ties, "_key", "left")
        order.append(F.col("_tie").asc_nulls_first())
    n = slim.count()
    ranges = None if rows_per_range is None else max(1, math.ceil(n / rows_per_range))
    at = ordered_index(slim, [], order, "_at", buckets=ranges).select(
        "_key", "_id", "_n", "_copies", "_at")
    before = at.select(((F.col("_at") + 1) % max(1, n)).alias("_at"), F.col("_key").alias("_prev"),
                       F.floor(F.col("_n") / 4).cast("int").alias("_need"))
    return stage(at.join(before, "_at").drop("_at", "_n"), "spot-order")


def _times(df: DataFrame, n: str, block: int = 1 << 16) -> DataFrame:
    """Each row ``n`` times, by blocks, so that no array is longer than ``block``."""
    last = F.floor((F.col(n) - 1) / block)
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(F.lit(block), F.col(n) - F.col("_block") * block)
    return blocks.withColumn("_one", F.explode(F.sequence(F.lit(1).cast("long"), size))) \
        .drop("_block", "_one")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    rows_per_range: int | None = None) -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_signatures. The edited text has its last floor(n_chars / 4) code points replaced by the
    first as many (or all) of the next document in ascending id order, after the last the
    first.

    Ids are of any type with an order. Null texts are empty; an empty text has the empty
    fingerprint, like to itself only. Null ids come first and rows of one id are ordered by
    text; of rows equal in id and text all but the last are followed by their own text; a
    single row is its own next; an empty table gives no rows; other columns are not read.

    The order is found on slim rows (id, 16-byte key, length), numbered in ranges of
    ``rows_per_range`` rows (default: as many ranges as the session has shuffle partitions).
    Texts are shuffled once, by key; each then sends what the row before it needs of it.
    """
    base = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    base = base.withColumn("_key", _key(F.col("_id"), F.col("_text")))
    order = _successions(base, rows_per_range)
    texts = base.groupBy("_key").agg(F.first("_text").alias("_text"))
    rows = texts.join(order, "_key")
    given = rows.select(F.col("_prev").alias("_key"),
                        F.substring("_text", F.lit(1), F.col("_need")).alias("_head"),
                        signature_set(F.col("_text")).alias("_next_set"))
    n = F.char_length("_text")
    cut = F.floor(n / 4).cast("int")
    both = texts.join(order.select("_key", "_id", "_copies"), "_key").join(given, "_key") \
        .withColumn("_set", signature_set(F.col("_text"))) \
        .withColumn("_own", F.explode(F.when(F.col("_copies") > 1, F.array(F.lit(False), F.lit(True)))
                                      .otherwise(F.array(F.lit(False)))))
    head = F.when(F.col("_own"), F.substring("_text", F.lit(1), cut)).otherwise(F.col("_head"))
    out = both.withColumn("_edited", F.concat(F.substring("_text", F.lit(1), n - cut), head))
    out = out.withColumn("_edited_set", signature_set(F.col("_edited")))
    following = F.when(F.col("_own"), F.col("_set")).otherwise(F.col("_next_set"))
    out = out.select(
        F.col("_id").alias(id_col), n.cast("long").alias("n_chars"),
        F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        as_string("_set").alias("fingerprint"), as_string("_edited_set").alias("edited_fingerprint"),
        likeness(F.col("_set"), F.col("_edited_set")).alias("near_edited"),
        likeness(F.col("_set"), following).alias("near_next"),
        F.size("_set").alias("n_signatures"),
        F.when(F.col("_own"), F.col("_copies") - 1).otherwise(F.lit(1)).alias("_rows"))
    return _times(out, "_rows").drop("_rows")

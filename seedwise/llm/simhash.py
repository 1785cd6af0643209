"""SimHash near-duplicates through covering locality-sensitive hashing.

Fingerprint: 64 bits, each set when more than half of the text's shingle hashes have it.

Method (covering LSH): every bit position gets a non-zero vector of r + 1 bits. For each
of the 2^(r+1) - 1 non-zero vectors v there is a table whose mask keeps the positions
with an odd inner product with v. The at most r positions where two fingerprints differ
span at most r dimensions, so some v is orthogonal to all of them and that mask hides
every difference: each pair within r bits shares a bucket in some table, with certainty.

At scale: documents are first reduced to distinct fingerprints (pre-aggregated); only
buckets with at least two of them go on. Buckets of up to ``BUCKET`` fingerprints are
compared inside one array, in blocks, and give a spanning set of links, never all pairs.
Fuller buckets take an exact way whose work per fingerprint is fixed: two fingerprints
within 3 bits always meet at a point at most 1 bit from one and 2 from the other, so
each is sent to the points around it within the bits that its mask hides, and linked
there to the smallest fingerprint at most 1 bit away. Links become components by
alternating stars. No document list is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwise.llm.common import stage, text_or_empty, tidy, utf8_column
from seedwise.llm.components import components

SHINGLE = 3
RADIUS = 3
#: Largest bucket compared as one array.
BUCKET = 2048


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; A-Z are read as a-z. Texts of fewer words
    than a shingle are one shingle; a text without words has fingerprint zero."""
    import numpy as np
    import xxhash
    tokens = raw.lower().split()
    if not tokens:
        return 0
    if len(tokens) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(tokens), 42)
    digest = xxhash.xxh64_digest
    total = len(tokens) - shingle + 1
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, total, 32768):          # bounded memory for very long texts
        part = tokens[at:at + 32768 + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        block = b"".join([digest(g, 42) for g in grams])
        bits = np.unpackbits(np.frombuffer(block, dtype=np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, h, fp): a hash of the text, and the fingerprint as a signed long. A null text is
    one without words."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            fps = [fingerprint(raw, shingle) for raw in utf8_column(batch, "_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([f - ((f >> 63) << 64) for f in fps], pa.int64())],
                names=["_id", "h", "fp"])

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("h"), text.alias("_text"))
    return rows.mapInArrow(tidy(run), f"_id {id_type}, h long, fp long").withColumnRenamed("_id", id_col)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One signed 64-bit mask per table; positions take the vectors 1 .. 2^(r+1) - 1 in turn."""
    size = (1 << (radius + 1)) - 1
    vectors = [i % size + 1 for i in range(64)]
    masks = [sum(1 << i for i, p in enumerate(vectors) if (p & v).bit_count() % 2)
             for v in range(1, size + 1)]
    return [m - ((m >> 63) << 64) for m in masks]


def _near_in_bucket(fps, radius: int):
    """Links (larger, smaller) that join the fingerprints of one bucket as all pairs within
    ``radius`` would: each is linked to one member of every component met before."""
    import numpy as np
    own = np.sort(np.asarray(fps, dtype=np.int64)).view(np.uint64)
    label = np.arange(len(own))
    links = []
    for i in range(1, len(own)):
        near = np.flatnonzero(np.bitwise_count(own[:i] ^ own[i]) <= radius)
        if not len(near):
            continue
        roots, first = np.unique(label[near], return_index=True)
        links.extend((int(own[i].view(np.int64)), int(own[j].view(np.int64))) for j in near[first])
        label[:i][np.isin(label[:i], roots)] = roots[0]
        label[i] = roots[0]
    return links


def _small_bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            links = {p for fps in batch.column(0).to_pylist() for p in _near_in_bucket(fps, radius)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in links], pa.int64()),
                 pa.array([p[1] for p in links], pa.int64())], names=["u", "v"])

    return buckets.select("fps").mapInArrow(tidy(run), "u long, v long")


def _full_bucket_links(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links of fingerprints in full buckets (columns fp, t), over meeting points."""
    import itertools
    near, far = radius // 2, radius - radius // 2
    flips = []
    for mask in masks:
        hidden = [b - ((b >> 63) << 64) for b in (1 << i for i in range(64)) if not (mask & b)]
        own = []
        for k in range(far + 1):
            for combo in itertools.combinations(hidden, k):
                x = 0
                for b in combo:
                    x ^= b
                own.append((x, k <= near))
        flips.append(own)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        tables = [(np.array([x for x, _ in f], dtype=np.int64), np.array([n for _, n in f]))
                  for f in flips]
        for batch in batches:
            for fp, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, close = tables[t]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x ^ np.int64(fp)), pa.array(np.full(len(x), fp)), pa.array(close)],
                    names=["point", "fp", "close"])

    points = rows.select("fp", "t").mapInArrow(tidy(run), "point long, fp long, close boolean")
    hub = points.where("close").groupBy("point").agg(F.min("fp").alias("hub"))
    return (points.select("point", "fp").join(hub, "point").where("fp != hub")
            .select(F.greatest("fp", "hub").alias("u"), F.least("fp", "hub").alias("v")).distinct())


def near_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that connect exactly what all
    pairs within ``radius`` bits connect."""
    masks = covering_masks(radius)
    keyed = fps.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(keyed.join(sizes, ["t", "key"]), "buckets")
    small = shared.where(F.col("n") <= bucket).groupBy("t", "key").agg(
        F.collect_list("fp").alias("fps"))
    links = _small_bucket_links(small, radius)
    full = shared.where(F.col("n") > bucket)
    if not full.isEmpty():
        links = links.union(_full_bucket_links(full, masks, radius))
    return links.distinct()


def _classes(rows: DataFrame, radius: int, bucket: int) -> DataFrame:
    """(_fp, _root): the component of every distinct fingerprint of ``rows``."""
    known = stage(rows.select("fp").distinct(), "distinct-fingerprints")
    nodes = components(near_links(known, radius, bucket))
    return known.join(nodes, known["fp"] == nodes["node"], "left") \
        .select(F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("_root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits) and component_id, the smallest id that is
    reachable over links of at most ``radius`` differing bits.

    Null and wordless texts share fingerprint zero; rows with one id are kept apart, and a
    null id gets the component of its fingerprint (null if no other id is in it); an empty
    table gives no rows; other columns are not read.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stage(_classes(rows, radius, bucket), "classes")
    per_print = rows.groupBy("fp").agg(F.min(id_col).alias("_least"))
    least = per_print.join(classes, per_print["fp"] == classes["_fp"]) \
        .groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = classes.join(least, "_root").select("_fp", "component_id")
    return (rows.join(named, rows["fp"] == named["_fp"])
            .select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    "component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component, that of the smallest id (null ids last, then
    the smallest text hash), with the columns of ``docs``."""
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stage(_classes(rows, radius, BUCKET), "classes")
    first = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "h")
    per_print = rows.groupBy("fp").agg(F.min(first).alias("one"))
    kept = per_print.join(classes, per_print["fp"] == classes["_fp"]) \
        .groupBy("_root").agg(F.min("one").alias("one")).select("one.id", "one.h")
    kept = stage(kept, "kept")
    copies = rows.groupBy(F.col(id_col).alias("_i"), F.col("h").alias("_h")) \
        .agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(id_col).alias("_id"), F.xxhash64(text_or_empty(text_col)).alias("_th"))
    held = held.join(kept, held["_id"].eqNullSafe(kept["id"]) & (held["_th"] == kept["h"]), "left_semi")
    if copies.isEmpty():
        return held.select("_row.*")
    # rows that agree in id and text: any one of them stays
    twice = stage(copies, "repeated-rows")
    same = held["_id"].eqNullSafe(twice["_i"]) & (held["_th"] == twice["_h"])
    once = held.join(twice, same, "left_anti")
    return once.unionByName(held.join(twice, same, "left_semi").dropDuplicates(["_id", "_th"])) \
        .select("_row.*")

"""Line dedup across documents: sorted hashes, first occurrences, keep bitmaps.

Method: the key of every line that is long enough becomes a 128-bit hash. The entries
(hash, document, position) are range-partitioned and sorted by hash, document descending
and position; one stream over each sorted partition meets the occurrence to keep first
(the largest document) and, once a hash has been met in enough documents, names every
later entry as dropped. The result is one compressed keep bitmap per document; texts are
cut from their bitmaps only where a caller asks for them.

The ranges are cut on (hash, document, position), so a line that a third of all documents
share is spread over many partitions. A partition decides alone on the hashes that lie
wholly inside it. Its first and last hash may go on in its neighbours: their entries come
out undecided, with one summary row per partition and hash, and the summaries (two rows
per partition at most) settle them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwise.llm.common import shuffle_partitions, stage, text_or_empty, tidy, utf8_column

_STRIP = b" \t\n\v\f\r"


@dataclass(frozen=True)
class LineDedup:
    """Keys of at least ``min_chars`` code points in at least ``min_documents`` documents lose
    their lines outside the largest document."""
    min_chars: int = 40
    min_documents: int = 5


#: About so many entries go to one sorted partition; the session's count is the least.
ENTRIES_PER_TASK = 4_000_000


def line_key(line: bytes) -> bytes:
    """The line without space and \\t to \\r at both ends, A-Z in lower case."""
    return line.strip(_STRIP).lower()


def long_enough(key: bytes, chars: int) -> bool:
    return len(key) >= chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= chars)


def content_key(id_col: str, text_col: str) -> Column:
    """128 bits that name a row by its id and text: rows alike in both are decided alike."""
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    tag = F.when(F.col(id_col).isNull(), F.lit("-")).otherwise(F.length(own).cast("string"))
    return F.unhex(F.md5(F.concat(tag, F.lit(":"), own, text_or_empty(text_col)).cast("binary")))


def line_entries(docs: DataFrame, rule: LineDedup = LineDedup(), id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document with a line that counts: _doc (content key), doc_id, lines
    array<struct<h1, h2: long, pos: int>> (128-bit hash of the key, line number)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash
        for batch in batches:
            digests, at, ends = [], [], [0]
            for raw in utf8_column(batch, "_text"):
                if len(raw) >= rule.min_chars:
                    for i, line in enumerate(raw.split(b"\n")):
                        if len(line) >= rule.min_chars:
                            key = line_key(line)
                            if long_enough(key, rule.min_chars):
                                digests.append(xxhash.xxh3_128_digest(key))
                                at.append(i)
                ends.append(len(at))
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            entry = pa.StructArray.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(at, pa.int32())],
                names=["h1", "h2", "pos"])
            lines = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entry)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lines],
                                             names=["_doc", "doc_id", "lines"])
            yield out.filter(pa.array(np.diff(ends) > 0))

    rows = docs.select(content_key(id_col, text_col).alias("_doc"), F.col(id_col).alias("_id"),
                       text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(tidy(run), f"_doc binary, doc_id {id_type}, "
                                      "lines array<struct<h1: long, h2: long, pos: int>>")


def _changes(columns):
    """Per row of a sorted table: is it unlike the row before it in one of the columns? (The
    first row is.) Nulls are alike."""
    import numpy as np
    import pyarrow.compute as pc
    n = len(columns[0])
    out = np.zeros(n, dtype=bool)
    out[:1] = True
    for c in columns:
        here, before = c.slice(1), c.slice(0, max(n - 1, 0))
        unlike = pc.fill_null(pc.not_equal(here, before), False).to_numpy(zero_copy_only=False)
        null = c.is_null().to_numpy(zero_copy_only=False)
        out[1:] |= unlike.astype(bool) | (null[1:] != null[:-1])
    return out


class _Stream:
    """First occurrences along one sorted partition.

    Of the open hash (the one the rows read so far end in) it knows the documents met, the
    first and the last of them. Its entries are held back until it is frequent: those of
    ``least - 1`` documents at most. Entries of the partition's first hash, and of a last one
    that is not frequent by then, pass undecided.
    """

    def __init__(self, least: int):
        self.least = least
        self.open: dict | None = None         # hash, n_docs, first_doc, last_doc
        self.is_first = True                  # the open hash is the partition's first
        self.first: dict | None = None        # the first hash, when it is over
        self.held = None

    def take(self, table):
        """``(dropped, undecided)``: the entries among the next rows of the partition that
        are dropped, and those that the neighbours decide."""
        import numpy as np
        import pyarrow as pa
        if self.held is not None:
            table = pa.concat_tables([self.held, table])
        h1, h2, doc = (table.column(c) for c in ("h1", "h2", "doc_id"))
        new_hash = _changes([h1, h2])
        new_doc = _changes([h1, h2, doc])
        carried = None
        if self.open and self.held is None and self.open["hash"] == (h1[0].as_py(), h2[0].as_py()):
            carried = self.open
            new_hash[0] = False
            new_doc[0] = doc[0].as_py() != carried["last_doc"]
        elif self.open and self.held is None:
            self._close()
        self.held = None
        begins = np.flatnonzero(new_hash)
        if carried:
            begins = np.concatenate([[0], begins])
        group = np.cumsum(new_hash) - (0 if carried else 1)
        met = np.cumsum(new_doc)
        base = met[begins] - new_doc[begins]
        if carried:
            base[0] -= carried["n_docs"]
        rank = met - base[group]              # documents of the hash up to this row
        ends = np.append(begins[1:], len(rank)) - 1
        n_docs = rank[ends]
        first = np.zeros(len(begins), dtype=bool)
        first[0] = self.is_first
        frequent = (n_docs >= self.least) & ~first
        held = not first[-1] and not frequent[-1]
        if len(begins) > 1 and self.is_first:
            self.open = self._state(table, begins[0], ends[0], n_docs[0], carried)
            self._close()
        last = len(begins) - 1
        self.open = self._state(table, begins[last], ends[last], n_docs[last],
                                carried if last == 0 else None)
        if held:
            self.held = table.slice(int(begins[-1])).combine_chunks()
        return (table.filter(pa.array(frequent[group] & (rank > 1))),
                table.filter(pa.array(first[group])))

    def _state(self, table, lo, hi, n_docs, carried):
        return {"hash": (table.column("h1")[int(hi)].as_py(), table.column("h2")[int(hi)].as_py()),
                "n_docs": int(n_docs), "last_doc": table.column("doc_id")[int(hi)].as_py(),
                "first_doc": carried["first_doc"] if carried
                else table.column("doc_id")[int(lo)].as_py()}

    def _close(self):
        if self.is_first:
            self.first, self.is_first = self.open, False

    def summaries(self) -> list[dict]:
        """Of the partition's first and last hash."""
        return [s for s in (self.first, self.open) if s]


KINDS = DROPPED, UNDECIDED, SUMMARY = 0, 1, 2


def first_occurrences(entries: DataFrame, rule: LineDedup = LineDedup(),
                      partitions: int | None = None) -> DataFrame:
    """``(_doc, pos)`` of every dropped line, from the staged result of ``line_entries``.

    Documents are told apart by id: rows of one id are one document, a null id is a document
    below all others.
    """
    spark = entries.sparkSession
    if partitions is None:
        n = entries.agg(F.sum(F.size("lines"))).first()[0] or 0
        partitions = max(shuffle_partitions(spark), -(-n // ENTRIES_PER_TASK))
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("_doc"),
             F.col("pos")]
    id_type = entries.schema["doc_id"].dataType.simpleString()
    rows = (entries.select("_doc", "doc_id", F.explode("lines").alias("l"))
            .select("l.h1", "l.h2", "doc_id", "_doc", "l.pos"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        stream = _Stream(rule.min_documents)
        part = TaskContext.get().partitionId()
        kind_id, id_arrow = pa.int8(), None

        def out(kind, table, summary=None):
            n = len(summary) if summary is not None else len(table)
            null = {t: pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.binary(), id_arrow)}
            col = dict.fromkeys(("h1", "h2", "n_docs"), null[pa.int64()])
            col |= {"kind": pa.array([kind] * n, kind_id), "part": pa.array([part] * n, pa.int32()),
                    "doc_id": null[id_arrow], "last_doc": null[id_arrow],
                    "_doc": null[pa.binary()], "pos": null[pa.int32()]}
            if summary is not None:
                col |= {"h1": pa.array([s["hash"][0] for s in summary], pa.int64()),
                        "h2": pa.array([s["hash"][1] for s in summary], pa.int64()),
                        "n_docs": pa.array([s["n_docs"] for s in summary], pa.int64()),
                        "doc_id": pa.array([s["first_doc"] for s in summary], id_arrow),
                        "last_doc": pa.array([s["last_doc"] for s in summary], id_arrow)}
            else:
                named = ("_doc", "pos") if kind == DROPPED else ("h1", "h2", "doc_id", "_doc", "pos")
                col |= {c: table.column(c).combine_chunks() for c in named}
            names = ("kind", "part", "h1", "h2", "doc_id", "_doc", "pos", "n_docs", "last_doc")
            cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
                    for c in (col[k] for k in names)]
            return pa.RecordBatch.from_arrays(cols, names=list(names))

        for batch in batches:
            if not batch.num_rows:
                continue
            id_arrow = batch.schema.field("doc_id").type
            dropped, undecided = stream.take(pa.Table.from_batches([batch]))
            if len(dropped):
                yield out(DROPPED, dropped)
            if len(undecided):
                yield out(UNDECIDED, undecided)
        if stream.open:
            if stream.held is not None:
                yield out(UNDECIDED, stream.held)
            yield out(SUMMARY, None, stream.summaries())

    streamed = stage(
        rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(
            tidy(run), f"kind byte, part int, h1 long, h2 long, doc_id {id_type}, _doc binary, "
                       f"pos int, n_docs long, last_doc {id_type}"), "line-stream")
    # two rows a partition at most: a document that goes on from the partition before counts once
    along = Window.partitionBy("h1", "h2").orderBy("part")
    again = (F.lag("part").over(along).isNotNull()
             & F.lag("last_doc").over(along).eqNullSafe(F.col("doc_id")))
    whole = (streamed.where(F.col("kind") == SUMMARY)
             .withColumn("_again", again.cast("long"))
             .groupBy("h1", "h2")
             .agg((F.sum("n_docs") - F.sum("_again")).alias("n"),
                  F.min_by(F.struct("doc_id"), "part").alias("top"))
             .where(F.col("n") >= rule.min_documents)
             .select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
                     F.col("top.doc_id").alias("_top")))
    settled = (streamed.where(F.col("kind") == UNDECIDED)
               .join(F.broadcast(whole), (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
               .where(~F.col("doc_id").eqNullSafe(F.col("_top"))))
    return (streamed.where(F.col("kind") == DROPPED).select("_doc", "pos")
            .unionByName(settled.select("_doc", "pos")))


def pack_bits(dropped: list[int]) -> bytes:
    """Keep bits of the lines up to the last dropped one, compressed; later lines stay."""
    import zlib

    import numpy as np
    keep = np.ones(max(dropped) // 8 * 8 + 8, dtype=np.uint8)       # whole bytes
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def kept(raw: bytes, bitmap: bytes | None) -> tuple[int, int, bytes]:
    """``(n_lines, n_dropped, text)`` of one text under its bitmap (None: all lines stay)."""
    import zlib

    import numpy as np
    lines = raw.split(b"\n")
    if bitmap is None:
        return len(lines), 0, raw
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8))
    keep = bits.tolist()[:len(lines)]
    keep += [1] * (len(lines) - len(keep))
    left = [line for line, k in zip(lines, keep) if k]
    return len(lines), len(lines) - len(left), b"\n".join(left)


def keep_bitmaps(docs: DataFrame, rule: LineDedup = LineDedup(), id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(_doc, n_dropped, keep)``: the keep bitmap of every row that loses a line, by its
    content key (``content_key``); rows alike in id and text share one."""
    entries = stage(line_entries(docs, rule, id_col, text_col), "line-entries")
    dropped = (first_occurrences(entries, rule).groupBy("_doc")
               .agg(F.collect_set("pos").alias("_dropped")))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            lists = batch.column("_dropped").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), pa.array([len(v) for v in lists], pa.int64()),
                 pa.array([pack_bits(v) for v in lists], pa.binary())],
                names=["_doc", "n_dropped", "keep"])

    return dropped.mapInArrow(run, "_doc binary, n_dropped long, keep binary")


def dedup_lines(docs: DataFrame, rule: LineDedup = LineDedup(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, kept_text.

    A null or empty text is one empty line; rows of one id are one document and a null id
    is a document below all others; repeated rows come out each, alike; an empty table
    gives no rows; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    bitmaps = keep_bitmaps(docs, rule, id_col, text_col).withColumnRenamed("_doc", "_key")
    rows = docs.select(content_key(id_col, text_col).alias("_doc"), F.col(id_col).alias("_id"),
                       text_or_empty(text_col).alias("_text"))
    joined = rows.join(bitmaps, rows["_doc"] == bitmaps["_key"], "left").select("_id", "_text", "keep")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            bits = batch.column("keep").to_pylist()
            done = [kept(raw, b) for raw, b in zip(utf8_column(batch, "_text"), bits)]
            n_lines, n_dropped, texts = zip(*done) if done else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_text"])

    return joined.mapInArrow(tidy(run), f"doc_id {id_type}, n_lines long, n_dropped long, "
                                        "kept_text string")


def line_report(docs: DataFrame, rule: LineDedup = LineDedup()) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, kept_sha256."""
    return dedup_lines(docs, rule).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
f AS (
  SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (
  SELECT l.*, f.k IS NOT NULL AND l.doc_id <> f.top AS gone FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

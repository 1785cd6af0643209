"""Brute-force versions and small inputs for the tests of the training-data operators."""

from __future__ import annotations

import re
import zlib

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text: str) -> str:
    """A-Z only."""
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def words(text: str | None) -> list[str]:
    return SPLIT.findall(text or "")


def remainder(doc_id, n: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def frame(spark, texts, ids=None, sources=None):
    rows = [(ids[i] if ids else i, t, "en", sources[i] if sources else f"s{i % 3}",
             None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


#: Nulls, empty and wordless texts, repeated rows, ties, a very long text, odd characters.
AWKWARD = [
    None, "", "   \n\t ", "one", "one two", "One  TWO\tthree\n", "one two three four five " * 8,
    "one two three four five " * 8, "x" * 5000, "naïve café ß Straße ÀÉÎ " * 30,
    "the quick brown fox of the lazy dog and the cat in the hat " * 400,
    "a|b #*$%&<> 12 345 … 数据 科学", " non-breaking wide\x85next", "<|endoftext|> x",
    "line\nline\nline\nother\n\n", "you idiot, you worthless clown! stupid moron",
    "the same passage that two documents share word for word, long enough to be a repeat of "
    "two hundred bytes or more when it is put beside itself in another text, which this is, as "
    "anyone who counts the letters can see for themselves without much ado",
    "before: the same passage that two documents share word for word, long enough to be a repeat "
    "of two hundred bytes or more when it is put beside itself in another text, which this is, as "
    "anyone who counts the letters can see for themselves without much ado :after",
]


def awkward(spark):
    """AWKWARD with a repeated id, a null id, a null source and columns of clashing names."""
    ids = list(range(len(AWKWARD)))
    ids[7], ids[5] = 6, None
    sources = [None if i == 4 else f"s{i % 3}" for i in range(len(AWKWARD))]
    from pyspark.sql import functions as F
    df = frame(spark, AWKWARD, ids, sources)
    for c in ("fp", "h", "marks", "keep", "score", "size", "rate", "copies", "target", "label",
              "_id", "_row", "_text", "length", "block", "toxic", "quality"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def label_rows(spark, ids, toxic=None):
    rows = [(i, 0 if i % 4 == 0 else 1, int(bool(toxic and i in toxic))) for i in ids
            if i is not None] + [(None, 1, 0), (3, None, None), (4, 7, 7)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

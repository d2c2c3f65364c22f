"""Small corpus tables with the awkward rows that every operator has to handle."""

from __future__ import annotations

import zlib

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows of (doc_id, text) or of all five columns."""
    full = [r if len(r) == 5 else (*r, "en", "src0", None if r[1] is None else len(r[1]))
            for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def awkward_documents(spark):
    """NULLs in every column, empty and very long texts, repeated rows, clashing column names."""
    base = documents(spark, [
        (1, "the cat sat on the mat and looked at the dog"),
        (1, "the cat sat on the mat and looked at the dog"),
        (2, None), (3, ""), (4, " \n\t "), (None, "a text without an id"),
        (5, "word " * 60_000), (6, "x" * 200_000), (7, "naïve café ß 中文 \U0001f600"),
        (8, "no metadata", None, None, None),
        (9, "the cat sat on the mat and looked at the dog"),
    ])
    clashing = "score predicted held_out fp root shard slot size position rank copies copy label"
    for name in clashing.split():
        from pyspark.sql import functions as F
        base = base.withColumn(name, F.lit("extra"))
    return base


def remainder(doc_id, divisor):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()),
                  key=lambda r: [(x is None, str(type(x)), x if x is not None else 0) for x in r])

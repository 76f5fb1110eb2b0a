"""Fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def sample_docs(spark):
    """Documents of the smallest table and odd rows: nulls, empty and very long texts, repeated rows, extra columns."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.unionByName(odd_docs(spark))


def odd_docs(spark):
    rows = [
        (900_001, None, None, None, None),
        (900_002, "", "en", "src1", 0),
        (900_003, " \t\n ", "en", None, 4),
        (900_004, LONG, "en", "src1", len(LONG)),
        (900_005, "one two", "fr", "src2", 7),
        (900_005, "one two", "fr", "src2", 7),
        (900_006, "12345 !!! 6789", "de", "src3", 14),
        (900_007, "same line\nsame line\nsame line 55555", None, "src3", 34),
        (None, "a row without an id " * 12, "en", "src0", 240),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

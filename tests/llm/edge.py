"""Rows that every training-data operator must take: nulls, empty and long texts, repeated rows, clashing names."""

import random

import duckdb

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, row string, key int, score double, text_ string"


def edge_rows():
    rng = random.Random(3)
    vocabulary = ["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma", "theta", "über", "niño"]
    long = " ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(4000))
    texts = [None, "", "...!?", "one", "ONE", "one two three four", long, long, "a\nb\nc\nd", "a\nb\nc\nx", long + " end",
             "line one\nline two\nline three\n\nlast", "x\nline one\nline two\nline three\n\nlast", "  \n\n ", "ÀÉ àé"]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, "r", i, 0.5, "t") for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], rows[0], (None, "one", "en", None, None, None, None, None),
             (None, None, None, None, None, None, None, None), (6, "another text with id six", None, "s", None, 1, None, None)]
    return rows


def edge_docs(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, COLUMNS)


def documents():
    """(doc_id, text, lang, source) of the smallest table."""
    return duckdb.sql(f"select doc_id, text, lang, source from '{SF}/documents.parquet' order by doc_id").fetchall()

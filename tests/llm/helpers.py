"""Rows that operators must bear, and small fixtures."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i * i % 9973}" for i in range(40_000))
PLAIN = "The quick brown fox jumps over the lazy dog while seven wizards brew potions in a quiet old town near the sea today"


def odd_documents(spark, extra: str = ""):
    """Nulls in every column, empty and long texts, repeated rows; ``extra`` adds columns of clashing names."""
    rows = [
        (1, PLAIN, "en", "a", 10), (1, PLAIN, "en", "a", 10), (2, None, "en", "a", 0), (3, "", None, "b", 0),
        (4, LONG, "en", "b", len(LONG)), (5, " \t\n\x0b ", "en", None, 5), (None, PLAIN + " again", "en", "b", 9),
        (7, "word", "en", "a", None), (8, "Ünïcode ß 你好 \x85 x\xa0y", "de", None, 3), (9, PLAIN, None, "b", 10),
        (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, DOCS)
    names = [n for n in extra.split(",") if n]
    return df.selectExpr("*", *[f"'old' AS `{n}`" for n in names])


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

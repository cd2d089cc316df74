"""Read a directory tree of posts: ``root/category/file``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.functions.text import unix_newlines


def _files(spark: SparkSession, root: str, skip_unreadable: bool) -> DataFrame:
    """Files one level below ``root``; contents are read only if they are selected."""
    parts = F.split(F.col("path"), "/")
    files = (
        spark.read.format("binaryFile")
        .option("ignoreCorruptFiles", str(skip_unreadable).lower())
        .load(f"{root}/*/*")
    )
    return files.withColumns({"category": F.element_at(parts, -2), "doc_id": F.element_at(parts, -1)})


def read_posts(spark: SparkSession, root: str, skip_unreadable: bool = False) -> DataFrame:
    """``(category, doc_id, raw)`` for every file one level below ``root``.

    Posts are Latin-1. The text source cannot decode whole files of that encoding, so
    the bytes are read and decoded here. An unreadable file fails the read, unless it is to be
    skipped; ``unreadable_posts`` lists those. By Spark's rule, files whose name starts with a dot or underscore are not read.
    """
    files = _files(spark, root, skip_unreadable)
    return files.select("category", "doc_id", unix_newlines(F.decode("content", "ISO-8859-1")).alias("raw"))


def unreadable_posts(spark: SparkSession, root: str) -> DataFrame:
    """``(category, doc_id, path)`` of the files that ``skip_unreadable`` leaves out.

    The files are listed without opening them; those that can be read are taken off.
    """
    read = _files(spark, root, True).filter(F.col("content").isNotNull()).select("path")
    return _files(spark, root, True).select("category", "doc_id", "path").join(read, "path", "left_anti").select("category", "doc_id", "path")

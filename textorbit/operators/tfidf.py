"""TF-IDF: a capped vocabulary and unit-length weight rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StructField, StructType

from textorbit.functions.terms import term_counts as counted_terms
from textorbit.functions.terms import coded_terms, row_slices, term_totals, text_slices, with_odd_tokens

MAX_FEATURES, MIN_DF, MAX_DF = 50_000, 3, 0.85

SPARSE_ROW = StructType(
    [
        StructField("term_ids", ArrayType(IntegerType())),
        StructField("weights", ArrayType(DoubleType())),
    ]
)

# The same as bytes, four and eight a term: written, read and sent to Python as two values a row, not two a term.
PACKED_ROW = StructType([StructField("term_ids", BinaryType()), StructField("weights", BinaryType())])


def term_counts(docs: DataFrame, text: str = "text", key: str = "id") -> DataFrame:
    """``(key, term, tf)``; row-local, no shuffle."""
    return counted_terms(docs, text, key)


def fit_vocab(
    docs: DataFrame,
    text: str = "text",
    max_features: int = MAX_FEATURES,
    min_df: int = MIN_DF,
    max_df: float = MAX_DF,
) -> DataFrame:
    """``(term, term_id, df, total, idf)`` of the terms that stay in the vocabulary.

    One aggregation of the corpus, combined before its shuffle. The number of documents
    is a scalar subquery. Numbering the terms uses one task on at most
    ``max_features`` rows; ``term_id`` follows the alphabet.
    """
    n_docs = docs.agg(F.count("*").cast("double")).scalar()
    counts = term_totals(docs, text)
    kept = counts.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    top = kept.orderBy(F.desc("total"), "term").limit(max_features)
    return top.select(
        "term",
        (F.row_number().over(W.orderBy("term")) - 1).alias("term_id"),
        "df",
        "total",
        (F.log((n_docs + 1) / (F.col("df") + 1)) + 1).alias("idf"),
    )


def collect_vocab(vocab: DataFrame) -> pa.Table:
    """The vocabulary on the driver, by term id; its size is capped by construction."""
    return vocab.select("term", "term_id", "df", "total", "idf").orderBy("term_id").toArrow()


def sparse_row(text: Column | str, odd: Column | str, vocab: pa.Table, packed: bool = False) -> Column:
    """Unit-length TF-IDF weights of the terms of a text: ``(1 + ln tf) * idf``, then L2.

    ``odd`` has the tokens of texts that are not plain, as ``with_odd_tokens`` makes them. Looks the terms
    up where the row is, in the shipped vocabulary, so no row per (document, term) is shuffled. Unknown
    terms drop out; a row without known terms gets empty arrays. ``packed`` makes bytes of the arrays.
    """
    names = vocab.column("term").combine_chunks()
    idf = vocab.column("idf").to_numpy()

    @F.arrow_udf(PACKED_ROW if packed else SPARSE_ROW)
    def weigh(texts: pa.Array, odd: pa.Array) -> pa.Array:
        parts = [_weigh_parts(tokens, names, idf) for _, tokens in text_slices(texts, odd)]
        rows = pa.concat_arrays(parts) if parts else _weigh(odd, names, idf)
        return _packed(rows) if packed else rows

    return weigh(text, odd)


def _packed(rows: pa.StructArray) -> pa.StructArray:
    return pa.StructArray.from_arrays([_bytes(rows.field("term_ids"), 4), _bytes(rows.field("weights"), 8)], names=["term_ids", "weights"])


def _bytes(lists: pa.ListArray, width: int) -> pa.Array:
    """Lists of numbers of so many bytes as binary values."""
    offsets = (lists.offsets.to_numpy() - lists.offsets[0].as_py()) * width
    data = lists.flatten().to_numpy()
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _weigh_parts(arrays: pa.Array, names: pa.Array, idf: np.ndarray) -> pa.Array:
    """``_weigh`` with the pairs and counts of a few rows in memory at a time, however many a batch has."""
    parts = [_weigh(arrays.slice(lo, hi - lo), names, idf) for lo, hi in row_slices(arrays)]
    return pa.concat_arrays(parts) if parts else _weigh(arrays, names, idf)


def _weigh(arrays: pa.Array, names: pa.Array, idf: np.ndarray) -> pa.Array:
    n_rows, n_terms = len(arrays), max(len(names), 1)
    row, place, terms = coded_terms(arrays)
    term = pc.fill_null(pc.index_in(terms, value_set=names), -1).to_numpy()[place]
    known = term >= 0
    cell, tf = np.unique(row[known] * n_terms + term[known], return_counts=True)
    row, term = cell // n_terms, (cell % n_terms).astype(np.int32)
    weight = (1.0 + np.log(tf)) * idf[term]
    norm = np.sqrt(np.bincount(row, weight * weight, minlength=n_rows))
    weight /= norm[row]
    offsets = np.zeros(n_rows + 1, np.int32)
    np.cumsum(np.bincount(row, minlength=n_rows), out=offsets[1:])
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(offsets, pa.array(term)),
            pa.ListArray.from_arrays(offsets, pa.array(weight)),
        ],
        names=["term_ids", "weights"],
    )


def sparse_rows(
    docs: DataFrame, vocab: pa.Table, text: str = "text", keep: tuple[str, ...] = ("id",), packed: bool = False
) -> DataFrame:
    """``(*keep, term_ids, weights)``, one row per document."""
    rows = with_odd_tokens(docs.select(*keep, text), text, "_odd_tokens")
    rows = rows.select(*keep, sparse_row(text, "_odd_tokens", vocab, packed).alias("r"))
    return rows.select(*keep, "r.term_ids", "r.weights")


def weight_table(rows: DataFrame, key: str = "id") -> DataFrame:
    """Sparse rows in long form: ``(key, term_id, weight)``."""
    pairs = F.explode_outer(F.arrays_zip("term_ids", "weights")).alias("p")
    return (
        rows.select(key, pairs)
        .select(key, F.col("p.term_ids").alias("term_id"), F.col("p.weights").alias("weight"))
        .filter(F.col("term_id").isNotNull())
    )

"""The tables of a built corpus: written once, appended to, read by search and clustering.

Rows lie in parts, one for the corpus as built and one for each append. A version is a manifest
that names its parts; it is one small file, written last, so a reader sees whole versions only, and
parts of an append that failed are in no version.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.functions.vectors import to_matrix
from textorbit.operators.corpus import category_index, corpus_stats
from textorbit.operators.lsa import LsaModel
from textorbit.operators.search import new_documents
from textorbit.operators.tfidf import collect_vocab
from textorbit.operators.vmf import assign, centroid_frame, centroid_matrix, doc_clusters
from textorbit.session import stage, unstage

# Tables in parts, and those of the model.
PARTS = {
    "corpus": "id string, doc_id string, n_tokens int, category string",
    "texts": "id string, text string",
    "embeddings": "id string, embedding array<float>, category string",
    "category_index": "id string, doc_id string, category string",
}
MODEL = {
    "vocab": "term string, term_id int, df long, total long, idf double",
    "basis": "term_id int, v array<double>",
}


@dataclass
class Store:
    """A version of a corpus as stored: metadata, texts, vectors and the fitted model."""

    corpus: DataFrame
    texts: DataFrame
    embeddings: DataFrame
    category_index: DataFrame
    model: LsaModel
    path: str
    version: int


def _write_part(path: str, docs: DataFrame, embeddings: DataFrame) -> str:
    """Write rows of the four tables as a new part, which no version names yet.

    Texts lie apart from vectors, so scoring never reads them; the others are
    partitioned by category, so a category filter prunes files.
    """
    part = uuid.uuid4().hex[:12]
    if "category" not in embeddings.columns:
        embeddings = embeddings.join(docs.select("id", "category"), "id")
    tables = {
        "corpus": docs.select("id", "doc_id", "n_tokens", "category"),
        "texts": docs.select("id", "text"),
        "embeddings": embeddings.select("id", "embedding", "category"),
        "category_index": category_index(docs),
    }
    for name, table in tables.items():
        writer = table.write if name == "texts" else table.write.partitionBy("category")
        writer.parquet(f"{path}/{name}/part={part}")
    return part


def _write_version(spark: SparkSession, path: str, version: int, parts: list[str]) -> None:
    """Make a version; an error if another writer has made it before."""
    rows = spark.createDataFrame([(p,) for p in parts], "part string")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/version={version}")


def write_store(path: str, docs: DataFrame, model: LsaModel, embeddings: DataFrame) -> None:
    """Write version 0 under ``path``: all documents as one part, and the model.

    ``embeddings`` with a ``category`` are written as they are, others are joined with it.
    """
    spark = docs.sparkSession
    model.vocab_frame(spark).write.parquet(f"{path}/vocab")
    model.basis_frame(spark).write.parquet(f"{path}/basis")
    stats = corpus_stats(docs, model.vocab.num_rows, model.dims, model.explained_variance)
    stats.coalesce(1).write.json(f"{path}/corpus_stats")
    _write_version(spark, path, 0, [_write_part(path, docs, embeddings)])


def versions(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Parts of each version; one row per append and version."""
    rows = spark.read.schema("part string, version int").parquet(f"{path}/manifest").orderBy("version", "part").collect()
    out: dict[int, list[str]] = {}
    for r in rows:
        out.setdefault(r.version, []).append(r.part)
    return out


def read_store(spark: SparkSession, path: str, version: int | None = None) -> Store:
    """Read a version (default: the latest); its schemas are declared, not inferred."""
    known = versions(spark, path)
    version = max(known) if version is None else version
    frames = {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in MODEL.items()}
    for name, schema in PARTS.items():
        reader = spark.read.schema(schema).option("basePath", f"{path}/{name}")
        table = reader.parquet(*[f"{path}/{name}/part={part}" for part in known[version]])
        frames[name] = table.select(*[field.split()[0] for field in schema.split(", ")])
    basis = frames["basis"].orderBy("term_id").select("v").toArrow().column(0)
    stats = spark.read.json(f"{path}/corpus_stats").select("explained_variance").first()
    matrix = to_matrix(basis, len(basis[0])) if len(basis) else np.zeros((0, 0))
    model = LsaModel(collect_vocab(frames["vocab"]), matrix, stats[0])
    tables = {name: frames[name] for name in PARTS}
    return Store(**tables, model=model, path=path, version=version)


def append_documents(store: Store, texts: DataFrame, dedup: bool = False) -> Store:
    """Add ``(text, category[, doc_id])`` to a store and return its next version.

    Texts are embedded with the store's model as they are, neither cleaned nor tested for length. Equal texts have
    one id, so a hit on it names each of their rows; with ``dedup`` those that the store holds already are left out. New rows are written as a part of all four
    tables; the version that names it is written last. A store that has moved on meanwhile is an error.
    """
    spark = store.corpus.sparkSession
    rows = new_documents(texts, store.model, store.corpus if dedup else None)
    rows = stage(rows.withColumn("n_tokens", F.col("n_tokens").cast("int")), "appended")
    part = _write_part(store.path, rows, rows)
    known = versions(spark, store.path)
    if max(known) != store.version:
        raise RuntimeError(f"version {store.version} of {store.path} is not the latest, {max(known)}")
    _write_version(spark, store.path, store.version + 1, [*known[store.version], part])
    unstage(rows)
    return read_store(spark, store.path)


def write_clusters(path: str, embeddings: DataFrame, centroids: np.ndarray, kappa: float) -> None:
    """Write centroids with their concentration, memberships and per-document records.

    Memberships are computed once: rows that do not come with theirs are assigned and staged.
    """
    assigned = embeddings if "u" in embeddings.columns else stage(assign(embeddings, centroids, kappa).drop("embedding"), "assigned")
    frame = centroid_frame(assigned.sparkSession, centroids).withColumn("kappa", F.lit(float(kappa)))
    frame.coalesce(1).write.parquet(f"{path}/centroids")
    assigned.select("id", "u", "hard_cluster").write.parquet(f"{path}/memberships")
    doc_clusters(assigned).write.parquet(f"{path}/doc_clusters")


def read_centroids(spark: SparkSession, path: str) -> tuple[np.ndarray, float]:
    frame = spark.read.parquet(f"{path}/centroids")
    return centroid_matrix(frame), frame.select("kappa").first()[0]

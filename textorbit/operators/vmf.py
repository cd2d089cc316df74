"""Soft clustering on the unit sphere (von Mises-Fisher memberships)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from textorbit.functions.vectors import (
    SUMS,
    collect_sums,
    keyed_sums,
    label_cells,
    to_lists,
    to_matrix,
    unit_rows,
    with_vector,
)
from textorbit.operators.kmeans import fit_kmeans
from textorbit.operators.medians import exact_medians
from textorbit.session import stage

# Fixed value: the concentrations that are compared.
KAPPAS = (5, 10, 15, 20, 30, 40, 50)
MAX_LABELS = 1 << 16


def softmax_rows(cosines: np.ndarray, kappa: float) -> np.ndarray:
    logits = cosines * kappa
    logits -= logits.max(axis=1, keepdims=True)
    weights = np.exp(logits)
    return weights / weights.sum(axis=1, keepdims=True)


def memberships(embedding: Column | str, centroids: np.ndarray, kappa: float) -> Column:
    """Soft assignment of a vector to each centroid, as ``array<double>``; row-local, null for a null vector."""
    centroids = np.asarray(centroids, np.float64)

    @F.arrow_udf(ArrayType(DoubleType()))
    def soft(vectors: pa.Array) -> pa.Array:
        u = softmax_rows(to_matrix(vectors.drop_null(), centroids.shape[1]) @ centroids.T, kappa)
        if not vectors.null_count:
            return to_lists(u)
        place = np.cumsum(~vectors.is_null().to_numpy(zero_copy_only=False)) - 1
        return to_lists(u).take(pa.array(place, mask=vectors.is_null().to_numpy(zero_copy_only=False)))

    return soft(embedding)


def entropy(u: Column | str) -> Column:
    """Shannon entropy (natural log) of memberships; 0 log 0 is 0."""
    return F.aggregate(u, F.lit(0.0), lambda h, p: h - F.when(p > 0, p * F.log(p)).otherwise(0.0))


def hard_cluster(u: Column | str) -> Column:
    """Index of the largest membership, the lowest one on a tie."""
    return (F.array_position(u, F.array_max(u)) - 1).cast("int")


def top_clusters(u: Column | str, n: int) -> Column:
    """The ``n`` largest memberships as ``array<struct<cluster, u>>``, largest first."""
    ordered = F.array_sort(
        F.transform(u, lambda x, i: F.struct((-x).alias("neg"), i.cast("int").alias("cluster")))
    )
    return F.transform(
        F.slice(ordered, 1, n), lambda s: F.struct(s["cluster"].alias("cluster"), (-s["neg"]).alias("u"))
    )


def assign(embeddings: DataFrame, centroids: np.ndarray, kappa: float) -> DataFrame:
    """Add ``u, hard_cluster, entropy, top_conf``."""
    return (
        embeddings.withColumn("u", memberships("embedding", centroids, kappa))
        .withColumn("hard_cluster", hard_cluster("u"))
        .withColumn("entropy", entropy("u"))
        .withColumn("top_conf", F.array_max("u"))
    )


def doc_clusters(assigned: DataFrame) -> DataFrame:
    """Per-document record with the five largest memberships as a map."""
    top5 = F.transform(
        top_clusters("u", 5), lambda s: F.struct(s["cluster"].alias("key"), F.round(s["u"], 5).alias("value"))
    )
    return assigned.select(
        "id",
        "doc_id",
        "category",
        "hard_cluster",
        F.round("entropy", 5).alias("entropy"),
        F.round("top_conf", 5).alias("top_conf"),
        F.map_from_entries(top5).alias("memberships"),
    )


def mean_directions(embeddings: DataFrame, label: str) -> tuple[list, np.ndarray]:
    """Sorted labels and the unit mean vector of each.

    Summed for a batch of rows at a time and combined before the shuffle, so one label may hold
    most rows. One vector a label reaches the driver, of at most ``MAX_LABELS`` labels.
    """
    sums = (
        label_cells(embeddings, label)
        .groupBy(label)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("v"))
        .select(label, F.transform("v", lambda x: x["s"]).alias("v"))
        .orderBy(label)
        .limit(MAX_LABELS + 1)
        .toArrow()
    )
    if sums.num_rows > MAX_LABELS:
        raise ValueError(f"over {MAX_LABELS} labels")
    labels = sums.column(0).to_pylist()
    return labels, unit_rows(to_matrix(sums.column(1), len(sums.column(1)[0])))


def soft_sums(embeddings: DataFrame, centroids: np.ndarray, kappa: float) -> np.ndarray:
    """M-step sums: membership-weighted vector sum per cluster, in one pass.

    Memberships are not stored; each task adds up a (clusters x dims) matrix.
    """
    k, dims = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims))
        for batch in batches:
            if batch.num_rows:
                x = to_matrix(batch.column(0), dims)
                total += softmax_rows(x @ centroids.T, kappa).T @ x
        yield from keyed_sums(np.arange(k), total)

    return collect_sums(with_vector(embeddings).select("embedding").mapInArrow(partial, SUMS), k, dims)


def fit_vmf(
    embeddings: DataFrame,
    k: int,
    kappa: float,
    n_iter: int = 30,
    seed: int = 42,
    start: np.ndarray | None = None,
    n_init: int = 10,
) -> np.ndarray:
    """Centroids after soft EM from a k-means start (or ``start``).

    Stops when no coordinate moves by 1e-5. Memberships under the result come from
    ``assign``.
    """
    points = with_vector(embeddings).persist()
    try:
        if start is None:
            start = fit_kmeans(points, k, n_init=n_init, seed=seed).centers
        centroids = unit_rows(np.asarray(start, np.float64))
        for _ in range(n_iter):
            moved = unit_rows(soft_sums(points, centroids, kappa))
            delta = float(np.abs(moved - centroids).max())
            centroids = moved
            if delta < 1e-5:
                break
    finally:
        points.unpersist()
    return centroids


def kappa_table(
    embeddings: DataFrame,
    centroids: np.ndarray,
    kappas=KAPPAS,
    head_rows: int | None = None,
) -> DataFrame:
    """Per concentration: mean entropy and confidence, counts, and whether the entropy
    lies in the middle third of its range.

    All documents are judged, unless ``head_rows`` asks for that many first ones in corpus
    order. Cosines are computed once per document for all concentrations.
    """
    centroids = np.asarray(centroids, np.float64)
    n_kappas, top = len(kappas), float(np.log(len(centroids)))
    points = with_vector(embeddings)
    if head_rows is not None:
        points = points.orderBy("category", "doc_id").limit(head_rows)

    @F.arrow_udf(ArrayType(DoubleType()))
    def judge(vectors: pa.Array) -> pa.Array:
        cosines = to_matrix(vectors, centroids.shape[1]) @ centroids.T
        out = np.zeros((len(vectors), 2 * n_kappas))
        for at, kappa in enumerate(kappas):
            u = softmax_rows(cosines, kappa)
            out[:, at] = -(u * np.log(np.where(u > 0, u, 1.0))).sum(axis=1)
            out[:, n_kappas + at] = u.max(axis=1)
        return to_lists(out)

    judged = points.select(judge("embedding").alias("j"))
    per_kappa = []
    for at, kappa in enumerate(kappas):
        h, conf = F.get("j", F.lit(at)), F.get("j", F.lit(n_kappas + at))
        per_kappa.append(
            F.struct(
                F.lit(kappa).alias("kappa"),
                F.avg(h).alias("h"),
                F.avg(conf).alias("c"),
                F.count_if(conf > 0.7).alias("conf_gt07"),
                F.count_if(conf < 0.3).alias("conf_lt03"),
            )
        )
    rows = judged.agg(F.array(*per_kappa).alias("rows")).select(F.inline("rows"))
    return rows.select(
        "kappa",
        F.round("h", 4).alias("entropy_mean"),
        F.round("c", 4).alias("conf_mean"),
        "conf_gt07",
        "conf_lt03",
        F.col("h").between(top / 3, 2 * top / 3).alias("in_target_range"),
    )


def select_kappa(table: DataFrame, n_clusters: int) -> int:
    """The concentration whose mean entropy is closest to half of its maximum."""
    distance = F.abs(F.col("entropy_mean") - F.lit(float(np.log(n_clusters)) / 2))
    return table.orderBy(distance, "kappa").first()["kappa"]


def centroid_frame(spark: SparkSession, centroids: np.ndarray) -> DataFrame:
    ids = pa.array(np.arange(len(centroids)), pa.int32())
    return spark.createDataFrame(pa.table({"cluster": ids, "centroid": to_lists(np.asarray(centroids))}))


def centroid_matrix(frame: DataFrame) -> np.ndarray:
    """Centroids of a stored table as a matrix; there are as many as clusters."""
    table = frame.orderBy("cluster").select("centroid").toArrow()
    return to_matrix(table.column(0), len(table.column(0)[0]))


def confidence_bands(assigned: DataFrame) -> DataFrame:
    """One row: entropy and confidence of the corpus, and documents per confidence band."""
    facts = stage(assigned.select("entropy", "top_conf"), "facts")
    bands = facts.agg(
        F.avg("entropy").alias("entropy_mean"),
        F.avg("top_conf").alias("conf_mean"),
        F.count_if(F.col("top_conf") > 0.7).alias("conf_gt07"),
        F.count_if(F.col("top_conf") > 0.5).alias("conf_gt05"),
        F.count_if(F.col("top_conf") < 0.3).alias("conf_lt03"),
    )
    whole = facts.select(F.lit(0).alias("g"), "entropy", "top_conf")
    medians = exact_medians(whole, "g", ["entropy", "top_conf"])
    return bands.withColumn("g", F.lit(0)).join(medians, "g").select(
        F.round("entropy_mean", 4).alias("entropy_mean"),
        F.round("entropy_median", 4).alias("entropy_median"),
        F.round("conf_mean", 4).alias("conf_mean"),
        F.round("top_conf_median", 4).alias("conf_median"),
        "conf_gt07",
        "conf_gt05",
        "conf_lt03",
    )

"""Evidence for the number of clusters: silhouette, Calinski-Harabasz, gap statistic."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textorbit.functions.vectors import SUMS, collect_sums, keyed_sums, label_cells, to_lists, to_matrix, with_vector
from textorbit.operators.kmeans import Fit, best_fits, fit_many, lloyd_totals, seeded_sample
from textorbit.session import stage


def calinski_harabasz(labelled: DataFrame, label: str = "label") -> DataFrame:
    """One row: between over within variance ratio of labelled vectors.

    Per-dimension sums per label are enough; they combine before the shuffle.
    """
    per_cell = label_cells(labelled, label)
    per_dim = per_cell.groupBy("pos").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("k"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("means"),
        F.sum("s").alias("s"),
        F.sum("q").alias("q"),
    )
    n, k = F.max("n"), F.max("k")
    between = F.sum(F.col("means") - F.col("s") * F.col("s") / F.col("n"))
    within = F.sum(F.col("q") - F.col("means"))
    return per_dim.agg(
        n.alias("n_docs"),
        k.alias("k"),
        F.when(within == 0, 1.0).otherwise((between / (k - 1)) / (within / (n - k))).alias("calinski_harabasz"),
        within.alias("inertia"),
    )


def silhouettes(points: DataFrame, fits: list[Fit]) -> list[float]:
    """Mean cosine silhouette of each fit's labels on ``points``, exact in linear time.

    On unit vectors the distances from x to a cluster sum to n - x.S with S the
    cluster's vector sum, so two passes replace all pairs.
    """
    dims = fits[0].centers.shape[1]
    copies = [Fit(f.k, dataset=0, centers=f.centers) for f in fits]
    if "dataset" not in points.columns:
        points = points.withColumn("dataset", F.lit(0))
    lloyd_totals(points, copies)
    known = [(f.centers, f.sums, f.sizes) for f in copies]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(known), 2))
        for batch in batches:
            if batch.num_rows:
                x = to_matrix(batch.column(0), dims)
                for at, (centers, sums, sizes) in enumerate(known):
                    s = _silhouette_values(x, centers, sums, sizes)
                    total[at] += s.sum(), len(s)
        yield from keyed_sums(np.arange(len(known)), total)

    out = collect_sums(points.select("embedding").mapInArrow(partial, SUMS), len(known), 2)
    return (out[:, 0] / np.maximum(out[:, 1], 1)).tolist()


def _silhouette_values(x: np.ndarray, centers: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    label = (x @ centers.T - 0.5 * (centers * centers).sum(axis=1)).argmax(axis=1)
    own = np.arange(len(x)), label
    distances = sizes - x @ sums.T
    to_itself = 1.0 - (x * x).sum(axis=1)
    a = (distances[own] - to_itself) / np.maximum(sizes[label] - 1, 1)
    others = np.where(sizes > 0, distances / np.maximum(sizes, 1), np.inf)
    others[own] = np.inf
    b = others.min(axis=1)
    scale = np.maximum(a, b)
    value = np.where(scale > 0, (b - a) / np.where(scale > 0, scale, 1.0), 0.0)
    return np.where((sizes[label] > 1) & np.isfinite(b), value, 0.0)


def k_sweep(
    embeddings: DataFrame,
    ks=tuple(range(8, 28, 2)),
    n_init: int = 5,
    max_iter: int = 200,
    seed: int = 42,
    silhouette_rows: int | None = None,
) -> DataFrame:
    """``(k, inertia, silhouette, calinski_harabasz)`` of the best of ``n_init`` fits per k.

    The silhouette is that of all documents, unless ``silhouette_rows`` asks for a seeded sample.
    """
    points = with_vector(embeddings).select("id", "embedding")
    fits = fit_many(points, [Fit(k, seed + i, max_iter) for k in ks for i in range(n_init)])
    best = [best_fits(fits)[(0, k)] for k in ks]
    judged = points if silhouette_rows is None else seeded_sample(points, silhouette_rows, seed)
    rows = []
    for fit, silhouette in zip(best, silhouettes(judged, best)):
        rows.append((fit.k, fit.inertia, round(silhouette, 5), round(_ratio(fit), 2)))
    return embeddings.sparkSession.createDataFrame(
        rows, "k int, inertia double, silhouette double, calinski_harabasz double"
    )


def _ratio(fit: Fit) -> float:
    full = fit.sizes > 0
    n, k = fit.sizes.sum(), int(full.sum())
    means = ((fit.sums[full] ** 2).sum(axis=1) / fit.sizes[full]).sum()
    between = means - (fit.sums.sum(axis=0) ** 2).sum() / n
    within = fit.square_norms - means
    return 1.0 if within <= 0 else float((between / (k - 1)) / (within / (n - k)))


def sweep_votes(sweep: DataFrame) -> DataFrame:
    """The k each metric prefers; the smaller k on a tie."""
    return sweep.agg(
        F.min_by("k", F.struct(-F.col("silhouette"), "k")).alias("silhouette"),
        F.min_by("k", F.struct(-F.col("calinski_harabasz"), "k")).alias("ch"),
    )


def uniform_references(
    spark: SparkSession, low: np.ndarray, high: np.ndarray, n_rows: int, n_sets: int, seed: int
) -> DataFrame:
    """``n_sets`` data sets of ``n_rows`` points drawn evenly from a box.

    Each block of rows has its own seed, so the points do not depend on partitioning.
    """
    block = 500
    n_blocks = -(-n_rows // block)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                which, part = divmod(number, n_blocks)
                size = min(block, n_rows - part * block)
                points = np.random.default_rng([seed, which, part]).uniform(low, high, (size, len(low)))
                ids = [f"{which}-{part}-{i}" for i in range(size)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        to_lists(points.astype(np.float32)),
                        pa.array(np.full(size, which + 1), pa.int32()),
                    ],
                    ["id", "embedding", "dataset"],
                )

    blocks = spark.range(n_sets * n_blocks)
    return blocks.mapInArrow(draw, "id string, embedding array<float>, dataset int")


def gap_table(
    embeddings: DataFrame,
    ks=tuple(range(8, 24, 2)),
    n_refs: int = 10,
    seed: int = 42,
    sample_rows: int | None = None,
) -> DataFrame:
    """``(k, gap, sk)`` from all vectors and ``n_refs`` uniform references of as many rows.

    The vectors and all references are fitted together: one data set column, one set of
    Lloyd passes. ``sample_rows`` asks for a seeded sample instead of all vectors.
    """
    spark = embeddings.sparkSession
    sample = with_vector(embeddings).select(F.col("id").cast("string"), "embedding")
    if sample_rows is not None:
        sample = stage(seeded_sample(sample, sample_rows, seed), "gap-sample")
    box = sample.select(F.posexplode("embedding").alias("pos", "x")).groupBy("pos").agg(
        F.min("x").cast("double").alias("lo"), F.max("x").cast("double").alias("hi")
    )
    bounds = box.orderBy("pos").toArrow()
    low, high = bounds.column("lo").to_numpy(), bounds.column("hi").to_numpy()
    n_rows = sample.count()
    references = uniform_references(spark, low, high, n_rows, n_refs, seed)
    points = sample.select("id", "embedding", F.lit(0).alias("dataset")).unionByName(references)
    fits = [Fit(k, seed + i, 100) for k in ks for i in range(3)]
    fits += [Fit(k, b, 50, dataset=b + 1) for k in ks for b in range(n_refs)]
    return gap_rows(spark, best_fits(fit_many(points, fits)), ks, n_refs)


def gap_rows(spark: SparkSession, fits: dict[tuple[int, int], Fit], ks, n_refs: int) -> DataFrame:
    """``(k, gap, sk)`` from the inertia of each k on the vectors (data set 0) and on ``n_refs`` references."""
    rows = []
    for k in ks:
        # Fixed value: 1e-10 keeps the logarithm finite.
        own = np.log(fits[(0, k)].inertia + 1e-10)
        refs = np.array([np.log(fits[(b + 1, k)].inertia + 1e-10) for b in range(n_refs)])
        rows.append((int(k), float(refs.mean() - own), float(np.sqrt(1 + 1 / n_refs) * refs.std())))
    return spark.createDataFrame(rows, "k int, gap double, sk double")


def gap_choice(gaps: DataFrame) -> DataFrame:
    """One row ``optimal_k``: first k with ``gap(k) >= gap(k+1) - sk(k+1)``, else the last.

    The table has one row per candidate k.
    """
    order = W.orderBy("k")
    nxt = gaps.withColumn("bar", F.lead("gap").over(order) - F.lead("sk").over(order))
    return nxt.agg(
        F.coalesce(F.min(F.when(F.col("gap") >= F.col("bar"), F.col("k"))), F.max("k")).alias("optimal_k")
    )

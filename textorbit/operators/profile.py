"""Describe clusters: composition, sharpness, typical and boundary documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textorbit.functions.text import preview
from textorbit.functions.vectors import dot
from textorbit.operators.medians import exact_medians
from textorbit.operators.vmf import top_clusters
from textorbit.session import stage

PROFILE_DOCS, BOUNDARY_CASES, CENTROID_PAIRS = 3, 25, 20


def category_breakdown(assigned: DataFrame) -> DataFrame:
    """``(cluster, category, n)``."""
    return assigned.groupBy(F.col("hard_cluster").alias("cluster"), "category").agg(F.count("*").alias("n"))


def dominant_categories(breakdown: DataFrame) -> DataFrame:
    """``(cluster, n_docs, dominant_category, purity)``; ties go to the first name."""
    best = F.min_by("category", F.struct(-F.col("n"), "category"))
    return breakdown.groupBy("cluster").agg(
        F.sum("n").alias("n_docs"),
        best.alias("dominant_category"),
        F.round(F.max("n") / F.sum("n"), 4).alias("purity"),
    )


def cluster_profile(assigned: DataFrame) -> DataFrame:
    """One row per non-empty cluster.

    The few facts needed are staged, so the vectors are assigned once, not once for
    each of the aggregations.
    """
    facts = stage(assigned.select("hard_cluster", "category", "entropy", "top_conf"), "facts")
    parts = facts.select(F.col("hard_cluster").alias("cluster"), "entropy", "top_conf")
    means = parts.groupBy("cluster").agg(
        F.round(F.avg("entropy"), 4).alias("entropy_mean"),
        F.round(F.max("entropy"), 4).alias("entropy_max"),
        F.round(F.avg("top_conf"), 4).alias("conf_mean"),
    )
    medians = exact_medians(parts, "cluster", ["entropy", "top_conf"]).select(
        "cluster",
        F.round("entropy_median", 4).alias("entropy_median"),
        F.round("top_conf_median", 4).alias("conf_median"),
    )
    shares = dominant_categories(category_breakdown(facts))
    return shares.join(means, "cluster").join(medians, "cluster")


def cluster_report(profile: DataFrame, breakdown: DataFrame) -> DataFrame:
    """Profiles by size, each with its three largest categories."""
    order = W.partitionBy("cluster").orderBy(F.desc("n"), "category")
    top = (
        breakdown.withColumn("r", F.row_number().over(order))
        .filter("r <= 3")
        .groupBy("cluster")
        .agg(F.array_sort(F.collect_list(F.struct("r", "category", "n"))).alias("t"))
        .select("cluster", F.transform("t", lambda s: F.format_string("%s(%d)", s["category"], s["n"])).alias("c"))
        .select("cluster", F.array_join("c", " | ").alias("composition"))
    )
    cols = ["cluster", "n_docs", "purity", "conf_mean", "entropy_mean", "composition"]
    return profile.join(top, "cluster").select(*cols).orderBy(F.desc("n_docs"), "cluster")


def _with_text(rows: DataFrame, texts: DataFrame | None) -> tuple[DataFrame, Column]:
    """A few dozen ranked documents with their text, and the text column.

    Staged, so that the ranking runs once; broadcast, so that texts are only scanned.
    """
    if texts is None:
        return rows, F.lit(None).cast("string")
    rows = stage(rows.drop("embedding"), "ranked")
    found = texts.select("id", "text").join(F.broadcast(rows.select("id")), "id", "left_semi")
    return rows.join(found, "id", "left"), F.col("text")


def _documents(ranked: DataFrame, texts: DataFrame | None) -> DataFrame:
    top5 = F.transform(
        top_clusters("u", 5), lambda s: F.struct(s["cluster"].alias("cluster"), F.round(s["u"], 4).alias("u"))
    )
    rows, text = _with_text(ranked.filter(F.col("rank") <= PROFILE_DOCS), texts)
    return rows.select(
        F.col("hard_cluster").alias("cluster"),
        "rank",
        "id",
        "doc_id",
        "category",
        F.round("top_conf", 4).alias("conf_in_cluster"),
        F.round("entropy", 4).alias("entropy"),
        top5.alias("top5_memberships"),
        preview(text, 250).alias("text_preview"),
    )


def _ranked(assigned: DataFrame, by: Column) -> DataFrame:
    # The rank limit also runs before the shuffle: a task sends three rows per cluster.
    order = W.partitionBy("hard_cluster").orderBy(by, "id")
    return assigned.withColumn("rank", F.row_number().over(order))


def core_docs(assigned: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """The three documents of each cluster that belong to it most."""
    return _documents(_ranked(assigned, F.desc("top_conf")), texts)


def boundary_docs(assigned: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """The three documents of each cluster with the highest entropy."""
    return _documents(_ranked(assigned, F.desc("entropy")), texts)


def nested_profiles(assigned: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Profiles with their breakdown, core and boundary documents nested.

    What is gathered per cluster is bounded: its categories, and three documents.
    """
    breakdown = category_breakdown(assigned)

    def gathered(docs: DataFrame, name: str) -> DataFrame:
        fields = [c for c in docs.columns if c not in ("cluster", "id")]
        return docs.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))

    per_category = breakdown.groupBy("cluster").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "category"))).alias("b")
    )
    per_category = per_category.select(
        "cluster",
        F.transform("b", lambda s: F.struct(s["category"].alias("category"), (-s["neg"]).alias("n"))).alias(
            "category_breakdown"
        ),
    )
    return (
        cluster_profile(assigned)
        .join(per_category, "cluster")
        .join(gathered(core_docs(assigned, texts), "core_docs"), "cluster")
        .join(gathered(boundary_docs(assigned, texts), "boundary_docs"), "cluster")
    )


def boundary_cases(assigned: DataFrame, texts: DataFrame | None = None, n: int = BOUNDARY_CASES) -> DataFrame:
    """The ``n`` documents of highest entropy in the corpus."""
    top, text = _with_text(assigned.orderBy(F.desc("entropy"), "id").limit(n), texts)
    top5 = F.transform(
        top_clusters("u", 5), lambda s: F.struct(s["cluster"].alias("cluster"), F.round(s["u"], 4).alias("u"))
    )
    return top.select(
        "id",
        "doc_id",
        "category",
        F.round("entropy", 4).alias("entropy"),
        top5.alias("top5_memberships"),
        preview(text, 350).alias("text_preview"),
    )


def centroid_pairs(centroids: DataFrame, dominants: DataFrame, n: int = CENTROID_PAIRS) -> DataFrame:
    """The ``n`` most similar pairs of clusters, with their dominant categories.

    Pairs are unfolded from one row that holds the centroids, of which there are as
    many as clusters.
    """
    gathered = centroids.agg(
        F.array_sort(F.collect_list(F.struct("cluster", "centroid"))).alias("all")
    )
    first = gathered.select("all", F.explode("all").alias("a"))
    later = F.filter("all", lambda b: b["cluster"] > F.col("a.cluster"))
    pairs = first.select("a", F.explode(later).alias("b")).select(
        F.col("a.cluster").alias("c1"),
        F.col("b.cluster").alias("c2"),
        dot("a.centroid", "b.centroid").alias("sim"),
    )
    top = pairs.orderBy(F.desc("sim"), "c1", "c2").limit(n)
    names = dominants.select("cluster", "dominant_category")
    one = names.select(F.col("cluster").alias("c1"), F.col("dominant_category").alias("c1_dom"))
    two = names.select(F.col("cluster").alias("c2"), F.col("dominant_category").alias("c2_dom"))
    return (
        top.join(one, "c1", "left")
        .join(two, "c2", "left")
        .select(
            "c1",
            "c2",
            F.coalesce("c1_dom", F.lit("?")).alias("c1_dom"),
            F.coalesce("c2_dom", F.lit("?")).alias("c2_dom"),
            F.round("sim", 5).alias("sim"),
        )
    )

"""The workflows end to end: build a store, append to it, cluster it, answer queries, calibrate the cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.functions.vectors import dot
from textorbit.operators import kselect, profile, search, vmf
from textorbit.operators.corpus import build_corpus
from textorbit.operators.kmeans import fit_kmeans
from textorbit.operators.lsa import fit_lsa
from textorbit.session import spread, stage, staging
from textorbit.sources.posts import read_posts
from textorbit.sources.store import Store, read_centroids, read_store, write_clusters, write_store
from textorbit.streaming.cache import THETAS, SemanticCache, explore_threshold

N_CLUSTERS = 17


def build_store(spark: SparkSession, posts: str | DataFrame, path: str, **lsa_args) -> Store:
    """From a directory of posts (or a ``category, doc_id, raw`` table) to a written store."""
    raw = read_posts(spark, posts) if isinstance(posts, str) else posts
    with staging(spark):
        docs = spread(stage(build_corpus(raw), "corpus"))
        model, embeddings = fit_lsa(docs, keep=("id", "category"), **lsa_args)
        write_store(path, docs, model, embeddings)
    return read_store(spark, path)


def build_clusters(
    store: Store,
    path: str,
    k: int = N_CLUSTERS,
    ks=tuple(range(8, 28, 2)),
    gap_ks=tuple(range(8, 24, 2)),
    n_refs: int = 10,
    n_init: int = 10,
) -> None:
    """Score candidate cluster numbers, fit ``k`` soft clusters, and write all findings.

    The scores are evidence for a person; ``k`` is what is fitted. The concentration is
    the one selected on a k-means solution.
    """
    spark = store.corpus.sparkSession
    with staging(spark):
        docs = stage(store.embeddings.join(store.corpus.select("id", "doc_id"), "id"), "points")
        points = docs.select("id", "embedding")
        sweep = kselect.k_sweep(points, ks)
        gaps = kselect.gap_table(points, gap_ks, n_refs)
        start = vmf.unit_rows(fit_kmeans(points, k, n_init=n_init).centers)
        kappas = vmf.kappa_table(docs, start)
        kappa = float(vmf.select_kappa(kappas, k))
        centroids = vmf.fit_vmf(points, k, kappa, start=start)
        # Memberships are computed once; all findings read them.
        assigned = stage(vmf.assign(docs, centroids, kappa).drop("embedding"), "assigned")
        write_clusters(path, assigned, centroids, kappa)
        profiles = profile.cluster_profile(assigned)
        pairs = profile.centroid_pairs(vmf.centroid_frame(spark, centroids), profiles)
        votes = kselect.sweep_votes(sweep).select("*", kselect.gap_choice(gaps).scalar().alias("gap"))
        tables = {
            "k_sweep": sweep,
            "gap": gaps,
            "votes": votes,
            "kappa": kappas,
            "summary": vmf.confidence_bands(assigned),
            "profiles": profile.nested_profiles(assigned, store.texts),
            "boundary_cases": profile.boundary_cases(assigned, store.texts),
            "centroid_pairs": pairs,
        }
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")


def open_cache(store: Store, clusters: str, path: str | None = None, **settings) -> SemanticCache:
    """A cache over a store and its clusters; ``path`` keeps it across sessions."""
    spark = store.corpus.sparkSession
    centroids, kappa = read_centroids(spark, clusters)

    def find(misses: DataFrame) -> DataFrame:
        hits = search.top_k(misses, store.embeddings)
        asked = misses.filter("return_text").select("query_id")
        if not asked.head(1):
            return search.hit_rows(hits, store.corpus)
        rows = search.hit_rows(hits, store.corpus, store.texts)
        flags = asked.withColumn("_asked", F.lit(True))
        shown = F.when(F.col("_asked"), F.col("text"))
        return rows.join(flags, "query_id", "left").withColumn("text", shown).drop("_asked")

    return SemanticCache(spark, centroids, find, **{"kappa": kappa, "path": path, **settings})


def answer(requests: DataFrame, store: Store, cache: SemanticCache) -> tuple[DataFrame, DataFrame]:
    """Decide a batch of ``(query_id, ts, query[, top_k, category, return_text])``.

    Returns decisions with results, and the rejected requests with their reason.
    """
    valid, rejected = search.validate_queries(requests, store.corpus)
    return cache.process(search.embed_queries(valid, store.model)), rejected


def explore_text_pairs(pairs: DataFrame, store: Store, thetas=THETAS) -> DataFrame:
    """Judge cache thresholds on labelled pairs of texts ``(query_a, query_b, should_hit)``.

    Both texts are embedded where the pair is; nothing is shuffled but the counts.
    """
    both = store.model.embed(store.model.embed(pairs, "query_a", "_a"), "query_b", "_b")
    return explore_threshold(both.select("should_hit", dot("_a", "_b").alias("sim")), thetas)

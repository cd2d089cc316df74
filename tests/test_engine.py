"""The workflows end to end, and the registered queries on the smallest data."""

import numpy as np
import pytest
from check_oracles import database, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry
from textorbit.plans import engine, inputs

SF = "/root/testdata/sf0.001"
# Spark and SQL results of these are compared on every run; all others by check_oracles.py.
COMPARED = [
    "clean_posts", "load_report", "dedup_first", "tfidf_weights", "valid_queries", "rejected_queries",
    "add_documents_dedup", "vector_topk_filtered", "doc_clusters", "kappa_select", "vmf_em_step", "cluster_profile",
    "core_docs", "boundary_cases", "centroid_pairs", "silhouette", "gap_curve", "gap_rule", "threshold_explore", "cache_lookup",
    "cache_evicting", "cache_stream", "cache_peek", "vmf_em_rounds", "kmeans_rounds", "profile_cells", "vector_topk_blocks",
    "store_append", "lsa_axes", "lsa_axes_embeddings", "lsa_axes_search",
]


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, SF), database(SF), entry.oracle_sql()[name]) == []


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    space = inputs.text_space(spark, SF)
    asked = inputs.table(spark, SF, "benchmark").orderBy("item_id")
    q = np.stack([r.embedding for r in space.model.embed(asked).orderBy("item_id").collect()]).astype(float)
    d = np.stack([r.embedding for r in space.embeddings.collect()]).astype(float)
    best = -np.sort(-(q @ d.T), axis=1)[:, :10]
    got = {(r.query_id, r["rank"]): r.score for r in rows}
    assert len(rows) == best.size
    ids = [r.item_id for r in asked.collect()]
    for n, item in enumerate(ids):
        assert [got[item, k] for k in range(1, 11)] == pytest.approx(best[n].tolist(), abs=1e-6)


def test_build_cluster_answer(spark, tmp_path):
    posts = inputs.plain_posts(spark, SF)
    store = engine.build_store(spark, posts, str(tmp_path / "store"), dims=32)
    n = store.corpus.count()
    assert n == store.embeddings.count() and store.model.dims == 32
    engine.build_clusters(store, str(tmp_path / "clusters"), k=4, ks=(3, 4), gap_ks=(2, 3), n_refs=2, n_init=2)

    def written(name):
        return spark.read.parquet(str(tmp_path / "clusters" / name))

    assert written("doc_clusters").count() == written("memberships").count() == n
    assert written("profiles").agg(F.sum("n_docs")).first()[0] == n
    assert written("votes").first().gap in (2, 3) and written("kappa").filter("conf_gt07 >= 0").count() == 7
    assert written("boundary_cases").filter("text_preview <> ''").count() == 25

    cache = engine.open_cache(store, str(tmp_path / "clusters"), str(tmp_path / "cache"))
    docs = store.texts.join(store.corpus, "id").orderBy("id").limit(12).collect()
    rows = [(i, d.text, 2, d.category if i % 2 else None, i % 3 == 0) for i, d in enumerate(docs)]
    rows += [(100 + i, " ".join(reversed(d.text.split())), 2, None, False) for i, d in enumerate(docs)]
    rows += [(200, "qqqq zzzz", None, None, None), (201, "", None, None, None), (202, "x", 3, "nowhere", None)]
    requests = spark.createDataFrame(
        rows, "query_id long, query string, top_k int, category string, return_text boolean"
    ).withColumn("ts", F.timestamp_seconds("query_id"))
    decisions, rejected = engine.answer(requests, store, cache)
    got = {r.query_id: r for r in decisions.collect()}
    assert sorted(r.query_id for r in rejected.collect()) == [201, 202]
    for i, d in enumerate(docs):
        first = got[i]
        if not first.cache_hit:
            assert first.result[0].id == d.id and first.result[0].score == pytest.approx(1, abs=1e-5)
            assert len(first.result) == 2 and (first.result[0].text is not None) == (i % 3 == 0)
            if i % 2:
                assert {h.category for h in first.result} == {d.category}
    # An unknown query is near nothing; its scores are zero and rank by id.
    assert not got[200].cache_hit and got[200].similarity_score == 0.0
    assert [h.score for h in got[200].result] == [0.0] * 10
    again, _ = engine.answer(requests.withColumn("query_id", F.col("query_id") + 1000), store, cache)
    assert again.filter("query_id < 1012 and not cache_hit").count() == 0

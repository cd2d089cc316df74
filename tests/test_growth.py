"""Inputs of many files, and work that may not grow faster than they do."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from textorbit.functions import terms, vectors
from textorbit.operators import corpus, search, tfidf
from textorbit.streaming import cache as ca

SF = "/root/testdata/sf0.001"


def test_stream_reads_a_folder_of_files(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").filter("vec_id < 60")
    rows.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    columns = ["query_id", "cache_hit", "matched_query", "similarity_score"]
    streamed = entry.queries()["cache_stream"](spark, str(tmp_path)).select(columns).orderBy("query_id").collect()
    assert len(streamed) == 60
    assert streamed == entry.queries()["cache_replay"](spark, str(tmp_path)).select(columns).orderBy("query_id").collect()


def test_partial_sums_of_a_pass_are_added_by_tasks(spark, monkeypatch):
    asked = []
    added = vectors.sum_by_key
    monkeypatch.setattr(vectors, "sum_by_key", lambda *args: asked.append(args[-1]) or added(*args))

    def partial(batches):
        rows = sum(batch.num_rows for batch in batches)
        yield from vectors.keyed_sums(np.arange(500), np.full((500, 60), float(rows)))

    total = vectors.collect_sums(spark.range(0, 40, 1, 4).mapInArrow(partial, vectors.SUMS), 500, 60)
    assert asked == [1] and (total == 40).all()


def test_rounds_of_the_cache_broadcast_no_rows(spark):
    state = spark.createDataFrame([(0, True), (1, None), (2, None)], "seq long, miss boolean")
    edges = spark.createDataFrame([(1, [0], False), (2, [1], False)], "seq long, earlier array<long>, cut boolean")
    settled = ca.settle(state, edges)
    assert sorted(map(tuple, settled.collect())) == [(0, True), (1, False), (2, None)]
    assert "Broadcast" not in settled._jdf.queryExecution().executedPlan().toString()
    rows, entries = spark.range(3).select(F.col("id").alias("query_id"), F.lit("a").alias("entry_id")), spark.createDataFrame([("a", 1)], "entry_id string, n int")
    joined = ca.SemanticCache._with_entry(rows, entries)
    assert [r.n for r in joined.collect()] == [1, 1, 1]
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_blocks_ask_for_every_vector(spark):
    got = {(r.query_id, r["rank"]): r.score for r in entry.queries()["vector_topk_blocks"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").toArrow().sort_by("vec_id")
    ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
    x = vectors.to_matrix(rows.column("embedding"), 64)
    scores = np.where((ids[:, None] % 3 == 0) | (labels[:, None] == labels), x @ x.T, -np.inf)
    best = -np.sort(-scores, axis=1)[:, :5]
    want = {(int(i), r + 1): best[at, r] for at, i in enumerate(ids) for r in range(5) if best[at, r] > -np.inf}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_small_blocks_and_shards_are_joined_where_there_are_many(spark, monkeypatch):
    x = vectors.unit_rows(np.random.default_rng(6).standard_normal((300, 8))).astype(np.float32)
    ids = [f"{i:03d}" for i in range(300)]
    docs = spark.createDataFrame(pa.table({"id": ids, "category": ["a"] * 300, "embedding": vectors.to_lists(x)}))
    wanted = pa.array([None, "a"] * 150, pa.string())
    ask = spark.createDataFrame(pa.table({"query_id": list(range(300)), "embedding": vectors.to_lists(x), "top_k": [3] * 300, "category": wanted}))
    made = []
    stage = search.stage
    monkeypatch.setattr(search, "stage", lambda df, name: made.append((name, stage(df, name))) or made[-1][1])
    hits = search.top_k(ask, docs, max_block=2, shard_docs=3)
    cuts = {name: [r[-1] for r in df.collect()] for name, df in made}
    assert cuts["query-blocks"] == [16, 16] and cuts["document-shards"] == [16]
    want = np.argsort(-np.round(x.astype(float) @ x.astype(float).T, 12), axis=1, kind="stable")[:, :3]
    assert sorted((r.query_id, r["rank"], int(r.id)) for r in hits.collect()) == [(q, k + 1, int(want[q, k])) for q in range(300) for k in range(3)]
    monkeypatch.setattr(search, "MAX_BLOCK_QUERIES", 5)
    monkeypatch.setattr(search, "SHARD_DOCS", 10)
    made.clear()
    assert search.top_k(ask, docs, max_block=2, shard_docs=3).count() == 900
    assert [[r[-1] for r in df.collect()] for name, df in made if name != "queries"] == [[30, 30], [30]]


def test_lookup_cleans_posts_once(spark, monkeypatch):
    calls = []
    clean = corpus.clean_posts
    monkeypatch.setattr(corpus, "clean_posts", lambda *args, **more: calls.append(1) or clean(*args, **more))
    assert entry.queries()["doc_lookup"](spark, SF).count() > 0 and calls == [1]


def test_weights_are_made_for_a_few_rows_at_a_time(monkeypatch):
    tokens = pa.array([["aa", "bb", "aa"], [], None, ["bb", "cc"], ["cc", "aa", "bb", "zz"]])
    names, idf = pa.array(["aa", "aa bb", "bb", "cc"]), np.array([1.0, 2.0, 1.5, 3.0])
    whole, sizes, made = tfidf._weigh(tokens, names, idf), [], tfidf._weigh
    monkeypatch.setattr(terms, "TOKENS_AT_ONCE", 3)
    monkeypatch.setattr(tfidf, "_weigh", lambda part, *more: sizes.append(len(part)) or made(part, *more))
    got = tfidf._weigh_parts(tokens, names, idf)
    assert max(sizes) < len(tokens) and sum(sizes) == len(tokens)
    for a, b in zip(got.to_pylist(), whole.to_pylist()):
        assert a["term_ids"] == b["term_ids"] and a["weights"] == pytest.approx(b["weights"])

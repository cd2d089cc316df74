"""Versions of a store, the life of staged tables, files that cannot be read, thresholds from texts."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textorbit import session
from textorbit.operators import search as se
from textorbit.plans import engine, inputs
from textorbit.session import stage, staged_paths, staging, unstage
from textorbit.sources import store as st
from textorbit.sources.posts import read_posts, unreadable_posts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "store")
    return engine.build_store(spark, inputs.plain_posts(spark, SF), path, dims=16, n_iter=1)


def counts(store):
    return [t.count() for t in (store.corpus, store.texts, store.embeddings, store.category_index)]


def test_append_is_found_and_old_versions_stay(spark, built):
    first = counts(built)
    assert len(set(first)) == 1
    text = built.texts.orderBy("id").first().text
    new = spark.createDataFrame(
        [(text + " once more", "fresh", "n1"), (text + " and twice", "fresh", None), ("qqqq zzzz", "odd", None)],
        "text string, category string, doc_id string",
    )
    after = st.append_documents(built, new)
    assert after.version == built.version + 1 and counts(after) == [n + 3 for n in first]
    assert counts(st.read_store(spark, built.path, built.version)) == first
    queries = spark.createDataFrame([(1, text + " once more", 2, "fresh")], "query_id long, query string, top_k int, category string")
    hits = se.search(queries, after.model, after.embeddings, after.corpus, after.texts).orderBy("rank").collect()
    assert {h.doc_id for h in hits} == {"n1", "custom"} and hits[0].score == pytest.approx(1, abs=1e-6)
    assert hits[0].doc_id == "n1" and hits[0].text == text + " once more"
    # A text without known words has a zero vector; names and index are there.
    odd = after.corpus.filter("category = 'odd'").first()
    assert after.category_index.filter("category = 'odd'").first().id == odd.id
    assert not np.any(after.embeddings.filter(F.col("id") == odd.id).first().embedding)
    # What is stored already can be left out.
    again = st.append_documents(after, new, dedup=True)
    assert again.version == after.version + 1 and counts(again) == counts(after)
    # A writer that has missed a version does not overwrite it.
    with pytest.raises(RuntimeError, match="not the latest"):
        st.append_documents(after, new)


def test_failed_append_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    store = engine.build_store(spark, inputs.plain_posts(spark, SF), str(tmp_path / "store"), dims=8, n_iter=1)
    before, new = counts(store), spark.createDataFrame([("some text", "c")], "text string, category string")
    written = st._write_part

    def breaks(*args):
        written(*args)
        raise OSError("disk full")

    monkeypatch.setattr(st, "_write_part", breaks)
    with pytest.raises(OSError, match="disk full"):
        st.append_documents(store, new)
    monkeypatch.undo()
    again = st.read_store(spark, store.path)
    assert again.version == 0 and counts(again) == before
    assert counts(st.append_documents(again, new)) == [n + 1 for n in before]


def test_category_filter_prunes_files(spark, built):
    store = st.read_store(spark, built.path)
    plan = store.embeddings.filter("category = 'src1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "category" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_scopes_remove_what_they_staged(spark, tmp_path):
    kept = staged_paths(spark)
    outside = stage(spark.range(5), "outside")
    with staging(spark):
        inside = stage(spark.range(3), "inside")
        with staging(spark):
            assert stage(spark.range(2), "inner").count() == 2
        assert len(staged_paths(spark)) == len(kept) + 2 and inside.count() == 3
    assert staged_paths(spark) == [*kept, outside._staged_at]
    with pytest.raises(Exception):
        inside.count()
    unstage(outside, spark.range(1))
    assert staged_paths(spark) == kept
    # Building a store and clusters leaves nothing staged.
    store = engine.build_store(spark, inputs.plain_posts(spark, SF), str(tmp_path / "s"), dims=4, n_iter=1)
    engine.build_clusters(store, str(tmp_path / "c"), k=2, ks=(2,), gap_ks=(2, 3), n_refs=1, n_init=1)
    assert staged_paths(spark) == kept
    folder = session.shared_folder(spark)
    assert not [f for f in os.listdir(f"{folder}/textorbit") if f.startswith(("assigned-", "points-", "sparse_rows-")) and f"{folder}/textorbit/{f}" not in kept]


def test_unreadable_posts_are_listed(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("1", "2", "3"):
        (tmp_path / "a" / name).write_bytes(b"x" + name.encode())
    # A checksum that does not fit makes the file unreadable.
    (tmp_path / "a" / ".2.crc").write_bytes(b"crc\x00\x00\x00\x02\x00" + (zlib.crc32(b"other")).to_bytes(4, "big"))
    with pytest.raises(Exception, match="(?i)checksum"):
        read_posts(spark, str(tmp_path)).collect()
    assert sorted(r.raw for r in read_posts(spark, str(tmp_path), True).collect()) == ["x1", "x3"]
    (bad,) = unreadable_posts(spark, str(tmp_path)).collect()
    assert (bad.category, bad.doc_id) == ("a", "2") and bad.path.endswith("/a/2")


def test_thresholds_from_pairs_of_texts(spark, built):
    texts = [r.text for r in built.texts.orderBy("id").limit(6).collect()]
    pairs = [(t, " ".join(reversed(t.split())), True) for t in texts[:3]] + [(texts[0], "qqqq", False), ("", texts[1], False)]
    frame = spark.createDataFrame(pairs, "query_a string, query_b string, should_hit boolean")
    rows = {r.theta: r for r in engine.explore_text_pairs(frame, built, (0.01, 0.5, 1.1)).collect()}
    vectors = {k: np.stack([np.array(r[k]) for r in built.model.embed(frame, f"query_{k}", k).collect()]) for k in "ab"}
    sims = (vectors["a"].astype(float) * vectors["b"]).sum(axis=1)
    for theta, row in rows.items():
        assert (row.tp, row.fp) == (int((sims[:3] >= theta).sum()), int((sims[3:] >= theta).sum()))
    assert rows[0.01].fp == 0 and rows[0.01].tp >= 1 and rows[1.1].tp == 0


def test_requests_keep_their_other_columns(spark):
    docs = spark.createDataFrame([("x",)], "category string")
    rows = [(i, "q", None, "x" if i % 4 == 0 else None, None, f"extra{i}") for i in range(8)] + [(9, " ", None, None, None, "bad")]
    frame = spark.createDataFrame(rows, "query_id long, query string, top_k int, category string, return_text boolean, tag string")
    valid, rejected = se.validate_queries(frame, docs)
    assert {(r.query_id, r.tag) for r in valid.collect()} == {(i, f"extra{i}") for i in range(8)}
    assert [(r.query_id, r.tag) for r in rejected.collect()] == [(9, "bad")]

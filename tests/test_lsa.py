"""The distributed SVD and embeddings against numpy."""

import numpy as np
import pyarrow as pa
import pytest

from textorbit.functions.vectors import to_lists
from textorbit.operators import lsa, tfidf
from textorbit.sources.store import read_store, write_store


def rows_of(spark, dense, n_parts):
    keep = [np.flatnonzero(r) for r in dense]
    table = pa.table(
        {
            "id": [str(i) for i in range(len(dense))],
            "term_ids": pa.array([k.tolist() for k in keep], pa.list_(pa.int32())),
            "weights": pa.array([dense[i, k].tolist() for i, k in enumerate(keep)], pa.list_(pa.float64())),
        }
    )
    return spark.createDataFrame(table).repartition(n_parts)


@pytest.mark.parametrize("n_parts", [1, 5])
def test_low_rank_matrix_is_recovered(spark, n_parts):
    rng = np.random.default_rng(1)
    dense = rng.random((60, 6)) @ rng.random((6, 90))
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    basis, explained = lsa.fit_basis(rows_of(spark, dense, n_parts), 90, 60, 60, dims=6)
    assert basis.shape == (90, 6)
    assert np.allclose(basis.T @ basis, np.eye(6), atol=1e-8)
    assert np.allclose(dense @ basis @ basis.T, dense, atol=1e-6)
    assert abs(explained - 1.0) < 1e-6


def test_explained_variance_near_exact(spark):
    rng = np.random.default_rng(2)
    dense = np.where(rng.random((300, 200)) < 0.1, rng.random((300, 200)), 0.0)
    dense[7] = 0.0
    norm = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = dense / np.where(norm == 0, 1, norm)
    _, explained = lsa.fit_basis(rows_of(spark, dense, 3), 200, 300, int((norm > 0).sum()), dims=40)
    v = np.linalg.svd(dense, full_matrices=False)[2][:40].T
    exact = (dense @ v).var(axis=0).sum() / dense.var(axis=0).sum()
    assert abs(explained - exact) < 0.03 * exact


TEXTS = ["alpha beta gamma", "alpha beta delta alpha", "gamma delta epsilon zeta", "beta gamma zeta alpha", "delta zeta epsilon"]


def test_weights_and_embedding(spark, tmp_path):
    docs = spark.createDataFrame(
        [(str(i), str(i), "c%d" % (i % 2), t, len(t.split())) for i, t in enumerate(TEXTS)],
        "id string, doc_id string, category string, text string, n_tokens int",
    )
    model, embeddings = lsa.fit_lsa(docs, dims=3, min_df=1, max_df=1.0)
    names = model.vocab.column("term").to_pylist()
    assert names == sorted(names)
    idf = dict(zip(names, model.vocab.column("idf").to_pylist()))
    assert idf["alpha"] == pytest.approx(np.log(6 / 4) + 1)
    tf = {"alpha": 2, "beta": 1, "delta": 1, "alpha beta": 1, "beta delta": 1, "delta alpha": 1}
    raw = {t: (1 + np.log(c)) * idf[t] for t, c in tf.items()}
    norm = np.sqrt(sum(w * w for w in raw.values()))
    got = tfidf.weight_table(tfidf.sparse_rows(docs, model.vocab)).filter("id = '1'").collect()
    assert {names[r.term_id]: r.weight for r in got} == pytest.approx({t: w / norm for t, w in raw.items()})
    vectors = {r.id: np.array(r.embedding) for r in embeddings.collect()}
    assert all(abs(np.linalg.norm(v) - 1) < 1e-6 for v in vectors.values())
    asked = spark.createDataFrame([("a", TEXTS[1]), ("b", "unknown words only"), ("c", "")], "id string, text string")
    found = {r.id: np.array(r.embedding) for r in model.embed(asked).collect()}
    assert np.allclose(found["a"], vectors["1"]) and not found["b"].any() and not found["c"].any()

    path = str(tmp_path / "store")
    write_store(path, docs, model, embeddings)
    store = read_store(spark, path)
    again = {r.id: np.array(r.embedding) for r in store.model.embed(asked).collect()}
    assert np.allclose(again["a"], found["a"]) and len(again["b"]) == len(found["b"])
    assert store.corpus.count() == store.texts.count() == store.embeddings.count() == 5
    assert store.model.explained_variance == pytest.approx(model.explained_variance)


def test_vocabulary_bounds_and_ties(spark):
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "id string, text string")
    vocab = tfidf.fit_vocab(docs, max_features=2, min_df=2, max_df=0.6).orderBy("term_id").collect()
    # alpha (total 4, df 3) leads; beta, delta, gamma and zeta tie at 3: the alphabet decides.
    assert [(r.term, r.term_id, r.df, r.total) for r in vocab] == [("alpha", 0, 3, 4), ("beta", 1, 3, 3)]
    assert to_lists(np.eye(2)).to_pylist() == [[1.0, 0.0], [0.0, 1.0]]


def test_rows_are_added_piece_by_piece():
    rng = np.random.default_rng(4)
    for n in (0, 1, 256, 700):
        total = rng.standard_normal((900, 6))
        rows, values, last = rng.permutation(900)[:n], rng.standard_normal((n, 5)).astype(np.float32), rng.standard_normal(n)
        want = total.copy()
        want[rows, :5] += values
        want[rows, 5] += last
        lsa._add_rows(total, rows, values, last)
        assert (total == want).all()


def test_chunks_multiply_like_dense_rows_without_wide_blocks(monkeypatch):
    rng = np.random.default_rng(8)
    dense = np.where(rng.random((300, 400)) < rng.random(400) ** 8 * 0.6, rng.random((300, 400)), 0.0)
    dense[[0, 7, 299]] = 0.0
    lengths, ids, weights = (dense > 0).sum(axis=1), np.nonzero(dense)[1].astype(np.int32), dense[dense > 0]
    basis = rng.standard_normal((400, 9))
    want = np.concatenate([dense.T @ (dense @ basis), dense.sum(axis=0)[:, None]], axis=1)
    for rows, entries, cells, at_once in ((4096, 1 << 20, 1 << 23, 256), (70, 500, 300, 8), (1, 1, 0, 1)):
        for name, value in (("ROWS", rows), ("ENTRIES", entries), ("CELLS", cells)):
            monkeypatch.setattr(lsa, f"_CHUNK_{name}", value)
        monkeypatch.setattr(lsa, "_ROWS_AT_ONCE", at_once)
        total, scores = np.zeros((400, 10)), np.zeros((300, 9))
        for lo, hi, chunk in lsa._chunks(lengths, ids, weights):
            # Only terms of many of its rows take a column of a block, not every term of the chunk.
            assert chunk.block.size <= max(cells, 0) and (chunk.n < 200 or len(chunk.common) < 0.7 * len(chunk.terms))
            scores[lo:hi] = chunk.times(basis)
            chunk.add_transposed(scores[lo:hi], total)
        assert np.allclose(scores, dense @ basis, atol=1e-12) and np.allclose(total, want, atol=1e-11)


def test_packed_rows_are_the_lists_as_bytes(spark):
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate([*TEXTS, "", None, "nothing known"])], "id string, text string")
    vocab = tfidf.collect_vocab(tfidf.fit_vocab(docs, min_df=1, max_df=1.0))
    vocab = vocab.filter(pa.compute.not_equal(vocab.column("term"), "nothing")).slice(0, 9)
    lists = tfidf.sparse_rows(docs, vocab).toArrow().sort_by("id").combine_chunks()
    packed = tfidf.sparse_rows(docs, vocab, packed=True)
    assert dict(packed.dtypes)["term_ids"] == dict(packed.dtypes)["weights"] == "binary"
    packed = packed.toArrow().sort_by("id").combine_chunks()
    for at, n in ((0, 8), (2, 5), (5, 3), (8, 0)):
        parts = [lsa._sparse_parts(*(t.column(c).chunk(0).slice(at, n) for c in ("term_ids", "weights"))) for t in (lists, packed)]
        assert all(np.array_equal(a, b) for a, b in zip(*parts)) and len(parts[0][0]) == n

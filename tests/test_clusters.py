"""Clustering, K selection and profiles against numpy on small data."""

import numpy as np
import pyarrow as pa
import pytest

from textorbit.functions.vectors import to_lists, unit_rows
from textorbit.operators import kmeans as km
from textorbit.operators import kselect as ks
from textorbit.operators import profile as pr
from textorbit.operators import vmf
from textorbit.operators.medians import exact_medians
from textorbit.sources.store import read_centroids, write_clusters


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    centers = unit_rows(rng.standard_normal((4, 12)))
    # One cluster holds half of the points.
    label = np.concatenate([np.zeros(90, int), rng.integers(0, 4, 90)])
    x = unit_rows(centers[label] + 0.15 * rng.standard_normal((180, 12))).astype(np.float32)
    table = pa.table(
        {
            "id": [f"{i:03d}" for i in range(180)],
            "doc_id": [f"f{i}" for i in range(180)],
            "category": [f"c{l}" for l in label],
            "embedding": to_lists(x),
        }
    )
    return spark.createDataFrame(table).repartition(5), x.astype(float), label


def assign(x, centers):
    return ((x[:, None, :] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)


def test_kmeans_reaches_a_fixed_point(blobs):
    frame, x, label = blobs
    fit = km.fit_kmeans(frame, 4, n_init=4)
    found = assign(x, fit.centers)
    means = np.stack([x[found == c].mean(axis=0) for c in range(4)])
    assert np.allclose(means, fit.centers, atol=1e-3)
    assert fit.inertia == pytest.approx(((x - fit.centers[found]) ** 2).sum())
    assert len({(a, b) for a, b in zip(found, label)}) == 4  # the blobs are recovered
    assert np.allclose(np.sort(fit.sizes), np.sort(np.bincount(label)))


def test_fits_together_equal_fits_alone(blobs):
    frame, _, _ = blobs
    together = km.fit_many(frame, [km.Fit(3, 7), km.Fit(5, 7), km.Fit(3, 8)])
    alone = km.fit_many(frame.repartition(2), [km.Fit(5, 7)])[0]
    assert np.allclose(together[1].centers, alone.centers) and together[1].n_iter == alone.n_iter


def silhouette(x, labels):
    x = unit_rows(x)
    d = 1 - x @ x.T
    np.fill_diagonal(d, 0)
    out = []
    for i, own in enumerate(labels):
        n = (labels == own).sum()
        if n == 1:
            out.append(0.0)
            continue
        a = d[i, labels == own].sum() / (n - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_sweep_metrics(blobs):
    frame, x, _ = blobs
    sweep = ks.k_sweep(frame, ks=(2, 4, 6), n_init=2)
    rows = {r.k: r for r in sweep.collect()}
    best = km.best_fits(km.fit_many(frame.select("id", "embedding"), [km.Fit(k, 42 + i, 200) for k in (2, 4, 6) for i in range(2)]))
    for k in (2, 4, 6):
        labels = assign(x, best[(0, k)].centers)
        assert rows[k].silhouette == pytest.approx(silhouette(x, labels), abs=1e-5)
        means = np.stack([x[labels == c].mean(axis=0) for c in range(k)])
        within = ((x - means[labels]) ** 2).sum()
        between = (np.bincount(labels)[:, None] * (means - x.mean(axis=0)) ** 2).sum()
        assert rows[k].calinski_harabasz == pytest.approx((between / (k - 1)) / (within / (180 - k)), abs=0.01)
    votes = ks.sweep_votes(sweep).first()
    assert votes.silhouette == max(rows, key=lambda k: (rows[k].silhouette, -k))
    assert votes.ch == max(rows, key=lambda k: (rows[k].calinski_harabasz, -k))


def test_gap(spark, blobs):
    frame, _, _ = blobs
    gaps = ks.gap_table(frame, ks=(2, 4, 6), n_refs=3, sample_rows=150)
    curve = {r.k: r for r in gaps.collect()}
    # Up to the four blobs every split pays, after them hardly any.
    assert curve[4].gap - curve[2].gap > 3 * (curve[6].gap - curve[4].gap)
    rule = next((k for k, n in ((2, 4), (4, 6)) if curve[k].gap >= curve[n].gap - curve[n].sk), 6)
    assert ks.gap_choice(gaps).first().optimal_k == rule
    rising = spark.createDataFrame([(2, 0.1, 0.0), (4, 0.5, 0.1), (6, 0.9, 0.1)], "k int, gap double, sk double")
    assert ks.gap_choice(rising).first().optimal_k == 6
    flat = spark.createDataFrame([(2, 0.1, 0.0), (4, 0.5, 0.1), (6, 0.55, 0.1)], "k int, gap double, sk double")
    assert ks.gap_choice(flat).first().optimal_k == 4


def test_references_do_not_depend_on_partitioning(spark):
    low, high = np.zeros(3), np.ones(3)
    a = ks.uniform_references(spark, low, high, 700, 2, 1)
    one = {r.id: tuple(r.embedding) for r in a.coalesce(1).filter("dataset = 2").collect()}
    two = {r.id: tuple(r.embedding) for r in a.filter("dataset = 2").collect()}
    assert one == two and len(one) == 700


def test_soft_em(blobs):
    frame, x, label = blobs
    start = np.stack([x[label == c].mean(axis=0) for c in range(4)])
    got = vmf.fit_vmf(frame.select("id", "embedding"), 4, 15.0, start=start)
    c = unit_rows(start)
    for _ in range(30):
        u = np.exp(15.0 * (x @ c.T))
        u /= u.sum(axis=1, keepdims=True)
        moved = unit_rows(u.T @ x)
        delta, c = np.abs(moved - c).max(), moved
        if delta < 1e-5:
            break
    assert np.allclose(got, c, atol=1e-9)
    warm = vmf.fit_vmf(frame.select("id", "embedding"), 4, 15.0, n_init=3)
    assert len({(a, b) for a, b in zip((x @ warm.T).argmax(axis=1), label)}) == 4


def test_membership_invariants(blobs):
    frame, x, label = blobs
    c = unit_rows(np.stack([x[label == k].mean(axis=0) for k in range(4)]))
    rows = vmf.assign(frame, c, 10.0).collect()
    assert all(abs(sum(r.u) - 1) < 1e-12 and 0 <= r.entropy <= np.log(4) and r.top_conf == max(r.u) for r in rows)
    flat = vmf.assign(frame, c, 1e-9).first()
    assert np.allclose(flat.u, 0.25)
    sharp = vmf.assign(frame, c, 1e6).collect()
    assert all(r.top_conf == pytest.approx(1) and r.entropy == pytest.approx(0) for r in sharp)
    record = vmf.doc_clusters(vmf.assign(frame, c, 10.0)).first()
    assert len(record.memberships) == 4


def test_tied_memberships_go_to_the_lowest_cluster(spark):
    frame = spark.createDataFrame([("z", [0.0, 0.0])], "id string, embedding array<float>")
    row = vmf.assign(frame, np.eye(2), 20.0).first()
    assert row.hard_cluster == 0 and row.u == [0.5, 0.5]


def test_kappa_head_sample(blobs):
    frame, x, label = blobs
    c = unit_rows(np.stack([x[label == k].mean(axis=0) for k in range(4)]))
    table = vmf.kappa_table(frame, c, head_rows=50)
    order = sorted(range(180), key=lambda i: (f"c{label[i]}", f"f{i}"))[:50]
    for r in table.collect():
        u = np.exp(r.kappa * (x[order] @ c.T))
        u /= u.sum(axis=1, keepdims=True)
        h = -(u * np.log(u)).sum(axis=1).mean()
        assert r.entropy_mean == pytest.approx(h, abs=6e-5)
        assert r.in_target_range == (np.log(4) / 3 <= h <= 2 * np.log(4) / 3)
    assert vmf.select_kappa(table, 4) in vmf.KAPPAS


@pytest.mark.parametrize("accuracy", [10_000, 40])
def test_medians(spark, monkeypatch, accuracy):
    """Also with a coarse sketch, so that the bracket is narrower than the groups."""
    monkeypatch.setattr("textorbit.operators.medians.ACCURACY", accuracy)
    rng = np.random.default_rng(5)
    rows = [(0, float(v), 1.0) for v in rng.random(1001)] + [(1, float(v), float(v > 0.3)) for v in rng.random(500)]
    rows += [(2, 0.25, 7.0)] * 600 + [(2, float(v), 7.0) for v in rng.random(300)] + [(3, 5.0, 6.0)]
    frame = spark.createDataFrame(rows, "g int, a double, b double").repartition(4)
    got = {r.g: (r.a_median, r.b_median) for r in exact_medians(frame, "g", ["a", "b"]).collect()}
    for g in range(4):
        own = [r for r in rows if r[0] == g]
        assert got[g] == (np.median([r[1] for r in own]), np.median([r[2] for r in own]))


def test_profiles_and_artifacts(spark, blobs, tmp_path):
    frame, x, label = blobs
    c = unit_rows(np.stack([x[label == k].mean(axis=0) for k in range(4)]))
    assigned = vmf.assign(frame, c, 10.0)
    nested = {r.cluster: r for r in pr.nested_profiles(assigned).collect()}
    hard = (x @ c.T).argmax(axis=1)
    for k in range(4):
        own = np.flatnonzero(hard == k)
        assert nested[k].n_docs == len(own)
        assert sum(b.n for b in nested[k].category_breakdown) == len(own)
        assert [d.rank for d in nested[k].core_docs] == [1, 2, 3]
        assert nested[k].purity == pytest.approx(max(np.bincount(label[own])) / len(own), abs=1e-4)
    assert pr.boundary_cases(assigned, n=10).count() == 10
    empty = spark.createDataFrame([], "cluster int, dominant_category string")
    pairs = pr.centroid_pairs(vmf.centroid_frame(spark, c), empty, n=20).collect()
    assert len(pairs) == 6 and all(p.c1 < p.c2 and p.c1_dom == "?" for p in pairs)
    write_clusters(str(tmp_path / "c"), frame, c, 10.0)
    back, kappa = read_centroids(spark, str(tmp_path / "c"))
    assert np.array_equal(back, c) and kappa == 10.0
    assert spark.read.parquet(str(tmp_path / "c" / "doc_clusters")).count() == 180


def test_label_scores(blobs):
    frame, x, label = blobs
    row = ks.calinski_harabasz(frame, "category").first()
    means = np.stack([x[label == c].mean(axis=0) for c in range(4)])
    within = ((x - means[label]) ** 2).sum()
    between = (np.bincount(label)[:, None] * (means - x.mean(axis=0)) ** 2).sum()
    assert row.calinski_harabasz == pytest.approx((between / 3) / (within / 176))
    names, directions = vmf.mean_directions(frame, "category")
    assert names == ["c0", "c1", "c2", "c3"] and np.allclose(directions, unit_rows(means))

"""Nothing is cut, and rows without a vector do no harm."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textorbit import session
from textorbit.functions.vectors import to_lists, to_matrix, unit_rows
from textorbit.operators import kmeans as km
from textorbit.operators import kselect as ks
from textorbit.operators import search as se
from textorbit.operators import vmf
from textorbit.sources.posts import read_posts

REPO = str(Path(__file__).resolve().parents[1])


def vectors(spark, x, start=0):
    ids = [f"{i + start:05d}" for i in range(len(x))]
    return spark.createDataFrame(pa.table({"id": ids, "category": ["c"] * len(x), "embedding": to_lists(x.astype(np.float32))}))


def ask(spark, rows):
    return spark.createDataFrame(rows, "query_id long, embedding array<float>, top_k int, category string")


def test_a_query_gets_as_many_hits_as_it_asks_for(spark):
    x = unit_rows(np.random.default_rng(0).standard_normal((500, 8)))
    docs = vectors(spark, x).repartition(4)
    queries = ask(spark, [(1, x[0].tolist(), 300, None), (2, x[1].tolist(), 2, None), (3, x[2].tolist(), 1000, "c")])
    for block in (4096, 1):
        counts = {r.query_id: r.n for r in se.top_k(queries, docs, max_block=block, shard_docs=90).groupBy("query_id").agg(F.count("*").alias("n")).collect()}
        assert counts == {1: 300, 2: 2, 3: 500}


def test_null_vectors_take_no_part(spark):
    docs = spark.createDataFrame(
        [("a", "c", None), ("b", "c", [1.0, 0.0]), ("c", "c", [0.0, 1.0])], "id string, category string, embedding array<float>"
    )
    hits = se.top_k(ask(spark, [(1, [1.0, 0.0], 5, None), (2, None, 5, None)]), docs).orderBy("rank").collect()
    assert [(r.query_id, r.id, r.score) for r in hits] == [(1, "b", 1.0), (1, "c", 0.0)]
    centers = np.eye(2)
    rows = {r.id: r.u for r in vmf.assign(docs.coalesce(1), centers, 5.0).collect()}
    assert rows["a"] is None and rows["b"][0] > 0.9 and rows["c"][1] > 0.9
    assert np.allclose(vmf.soft_sums(docs, centers, 5.0).sum(axis=0), [1, 1])
    fit = km.fit_kmeans(docs, 2, n_init=2)
    assert sorted(fit.sizes.tolist()) == [1, 1]
    table = vmf.kappa_table(docs.withColumn("doc_id", F.col("id")), centers, (5, 50)).collect()
    assert table[1].conf_gt07 == 2


def test_vectors_of_another_length_are_refused():
    with pytest.raises(ValueError):
        to_matrix(pa.array([[1.0, 2.0], [1.0], [1.0, 2.0, 3.0]], pa.list_(pa.float64())), 2)
    with pytest.raises(ValueError):
        to_matrix(pa.array([None, [1.0, 2.0]], pa.list_(pa.float64())), 2)


def test_an_id_given_to_two_queries_is_refused(spark):
    docs = vectors(spark, np.eye(3))
    with pytest.raises(ValueError, match="query_id 7"):
        se.top_k(ask(spark, [(7, [1.0, 0.0, 0.0], 1, None), (7, [0.0, 1.0, 0.0], 1, None)]), docs)


def test_a_rare_group_gets_a_centre(spark):
    """Six rows among 7,000 that lie far from all others."""
    rng = np.random.default_rng(5)
    x = unit_rows(np.array([1.0, 0, 0, 0]) + 0.01 * rng.standard_normal((7000, 4)))
    x[3000:3006] = [0.0, 0.0, 0.0, -1.0]
    fit = km.fit_kmeans(vectors(spark, x).repartition(6), 2, n_init=2)
    assert sorted(fit.sizes.tolist()) == [6, 6994]
    sweep = ks.k_sweep(vectors(spark, x).repartition(6), ks=(2, 3), n_init=1).orderBy("k").collect()
    assert sweep[0].silhouette > 0.9
    gaps = ks.gap_table(vectors(spark, x), ks=(2, 3), n_refs=2).collect()
    assert len(gaps) == 2


def test_concentration_is_chosen_from_all_documents(spark):
    """The first 5,000 in corpus order are clear cases, the rest lie between the centres."""
    x = np.concatenate([np.tile([1.0, 0.0], (5200, 1)), np.tile([0.70710678, 0.70710678], (5200, 1))])
    frame = vectors(spark, x).withColumn("doc_id", F.col("id"))
    row = vmf.kappa_table(frame, np.eye(2), (50,)).first()
    assert row.conf_gt07 == 5200


def test_unreadable_posts_fail_the_read(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1").write_bytes(b"x")
    assert read_posts(spark, str(tmp_path)).count() == 1
    assert "true" not in str(read_posts.__defaults__).lower()


def test_staged_tables_go_where_the_cluster_says(spark):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, conf, folder):
            self.conf = Conf(conf)
            self.sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: folder)})

    warehouse = {"spark.sql.warehouse.dir": "hdfs:/w"}
    assert session.shared_folder(Session({"spark.checkpoint.dir": "hdfs:/c", **warehouse}, "hdfs:/own")) == "hdfs:/c"
    assert session.shared_folder(Session(warehouse, "hdfs:/own")) == "hdfs:/own"
    assert session.shared_folder(Session(warehouse, None)) == "hdfs:/w/textorbit-staged"


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import numpy as np
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.warehouse.dir", {folder!r}).getOrCreate())
from textorbit.operators import kmeans, search
from textorbit.streaming import cache
rows = [(i, "q%d" % i, [float(i % 2), 1.0 - i % 2]) for i in range(6)]
log = spark.createDataFrame(rows, "query_id long, query string, embedding array<float>").selectExpr("*", "timestamp_seconds(query_id) AS ts")
done = cache.SemanticCache(spark, np.eye(2)).process(log)
print("HITS", done.filter("cache_hit").count())
docs = log.selectExpr("query AS id", "'c' AS category", "embedding")
print("TOP", search.top_k(log.selectExpr("query_id", "embedding", "1 AS top_k", "NULL AS category"), docs).count())
print("FIT", sorted(kmeans.fit_kmeans(docs, 2, n_init=1).sizes.tolist()))
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Spark started elsewhere, with the package on the driver's path only."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=REPO, folder=str(tmp_path / "warehouse"))
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert "HITS 4" in run.stdout and "TOP 6" in run.stdout and "FIT [3.0, 3.0]" in run.stdout

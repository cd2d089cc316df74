"""The pipeline against a plain version of its stages."""

import zlib
from collections import Counter

import corpus_pipeline
import pytest
import zstandard
from helpers import SF, documents, no_documents, odd_documents
from test_models import plain_classes
from test_rows import plain_hits, repeated_plain
from test_tables import check_layout, plain_targets

import __spark_entry__ as entry
from textorbit.llm import bands, mixing
from textorbit.session import stage


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage hands on."""
    docs, out = documents(spark), [documents(spark).toPandas()]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), f"test-{name}")
        out.append(docs.toPandas())
    return out


def test_rules_keep_what_a_plain_version_keeps(stages):
    compress = zstandard.ZstdCompressor(level=3).compress

    def kept(text):
        words = text.encode().split()
        few = len(words) < 20 or 100 * repeated_plain(words) > 30 * len(words)
        return not few and bands.judge(text.encode(), compress)[2] is None

    assert sorted(stages[1].doc_id) == sorted(stages[0][stages[0].text.map(kept)].doc_id)


def test_dedup_keeps_the_least_of_each_class(stages):
    want = set(plain_classes(list(zip(stages[1].doc_id, stages[1].text))).values())
    assert sorted(stages[2].doc_id) == sorted(want) and len(want) < len(stages[1])


def test_no_benchmark_passage_is_left(spark, stages):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [d for d, t in zip(stages[2].doc_id, stages[2].text) if not plain_hits(t, items)[1]]
    assert sorted(stages[3].doc_id) == clean == sorted(clean) and len(clean) < len(stages[2])


def test_mix_meets_its_targets(spark, stages):
    count = lambda rows: rows.assign(n=rows.text.map(lambda t: len(t.encode().split()))).groupby("source").n.sum().to_dict()
    have, taken = count(stages[3]), count(stages[4])
    for source, target in plain_targets(have).items():
        assert abs(taken[source] - target) <= 64 + 0.04 * target
    words = {d: Counter(t.encode().split()) for d, t in zip(stages[3].doc_id, stages[3].text)}
    for doc, rows in stages[4].groupby("doc_id"):
        got = sum((Counter(t.encode().split()) for t in rows.text), Counter())
        assert all(n <= 3 * words[doc][w] for w, n in got.items())
    assert stages[4].columns.tolist() == stages[0].columns.tolist()


def test_shards_hold_the_mix(stages):
    last = stages[5]
    check_layout(last, 16)
    key = lambda rows: sorted(zip(rows.doc_id, rows.text.map(lambda t: zlib.crc32(t.encode()))))
    assert key(last) == key(stages[4])
    sizes = last.text.map(lambda t: len(t.encode()) + 1).groupby(last.shard).sum()
    assert sizes.max() - sizes.min() <= last.text.map(len).max() * 2


def test_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).toPandas()
    order = ["shard", "slot"]
    assert got.sort_values(order).reset_index(drop=True).equals(stages[5].sort_values(order).reset_index(drop=True))


def test_stages_bear_odd_and_no_rows(spark):
    for rows, n in ((odd_documents(spark), 11), (no_documents(spark), 0)):
        for _, function in corpus_pipeline.STAGES:
            assert function(spark, rows, SF).count() <= max(3 * n, n)
    assert mixing.take(mixing.mix_sources(odd_documents(spark))).columns == odd_documents(spark).columns


def test_all_queries_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert names["pipeline"] is corpus_pipeline.run


def test_stages_hand_small_batches_to_python(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for _, function in corpus_pipeline.STAGES:
            spark.conf.set(name, str(1 << 30))
            function(spark, no_documents(spark), SF)
            assert int(spark.conf.get(name)) <= 8 << 20
    finally:
        spark.conf.set(name, before)

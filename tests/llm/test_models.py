"""Near-duplicates, the language model and the quality classifier."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from helpers import LONG, documents, no_documents, odd_documents

from textorbit.llm import mixer, omh, rff
from textorbit.llm.decontaminate import words_of
from textorbit.session import arrow_batches, stage

SF = "/root/testdata/sf0.001"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_banded_alignment_equals_a_full_table():
    rng = random.Random(1)
    for _ in range(400):
        letters = rng.choice([2, 4, 40])
        a = [rng.randrange(letters) for _ in range(rng.randint(1, 30))]
        b = [x for x in a if rng.random() > 0.15] or [1]
        for _ in range(rng.randint(0, 5)):
            b.insert(rng.randint(0, len(b)), rng.randrange(letters))
        most, want = rng.randint(0, 12), plain_distance(a, b)
        got = omh.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), most)
        assert got == (want if want <= most else None), (a, b, most)


def test_sketches_see_order_and_repetition():
    hashes, salt = omh.WordHashes(), omh.seeds(50)
    words = [f"w{i}".encode() for i in range(60)]
    a = omh.sketch(hashes(words), salt)
    moved = omh.sketch(hashes(words[30:] + words[:30]), salt)
    edited = omh.sketch(hashes(words[:20] + [b"new"] + words[21:]), salt)
    # Moving half of the text keeps nearly all k-mers but breaks their order.
    assert (a == omh.sketch(hashes(list(words)), salt)).all()
    assert (a == edited).mean() > (a == moved).mean() + 0.05
    assert len(omh.sketch(hashes([b"one"]), salt)) == 50
    assert omh.occurrence(np.array([5, 7, 5, 5, 7], np.uint64)).tolist() == [0, 0, 1, 2, 1]


def test_bags_never_dismiss_a_similar_pair():
    rng = random.Random(8)
    for _ in range(200):
        a = [rng.randrange(30) for _ in range(rng.randint(1, 60))]
        b = [x if rng.random() > 0.2 else rng.randrange(30) for x in a] + [1] * rng.randint(0, 5)
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        similar = 1 - plain_distance(a, b) / max(len(a), len(b)) >= 0.8
        assert not similar or omh.allowed(np.array([len(a)]), np.array([len(b)]), omh.bag(x)[None], omh.bag(y)[None], 0.8)[0]


def components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def plain_classes(rows):
    """Class of each (doc_id, text) by comparing all pairs."""
    hashes = omh.WordHashes()
    first = {}
    for doc, text in rows:
        first[text] = min(doc, first.get(text, doc))
    items = [(doc, hashes(words_of(text))) for text, doc in first.items()]
    pairs = []
    for (i, a), (j, b) in itertools.combinations(items, 2):
        longer = max(len(a), len(b))
        if longer and omh.edit_distance(a, b, int(0.2 * longer + 1e-9)) is not None:
            pairs.append((i, j))
    found = components([d for d, _ in items], pairs)
    return {doc: found[first[text]] for doc, text in rows}


def test_classes_equal_comparing_all_pairs(spark):
    want = plain_classes([(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()])
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(documents(spark)).collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_large_group_of_near_copies(spark):
    """One group of copies with edits, and texts that share only a passage with it; blocks of four."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base, rows = [word() for _ in range(120)], []
    for i in range(60):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(120)] = word()
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(base[:40] + [word() for _ in range(80)])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.class_size) for r in omh.near_duplicates(df, block=4).collect()}
    assert all(got[i] == (0, 60) for i in range(60)) and all(got[i] == (i, 1) for i in range(100, 140))
    kept = sorted(r.doc_id for r in omh.keep_one(df, block=4).collect())
    assert kept == [0, *range(100, 140)]


def test_scattered_edits_up_to_the_threshold_are_found(spark):
    """Pairs at edit similarity 0.80 to 0.90, edits anywhere; short texts with every place of one edit."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    pairs = []
    for n, share in itertools.product((10, 14, 15, 20, 40, 41, 100, 400), (0.2, 0.15, 0.1)):
        for _ in range(8):
            a = [word() for _ in range(n)]
            b = list(a)
            for at in rng.sample(range(n), int(share * n)):
                b[at] = word()
            pairs.append((a, b))
    for n in range(5, 10):
        for at in range(n):
            a = [word() for _ in range(n)]
            pairs += [(a, a[:at] + [word()] + a[at + 1 :])]
            a = [word() for _ in range(n)]
            pairs += [(a, a[:at] + a[at + 1 :])]
    rows = [(2 * i + j, " ".join(text)) for i, pair in enumerate(pairs) for j, text in enumerate(pair)]
    got = {r.doc_id: r.class_id for r in omh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    missed = [len(pairs[d // 2][0]) for d in range(1, len(rows), 2) if got[d] != d - 1]
    assert not missed and len(set(got.values())) == len(pairs)


def test_near_duplicates_bear_odd_rows(spark):
    rows = omh.near_duplicates(odd_documents(spark, "CLASS_ID,other"))
    got = rows.toPandas()
    assert len(got) == 11 and "other" in got and got.class_id.isna().sum() == 1
    plain = got[got.doc_id.isin([1, 9])]
    assert (plain.class_id == 1).all() and (plain.class_size == 4).all()  # with the row that adds a word
    assert (got[got.doc_id == 2].class_id == 2).all() and (got[got.doc_id == 3].class_id == 3).all()
    kept = omh.keep_one(odd_documents(spark, "CLASS_ID,other")).toPandas()
    assert (kept.doc_id == 1).sum() == 1 and kept.text.isna().sum() == 2 and list(kept.columns)[5:] == ["CLASS_ID", "other"]
    assert omh.near_duplicates(no_documents(spark)).count() == 0 and omh.keep_one(no_documents(spark)).count() == 0


# Language model


def test_probabilities_of_all_next_bytes_sum_to_one():
    """The model is a code: whatever was learned, the costs of a byte's 256 values add up to one."""
    texts = [mixer.coded_text(t) for t in ("the cat sat on the mat", "the dog ate the cat", "a mat")] * 5
    counts = mixer.block_counts(texts, [False] * len(texts))
    kinds = list(counts)
    own = {k: v[0] for k, v in counts.items()}
    mix = mixer.Mixer(len(mixer.PREDICTORS))
    for context in (b"the ca", b"on the ", b"zzq"):
        every = [context + bytes([b]) for b in range(256)]
        grams = np.sort([mixer.Coded([data]).grams()[len(data) - 1] for data in every])
        keys, told = {}, {}
        for name in mixer.PREDICTORS:
            keys[name] = np.unique(np.concatenate([own[name], mixer.context_keys(grams, name)]))
            known = dict(zip(own[name].tolist(), counts[name][1].tolist()))
            told[name] = mixer.bit_predictions(keys[name], np.array([known.get(k, 0) for k in keys[name].tolist()]))
        found = mixer.Answers(grams, keys, told)
        where, _ = found.find(grams)
        rows, gate = [r[where] for r in found.rows], mix.gate(found.known)[where]
        costs = mix.code(rows, gate, np.ones(256, np.int64), learn=False)
        assert abs((2.0**-costs).sum() - 1) < 1e-4
        mix.code(rows, gate, np.arange(256), learn=True)
    assert kinds[0] == mixer.TOKENS


def test_bit_predictions_come_from_plain_counts():
    rng = random.Random(3)
    data = [(rng.randrange(3), rng.choice(b"abcxyz")) for _ in range(200)]
    count = Counter(data)
    keys = np.array(sorted((c << 8) | b for c, b in count), np.uint64)
    got = mixer.bit_predictions(keys, np.array([count[int(k) >> 8, int(k) & 255] for k in keys]))
    for key, row in zip(keys.tolist(), got):
        context, byte = key >> 8, key & 255
        for bit in range(8):
            same = [b for c, b in data if c == context and b >> (8 - bit) == byte >> (8 - bit)]
            ones = sum(b >> (7 - bit) == byte >> (7 - bit) for b in same)
            want = math.log((ones + mixer.DELTA) / (len(same) - ones + mixer.DELTA)) * mixer.UNIT
            assert abs(row[bit] - want) <= 0.5 + 1e-9


def test_packed_keys_come_back():
    for n in (0, 1, 5000):
        keys = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
        assert (mixer.unpack_keys(mixer.pack_keys(keys)) == keys).all()
        edges = mixer.shard_edges(keys, 7)
        assert edges[0] == 0 and edges[-1] == len(keys) and (np.diff(edges) >= 0).all()


def plain_base(rows):
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    tokens = [(d, (t or "").encode().lower().split() + [b"\n"]) for d, t in rows]
    count = Counter(w for d, ws in tokens if not held[d] for w in ws)
    n, v = sum(count.values()), len(count)
    return [
        (d, held[d], len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for d, ws in tokens
    ]


def test_mixer_learns_in_small_steps(monkeypatch):
    """Held-out bits per byte are no more than with steps of 2^12 or 2^18 positions, or three predictors."""
    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pylist()[:600]
    ids, texts = [r["doc_id"] for r in rows], [mixer.coded_text(r["text"]) for r in rows]
    held = [i % 5 == 1 for i in range(len(rows))]

    def held_bits():
        counts = mixer.block_counts(texts, held)
        own = {k: v[0] for k, v in counts.items()}
        found = mixer.Answers(own[mixer.GRAMS], own, {o: mixer.bit_predictions(*counts[o]) for o in mixer.PREDICTORS})
        bits, sizes = mixer.score_block(ids, texts, held, found)
        return bits[held].sum() / sizes[held].sum()

    assert mixer.PREDICTORS == (1, 2, 3, 4, 5) and mixer.STEP <= 1 << 14
    got = held_bits()
    monkeypatch.setattr(mixer, "STEP", 1 << 12)
    assert got < 1.005 * held_bits()
    monkeypatch.setattr(mixer, "STEP", 1 << 18)
    assert got < held_bits()
    monkeypatch.undo()
    monkeypatch.setattr(mixer, "PREDICTORS", (1, 3, 5))
    assert got < held_bits()


def test_scores_over_a_table(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for size in (mixer.BLOCK_BYTES, 60_000):
        got = {r.doc_id: r for r in mixer.context_mixing(docs, block_bytes=size).collect()}
        better = 0
        for d, held, n, known, train, base in plain_base(rows):
            row = got[d]
            assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held, n, known, train)
            assert abs(row.base_score - base) < 1e-6 * abs(base)
            assert row.score < 0 and abs(row.bits_per_byte * row.n_bytes * math.log10(2) + row.score) < 1e-6
            better += held * (row.score - base) / row.n_tokens
        # Even half a megabyte teaches it about as much as the base has from its words.
        assert better / sum(r.held_out for r in got.values()) > -1.0


def test_scores_bear_odd_rows(spark):
    docs = odd_documents(spark, "SCORE,other")
    got = mixer.context_mixing(docs).toPandas()
    assert len(got) == 11 and "other" in got and got.score.notna().all() and (got.score < 0).all()
    want = plain_base([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(got.base_score.round(6)) == sorted(round(w[5], 6) for w in want)
    empty = got[got.text.isna() | (got.text == "")]
    assert (empty.n_tokens == 1).all() and (empty.n_bytes == 1).all()
    assert got[got.text == LONG].n_tokens.item() == 40_001
    again = mixer.context_mixing(docs.repartition(3)).toPandas()
    assert sorted(got.score) == sorted(again.score)
    assert mixer.context_mixing(no_documents(spark)).count() == 0
    held = spark.createDataFrame([(3, "some words here")], "doc_id long, text string")
    assert zlib.crc32(b"3") % 5 == 1
    alone = mixer.context_mixing(held).collect()[0]
    assert alone.base_score == 0 and alone.train_tokens == 0 and abs(alone.bits_per_byte - 8) < 1e-3


# Quality


def test_isotonic_means_are_the_best_monotone_fit():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = rng.integers(1, 8)
        counts, sums = rng.integers(1, 5, n).astype(float), None
        sums = counts * rng.random(n)
        got = rff.isotonic(np.arange(n), sums, counts)
        assert (np.diff(got) >= -1e-12).all()
        # min-max formula of the isotonic regression
        for i in range(n):
            want = max(min(sums[a : b + 1].sum() / counts[a : b + 1].sum() for b in range(i, n)) for a in range(i + 1))
            assert abs(got[i] - want) < 1e-9


def test_fourier_features_approximate_a_gaussian():
    rng = np.random.default_rng(2)
    d = len(rff.NAMES)
    model = rff.QualityModel(np.zeros(d), np.ones(d), rng.normal(size=(d, 20_000)) / 3, rng.uniform(0, 2 * np.pi, 20_000), *[np.zeros(1)] * 3)
    x = rng.normal(size=(5, d)) * 0.7
    z = model.map(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / 18)
    assert np.abs(z @ z.T - want).max() < 0.05


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = rff.op3_fourier_quality(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(rows) == 1000 and rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.7)).all()
    assert (rows.held_out == rows.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.93


def test_partition_sums_do_not_depend_on_partitions(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    one = rff.quality_scores(docs.coalesce(1), labels).toPandas().set_index("doc_id").score.sort_index()
    many = rff.quality_scores(docs.repartition(7), labels).toPandas().set_index("doc_id").score.sort_index()
    assert (one - many).abs().max() < 1e-3


def test_quality_bears_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (7, None), (99, 1)], "doc_id long, quality int")
    got = rff.quality_scores(odd_documents(spark, "SCORE,features,other"), labels).toPandas()
    assert len(got) == 11 and "other" in got and got.score.between(0, 1).all()
    none = rff.quality_scores(odd_documents(spark), labels.limit(0)).toPandas()
    assert (none.score - 0.5).abs().max() < 1e-2
    assert rff.quality_scores(no_documents(spark), labels).count() == 0


def test_fine_bags_never_dismiss_a_similar_pair():
    rng = random.Random(9)
    for _ in range(200):
        a = [rng.randrange(3000) for _ in range(rng.randint(1, 60))]
        b = [x if rng.random() > 0.2 else rng.randrange(3000) for x in a] + [1] * rng.randint(0, 5)
        x, y = omh.fine_bag(np.array(a * 9, np.uint64)), omh.fine_bag(np.array(b * 9, np.uint64))
        assert omh.least_edits(x, y) <= plain_distance(a, b) * 9


def test_texts_of_a_common_passage_are_not_paired_in_blocks(spark, monkeypatch):
    rng, blocks, offered = random.Random(3), omh.block_candidates, []

    def counted(*args):
        found = stage(blocks(*args), "test-blocks")
        offered.append(found.filter("a IS NOT NULL").count())
        return found

    monkeypatch.setattr(omh, "block_candidates", counted)
    # A quarter of each text is its own, so none are similar, but three in four runs of words are the same.
    passage = [f"p{i}" for i in range(300)]
    texts = [[f"w{rng.randrange(10**9)}" for _ in range(100)] + passage for _ in range(60)]
    texts += [[*t[:50], "new", *t[51:]] for t in texts[:5]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for block in (16, 1024):
        found = {r.doc_id: r.class_id for r in omh.near_duplicates(docs, block=block).collect()}
        assert found == {i: i % 60 for i in range(65)}
    assert offered and sum(offered) < 60


def test_a_block_gets_its_runs_back_and_needs_no_second_count():
    texts = [mixer.coded_text(t) for t in ("the cat sat on the mat", "the dog ate the cat", "a mat")] * 5
    counts = mixer.block_counts(texts, [False] * len(texts))
    grams = counts[mixer.GRAMS][0]
    (back,) = mixer.answers([3], [mixer.GRAMS], [mixer.pack_keys(grams)], [b""])
    assert back[:2] == (3, mixer.GRAMS) and back[3:] == (0, 0)
    back = mixer.unpack_keys(back[2])
    told = {o: mixer.bit_predictions(*counts[o]) for o in mixer.PREDICTORS}
    a, b = mixer.Answers(back, None, told), mixer.Answers(grams, {k: v[0] for k, v in counts.items()}, told)
    assert (a.grams == b.grams).all()
    assert all((x == y).all() for x, y in zip(a.rows + a.known, b.rows + b.known))
    words, places = mixer.word_places(texts)
    assert [[words[p] for p in own] for own in places] == [[*t.split(), mixer.END] for t in texts]


def test_members_of_buckets_are_joined_few_times(spark, monkeypatch):
    """Members meet their classes' buckets once before the blocks, and after them only where a block left some out."""
    staged, put = [], omh.stage

    def counted(df, name):
        out = put(df, name)
        staged.append((name, out.count() if name == "torn-buckets" else 0))
        return out

    monkeypatch.setattr(omh, "stage", counted)
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(300)]
    texts = [[f"w{rng.randrange(10**9)}" for _ in range(100)] + passage for _ in range(60)]
    texts += [[*t[:50], "new", *t[51:]] for t in texts[:5]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in omh.near_duplicates(docs).collect()}
    assert found == {i: i % 60 for i in range(65)}
    names = [name for name, _ in staged]
    assert names.count("torn-buckets") == 1 and names.index("torn-buckets") > names.index("class-pairs")
    staged.clear()
    # Texts of which each block offers one at a time: the second round is of the buckets cut in the first.
    found = {r.doc_id: r.class_id for r in omh.near_duplicates(docs, offered=(0, 1 << 30)).collect()}
    assert found == {i: i % 60 for i in range(65)}
    assert [name for name, _ in staged].count("torn-buckets") <= 2


def test_blocks_make_no_more_pairs_than_rows(spark, monkeypatch):
    """Texts that share a passage and all words, in another order, meet in many buckets and are no copies."""
    rng, blocks, links, made, linked = random.Random(6), omh.block_candidates, omh.block_links, [], []

    def counted(*args):
        found = stage(blocks(*args), "test-blocks")
        pairs = found.filter("a IS NOT NULL").select("a", "b")
        assert pairs.distinct().count() == pairs.count()
        made.append((args[0].count(), found.count()))
        return found

    def joined(*args):
        found = stage(links(*args), "test-links")
        linked.append((args[0].count(), found.count()))
        return found

    monkeypatch.setattr(omh, "block_candidates", counted)
    monkeypatch.setattr(omh, "block_links", joined)
    passage, rest = [f"p{i}" for i in range(200)], [f"r{i}" for i in range(120)]
    texts = [passage + rng.sample(rest, len(rest)) for _ in range(60)]
    texts += [[*t[:150], "new", *t[151:]] for t in texts[:5]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs, want = spark.createDataFrame(rows, "doc_id long, text string"), plain_classes(rows)
    assert want == {i: i % 60 for i in range(65)}
    for settings in ({}, {"offered": (1,)}, {"offered": (0, 2)}, {"offered": (), "block": 16}):
        made.clear()
        linked.clear()
        assert {r.doc_id: r.class_id for r in omh.near_duplicates(docs, **settings).collect()} == want
        assert len(made) == len(settings.get("offered", omh.OFFERED)) and all(n >= m for n, m in made + linked)
        assert linked and linked[0][0]
    # Blocks of few words, as of long texts.
    monkeypatch.setattr(omh, "BLOCK_WORDS", 3000)
    assert {r.doc_id: r.class_id for r in omh.near_duplicates(docs).collect()} == want


def test_near_copies_left_out_by_blocks_are_joined_there(spark):
    """Two blocks share all their texts: each pair is aligned in one of them, and links only join classes."""
    rng, hashes = random.Random(8), omh.WordHashes()
    base = [b"w%d" % i for i in range(90)]
    texts = [[b"x%d" % rng.randrange(10**9) if i in at else w for i, w in enumerate(base)] for at in (rng.sample(range(90), 7) for _ in range(30))]
    texts += [[b"y%d" % i for i in range(90)]]
    rows = []
    for bucket in (3, 4):
        for i, text in enumerate(texts):
            key, words = (b"%016d" % i)[::-1], hashes(text)
            rows.append((bucket, 0, 0, 0, key, key, key, len(words), omh.fine_bag(words).tobytes(), [3, 4], words.tobytes()))
    schema = "bucket long, i int, j int, part int, key binary, class binary, now binary, n int, bag binary, buckets array<long>, words binary"
    df = spark.createDataFrame(rows, schema)
    links = [(int(r.a[::-1]), int(r.b[::-1]), r.similarity) for r in omh.block_links(df, 0.8, 0).collect()]
    found = components(range(31), [(a, b) for a, b, _ in links])
    assert found == {i: 0 if i < 30 else 30 for i in range(31)}
    assert len(links) <= 58 and len({(a, b) for a, b, _ in links}) == len(links) and all(s >= 0.8 for *_, s in links)
    assert omh.block_links(df, 0.8, omh.NEVER + 1).isEmpty()
    offered = omh.block_candidates(df.drop("words"), 0.8, 0, 64).collect()
    assert len(offered) <= len(rows) and {r.bucket for r in offered if r.a is None} == {3, 4}
    pairs = [(r.a, r.b) for r in offered if r.a is not None]
    assert len(set(pairs)) == len(pairs) == 60


def test_texts_reach_python_in_batches_of_bounded_bytes(spark, monkeypatch):
    name, seen, put = "spark.sql.execution.arrow.maxBytesPerBatch", [], omh.stage
    before = spark.conf.get(name)

    def noted(df, what):
        seen.append(spark.conf.get(name))
        return put(df, what)

    monkeypatch.setattr(omh, "stage", noted)
    assert omh.keep_one(documents(spark)).count()
    # All but the last, of a few keys.
    assert len(seen) > 5 and {int(s) for s in seen[:-1]} == {omh.BATCH_BYTES}
    assert spark.conf.get(name) == before
    docs = spark.range(0, 9000, 1, 1).selectExpr("repeat('x', 3000) AS text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    with arrow_batches(spark, omh.BATCH_BYTES):
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) <= omh.BATCH_BYTES * 1.1

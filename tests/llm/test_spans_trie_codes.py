"""Language spans, the conversation trie and vector codes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import documents, no_documents, odd_documents

from check_oracles import database, differences
from textorbit.llm import langid, lloyd, trie

SF = "/root/testdata/sf0.001"


# Language spans


def plain_viterbi(scores, switch):
    """One text, one word at a time, every pair of languages."""
    n, languages = scores.shape
    value, came = [list(scores[0])], []
    for t in range(1, n):
        row, back = [], []
        for now in range(languages):
            options = [value[-1][old] - (switch if old != now else 0.0) for old in range(languages)]
            best = max(options)
            # Staying first, then the lowest language.
            back.append(now if options[now] == best else options.index(best))
            row.append(best + scores[t][now])
        value.append(row)
        came.append(back)
    state = value[-1].index(max(value[-1]))
    labels = [state]
    for back in reversed(came):
        state = back[state]
        labels.append(state)
    return labels[::-1]


def test_viterbi_side_by_side_equals_one_text_at_a_time():
    rng = np.random.default_rng(5)
    for _ in range(30):
        sizes = rng.integers(1, 30, rng.integers(1, 12))
        scores = rng.integers(-8, 8, (sizes.sum(), 4)).astype(float)
        scores[rng.random(scores.shape) < 0.1] = -np.inf
        scores[np.isinf(scores).all(axis=1), 2] = 0.0
        got = langid.viterbi(scores, np.repeat(np.arange(len(sizes)), sizes), 5.0)
        at = 0
        for size in sizes:
            part = scores[at : at + size]

            def worth(path):
                return sum(part[t][s] for t, s in enumerate(path)) - 5.0 * sum(a != b for a, b in zip(path, path[1:]))

            assert worth(got[at : at + size].tolist()) == worth(plain_viterbi(part, 5.0))
            at += size


def plain_words(text):
    """Runs of letters of one script, marks included, by one character at a time."""
    kinds, _ = langid._characters()
    found, open_ = [], None
    for i, c in enumerate(text):
        kind = int(kinds[min(ord(c), len(kinds) - 1)])
        if kind < 0 and open_:
            found[-1][1] = i + 1
        elif kind > 0 and open_ == kind:
            found[-1][1] = i + 1
        elif kind > 0:
            found.append([i, i + 1])
            open_ = kind
        if kind <= 0 and not (kind < 0 and open_):
            open_ = None
    return [tuple(f) for f in found]


def test_words_are_runs_of_one_script():
    for text in ("Ünïcode, ß!", "abc где12 你好 ab你", "été नमस्ते", "", "...", "\U0001f600 x"):
        words = langid.Words([text, None, text])
        half = words.text == 0
        assert list(zip(words.start[half].tolist(), words.end[half].tolist())) == plain_words(text), text
        assert not (words.text == 1).any() and (words.text == 2).sum() == half.sum()
    # A triple for each character, the same wherever the word stands and however it is written.
    a, b = langid.Words(["Hello world"]), langid.Words(["world", "HELLO"])
    assert a.triples.tolist() == b.triples[5:].tolist() + b.triples[:5].tolist()


def test_languages_are_told_apart_on_held_out_rows(spark):
    docs = documents(spark).select("doc_id", "text", "lang")
    rows = langid.op11_script_viterbi(spark, SF).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = sum(r.lang_pred == r.lang for r in held if r.lang_pred != "und")
    assert len(held) > 20 and right >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_spans_of_mixed_text_and_scripts(spark):
    english = "the quick brown fox jumps over the lazy dog while seven wizards brew potions in a quiet old town"
    german = "der schnelle braune Fuchs springt über den faulen Hund und sieben Zauberer brauen Tränke in der alten Stadt"
    russian = "быстрая коричневая лиса прыгает через ленивую собаку"
    greek = "γρήγορη καφέ αλεπού"
    rows = [(i, t, x) for i, (t, x) in enumerate([(english, "en"), (german, "de"), (russian, "ru")] * 6)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "ru"]
    texts = [f"{english}. {german}!", russian + " " + english, "der fox", greek, "", None, "12 -- 34", "fox" + " Hund" * 3]
    found = list(langid.decode(model, texts))
    assert [s[2] for s in found[0][2]] == ["en", "de"] and found[0][2][1][0] == len(english) + 2 and found[0][2][1][1] == len(english) + 2 + len(german)
    assert found[0][0] == "de" and 0.4 < found[0][1] < 0.6
    assert [s[2] for s in found[1][2]] == ["ru", "en"]
    assert len(found[2][2]) == 1  # too short to switch
    assert found[3][0] in model.languages  # a script that nobody uses leaves all possible
    assert found[4] == found[5] == found[6] == ("und", 0.0, [])
    # The same with other texts around, and whatever goes in one step.
    for i, text in enumerate(texts):
        (alone,) = langid.decode(model, [text])
        assert alone[0] == found[i][0] and alone[2] == found[i][2] and abs(alone[1] - found[i][1]) < 1e-9


def test_language_rows_that_are_odd(spark):
    docs = odd_documents(spark, "score,LANG_PRED,held_out,text_")
    rows = langid.language_spans(docs)
    assert sorted(rows.columns) == sorted(["doc_id", "lang", "source", "n_chars", "text_", "held_out", "lang_pred", "score", "spans"])
    found = rows.collect()
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id in (2, 3, 5):
            assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
    long = next(r for r in found if r.doc_id == 4)
    assert long.lang_pred in ("en", "de") and long.spans[-1].end > 100_000
    assert langid.language_spans(no_documents(spark)).count() == 0
    # Nothing to learn from: nothing is known.
    unlabelled = docs.withColumn("lang", docs["lang"].substr(1, 0)).filter("false").unionByName(docs.selectExpr("*").withColumn("lang", docs["source"].substr(1, 9)).filter("doc_id IS NULL"))
    assert {r.lang_pred for r in langid.language_spans(unlabelled).collect()} == {"und"}


def test_too_many_languages_are_refused(spark):
    docs = spark.createDataFrame([(i, "word", f"l{i}") for i in range(40)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="exceed"):
        langid.learn(docs, table_bytes=30 * (4 << langid.BITS))


# Conversation trie


def plain_trie(rows):
    """Nodes by their full path, from (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            named = f"{len(role or '')}:{role or ''}{text or ''}"
            convs.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.md5(named.encode()).digest(), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in convs.items()}
    nodes = {}
    for conv in own:
        base, h = conv - int(np.fmod(conv, 5)), zlib.crc32(str(conv).encode()) % 9
        path = tuple(own.get(base, [])[:h] + own[conv][h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((conv, d == len(path)))
    children, leaves, saved = {}, {}, {}
    for path in nodes:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] = leaves.get(path[:d], 0) + (path not in children)
            saved[path[:d]] = saved.get(path[:d], 0) + (len(members) - 1) * (len(path[-1][1].encode()) if path else 0)
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, e in members if e))
        above = min(c for c, _ in nodes[path[:-1]]) if path else None
        out.append((min(c for c, _ in members), len(path), above, len(members), children.get(path, 0), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def trie_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_trie_equals_sql(spark):
    assert differences(trie.op12_splitter_skeleton(spark, SF), database(SF), trie.ORACLE) == []


@pytest.mark.parametrize("shard_bytes", [1 << 30, 600, 40])
def test_trie_equals_a_plain_one_for_any_shards(spark, shard_bytes):
    rng = random.Random(11)
    rows = []
    for conv in range(-12, 140):
        # Few different turns, so paths branch late; every third conversation is a copy; some are long.
        n = rng.choice([1, 2, 3, 4, 9, 12, 60])
        chosen = [("user", "same")] * 6 if conv % 3 == 0 else [(rng.choice(["user", None]), rng.choice(["a", "b", "é", None, ""])) for _ in range(n)]
        rows += [(conv, rng.choice([t, t, None]) if conv % 7 == 0 else t, *x) for t, x in enumerate(chosen)]
    rows += [(None, 1, "user", "lost")] + rows[:4]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    paths = trie.rebuilt(df)
    skeleton = trie.make_skeleton(paths, shard_bytes)
    assert (len(skeleton.splitters) > 5) == (shard_bytes < 1000)
    assert trie_rows(trie.prefix_trie(df, shard_bytes=shard_bytes)) == plain_trie(rows)


def test_trie_with_one_conversation_everywhere(spark, monkeypatch):
    """Copies are cut between shards; their ids, sent in many pieces, make one hash."""
    monkeypatch.setattr(trie, "PIECE_BYTES", 20)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 1500, 5) for t in range(4)] + [(c, 0, "user", "other") for c in range(2000, 2040)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert trie_rows(trie.prefix_trie(df, shard_bytes=2000)) == plain_trie(rows)


def test_splitters_stay_within_their_bytes():
    rng = random.Random(2)
    sample = sorted((b"".join(rng.choice([b"a" * 16, b"b" * 16]) for _ in range(rng.randint(0, 30))), i) for i in range(400))
    full = trie.choose_splitters(sample, 50)
    assert full == sorted(set(full)) and 20 < len(full) < 50
    few = trie.choose_splitters(sample, 50, limit=300)
    assert sum(len(p) for p, _ in few) <= 300 and set(few) <= set(full)
    assert trie.choose_splitters([(b"x" * 1600, 1)] * 4, 4, limit=100) == []


def test_trie_of_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(empty).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
    rows = [(7, 0, "user", "x" * 300_000), (7, None, None, None), (7, 0, "user", "x" * 300_000), (8, 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'old' AS depth", "1 AS n_convs")
    assert trie_rows(trie.prefix_trie(df)) == plain_trie(rows)
    # A conversation whose turns are all replaced by those of an absent base has none: it stands at the root.
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    (root,) = trie_rows(trie.prefix_trie(spark.createDataFrame([(lone, 0, "user", "gone")], SCHEMA)))
    assert root == (lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())


# Vector codes


def plain_codes(rows, parts=lloyd.PARTS, entries=lloyd.ENTRIES, rounds=lloyd.ROUNDS):
    """Everything compared with everything, in Python integers; rows of (id, vector, label)."""
    kept = [(i, [int(np.floor(np.float64(x) * 256)) for x in v], g) for i, v, g in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    seeds = {}
    for (i, v, _), c in sorted(zip(kept, cut), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[0][1])):
        if i is not None:
            seeds.setdefault(i, c)
    books = [[seeds[i][p] for i in sorted(seeds)[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            out.append([min((sum((a - b) ** 2 for a, b in zip(c[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)])
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    labels = {}
    for (_, _, g), e in zip(kept, errors):
        labels[g] = labels.get(g, 0) + e
    return sorted(((i, g, "".join(f"{k:02x}" for _, k in f), e, labels[g], digest) for (i, _, g), f, e in zip(kept, found, errors)), key=str)


VECTORS = "vec_id long, embedding array<double>, label int"


def codes(df, **settings):
    columns = ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in lloyd.encode_vectors(df, **settings).select(*columns).collect()), key=str)


def test_moved_entries_are_enough():
    """Comparing with moved entries only gives what comparing with all gives, ties included, for fewer comparisons."""
    rng = np.random.default_rng(9)
    for trial in range(200):
        book = rng.integers(-3, 4, (12, 2)).astype(float)
        x = rng.integers(-3, 4, (60, 2)).astype(float)
        at, distance = lloyd.nearest(x, book)
        after = book.copy()
        moving = rng.random(12) < rng.choice([0.0, 0.2, 0.9])
        after[moving] = rng.integers(-3, 4, (int(moving.sum()), 2))
        moved = (after != book).any(axis=1)
        got, found, compared = lloyd.reassign(x, after, moved, at, distance)
        want, exact = lloyd.nearest(x, after)
        assert got.tolist() == want.tolist() and found.tolist() == exact.tolist()
        assert compared <= 60 * 12 and (moved.any() or compared == 0)


def test_codes_equal_sql(spark):
    assert differences(lloyd.op13_active_lloyd(spark, SF), database(SF), lloyd.ORACLES["op13_active_lloyd"]) == []


def test_codes_equal_a_plain_version_on_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.001, 0.5, rng.uniform(-1, 1)]) for _ in range(8)], rng.choice([None, 1, 2, i])) for i in range(90)]
    rows += rows[:3] + [(200 + i, rows[5][1], 7) for i in range(40)]  # repeated rows, copies
    rows += [(300, None, 1), (301, [0.1] * 7 + [None], 1), (302, [0.1] * 7 + [float("nan")], 1), (303, [float("-inf")] + [0.1] * 7, 1)]
    rows += [(304, [], 1), (None, rows[8][1], 3), (None, rows[9][1], None), (-5, [0.25] * 8, None)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'old' AS code", "2 AS ERROR", "5 AS kept")
    want = plain_codes(rows, 4, 10, 3)
    assert codes(df, parts=4, entries=10, rounds=3) == want
    assert codes(df.repartition(7), parts=4, entries=10, rounds=3) == want
    assert sorted(lloyd.encode_vectors(df, parts=4, entries=10).columns) == ["code", "codebooks_sha256", "error", "kept", "label", "label_error", "vec_id"]
    # More entries than one byte counts, and fewer rows than entries.
    assert [r[3:] for r in codes(df, parts=2, entries=300)] == [r[3:] for r in plain_codes(rows, 2, 300, 2)]


def test_components_beyond_doubles_exactness(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([1.0, 2.0**20, -(2.0**20) + 0.5, rng.uniform(-1, 1) * 1e6]) for _ in range(4)], i % 3) for i in range(50)]
    df = spark.createDataFrame(rows, VECTORS)
    assert codes(df, parts=2, entries=6) == plain_codes(rows, 2, 6)
    floats = [(i, [float(np.float32(x)) for x in v], g) for i, v, g in rows]
    assert codes(df.withColumn("embedding", df["embedding"].cast("array<float>")), parts=2, entries=6) == plain_codes(floats, 2, 6)


def test_label_sums_of_frequent_and_rare_labels(spark):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else i // 4 if i > 50 else 1, i) for i in range(200)], "vec_id long, label int, error long")
    want = {}
    for r in rows.collect():
        want[r.label] = want.get(r.label, 0) + r.error
    for hot in (1, 10, 10_000):
        found = lloyd.with_label_sums(rows, "label", hot).collect()
        assert len(found) == 200 and all(r.label_error == want[r.label] for r in found)


def test_vectors_that_have_no_codes(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert lloyd.encode_vectors(empty).count() == 0
    assert lloyd.encode_vectors(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        lloyd.encode_vectors(spark.createDataFrame([(1, [0.1] * 5, 1)], VECTORS))
    with pytest.raises(Exception, match="exceeds a long"):
        lloyd.encode_vectors(spark.createDataFrame([(1, [0.0] * 2, 1), (2, [1e15] * 2, 1)], VECTORS), parts=1, entries=1)
    with pytest.raises(Exception, match="number of components|must all have"):
        lloyd.encode_vectors(spark.createDataFrame([(1, [0.1] * 4, 1), (2, [0.1] * 2, 1)], VECTORS), parts=2).count()

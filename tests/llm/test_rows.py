"""Quality rules, decontamination and URL rules: operators that judge rows one by one."""

import hashlib
import random

import zstandard
from helpers import LONG, PLAIN, documents, no_documents, odd_documents

from check_oracles import database, differences
from textorbit.llm import bands, decontaminate, urlrules
from textorbit.llm.decontaminate import find_benchmark, words_of

SF = "/root/testdata/sf0.001"


def repeated_plain(words, window=8):
    places = {}
    for i in range(len(words) - window + 1):
        places.setdefault(tuple(words[i : i + window]), []).append(i)
    hit = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + window)}
    return len(hit)


def test_repeated_words_equal_a_plain_count():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            words = words + words[: rng.randint(0, len(words))]
        assert bands.repeated_words(words) == repeated_plain(words)


def test_bands_reject_repetition_and_noise_and_keep_text():
    compress = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(1)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(2000)).encode()
    assert bands.judge(prose, compress)[2] is None
    assert bands.judge(b"buy now " * 500, compress)[2] == "repetitive"
    assert bands.judge(rng.randbytes(5000), compress)[2] == "incompressible"
    assert bands.judge(prose[:9000] + b"buy now " * 600, compress)[2] == "chunks"
    assert bands.judge(b"ab " * 20, compress)[2] is None  # too short to judge


def test_random_strings_are_incompressible_wherever_clean_text_compresses_better():
    """Base64 in every class; random letters and hex where their ratios leave those of clean text."""
    compress = zstandard.ZstdCompressor(level=3).compress
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    kinds = {letters + letters.upper() + "0123456789+/": 256, letters: 2048, "0123456789abcdef": 16384}
    for alphabet, least in kinds.items():
        for n in (256, 300, 383, 447, 511, 512, 1023, 1024, 2047, 2048, 4095, 4096, 8192, 16384, 20000, 100_000):
            data = " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(3, 9))) for _ in range(n // 3))[:n].encode()
            assert n < least or bands.judge(data, compress)[2] == "incompressible", (len(alphabet), n)
    # Characters of three bytes have limits of their own.
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(1000)).encode()
    assert bands.mostly_multi(han) and not bands.mostly_multi("déjà vu à la fête".encode())
    assert bands.judge(han, compress)[2] is None and bands.judge(han, compress, multi_limits=bands.LIMITS)[2] == "incompressible"


def test_bands_over_a_table(spark):
    rows = bands.compression_bands(documents(spark)).toPandas()
    assert len(rows) == documents(spark).count()
    for row in rows.itertuples():
        data = row.text.encode()
        words = data.split()
        lines = [x for x in row.text.split("\n") if x.strip(bands.SPACES)]
        assert (row.n_words, row.n_repeat_words) == (len(words), repeated_plain(words))
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_symbols == sum(c in "#*$%&|<>" for c in row.text)
        assert row.base_failed == (len(words) < 20 or 100 * row.n_repeat_words > 30 * len(words))
        assert not (row.kept and row.base_failed)


def test_bands_bear_odd_rows(spark):
    rows = bands.compression_bands(odd_documents(spark, "N_WORDS,kept,other")).toPandas()
    assert len(rows) == 11 and list(rows.columns)[:6] == ["doc_id", "text", "lang", "source", "n_chars", "other"]
    null = rows[rows.text.isna()]
    assert (null.n_words == 0).all() and null.base_failed.all() and not null.kept.any() and null.ratio.isna().all()
    assert rows[rows.text == LONG].n_words.item() == 40_000
    assert rows[rows.text == PLAIN].kept.all()
    assert bands.compression_bands(no_documents(spark)).count() == 0


def plain_hits(text, items, window=10):
    words, hit, found = words_of(text), set(), set()
    for name, item in items:
        own = words_of(item)
        m = min(window, len(own))
        patterns = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if own else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in patterns:
                hit.update(range(i, i + m))
                found.add(name)
    return len(words), len(hit), ",".join(sorted(found))


def test_wu_manber_equals_a_plain_search():
    rng = random.Random(5)
    for _ in range(200):
        make = lambda n: [rng.choice("abc") for _ in range(n)]
        items = [(str(i), " ".join(make(rng.randint(0, 14)))) for i in range(5)]
        text = " ".join(make(rng.randint(0, 80)))
        spans, names = decontaminate.Patterns(items, 10).find(words_of(text))
        n, hit, found = plain_hits(text, items)
        assert sum(b - a for a, b in spans) == hit and ",".join(sorted(names)) == found


def test_items_in_blocks_give_the_same(spark):
    docs, items = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    one = find_benchmark(docs, items).select("doc_id", "n_hit", "items_sha256").toPandas()
    many = find_benchmark(docs, items, block_bytes=2500).select("doc_id", "n_hit", "items_sha256").toPandas()
    assert one.equals(many) and (one.n_hit > 0).any()


def test_decontamination_bears_odd_rows(spark):
    items = spark.createDataFrame(
        [(1, PLAIN), (1, PLAIN), (2, None), (None, PLAIN), (3, ""), (4, "word"), (10, PLAIN.upper())], "item_id long, text string"
    )
    rows = find_benchmark(odd_documents(spark, "n_hit,ITEMS,other"), items).toPandas()
    assert len(rows) == 11 and "other" in rows.columns
    plain = rows[rows.text == PLAIN]
    assert (plain.n_hit == 23).all() and (plain.n_items == 2).all()
    assert set(plain.items_sha256) == {hashlib.sha256(b"1,10").hexdigest()}
    assert rows[rows.text == "word"].n_items.item() == 1
    assert not rows[rows.text.isna()].contaminated.any()
    none = find_benchmark(odd_documents(spark), items.limit(0)).toPandas()
    assert not none.contaminated.any() and set(none.items_sha256) == {hashlib.sha256(b"").hexdigest()}
    assert find_benchmark(no_documents(spark), items).count() == 0


def test_row_queries_equal_their_sql(spark):
    db = database(SF)
    for module in (decontaminate, urlrules):
        for name, sql in module.ORACLES.items():
            assert differences(module.QUERIES[name](spark, SF), db, sql) == [], name


URLS = [
    ("http://a.com/x", "a.com", "/x", "com/", "allow"),
    ("https://Shop.Example.COM/en/1?q#f", "shop.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://x.www.example.com/en/1", "x.www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
    ("https://www.example.com/EN/1", "www.example.com", "/EN/1", "com/", "allow"),
    ("http://b.net/es/1", "b.net", "/es/1", "net/es/", "block"),
    ("http://b.net/es", "b.net", "/es", None, "allow"),
    ("http://b.com", "b.com", "", None, "allow"),
    ("http://cheap-pills.example.org/x", "cheap-pills.example.org", "/x", None, "block"),
    ("http://notcheap-pills.example.org/x", "notcheap-pills.example.org", "/x", None, "allow"),
    ("http://h.org/wiki/casino/", "h.org", "/wiki/casino/", None, "allow"),
    ("http://h.org/casino", "h.org", "/casino", None, "block"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://first.com/a://second.net/es/", "first.com", "/a:/" + "/second.net/es/", "com/", "allow"),
    ("http://h.org/" + "x" * 50_000, "h.org", "/" + "x" * 50_000, None, "allow"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "old") for i, u in enumerate(URLS)] * 2, "page_id long, url string, Rule string")
    rows = urlrules.judge_urls(pages).orderBy("page_id").collect()
    assert len(rows) == 2 * len(URLS)
    for row in rows:
        assert (row.url, row.host, row.path, row.rule, row.verdict) == URLS[row.page_id]
    assert urlrules.judge_urls(pages.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token():
    rules = (urlrules.site_rule("block", "example.com", "/en/"), urlrules.pattern_rule("block", "*"))
    assert rules[0].tokens == ("example", "com", "en")
    buckets, loose = urlrules.index_rules(rules, {"example": 5, "com": 9, "en": 7})
    assert [e for b in buckets for e in b] == [{"token": "example", "number": 0}] and loose == [1]


def test_url_rules_run_no_python(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    plan = urlrules.judge_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan



"""WARC archives, HTML extraction, mixing and sharding."""

import hashlib
import html
import random
import re
from itertools import product

import pandas as pd
from helpers import LONG, documents, no_documents, odd_documents

from check_oracles import database, differences
from textorbit.llm import hostpaths, mixing, sharding, warc
from textorbit.session import new_path

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def odd_pages(spark):
    rows = [
        (1, "http://a.org/%C3%A9 x\ny", "<p>" + "copy " * 40 + "</p>"), (2, "http://a.org/2", "<p>" + "copy " * 40 + "</p>"),
        (2, "http://a.org/2", "<p>" + "copy " * 40 + "</p>"), (1, None, "<p>" + "copy " * 40 + "</p>"), (3, "http://b.org", "short"),
        (4, "http://b.org", "short"), (5, "x", None), (6, None, ""), (None, "http://c.org", "<p>" + "copy " * 40 + "</p>"),
        (7, "http://c.org", "<p>" + LONG + "é \r\n\r\nWARC/1.1 \r\n" + "</p>"), (None, None, None),
    ]
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "'old' AS `Text`", "'old' AS payload", "1 AS chunk_no")


def test_warc_query_equals_its_sql(spark):
    assert differences(warc.op2_warc_chunks(spark, SF), database(SF), warc.OP2_SQL) == []


def test_archives_give_back_every_payload_in_chunks(spark):
    pages = odd_pages(spark)
    _, chunks = warc.archive_pages(pages, chunk_bytes=1000)
    rows = chunks.toPandas()
    assert (rows.data.map(len) <= 1000).all()
    payloads = {}
    for _, record in rows.sort_values("chunk_no").groupby(["archive", "record_no"]):
        data = b"".join(record.data)
        for n, row in enumerate(record.itertuples()):
            done = b"".join(record.data[: n + 1])
            assert (row.chunk_no, row.start) == (n, len(done) - len(row.data))
            assert row.sha256 == hashlib.sha256(done).hexdigest() and row.last == (n == len(record) - 1)
        kind = record.record_type.iloc[0]
        payloads.setdefault((kind, data), []).append((record.page_id.iloc[0], record.url.iloc[0], record.refers_to.iloc[0]))
    copy = ("<p>" + "copy " * 40 + "</p>").encode()
    long = ("<p>" + LONG + "é \r\n\r\nWARC/1.1 \r\n" + "</p>").encode()
    # Both rows of the least id are responses, and so is the page without id.
    assert len(payloads["response", copy]) == 3 and len(payloads["response", long]) == 1
    assert sorted(p for p, _, _ in payloads["revisit", b""]) == [2, 2] and {r for *_, r in payloads["revisit", b""]} == {1}
    assert len(payloads["response", b"short"]) == 2 and len(payloads["response", b""]) == 3
    resolved = warc.resolve(chunks).toPandas()
    assert len(resolved) == 11 and resolved.digest_ok.all()
    revisits = resolved[resolved.record_type == "revisit"]
    assert (revisits.payload_bytes == len(copy)).all() and set(revisits.payload_digest) == {hashlib.sha256(copy).hexdigest()}


def test_urls_survive_the_archive(spark):
    urls = ["http://a.org/%C3%A9", "http://a.org/é x", "a\r\nWARC-Type: revisit", "100%", "", " "]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], PAGES)
    _, chunks = warc.archive_pages(pages)
    assert [r.url for r in chunks.orderBy("page_id").collect()] == urls


def test_no_pages_no_archives(spark):
    manifest, chunks = warc.archive_pages(odd_pages(spark).limit(0))
    assert manifest.count() == 0 and chunks.count() == 0 and warc.resolve(chunks).count() == 0


def test_small_archives_hold_all_records(spark):
    folder = new_path(spark, "small")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    manifest = warc.write_archives(warc.with_records(pages), folder, 5000, archive_bytes=20_000)
    assert manifest.count() > 3
    assert warc.resolve(warc.read_archives(manifest, folder, 700, 3000)).count() == pages.count()


def article_text(page):
    """The text of the fixtures' only template."""
    found = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1].replace("<br>", " ")
    blocks = re.split(r"</?(?:p|h1)>", found)
    texts = [" ".join(html.unescape(re.sub(r"</?[a-z]+>", "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_extraction_equals_the_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas().set_index("page_id")
    for row in hostpaths.op10_host_paths(spark, SF).collect():
        assert row.text == article_text(pages.html[row.page_id]) and row.n_chars == len(row.text)


PAGE = """<html><head><title>no</title><style>no</style></head><body><header><h2>no</h2></header><nav><ul><li>no</ul></nav>
<div class="cookie-notice"><p>no, this is a rather long notice on cookies that we bake</p></div>
<div id="post-17" class="entry c17"><h1>Caf&eacute; &amp; tea</h1><p>First  <b>bold</b>\n text,<br>more &lt;b&gt;.
<p>Second<script>var a = "<p>no</p>";</script> part<div class="share-box">no</div>
<blockquote>quoted</blockquote><aside>no</aside><form><p>no</p></form><ul><li>one<li>two</ul><table><tr><td>cell</table></div>
<section class="comments"><p>no, said a reader at quite some length, and went on and on about it</p></section><!-- <p>no</p> -->
<div class="sidebar"><p>no</p></div><footer>no</footer></body></html>"""


def test_boilerplate_is_left_out():
    page = hostpaths.Page(PAGE)
    best = max(page.votes().items(), key=lambda v: v[1])[0]
    assert best == "body>div.c#.entry"
    text, path = page.text([best])
    assert path == best
    assert text == "Café & tea\n\nFirst bold text, more <b>.\n\nSecond part\n\nquoted\n\none\n\ntwo\n\ncell"


def test_the_whole_article_around_the_winner_is_read():
    lead, long = "the lead of it. " * 20, "the text of it. " * 60
    pages = {
        "nested": (f"<body><div class='x'><article><h1>Head</h1><div class='entry-content'><p>{long}</p></div></article></div></body>", ["Head", long]),
        "siblings": (f"<article><div class='lead'><p>{lead}</p></div><div class='text'><p>{long}</p></div></article><div><p>no</p></div>", [lead, long]),
        "main": (f"<main><h1>Head</h1><section class='a'><p>{lead}</p></section><section class='b'><p>{long}</p></section></main>", ["Head", lead, long]),
        "no article": (f"<body><div id='p'><h1>Head</h1><div class='entry'><p>{long}</p></div></div><div class='s'><p>no</p></div></body>", ["Head", long]),
    }
    for name, (page, want) in pages.items():
        read = hostpaths.Page(page)
        best = max(read.votes().items(), key=lambda v: v[1])[0]
        for paths in ([best], []):
            assert read.text(paths)[0] == "\n\n".join(x.strip() for x in want), name


def test_wrappers_named_after_other_matter_are_read():
    side, long = "<div class='sidebar'><p>no, other stories</p></div>", "the text of it. " * 30
    inner = f"<h1>Head</h1><p>{long}</p><div class='comments'><p>no, a reader</p></div>"
    want = "Head\n\n" + long.strip()
    for page in (
        f"<body class='right-sidebar'><article>{inner}</article>{side}</body>",
        f"<html class='no-comments'><body><article>{inner}</article>{side}</body></html>",
        f"<body><div class='content-with-sidebar'><div class='c'>{inner}</div>{side}</div></body>",
        f"<body><main class='no-comments'>{inner}{side}</main></body>",
        f"<body><article class='post related-1 share'>{inner}</article>{side}</body>",
    ):
        assert hostpaths.Page(page).text([])[0] == want, page
    # Long comments on a short article are no wrapper.
    short = f"<body><div class='c'><h1>Head</h1><p>short</p></div><div class='comments'><p>{long}</p></div></body>"
    assert hostpaths.Page(short).text([])[0] == "Head\n\nshort"


def test_hosts_agree_on_a_path(spark):
    def page(long_aside):
        side = "words of another story. " * long_aside
        return f"<body><div class='s'><p>{side}</p></div><div class='m'><p>{'the real text. ' * 20}</p></div></body>"

    rows = [(i, "http://h.org/", page(2)) for i in range(20)] + [(99, "http://h.org/", page(60)), (100, "http://k.org/", page(60))]
    rows = spark.createDataFrame(rows, PAGES)
    found = {r.page_id: r for r in hostpaths.extract_text(rows, salts=4).collect()}
    assert found[99].text.startswith("the real text") and found[99].content_path == "body>div.m"
    assert found[100].text.startswith("words of another")  # alone, a host has only its own page's votes


def test_extraction_bears_odd_pages(spark):
    found = hostpaths.extract_text(odd_pages(spark)).toPandas()
    assert len(found) == 11 and "html" not in found and found.text.notna().all()
    assert sorted(found[found.page_id == 7].n_chars) == [len(" ".join((LONG + "é \r\n\r\nWARC/1.1 \r\n").split()))]
    assert (found[found.page_id.isin([5, 6])].text == "").all() and found[found.page_id == 3].text.item() == "short"
    assert hostpaths.extract_text(odd_pages(spark).limit(0)).count() == 0
    for broken in ("<", "<p", "<a href='x", "</p></div>", "<p>a<!-- b", "&#xD800;", "<script>x", "a\0b"):
        hostpaths.Page(broken).text([])


def plain_sainte_lague(votes, seats):
    won = {k: 0 for k in votes}
    for _ in range(seats):
        best = min((k for k in votes if votes[k] > 0), key=lambda k: (-votes[k] / (2 * won[k] + 1), k), default=None)
        if best is None:
            break
        won[best] += 1
    return won


def test_sainte_lague_equals_seat_by_seat(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for g in range(40):
        n, seats = rng.randint(1, 12), rng.choice([0, 1, 3, 20, 200])
        votes = {f"p{i:02}": float(rng.choice([0, 1, 5, 5, rng.randint(1, 10**6)])) for i in range(n)}
        want[g] = plain_sainte_lague(votes, seats)
        rows += [(g, k, v, seats) for k, v in votes.items()]
    got = mixing.sainte_lague(spark.createDataFrame(rows, "g int, p string, v double, s long"), ["g"], ["p"], "v", "s").collect()
    assert len(got) == len(rows)
    for row in got:
        assert row.quota == want[row.g][row.p], (row, want[row.g])


def plain_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weights = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weights[n] for n in free)
        over = [n for n in free if weights[n] * level > 3 * sizes[n]]
        if not over:
            return out | {n: weights[n] * level for n in free}
        for n in over:
            out[n] = 3.0 * sizes[n]
            left -= out[n]
            free.discard(n)
    return out


def test_targets_equal_resharing_step_by_step(spark):
    rng = random.Random(4)
    for _ in range(4):
        sizes = {n: rng.choice([0, 3, 50, rng.randint(0, 5000)]) for n in ["z", "a", "é", "B", "", None, "b", "c"][: rng.randint(1, 8)]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys()
        for n in want:
            assert abs(got[n] - want[n]) <= 1e-6 * max(1, want[n]), (sizes, got, want)


def test_mix_comes_near_its_targets_and_repeats(spark):
    mixed = mixing.mix_sources(documents(spark), shard_words=3000)
    rows = mixed.toPandas()
    assert len(rows) == documents(spark).count()
    assert (rows.taken <= 3 * rows["size"]).all() and (rows["size"] == rows.text.map(lambda t: len(t.encode().split()))).all()
    by = rows.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    want = plain_targets(by["size"].to_dict())
    assert (by["size"] == by.source_size).all() and all(abs(by.target[n] - t) < 1e-6 * max(t, 1) for n, t in want.items())
    assert ((by.taken - by.target).abs() <= 64 + 0.04 * by.target).all()
    again = mixing.mix_sources(documents(spark).repartition(5), shard_words=3000).toPandas()
    assert rows.set_index("doc_id").taken.sort_index().equals(again.set_index("doc_id").taken.sort_index())
    written = mixing.take(mixed).toPandas()
    words = written.assign(n=written.text.map(lambda t: len(t.encode().split()))).groupby("doc_id").n.sum()
    assert words.equals(rows[rows.taken > 0].set_index("doc_id").taken.sort_index().rename("n"))
    assert (written.n_chars == written.text.map(len)).all() and list(written.columns) == documents(spark).columns


def test_tiny_sources_come_near_their_targets(spark):
    rows = [(100 * i + j, "w " * (5 if n >= 5 else n), f"s{i:03}") for i, n in enumerate((10, 20, 5, 90, 3, 400, 40, 1, 70) * 5) for j in range(max(1, n // 5))]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    by = got.groupby("source").agg(target=("target", "first"), size=("source_size", "first"), taken=("taken", "sum"))
    assert len(by) == 45 and ((by.taken - by.target).abs() <= 1.01 + by["size"] / 100).all()


def test_mix_bears_odd_rows(spark):
    rows = mixing.mix_sources(odd_documents(spark, "SIZE,other")).toPandas()
    assert len(rows) == 11 and "other" in rows and (rows.taken <= 3 * rows["size"]).all()
    assert (rows[rows.text.isna()][["size", "taken"]] == 0).all().all()
    total = rows.drop_duplicates("source").target.sum()
    assert abs(total - rows["size"].sum()) < 1e-6 * total
    assert mixing.take(mixing.mix_sources(odd_documents(spark))).filter("text IS NULL").count() == 0
    assert mixing.mix_sources(no_documents(spark)).count() == 0
    empty = odd_documents(spark).filter("text IS NULL OR text = ''")
    assert mixing.mix_sources(empty).selectExpr("sum(taken) + sum(target)").first()[0] == 0


def test_flow_moves_the_least():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randint(1, 6)
        supply = [rng.randint(0, 30) for _ in range(n)]
        total = sum(supply)
        capacity = [total * (i + 1) // n - total * i // n for i in range(n)]
        flow = sharding.min_cost_flow(supply, capacity, lambda i, j: 0 if i == j else 1)
        assert [sum(f for (i, _), f in flow.items() if i == k) for k in range(n)] == supply
        assert [sum(f for (_, j), f in flow.items() if j == k) for k in range(n)] == capacity
        assert sum(f for (i, j), f in flow.items() if i != j) == sum(max(0, s - c) for s, c in zip(supply, capacity))
    # Prices of its own: compare with all ways of sending four units.
    price = [[rng.randint(0, 9) for _ in range(3)] for _ in range(2)]
    flow = sharding.min_cost_flow([2, 2], [2, 1, 1], lambda i, j: price[i][j])
    ways = [w for w in product(product(range(3), repeat=2), repeat=2) if sorted(w[0] + w[1]) == [0, 0, 1, 2]]
    assert sum(price[i][j] * f for (i, j), f in flow.items()) == min(sum(price[i][j] for i in range(2) for j in w[i]) for w in ways)


def check_layout(rows: pd.DataFrame, shards: int):
    for _, shard in rows.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    assert set(rows.shard) <= set(range(shards))


def test_shards_are_even_and_keep_copies_together(spark):
    rows = sharding.op8_flow_reshard(spark, SF).toPandas()
    docs = documents(spark).toPandas().set_index("doc_id")
    check_layout(rows, 16)
    sizes = rows.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= rows["size"].max()
    assert (rows["size"] == rows.doc_id.map(docs.text.map(lambda t: len(t.encode()) + 1))).all()
    assert (rows.assign(text=rows.doc_id.map(docs.text)).groupby("text").shard.nunique() == 1).all()
    again = sharding.op8_flow_reshard(spark, SF).toPandas()
    key = ["doc_id", "shard", "slot"]
    assert rows[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))


def test_resharding_rewrites_only_files_that_lose_blocks(spark):
    path = new_path(spark, "layout")
    sharding.write_layout(sharding.hash_layout(documents(spark), 4, 32, 8), path)
    old = spark.read.parquet(path)
    sizes = {r.shard: r.n for r in old.groupBy("shard").sum("size").toDF("shard", "n").collect()}
    capacity = [sizes[0] + sizes[1] // 2, sizes[1] - sizes[1] // 2, sizes[2], sizes[3]]
    new = sharding.reshard(spark, path, capacity)
    assert new.count() == old.count() and sorted(r.doc_id for r in new.collect()) == sorted(r.doc_id for r in old.collect())
    got = {r.shard: r.n for r in new.groupBy("shard").sum("size").toDF("shard", "n").collect()}
    assert abs(got[0] - capacity[0]) < 0.1 * capacity[0] and got[2] == sizes[2] and got[3] == sizes[3]
    kept = [f for f in new.inputFiles() if path in f]
    assert all(f"shard={s}/" in "".join(kept) for s in (2, 3))


def test_sharding_bears_odd_rows(spark):
    rows = sharding.shard_documents(odd_documents(spark, "SLOT,other"), 3).toPandas()
    assert len(rows) == 11 and "other" in rows
    check_layout(rows, 3)
    assert (rows[rows.text.isna()]["size"] == 1).all() and (rows[rows.text.isna()].text_crc32 == 0).all()
    assert sharding.shard_documents(no_documents(spark)).count() == 0
    # A group of copies that is over half a shard is cut; nothing is lost.
    hot = spark.range(400).selectExpr("id AS doc_id", "IF(id < 200, 'same text', concat('text ', id)) AS text")
    many = sharding.shard_documents(hot, 4).toPandas()
    check_layout(many, 4)
    sizes = many.groupby("shard")["size"].sum()
    assert len(many) == 400 and sizes.max() < 1.3 * sizes.min()

"""Cleaning against worked-out texts, tokens against Python's own regular expressions."""

import hashlib
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textorbit.functions import terms as tm
from textorbit.functions import text as tx
from textorbit.operators import corpus as co
from textorbit.sources.posts import read_posts

POSTS = [
    "Subject: Re: Re: x\nFrom: a@b.c\n\nbody text here",
    "From: a\n\nfirst\nSubject: in the body\nlast",
    "Subject:\nFrom: next header\n\nbody",
    "no blank line at all\nTo: someone\nrest",
    "H: x\n\n-- \nsignature on the first body line",
    "H: x\n\ntext\n--\nno trailing blank",
    "H: x\n\ntext\n--   \n\n\nmore",
    "H: x\n\na\x85b\xa0c\x1cd e",
    "subject: FWD:  hello \xa0 world \n\n> quoted\n  > kept\nhttp://x.y/z and www.a.b, c@d.e.\nOrg: z\n",
    "Subject: only\n\n",
    "H: é\n\n@a.b x@y@z.w foo@bar baz@.q a@b.",
    "\n\n",
    "",
]


# Subject, text and number of tokens of each post.
CLEANED = [
    ('Re: x', 'Re: x Re: x body text here', 7),
    ('in the body', 'in the body in the body first last', 8),
    ('From: next header', 'From: next header From: next header body', 7),
    ('', 'no blank line at all rest', 6),
    ('', '-- signature on the first body line', 7),
    ('', 'text', 1),
    ('', 'text', 1),
    ('', 'a b c d e', 5),
    ('hello \xa0 world', 'hello \xa0 world hello \xa0 world > kept and', 7),
    ('only', 'only only ', 2),
    ('', '@a.b foo@bar baz@.q a@b.', 4),
    ('', '', 0),
    ('', '', 0),
]


def test_cleaning_gives_the_worked_out_texts(spark):
    frame = spark.createDataFrame(list(enumerate(POSTS)), "n int, raw string")
    rows = {r.n: r for r in co.clean_posts(frame).collect()}
    assert [(rows[n].subject, rows[n].text, rows[n].n_tokens) for n in range(len(POSTS))] == CLEANED
    assert all(r.id == hashlib.sha256(r.text.encode()).hexdigest()[:16] for r in rows.values())


def test_strip_chain_is_opt_in(spark):
    frame = spark.createDataFrame([("Subject: Re: re: Fwd: x\n\ny",)], "raw string")
    assert co.clean_posts(frame).first().subject == "re: Fwd: x"
    assert co.clean_posts(frame, strip_chain=True).first().subject == "x"


def bare(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


@pytest.mark.parametrize("n_parts", [1, 4])
def test_terms_equal_python(spark, n_parts):
    texts = [
        "The quick-brown fox, ab- abc- foo_bar straße x1y2 Ünïcödé ÉCLAIR",
        "ﬁne ＷＩＤＥ ½ cup ™ Ⅷ 한국어 текст naïve étude",
        "a b c",
        "",
        "one two two one two two",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(n_parts)
    got = {r.n: (r.f, r.terms) for r in tm.with_terms(tm.with_folded(frame, "text", "f"), "text").collect()}
    for n, text in enumerate(texts):
        toks = re.findall(r"\b[a-zA-Z][a-zA-Z0-9\-]{2,}\b", bare(text))
        assert got[n] == (bare(text), toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])])
    counted = tm.term_counts(frame, "text", "n")
    totals = {r.term: (r.df, r.total) for r in tm.term_totals(frame.union(frame), "text").collect()}
    assert totals["two"] == (2, 8) and totals["two two"] == (2, 4) and totals["naive"] == (2, 2)
    assert {(r.term, r.tf) for r in counted.filter("n = 4").collect()} == {
        ("one", 2), ("two", 4), ("one two", 2), ("two two", 2), ("two one", 1),
    }


def test_first_copy_wins_and_report(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [("b", "1", words), ("a", "2", words), ("a", "10", words), ("c", "3", "too short"), ("d", "4", "too short")]
    frame = spark.createDataFrame(rows, "category string, doc_id string, raw string").repartition(3)
    kept = co.build_corpus(frame).collect()
    assert [(r.category, r.doc_id, r.n_tokens) for r in kept] == [("a", "10", 40)]
    assert co.load_report(co.clean_posts(frame)).first().asDict() == {
        "total_raw": 5, "kept": 1, "dropped_short": 2, "dropped_duplicate": 2,
    }
    assert co.keep_long(co.clean_posts(frame)).count() == 3


def test_dedup_limits_before_its_shuffle(spark):
    frame = spark.createDataFrame([("a", "1", "x")], "category string, doc_id string, raw string")
    plan = co.build_corpus(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_read_posts(spark, tmp_path):
    for category, name, data in (
        ("alt.x", "1", b"Subject: caf\xe9\r\n\r\nbody\rend"), ("sci y", "2%+3", b"plain"),
    ):
        (tmp_path / category).mkdir()
        (tmp_path / category / name).write_bytes(data)
    got = sorted((r.category, r.doc_id, r.raw) for r in read_posts(spark, str(tmp_path)).collect())
    assert got == [("alt.x", "1", "Subject: café\n\nbody\nend"), ("sci y", "2%+3", "plain")]


def test_category_outputs(spark):
    docs = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), ("c", "3", "x")], "id string, doc_id string, category string")
    assert co.category_list(docs).first().asDict() == {"categories": ["x", "y"], "count": 2}
    stats = co.corpus_stats(docs, 7, 256, 0.5).first().asDict()
    assert stats == {
        "n_docs": 3, "n_categories": 2, "svd_dims": 256, "vocab_size": 7, "explained_variance": 0.5,
        "categories": ["x", "y"],
    }
    assert {r.category: r.n for r in docs.groupBy("category").agg(F.count("*").alias("n")).collect()} == {"x": 2, "y": 1}


def test_plain_texts_are_cut_into_tokens_as_the_pattern_does(spark):
    """In Python all texts of plain characters, against the JVM's lower case, folding and pattern."""
    rng = np.random.default_rng(9)
    plain = "".join(map(chr, tm._PLAIN))
    signs = ["a", "b", "Z", "q", "7", "0", "-", "-", "_", " ", "\n", "\u00e9", "\u00c9", "\u00df", "\u00d7", "\u0142", "\u017f", "."]
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 60, 3000)]
    texts += [" ab".join(plain), "ab".join(plain), "-".join(plain), "", " ", "abc", "\u00e9t\u00e9 \u00e9t\u00e9s", None]
    odd = ["stra\u00dfe \ufb01ne caf\u00e9", "abc\u0130def \u0130stanbul", "a\u0301bc abc", "\u2019tis isn\u2019t", "x\u00b2 abc\u00aa", "abc \U0001f600 def", "\u0149abc \u0133sland"]
    texts = [t for pair in zip(texts, odd * 1000) for t in pair]
    frame = spark.createDataFrame(pa.table({"id": list(range(len(texts))), "text": pa.array(texts, pa.string())}))
    rows = tm.with_odd_tokens(tm.with_tokens(frame, "text", "want"), "text", "odd").toArrow().sort_by("id")
    want, found = rows.column("want").combine_chunks(), rows.column("odd").combine_chunks()
    assert [i for i, t in enumerate(found.to_pylist()) if t is not None] == list(range(1, len(texts), 2))
    got = tm.tokens_of(rows.column("text").combine_chunks(), found)
    assert [t or [] for t in want.to_pylist()] == got.to_pylist()
    parts = [t for lo, part in tm.text_slices(rows.column("text").combine_chunks(), found) for t in part.to_pylist()]
    assert parts == got.to_pylist()
    assert parts and tm.tokens_of(pa.array(["x"] * 3).slice(1, 0), found.slice(0, 0)).to_pylist() == []


def test_distinct_terms_are_coded_as_all_terms_are_found():
    tokens = pa.array([["aa", "bb", "aa", "bb"], [], None, ["bb"], ["cc", "aa", "bb"]])
    row, place, names = tm.coded_terms(tokens.slice(0))
    want_row, want = tm.terms_of(tokens)
    assert row.tolist() == want_row.tolist() and names.take(pa.array(place)).to_pylist() == want.to_pylist()
    assert len(set(names.to_pylist())) == len(names)


def test_white_space_is_collapsed_and_blanks_counted_as_before(spark):
    rng = np.random.default_rng(10)
    signs = [" ", " ", "\t", "\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u3000", "a", "\u00e9", "\u2019", "~", "!", "\x7f", "\x00"]
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 30, 2000)] + ["", " ", "  ", "a b", "a \n b", "\na", None]
    frame = spark.createDataFrame([(t,) for t in texts], "raw string")
    flat = frame.select("raw", tx.flattened(F.col("raw")).alias("flat"), F.trim(F.regexp_replace("raw", tx.WS + "+", " ")).alias("want"))
    rows = flat.select("*", tx.flat_token_count(F.col("flat")).alias("n"), tx.token_count(F.col("flat")).alias("words")).collect()
    assert all(r.flat == r.want and r.n == r.words for r in rows)
    plan = flat._jdf.queryExecution().optimizedPlan().toString() + str(tx.flat_token_count(F.col("x")))
    assert tx.WIDE_WS in plan and "translate" not in plan


def test_broken_characters_are_not_plain():
    """The first byte of a pair at a text's end, its second at the next one's start, and one that no pair has."""
    raw = [b"abc\xc3", b"\xa9abc", b"caf\xc3\xa9", b"\xc3\xc3\xa9", b"\xc3\xa9\xa9", b"\xff", b"", b"\xc2\xa0", b"\xe2\x80\x99", b"\xc4\xb0", b"\xc5\xbf\xc3\x97"]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int32)
    texts = pa.StringArray.from_buffers(len(raw), pa.py_buffer(offsets), pa.py_buffer(b"".join(raw)))
    assert np.flatnonzero(~tm._odd(texts)).tolist() == [2, 6, 10]
    assert tm._odd(texts.slice(2, 1)).tolist() == [False] and tm._odd(texts.slice(0, 0)).tolist() == []

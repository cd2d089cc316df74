"""Registered queries over the text tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.operators import corpus as co
from textorbit.operators.lsa import LsaModel, fit_lsa
from textorbit.operators import search as se
from textorbit.operators import tfidf as ti
from textorbit.plans import engine, inputs
from textorbit.session import new_path, spread, stage
from textorbit.sources.store import append_documents


def clean_posts(spark: SparkSession, sf: str) -> DataFrame:
    return co.clean_posts(inputs.wrapped_posts(spark, sf)).select("category", "doc_id", "text", "n_tokens", "id")


def post_subject(spark: SparkSession, sf: str) -> DataFrame:
    return co.clean_posts(inputs.wrapped_posts(spark, sf)).select("doc_id", "subject")


def load_report(spark: SparkSession, sf: str) -> DataFrame:
    return co.load_report(co.clean_posts(inputs.plain_posts(spark, sf)))


def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.corpus(spark, sf).select("id", "doc_id", "category", "n_tokens")


def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(stage(inputs.corpus(spark, sf), "corpus"))
    size = ti.fit_vocab(docs).count()
    stats = co.corpus_stats(docs, size, 256, 0.0)
    return stats.select(
        "n_docs",
        "n_categories",
        F.col("vocab_size").cast("long").alias("vocab_size"),
        F.array_join("categories", ",").alias("categories"),
    )


def category_index(spark: SparkSession, sf: str) -> DataFrame:
    return co.category_index(inputs.corpus(spark, sf))


def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return co.category_counts(inputs.corpus(spark, sf))


def category_list(spark: SparkSession, sf: str) -> DataFrame:
    row = co.category_list(inputs.corpus(spark, sf))
    return row.select(F.array_join("categories", ",").alias("categories"), F.col("count").alias("n"))


def term_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(stage(inputs.corpus(spark, sf).select("id", "text"), "corpus"))
    return ti.term_counts(docs).select("id", "term", F.col("tf").cast("long").alias("tf"))


def doc_freq_vocab(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(stage(inputs.corpus(spark, sf).select("id", "text"), "corpus"))
    return ti.fit_vocab(docs).select(
        "term", F.col("term_id").cast("long").alias("term_id"), "df", "total", F.round("idf", 6).alias("idf")
    )


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(stage(inputs.corpus(spark, sf).select("id", "text"), "corpus"))
    vocab = ti.collect_vocab(ti.fit_vocab(docs))
    rows = ti.weight_table(ti.sparse_rows(docs, vocab))
    # The vocabulary is capped, so it is broadcast.
    names = F.broadcast(spark.createDataFrame(vocab).select("term", "term_id"))
    return rows.join(names, "term_id").select("id", "term", F.round("weight", 6).alias("weight"))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """User turns with every kind of valid and invalid argument."""
    turns = inputs.user_turns(spark, sf)
    kind = F.col("conv_id") % 5
    place = (F.col("conv_id") + F.floor(F.col("turn") / 2)) % 4
    return turns.select(
        "query_id",
        F.when(F.col("conv_id") % 7 == 0, " \t ").otherwise(F.concat(F.lit("  "), "query")).alias("query"),
        F.when(kind == 0, 0).when(kind == 2, 100).when(kind == 3, 101).when(kind == 4, 5).cast("int").alias("top_k"),
        F.when(place == 0, F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")))
        .when(place == 1, "")
        .when(place == 2, "nowhere")
        .alias("category"),
        F.when(F.col("conv_id") % 3 == 0, True).alias("return_text"),
    )


def valid_queries(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.table(spark, sf, "documents").select(F.col("source").alias("category"))
    valid, _ = se.validate_queries(_requests(spark, sf), docs)
    return valid.withColumn("top_k", F.col("top_k").cast("long"))


def rejected_queries(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.table(spark, sf, "documents").select(F.col("source").alias("category"))
    _, rejected = se.validate_queries(_requests(spark, sf), docs)
    return rejected.select("query_id", "reason", F.array_join("valid_categories", ",").alias("valid_categories"))


def doc_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Look up the id of every post, kept or not, in the corpus."""
    # Posts are cleaned once; ids, metadata and texts are read from the result.
    posts = stage(co.clean_posts(inputs.plain_posts(spark, sf)).drop("subject"), "cleaned")
    docs = stage(co.first_copies(posts, co.MIN_TOKENS).select("id", "doc_id", "category", "text", "n_tokens"), "corpus")
    return se.find_documents(posts.select("id"), docs.drop("text"), docs.select("id", "text"))


def add_documents(spark: SparkSession, sf: str) -> DataFrame:
    passages = inputs.table(spark, sf, "benchmark").select("text", F.lit("benchmark").alias("category"))
    docs = inputs.corpus(spark, sf)
    return se.add_documents(docs, passages, None).select("id", "doc_id", "category", "n_tokens")


def add_documents_dedup(spark: SparkSession, sf: str) -> DataFrame:
    passages = inputs.table(spark, sf, "documents").select("text", F.lit("again").alias("category"))
    docs = inputs.corpus(spark, sf)
    return se.add_documents(docs, passages, None, dedup=True).select("id", "doc_id", "category", "n_tokens")


def _stored(spark: SparkSession, sf: str, append: bool) -> DataFrame:
    """Documents of a store written with a small model and read back, perhaps after an append, with all that is stored of them."""
    path = new_path(spark, "store")
    store = engine.build_store(spark, inputs.plain_posts(spark, sf), path, dims=8, n_iter=1)
    if append:
        passages = inputs.table(spark, sf, "benchmark").select("text", F.lit("benchmark").alias("category"))
        store = append_documents(store, passages)
    sizes = store.embeddings.select("id", "category", F.size("embedding").alias("dims")).distinct()
    texts = store.texts.distinct().select("id", F.length("text").cast("long").alias("n_chars"))
    index = store.category_index.select("id", "doc_id", "category")
    rows = store.corpus.join(index, ["id", "doc_id", "category"], "left_semi").join(texts, "id").join(sizes, ["id", "category"])
    return rows.select("id", "doc_id", "category", F.col("n_tokens").cast("long").alias("n_tokens"), "n_chars", F.col("dims").cast("long").alias("dims"))


def store_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, sf, False)


def store_append(spark: SparkSession, sf: str) -> DataFrame:
    """The same after the benchmark's passages were appended to the store."""
    return _stored(spark, sf, True)


def lsa_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Build corpus and space afresh; later queries of the session use the result."""
    space = inputs.text_space(spark, sf, refit=True)
    stats = co.corpus_stats(space.docs, space.model.vocab.num_rows, space.model.dims, space.model.explained_variance)
    return stats.withColumn("explained_variance", F.round("explained_variance", 4))


def lsa_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Documents embedded afresh with the fitted model."""
    space = inputs.text_space(spark, sf)
    return space.model.embed(space.docs).select("id", "embedding")


def lsa_search(spark: SparkSession, sf: str) -> DataFrame:
    """Ten best documents for each benchmark passage."""
    space = inputs.text_space(spark, sf)
    queries = inputs.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return se.search(queries, space.model, space.embeddings, space.docs)


def lsa_search_category(spark: SparkSession, sf: str) -> DataFrame:
    """Three best documents of one category for each user turn, with their text."""
    space = inputs.text_space(spark, sf)
    queries = inputs.user_turns(spark, sf).select(
        "query_id",
        "query",
        F.lit(3).alias("top_k"),
        F.concat(F.lit("src"), (F.col("conv_id") % 20).cast("string")).alias("category"),
    )
    return se.search(queries, space.model, space.embeddings, space.docs, space.docs.select("id", "text"))


# A space that SQL can repeat: so many terms and axes, and as many directions as terms, so nothing is left to chance.
AXES_TERMS, AXES = 20, 3


def _axes(spark: SparkSession, sf: str) -> tuple[DataFrame, LsaModel, DataFrame]:
    docs = spread(stage(inputs.corpus(spark, sf), "corpus"))
    model, embeddings = fit_lsa(docs, AXES, 1, keep=("id", "category"), oversamples=AXES_TERMS, max_features=AXES_TERMS)
    return docs, model, embeddings


def lsa_axes(spark: SparkSession, sf: str) -> DataFrame:
    """The first axes over the twenty commonest terms, and the variance they explain."""
    _, model, _ = _axes(spark, sf)
    terms = model.vocab_frame(spark).select("term", "term_id").join(model.basis_frame(spark), "term_id")
    return terms.select("term", F.posexplode("v").alias("axis", "x")).select(
        "term", F.col("axis").cast("long").alias("axis"), F.round("x", 4).alias("x"),
        F.lit(round(model.explained_variance, 4)).alias("explained_variance"),
    )


def lsa_axes_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's unit vector along these axes."""
    rows = _axes(spark, sf)[2].select("id", F.posexplode("embedding").alias("axis", "x"))
    return rows.select("id", F.col("axis").cast("long").alias("axis"), F.round(F.col("x").cast("double"), 4).alias("x"))


def lsa_axes_search(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the five documents nearest to each benchmark passage along these axes."""
    docs, model, embeddings = _axes(spark, sf)
    queries = inputs.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"), F.lit(5).alias("top_k"))
    hits = se.search(queries, model, stage(embeddings, "axes-embeddings"), docs)
    return hits.select("query_id", F.col("rank").cast("long").alias("rank"), F.round("score", 4).alias("score"))


QUERIES = {
    f.__name__: f
    for f in (
        clean_posts, post_subject, load_report, dedup_first, corpus_stats, category_index, category_counts,
        category_list, term_counts, doc_freq_vocab, tfidf_weights, valid_queries, rejected_queries, doc_lookup,
        add_documents, add_documents_dedup, store_round_trip, store_append, lsa_axes, lsa_axes_embeddings, lsa_axes_search, lsa_fit, lsa_embeddings, lsa_search, lsa_search_category,
    )
}

# -- SQL ------------------------------------------------------------------------------

_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WS, _NS = f"[{_SPACE}]", f"[^{_SPACE}]"


def _strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{_WS}+|{_WS}+$', '', 'g')"


def _tokens(expr: str) -> str:
    return rf"CAST(len(list_filter(string_split_regex({expr}, '{_WS}+'), lambda x: x <> '')) AS BIGINT)"


_PLAIN = "SELECT source AS category, CAST(doc_id AS VARCHAR) AS doc_id, text AS raw FROM documents"

_WRAPPED = """SELECT source AS category, CAST(doc_id AS VARCHAR) AS doc_id,
  'From: user' || doc_id || '@example.org' || chr(10)
  || CASE WHEN doc_id % 7 <> 0 THEN 'Subject: ' || CASE WHEN doc_id % 3 = 1 THEN 'Re: ' ELSE '' END
       || 'topic ' || source || chr(10) ELSE '' END
  || 'Message-ID: <' || doc_id || '@example.org>' || chr(10) || chr(10)
  || CASE WHEN doc_id % 3 = 0 THEN '> quoted words of a reply' || chr(10) ELSE '' END
  || CASE WHEN doc_id % 4 = 0 THEN 'Organization: some place' || chr(10) ELSE '' END
  || text
  || CASE WHEN doc_id % 5 = 0
       THEN ' see http://example.org/x?y=1 or www.example.org or mail a.b@example.org. ' ELSE '' END
  || CASE WHEN doc_id % 2 = 0 THEN chr(10) || '-- ' || chr(10) || 'name' || chr(10) || 'place' ELSE '' END
  AS raw FROM documents"""


def _cleaned(posts: str) -> str:
    """Common table expressions up to ``cleaned``."""
    subject = _strip(rf"regexp_extract(raw, '(?im)^Subject:{_WS}*(.+)$', 1)")
    subject = _strip(rf"regexp_replace({subject}, '(?i)^(Re|Fwd|Fw):{_WS}*', '')")
    return rf"""
posts AS ({posts}),
split AS (SELECT category, doc_id, {subject} AS subject,
  CASE WHEN instr(raw, chr(10) || chr(10)) > 0
    THEN substr(raw, instr(raw, chr(10) || chr(10)) + 2) ELSE raw END AS b FROM posts),
b1 AS (SELECT * REPLACE (regexp_replace(b, '(?s)\n--{_WS}*\n.*', '', 'g') AS b) FROM split),
b2 AS (SELECT * REPLACE (regexp_replace(b, '(?m)^>.*$', '', 'g') AS b) FROM b1),
b3 AS (SELECT * REPLACE (regexp_replace(b, 'https?://{_NS}+|www\.{_NS}+', ' ', 'g') AS b) FROM b2),
b4 AS (SELECT * REPLACE (regexp_replace(b, '{_NS}+@{_NS}+\.{_NS}+', ' ', 'g') AS b) FROM b3),
b5 AS (SELECT * REPLACE (regexp_replace(b, '(?m)^[A-Za-z\-]+:.*$', ' ', 'g') AS b) FROM b4),
b6 AS (SELECT * REPLACE ({_strip(f"regexp_replace(b, '{_WS}+', ' ', 'g')")} AS b) FROM b5),
texts AS (SELECT category, doc_id, subject,
  CASE WHEN subject <> '' THEN subject || ' ' || subject || ' ' || b ELSE b END AS text FROM b6),
cleaned AS (SELECT *, {_tokens("text")} AS n_tokens, left(sha256(text), 16) AS id FROM texts)"""


_CORPUS = f"""{_cleaned(_PLAIN)},
corpus AS (SELECT id, doc_id, category, text, n_tokens FROM cleaned WHERE n_tokens >= 30
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY category, doc_id) = 1)"""

_TERMS = rf"""{_CORPUS},
toks AS (SELECT id, regexp_extract_all(regexp_replace(strip_accents(lower(text)), '[^\x00-\x7f]', '_', 'g'),
  '\b[a-zA-Z][a-zA-Z0-9\-]{{2,}}\b') AS t FROM corpus),
grams AS (SELECT id, unnest(list_concat(t,
  list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM toks),
tf AS (SELECT id, term, count(*) AS tf FROM grams GROUP BY ALL)"""



def _vocab(terms: int = 50_000) -> str:
    return f"""{_TERMS},
vocab AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS term_id,
  ln((1 + (SELECT count(*) FROM corpus)) / (1 + df)) + 1 AS idf FROM (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term
  HAVING count(*) >= 3 AND count(*) <= 0.85 * (SELECT count(*) FROM corpus)
  ORDER BY total DESC, term LIMIT {terms}))"""


_VOCAB = _vocab()


def _space() -> str:
    """The axes by squaring the terms' cross products ten times, taking each axis out before the next."""
    out = [f"""{_vocab(AXES_TERMS)},
raw AS (SELECT id, term_id AS i, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term)),
w AS (SELECT id, i, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM raw),
cross_ AS (SELECT a.i, b.i AS j, sum(a.w * b.w) AS x FROM w a JOIN w b USING (id) GROUP BY ALL),
m0 AS (SELECT a.term_id AS i, b.term_id AS j, coalesce(x, 0) AS x FROM vocab a CROSS JOIN vocab b
  LEFT JOIN cross_ ON cross_.i = a.term_id AND cross_.j = b.term_id)"""]
    for axis in range(AXES):
        last = f"m{axis}"
        for power in range(10):
            name = f"q{axis}_{power}"
            out.append(f"""{name}x AS (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY ALL),
{name} AS (SELECT i, j, x / (SELECT sqrt(sum(x * x)) FROM {name}x) AS x FROM {name}x)""")
            last = name
        out.append(f"""v{axis}x AS (SELECT i, x / sqrt(sum(x * x) OVER ()) AS x FROM {last}
  WHERE j = (SELECT i FROM {last} WHERE i = j ORDER BY x DESC, i LIMIT 1)),
v{axis} AS (SELECT i, x * (SELECT sign(x) FROM v{axis}x ORDER BY abs(x) DESC LIMIT 1) AS x FROM v{axis}x),
m{axis + 1} AS (SELECT m.i, m.j, m.x - a.x * b.x * (SELECT sum(c.x * n.x * d.x) FROM m{axis} n JOIN v{axis} c ON c.i = n.i
  JOIN v{axis} d ON d.i = n.j) AS x FROM m{axis} m JOIN v{axis} a ON a.i = m.i JOIN v{axis} b ON b.i = m.j)""")
    axes = " UNION ALL ".join(f"SELECT i, {a} AS axis, x FROM v{a}" for a in range(AXES))
    out.append(f"""axes AS ({axes}),
place AS (SELECT id, axis, sum(w * x) AS s FROM w JOIN axes USING (i) GROUP BY ALL),
unit AS (SELECT id, axis, s / sqrt(sum(s * s) OVER (PARTITION BY id)) AS x FROM place)""")
    return ",\n".join(out)


_SPACE_AXES = _space()

# Passages as the space places them: no cleaning, unknown terms dropped.
_PASSAGES = rf"""
ptoks AS (SELECT item_id, regexp_extract_all(regexp_replace(strip_accents(lower(text)), '[^\x00-\x7f]', '_', 'g'),
  '\b[a-zA-Z][a-zA-Z0-9\-]{{2,}}\b') AS t FROM benchmark),
ptf AS (SELECT item_id, term, count(*) AS tf FROM (SELECT item_id, unnest(list_concat(t,
  list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM ptoks) GROUP BY ALL),
praw AS (SELECT item_id, axis, sum((1 + ln(tf)) * idf * x) AS s FROM ptf JOIN vocab USING (term) JOIN axes ON axes.i = term_id GROUP BY ALL),
punit AS (SELECT item_id, axis, s / sqrt(sum(s * s) OVER (PARTITION BY item_id)) AS x FROM praw)"""

_REQUESTS = f"""
turns AS (SELECT conv_id * 1000 + turn AS query_id, text AS query, conv_id, turn
  FROM conversations WHERE role = 'user'),
requests AS (SELECT query_id,
  CASE WHEN conv_id % 7 = 0 THEN ' ' || chr(9) || ' ' ELSE '  ' || query END AS query,
  CASE conv_id % 5 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN 100 WHEN 3 THEN 101 ELSE 5 END AS top_k,
  CASE (conv_id + turn // 2) % 4 WHEN 0 THEN 'src' || (conv_id % 20) WHEN 1 THEN '' WHEN 2 THEN 'nowhere' END
    AS category,
  CASE WHEN conv_id % 3 = 0 THEN true END AS return_text FROM turns),
filled AS (SELECT query_id, {_strip("query")} AS query, CAST(coalesce(top_k, 10) AS BIGINT) AS top_k,
  nullif(category, '') AS category, coalesce(return_text, false) AS return_text FROM requests),
judged AS (SELECT *, CASE WHEN query = '' THEN 'Field ''query'' is required and must be non-empty.'
  WHEN top_k < 1 OR top_k > 100 THEN '''top_k'' must be between 1 and 100.'
  WHEN category IS NOT NULL AND category NOT IN (SELECT source FROM documents)
    THEN 'Unknown category: ''' || category || '''' END AS reason FROM filled)"""

ORACLES = {
    "clean_posts": f"WITH {_cleaned(_WRAPPED)} SELECT category, doc_id, text, n_tokens, id FROM cleaned",
    "post_subject": f"WITH {_cleaned(_WRAPPED)} SELECT doc_id, subject FROM cleaned",
    "load_report": f"""WITH {_cleaned(_PLAIN)} SELECT count(*) AS total_raw,
  count(DISTINCT id) FILTER (n_tokens >= 30) AS kept,
  count(*) FILTER (n_tokens < 30) AS dropped_short,
  count(*) FILTER (n_tokens >= 30) - count(DISTINCT id) FILTER (n_tokens >= 30) AS dropped_duplicate
  FROM cleaned""",
    "dedup_first": f"WITH {_CORPUS} SELECT id, doc_id, category, n_tokens FROM corpus",
    "corpus_stats": f"""WITH {_VOCAB} SELECT count(*) AS n_docs, count(DISTINCT category) AS n_categories,
  (SELECT count(*) FROM vocab) AS vocab_size,
  (SELECT string_agg(category, ',' ORDER BY category) FROM (SELECT DISTINCT category FROM corpus)) AS categories
  FROM corpus""",
    "category_index": f"WITH {_CORPUS} SELECT category, id, doc_id FROM corpus",
    "category_counts": f"WITH {_CORPUS} SELECT category, count(*) AS n_docs FROM corpus GROUP BY category",
    "category_list": f"""WITH {_CORPUS} SELECT string_agg(category, ',' ORDER BY category) AS categories,
  count(*) AS n FROM (SELECT DISTINCT category FROM corpus)""",
    "term_counts": f"WITH {_TERMS} SELECT id, term, tf FROM tf",
    "doc_freq_vocab": f"WITH {_VOCAB} SELECT term, term_id, df, total, round(idf, 6) AS idf FROM vocab",
    "tfidf_weights": f"""WITH {_VOCAB},
raw AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN vocab USING (term))
SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM raw""",
    "valid_queries": f"""WITH {_REQUESTS} SELECT query_id, query, top_k, category, return_text FROM judged
  WHERE reason IS NULL""",
    "rejected_queries": f"""WITH {_REQUESTS} SELECT query_id, reason,
  CASE WHEN reason LIKE 'Unknown category%' THEN (SELECT string_agg(source, ',' ORDER BY source)
    FROM (SELECT DISTINCT source FROM documents)) END AS valid_categories
  FROM judged WHERE reason IS NOT NULL""",
    "doc_lookup": f"WITH {_CORPUS} SELECT id, doc_id, category, n_tokens, text FROM corpus",
    "lsa_axes": f"""WITH {_SPACE_AXES},
n AS (SELECT count(*) AS n FROM corpus),
kept AS (SELECT sum(v) AS v FROM (SELECT axis, sum(s * s) / n - (sum(s) / n) ** 2 AS v FROM place, n GROUP BY axis, n)),
whole AS (SELECT sum(v) AS v FROM (SELECT i, sum(w * w) / n - (sum(w) / n) ** 2 AS v FROM w, n GROUP BY i, n))
SELECT term, CAST(axis AS BIGINT) AS axis, round(x, 4) AS x, round((SELECT v FROM kept) / (SELECT v FROM whole), 4) AS explained_variance
FROM axes JOIN vocab ON term_id = i""",
    "lsa_axes_embeddings": f"""WITH {_SPACE_AXES}
SELECT id, CAST(axis AS BIGINT) AS axis, round(coalesce(x, 0), 4) AS x FROM corpus CROSS JOIN (SELECT DISTINCT axis FROM axes)
LEFT JOIN unit USING (id, axis)""",
    "lsa_axes_search": f"""WITH {_SPACE_AXES}, {_PASSAGES},
score AS (SELECT item_id AS query_id, c.id, coalesce(sum(p.x * u.x), 0) AS score FROM benchmark CROSS JOIN corpus c
  LEFT JOIN punit p USING (item_id) LEFT JOIN unit u ON u.id = c.id AND u.axis = p.axis GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC) AS rank FROM score)
SELECT query_id, rank, round(score, 4) AS score FROM ranked WHERE rank <= 5""",
    "store_round_trip": f"""WITH {_CORPUS} SELECT id, doc_id, category, n_tokens, length(text) AS n_chars,
  CAST(8 AS BIGINT) AS dims FROM corpus""",
    "store_append": f"""WITH {_CORPUS} SELECT id, doc_id, category, n_tokens, length(text) AS n_chars,
  CAST(8 AS BIGINT) AS dims FROM corpus
  UNION ALL SELECT left(sha256(text), 16), 'custom', 'benchmark', {_tokens("text")}, length(text), 8 FROM benchmark""",
    "add_documents": f"""WITH {_CORPUS} SELECT id, doc_id, category, n_tokens FROM corpus
  UNION ALL SELECT left(sha256(text), 16), 'custom', 'benchmark', {_tokens("text")} FROM benchmark""",
    "add_documents_dedup": f"""WITH {_CORPUS} SELECT id, doc_id, category, n_tokens FROM corpus
  UNION ALL SELECT left(sha256(text), 16), 'custom', 'again', {_tokens("text")} FROM documents
  WHERE left(sha256(text), 16) NOT IN (SELECT id FROM corpus)""",
}

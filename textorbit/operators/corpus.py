"""Raw posts to a clean, deduplicated corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textorbit.functions import text as tx

MIN_TOKENS = 30

KEPT, SHORT, DUPLICATE = "kept", "short", "duplicate"


def clean_posts(posts: DataFrame, raw: str = "raw", strip_chain: bool = False) -> DataFrame:
    """Replace ``raw`` by ``subject, text, n_tokens, id``.

    Every step that a later one uses twice is a projection of its own, which the
    optimizer leaves in place instead of evaluating the expression at each use.
    """
    others = [c for c in posts.columns if c != raw]
    cleaned = (
        posts.withColumn("subject", tx.post_subject(F.col(raw), strip_chain))
        .withColumn("_body", tx.without_trailer(tx.post_body(F.col(raw))))
        .withColumn("_body", tx.without_addresses(F.col("_body")))
        .withColumn("_body", tx.flattened(F.col("_body")))
        .withColumn("text", tx.boosted_text(F.col("subject"), F.col("_body")))
    )
    return cleaned.select(
        *others,
        "subject",
        "text",
        # The text is the subject twice and the body, joined by blanks.
        (2 * tx.token_count(F.col("subject")) + tx.flat_token_count(F.col("_body"))).alias("n_tokens"),
        tx.content_id(F.col("text")).alias("id"),
    )


def keep_long(docs: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    return docs.filter(F.col("n_tokens") >= min_tokens)


def first_copies(docs: DataFrame, min_tokens: int = 0) -> DataFrame:
    """Keep the first of all documents with the same ``id`` by ``(category, doc_id)``.

    The rank filter runs before the shuffle too, so of a text copied into a third of
    the corpus each task sends one row. Copies share their length, so the length test
    may follow the ranking; put before it, the optimizer would push it down and clean
    every text a second time to evaluate it.
    """
    order = W.partitionBy("id").orderBy("category", "doc_id")
    first = (F.col("_copy") == 1) & (F.col("n_tokens") >= min_tokens)
    return docs.withColumn("_copy", F.row_number().over(order)).filter(first).drop("_copy")


def build_corpus(posts: DataFrame, raw: str = "raw", min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``Doc`` rows of the posts that are long enough, one per text."""
    docs = first_copies(clean_posts(posts, raw), min_tokens)
    return docs.select("id", "doc_id", "category", "text", "n_tokens")


def load_report(cleaned: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """How many posts were read, kept, dropped as too short and dropped as copies.

    A copy of a short post counts as short. Grouping by id first combines copies
    before the shuffle; only counts travel.
    """
    per_id = cleaned.groupBy("id").agg(
        F.count("*").alias("n"), (F.max("n_tokens") < min_tokens).alias("short")
    )
    n_all = F.coalesce(F.sum("n"), F.lit(0))
    n_short = F.coalesce(F.sum(F.when(F.col("short"), F.col("n"))), F.lit(0))
    n_kept = F.count_if(~F.col("short"))
    return per_id.agg(
        n_all.alias("total_raw"),
        n_kept.alias(KEPT),
        n_short.alias(f"dropped_{SHORT}"),
        (n_all - n_short - n_kept).alias(f"dropped_{DUPLICATE}"),
    )


def category_index(docs: DataFrame) -> DataFrame:
    """The documents of each category as rows; written partitioned by category.

    One row per document: a category may hold a third of the corpus, so its members
    are never gathered into one list.
    """
    return docs.select("category", "id", "doc_id")


def category_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("category").agg(F.count("*").alias("n_docs"))


def category_list(docs: DataFrame) -> DataFrame:
    """One row: sorted category names and their number."""
    names = docs.select("category").distinct()
    return names.agg(
        F.sort_array(F.collect_set("category")).alias("categories"),
        F.count("*").alias("count"),
    )


def corpus_stats(docs: DataFrame, vocab_size: int, dims: int, explained: float) -> DataFrame:
    """One row describing the corpus and its vector space."""
    per_category = category_counts(docs)
    return per_category.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.count("*").alias("n_categories"),
        F.sort_array(F.collect_set("category")).alias("categories"),
    ).select(
        "n_docs",
        "n_categories",
        F.lit(dims).alias("svd_dims"),
        F.lit(vocab_size).alias("vocab_size"),
        F.lit(float(explained)).alias("explained_variance"),
        "categories",
    )

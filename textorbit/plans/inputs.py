"""The given tables in the shapes the operators take."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.operators.corpus import build_corpus
from textorbit.operators.lsa import LsaModel, fit_lsa
from textorbit.operators.vmf import fit_vmf, mean_directions
from textorbit.session import spread, stage

N_CLUSTERS, KAPPA = 17, 20.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts without headers; the source is the category."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return docs.select(
        F.col("source").alias("category"),
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("text").alias("raw"),
    )


def wrapped_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dressed up as news posts: headers, quotes, links and signatures."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    number, name = F.col("doc_id"), F.col("doc_id").cast("string")

    def every(n: int, rest: int, text) -> F.Column:
        return F.when(number % n == rest, text).otherwise("")

    subject = F.concat(F.lit("Subject: "), every(3, 1, "Re: "), F.lit("topic "), F.col("source"), F.lit("\n"))
    raw = F.concat(
        F.lit("From: user"),
        name,
        F.lit("@example.org\n"),
        F.when(number % 7 != 0, subject).otherwise(""),
        F.lit("Message-ID: <"),
        name,
        F.lit("@example.org>\n\n"),
        every(3, 0, "> quoted words of a reply\n"),
        every(4, 0, "Organization: some place\n"),
        F.col("text"),
        every(5, 0, " see http://example.org/x?y=1 or www.example.org or mail a.b@example.org. "),
        every(2, 0, "\n-- \nname\nplace"),
    )
    return docs.select(F.col("source").alias("category"), name.alias("doc_id"), raw.alias("raw"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as documents; the label is the category."""
    name = F.col("vec_id").cast("string")
    return table(spark, sf_dir, "embeddings").select(
        name.alias("id"),
        F.concat(F.lit("v"), name).alias("doc_id"),
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("category"),
        "embedding",
        "label",
        "vec_id",
    )


def label_centroids(spark: SparkSession, sf_dir: str) -> np.ndarray:
    return mean_directions(vectors(spark, sf_dir), "label")[1]


@dataclass
class TextSpace:
    """A staged corpus, its fitted model and its vectors."""

    docs: DataFrame
    model: LsaModel
    embeddings: DataFrame
    centroids: np.ndarray | None = None


_spaces: dict[tuple[str, str], TextSpace] = {}


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_corpus(plain_posts(spark, sf_dir))


def fit_space(spark: SparkSession, sf_dir: str) -> TextSpace:
    docs = spread(stage(corpus(spark, sf_dir), "corpus"))
    model, embeddings = fit_lsa(docs, keep=("id", "category"))
    return TextSpace(docs, model, stage(embeddings, "embeddings"))


def text_space(spark: SparkSession, sf_dir: str, clusters: bool = False, refit: bool = False) -> TextSpace:
    """The fitted space of a data folder: built once per session, as a service would."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if refit or key not in _spaces:
        _spaces[key] = fit_space(spark, sf_dir)
    space = _spaces[key]
    if clusters and space.centroids is None:
        space.centroids = fit_vmf(space.embeddings.select("id", "embedding"), N_CLUSTERS, KAPPA)
    return space


def user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of the conversations as a query log in ``(conv_id, turn)`` order."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    number = F.col("conv_id") * 1000 + F.col("turn")
    return turns.select(
        number.alias("query_id"),
        F.timestamp_seconds(number).alias("ts"),
        F.col("text").alias("query"),
        "conv_id",
        "turn",
    )

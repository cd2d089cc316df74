"""Exact medians of large groups without gathering any group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rank error of the sketch is at most group size / ACCURACY.
ACCURACY = 10_000


def exact_medians(df: DataFrame, group: str, values: list[str]) -> DataFrame:
    """``(group, <value>_median, ...)``; an even group takes the mean of the middle two.

    The built-in exact percentile holds a group's distinct values in one buffer. Here a
    mergeable sketch first brackets the median ranks; a second aggregation counts what
    lies below the bracket and keeps only values inside it, under 1 / 1,000 of a
    group, as (value, count) pairs. The ranks are then read off exactly.
    """
    long = df.select(
        group,
        F.explode(
            F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("x")) for v in values])
        ).alias("e"),
    ).select(group, "e.name", "e.x")
    keys = [group, "name"]
    slack = 4.0 / ACCURACY
    brackets = long.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.percentile_approx("x", [0.5 - slack, 0.5 + slack], ACCURACY).alias("q"),
        F.min("x").alias("least"),
        F.max("x").alias("most"),
    )
    # Small groups: the sketch may step over a middle rank, so bracket the whole group.
    few = F.col("n") <= ACCURACY
    brackets = brackets.select(
        *keys,
        "n",
        F.when(few, F.col("least")).otherwise(F.get("q", F.lit(0))).alias("lo"),
        F.when(few, F.col("most")).otherwise(F.get("q", F.lit(1))).alias("hi"),
    )
    # One bracket row per group and value: clusters number a few dozen, so it is broadcast.
    # Values under the bracket collapse into one pair, values over it are not needed.
    counts = (
        long.join(F.broadcast(brackets), keys)
        .filter(F.col("x") <= F.col("hi"))
        .withColumn("v", F.when(F.col("x") >= F.col("lo"), F.col("x")))
        .groupBy(*keys, "n", "v")
        .agg(F.count("*").alias("c"))
    )
    upto = W.partitionBy(*keys).orderBy(F.col("v").asc_nulls_first()).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    ranked = counts.withColumn("last", F.sum("c").over(upto))
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1

    def at(rank):
        return F.min(F.when(F.col("last") >= rank, F.col("v")))

    middles = ranked.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias("median"))
    return middles.groupBy(group).agg(
        *[F.max(F.when(F.col("name") == v, F.col("median"))).alias(f"{v}_median") for v in values]
    )

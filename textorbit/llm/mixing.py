"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are seats: sources get them by the highest quotients of their targets, and within a source
its shards get theirs by the highest quotients of their sizes. A shard's documents lie end to end
in seeded order, cut into equal blocks, which are smaller in small shards, down to one word; a
quota of more than all words takes whole passes first, and the rest of the quota goes, in whole
blocks, to those with the smallest seeded hashes. Shards hold a bounded number of words, so that no
window or sort grows with a source, however much of the data one source has.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textorbit.llm.common import append_columns, n_words, table, without

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3
BLOCK_WORDS = 64
# A shard has so many blocks at least, or one of each word.
LEAST_BLOCKS = 64
SHARD_WORDS = 200_000
SEED = 20_240_229

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """Append ``target`` to one row per source (source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn and share all words;
    targets stop at ``max_repeat`` times their source's size, and the excess is shared again by
    weight. Sorted by cap per weight, the stopped sources come first, so one pass of running
    sums finds the level at which the rest stand.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    rows = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    every = Window.partitionBy()
    stops = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    rows = rows.withColumns({"level": level, "place": F.row_number().over(stops)})
    free = F.when(F.col("cap") >= F.col("w") * F.col("level"), F.struct("place", "level"))
    rows = rows.withColumn("final", F.min(free).over(every)["level"])
    target = F.least(F.col("cap"), F.col("w") * F.coalesce(F.col("final"), F.col("level")))
    return rows.select("source", "source_size", target.alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], name: list[str], votes: str, seats: str) -> DataFrame:
    """Append ``quota``: seats of each party by the highest quotients votes / (2 s + 1), ties by name.

    Rounding at a divisor that is surely too large gives every party seats that it surely wins;
    what is left, at most one seat per party on average, goes by rank of the next quotients. A
    group's ranking holds about three rows per party.
    """
    of = Window.partitionBy(*group)
    v, n, total = F.col(votes).cast("double"), F.sum((F.col(votes) > 0).cast("long")).over(of), F.sum(F.col(votes).cast("double")).over(of)
    rows = parties.withColumns({"__n": n, "__total": total})
    share = F.when(F.col("__total") > 0, v / F.col("__total")).otherwise(F.lit(0.0))
    low = F.floor(share * (F.col(seats) - F.col("__n") / 2) + 0.5)
    sure = F.greatest(low, F.lit(0)).cast("long")
    most = F.ceil(share * (F.col(seats) + F.col("__n") / 2) + 1).cast("long")
    rows = rows.withColumns({"__sure": sure, "__most": most})
    rows = rows.withColumn("__left", F.col(seats) - F.sum("__sure").over(of))
    keys = [*group, *name]
    tries = rows.filter((v > 0) & (F.col("__most") >= F.col("__sure"))).select(
        *keys, "__left", v.alias("__v"), F.explode(F.sequence("__sure", "__most")).alias("__s")
    )
    order = Window.partitionBy(*group).orderBy(F.desc(F.col("__v") / (2 * F.col("__s") + 1)), *name)
    won = tries.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= F.col("__left"))
    won = won.groupBy(*keys).agg(F.count("*").alias("__won"))
    for k in keys:
        won = won.withColumnRenamed(k, f"__k_{k}")
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    rows = rows.join(won, same, "left").withColumn("quota", F.col("__sure") + F.coalesce(F.col("__won"), F.lit(0)))
    return rows.select(*parties.columns, "quota")


def mix_sources(
    docs: DataFrame,
    weights=WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Append ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes) to every row,
    and how they are taken: whole ``passes`` and the word ranges ``picked`` besides.

    Texts that are null or without words have size 0 and give nothing; a null source is a source
    of its own, the last one. Ties between quotients go by name. Repeated rows are rows of their
    own. Without any word all targets are 0; an empty table stays empty. Long texts span many
    blocks, each chosen by itself. The same rows always give the same mix. Other columns are
    carried along, and columns named like a result are replaced by it.
    """
    added = ["size", "source_size", "target", "taken", "passes", "picked"]
    keep = without(docs, added)
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col("source").alias("__source"),
        n_words(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("__order"),
        F.xxhash64(F.lit(seed + 1), "doc_id", "text").alias("__deal"),
    )
    sources, shards = plan_mix(rows, weights, max_repeat, block_words, shard_words, seed)
    rows = rows.join(sources.select("source", "n_shards"), F.col("__source").eqNullSafe(sources["source"])).drop(sources["source"])
    rows = rows.withColumn("__shard", F.pmod("__deal", "n_shards").cast("int"))
    line = Window.partitionBy("__source", "__shard").orderBy("__order", "__deal")
    end = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("__end", end).withColumn("__start", F.col("__end") - F.col("size"))
    plan = shards.select(F.col("source").alias("__s"), F.col("shard").alias("__h"), "source_size", "target", "n_blocks", "shard_size", "passes", "bar")
    rows = rows.join(plan, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__shard") == F.col("__h")), "left")

    # Block b of n covers words b * size div n up to (b + 1) * size div n of its shard.
    touched = F.expr(
        "CASE WHEN size > 0 AND bar IS NOT NULL THEN sequence(((__start + 1) * n_blocks - 1) div shard_size, (__end * n_blocks - 1) div shard_size) END"
    )
    rows = rows.withColumn("__blocks", touched)
    picked = F.expr(
        f"""transform(filter(__blocks, b -> xxhash64({seed + 2}, __source, __shard, CAST(b AS BIGINT)) <= bar), b -> struct(
        greatest(__start, b * shard_size div n_blocks) - __start AS first,
        least(__end, (b + 1) * shard_size div n_blocks) - __start AS end))"""
    )
    rows = rows.withColumn("__picked", F.filter(picked, lambda x: x["first"] < x["end"]))
    part = F.aggregate("__picked", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["first"])
    passes = F.coalesce(F.col("passes"), F.lit(0)).cast("int")
    return rows.select(
        *[F.col(f"`{c}`") for c in keep],
        "size",
        F.coalesce("source_size", F.lit(0)).cast("long").alias("source_size"),
        F.coalesce("target", F.lit(0.0)).alias("target"),
        (passes * F.col("size") + F.coalesce(part, F.lit(0))).cast("long").alias("taken"),
        passes.alias("passes"),
        F.col("__picked").alias("picked"),
    )


def take(mixed: DataFrame) -> DataFrame:
    """Rows of a mix as it is written out: each document once per whole pass, and once with its picked words.

    Picked words keep the white space between them; where words were left out a line ends. Such
    a row's ``n_chars`` is that of its new text. Documents of which nothing is taken are gone.
    """
    columns = without(mixed, ["size", "source_size", "target", "taken", "passes", "picked"])
    # One row per pass, numbered from 1, and one, numbered 0, for the picked words.
    uses = F.sequence(F.when(F.size("picked") > 0, F.lit(0)).otherwise(F.lit(1)), F.col("passes"))
    taken = mixed.filter("taken > 0").select(*columns, "picked", F.explode(uses).alias("__pass"))

    def cut(texts, picks, numbers):
        out = []
        for text, ranges, number in zip(texts, picks, numbers):
            if number:
                out.append(text)
                continue
            spans = [m.span() for m in _WORD.finditer(text)]
            runs: list[list[int]] = []
            for r in ranges:
                if runs and runs[-1][1] == r["first"]:
                    runs[-1][1] = r["end"]
                else:
                    runs.append([r["first"], r["end"]])
            out.append("\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in runs))
        return [out]

    rows = append_columns(taken, ["text", "picked", "__pass"], "text string", cut)
    if "n_chars" in columns:
        own = F.length("text").cast(mixed.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("__pass") == 0, own).otherwise(F.col("n_chars")))
    return rows.select(*columns)


def plan_mix(rows: DataFrame, weights, max_repeat, block_words, shard_words, seed) -> tuple[DataFrame, DataFrame]:
    """Quotas of sources and shards from their sizes; tables of one row per source and per shard."""
    sizes = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("size").alias("source_size"))
    sources = source_targets(sizes, weights, max_repeat)
    sources = sources.withColumns({
        "n_shards": F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("int"),
        "seats": F.sum("source_size").over(Window.partitionBy()),
    })
    sources = sainte_lague(sources, [], ["source"], "target", "seats").withColumnRenamed("quota", "source_quota")
    n = sources.select(F.col("source").alias("__n_source"), "n_shards")
    dealt = rows.join(n, F.col("__source").eqNullSafe(F.col("__n_source")))
    shards = dealt.groupBy("__source", F.pmod("__deal", "n_shards").cast("int").alias("shard")).agg(F.sum("size").alias("shard_size"))
    shards = shards.join(sources, F.col("__source").eqNullSafe(sources["source"])).drop("__source")
    shards = sainte_lague(shards, ["source"], ["shard"], "shard_size", "source_quota")
    least = F.least(F.col("shard_size"), F.lit(LEAST_BLOCKS))
    blocks = F.greatest(F.round(F.col("shard_size") / block_words), least, F.lit(1)).cast("long")
    quota = F.least(F.col("quota"), F.col("shard_size") * max_repeat)
    shards = shards.withColumns({"n_blocks": blocks, "quota": quota})
    # What whole passes leave, in blocks; a shard without words has no quota.
    extra = F.expr("CASE WHEN shard_size > 0 THEN CAST(round((quota % shard_size) * n_blocks / shard_size) AS BIGINT) ELSE 0L END")
    passes = F.expr("CASE WHEN shard_size > 0 THEN quota div shard_size ELSE 0L END")
    shards = shards.withColumns({"passes": passes, "extra": extra})
    bar = F.expr(
        f"""CASE WHEN extra > 0 AND shard_size > 0 THEN element_at(array_sort(transform(sequence(0L, n_blocks - 1),
        b -> xxhash64({seed + 2}, source, shard, b))), CAST(extra AS INT)) END"""
    )
    return sources, shards.withColumn("bar", bar)


def op5_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op5_sainte_lague": op5_sainte_lague}
ORACLES: dict[str, str] = {}

"""Minimum-cost-flow resharding.

Rows lie in shards, and within a shard in files and blocks. From the shards' old sizes and their
new capacities a minimum-cost flow says how many bytes go from which shard to which, moving the
fewest; whole blocks then carry these amounts, and only the files that lose a block are written
again. Block sizes, a bounded number per shard, are all that the driver sees.

Equal texts lie in one block. A group of copies that is larger than half a shard's capacity is cut
into pieces that are not, as otherwise no layout could be even; there are at most two such groups
per shard.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textorbit.llm.common import table, text_key, without
from textorbit.session import new_path

SHARDS = 16
BLOCKS_PER_SHARD = 256
FILES_PER_SHARD = 8
# Rows are numbered in units of about so many bytes.
UNIT_BYTES = 16 << 20


def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Amounts sent from each source to each sink so that all supply arrives at the least cost.

    Successive shortest paths with potentials, found by a queue-based Bellman-Ford search.
    ``cost(i, j)`` is the price of one unit. All of ``supply`` must fit into ``capacity``.
    """
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities hold less than there is")
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    to: list[int] = []
    room: list[int] = []
    price: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, most: int, unit: float) -> None:
        for x, y, r, p in ((a, b, most, unit), (b, a, 0, -unit)):
            out[x].append(len(to))
            to.append(y)
            room.append(r)
            price.append(p)

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
    arcs = {}
    for i in range(n):
        for j in range(m):
            arcs[i, j] = len(to)
            edge(i, n + j, supply[i], cost(i, j))
    for j, c in enumerate(capacity):
        edge(n + j, sink, c, 0)
    while True:
        far = [float("inf")] * (n + m + 2)
        via = [-1] * (n + m + 2)
        far[source], queue, waiting = 0, deque([source]), {source}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for e in out[a]:
                if room[e] and far[a] + price[e] < far[to[e]]:
                    far[to[e]], via[to[e]] = far[a] + price[e], e
                    if to[e] not in waiting:
                        waiting.add(to[e])
                        queue.append(to[e])
        if via[sink] < 0:
            break
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = to[via[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    return {k: room[e ^ 1] for k, e in arcs.items() if room[e ^ 1]}


def plan_moves(blocks: list[tuple[int, int, int, int]], capacity: list[int]) -> dict[int, tuple[int, int]]:
    """Moves block -> (old shard, new shard) for ``blocks`` of (block, shard, file, bytes).

    The flow's amounts are filled with whole blocks, those of few files first so that few files
    are touched, and to within half a block.
    """
    supply = [0] * len(capacity)
    held = defaultdict(list)
    for block, shard, file, size in blocks:
        supply[shard] += size
        held[shard].append((file, -size, block))
    flow = min_cost_flow(supply, capacity, lambda i, j: 0 if i == j else 1)
    moves = {}
    for (i, j), amount in sorted(flow.items()):
        if i == j:
            continue
        left, rest = amount, []
        for file, size, block in sorted(held[i]):
            if left + size >= 0:
                moves[block] = (i, j)
                left += size
            else:
                rest.append((file, size, block))
        # One more block, if that brings the amount nearer.
        best = min(rest, key=lambda b: (abs(left + b[1]), b[2]), default=None)
        if best and abs(left + best[1]) < left:
            moves[best[2]] = (i, j)
            rest.remove(best)
        held[i] = rest
    return moves


def hash_layout(
    docs: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD, files_per_shard: int = FILES_PER_SHARD
) -> DataFrame:
    """Append ``size``, ``block``, ``shard`` and ``file``: the layout by hash that resharding starts from."""
    added = ["size", "text_crc32", "block", "shard", "file"]
    keep = without(docs, added)
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.coalesce(text_key(F.col("text")), F.lit(b"")).alias("__key"),
    )
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    n_blocks = shards * blocks_per_shard
    target, half = max(1, (total or 0) // n_blocks), max(1, (total or 0) // shards // 2)
    # Groups above a block's mean size have blocks of their own: at most as many as there are blocks.
    large = rows.groupBy("__key").agg(F.sum("size").alias("__bytes"), F.count("*").alias("__n"))
    large = large.filter((F.col("__bytes") > target) & (F.col("__n") > 1)).select("__key", F.ceil(F.col("__bytes") / half).alias("__pieces"))
    rows = rows.join(F.broadcast(large), "__key", "left")
    spread = F.xxhash64("doc_id", "__key")
    piece = F.pmod(spread, F.col("__pieces"))
    # A large group's number is its key's hash, away from the numbers of common blocks.
    own = n_blocks + F.pmod(F.xxhash64("__key", piece), F.lit(1 << 60))
    block = F.when(F.col("__pieces").isNull(), F.pmod(F.xxhash64("__key"), F.lit(n_blocks))).otherwise(own)
    rows = rows.withColumn("block", block)
    shard = F.pmod("block", F.lit(shards)).cast("int")
    by_block = F.pmod(F.floor(F.col("block") / shards), F.lit(files_per_shard))
    file = F.when(F.col("__pieces").isNull(), by_block).otherwise(F.pmod(spread, F.lit(files_per_shard))).cast("int")
    return rows.withColumns({"shard": shard, "file": file}).select(*[F.col(f"`{c}`") for c in keep], *added)


def write_layout(rows: DataFrame, path: str) -> None:
    """One folder per shard and file."""
    rows.repartition("shard", "file").write.mode("append").partitionBy("shard", "file").parquet(path)


def reshard(spark: SparkSession, path: str, capacity: list[int]) -> DataFrame:
    """Move blocks of the layout at ``path`` to meet ``capacity``; rewrites only files that lose blocks.

    Returns the rows of the new layout: unchanged files where they are, files that lost blocks
    and the blocks that came in from a second folder.
    """
    old = spark.read.parquet(path)
    # A large group lies in all its shard's files; its block counts under the first.
    sizes = old.groupBy("block", "shard").agg(F.min("file").alias("file"), F.sum("size").alias("size"), F.collect_set("file").alias("files"))
    held = sizes.orderBy("block").collect()
    moves = plan_moves([(r.block, r.shard, r.file, r.size) for r in held], capacity)
    touched = sorted({f"{r.shard}/{f}" for r in held if r.block in moves for f in r.files})
    if not touched:
        return old
    affected = F.concat_ws("/", "shard", "file").isin(touched)
    table_ = spark.createDataFrame([(b, j) for b, (_, j) in sorted(moves.items())], "block long, __to int")
    moved = old.filter(affected).join(F.broadcast(table_), "block", "left")
    moved = moved.withColumn("shard", F.coalesce("__to", "shard")).select(old.columns)
    again = new_path(spark, "shards-rewritten")
    write_layout(moved, again)
    return old.filter(~affected).unionByName(spark.read.schema(old.schema).parquet(again))


def with_slots(rows: DataFrame, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Append ``slot``: rows of a shard numbered from 0 without gaps.

    A shard's rows are dealt into units of bounded size; a unit's rows are numbered in a window,
    starting from the number of rows in the units before.
    """
    largest = rows.groupBy("shard").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] or 0
    units = max(8, -(-largest // unit_bytes))
    rows = rows.withColumn("__unit", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(units)))
    counts = rows.groupBy("shard", "__unit").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__unit").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__unit", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy("shard", "__unit").orderBy("doc_id", "text_crc32", "size")
    rows = rows.withColumn("__number", F.row_number().over(within)).join(starts, ["shard", "__unit"])
    return rows.withColumn("slot", F.col("__first") + F.col("__number") - 1).drop("__unit", "__number", "__first")


def shard_documents(docs: DataFrame, shards: int = SHARDS, **layout) -> DataFrame:
    """Write ``docs`` in shards of near equal bytes; returns them with ``size``, ``text_crc32``, ``block``, ``shard``, ``file``, ``slot``.

    The layout by hash is written first and then resharded to equal capacities. A null text has
    no bytes and counts as one text; sizes are bytes plus 1, so empty texts count too. Equal
    texts share a shard, unless their group is over half a shard. Repeated rows have slots of
    their own; rows that agree in id, text and size may swap them. An empty table stays empty.
    A long text is one row. Other columns are carried along, and columns named like a result
    are replaced by it.
    """
    spark = docs.sparkSession
    names = ["size", "text_crc32", "block", "shard", "file", "slot"]
    keep = without(docs, names)
    path = new_path(spark, "shards")
    rows = hash_layout(docs.select(*[F.col(f"`{c}`") for c in keep]), shards, **layout)
    write_layout(rows, path)
    stored = spark.read.schema(rows.schema).parquet(path)
    total = stored.agg(F.sum("size")).first()[0] or 0
    if not total:
        return stored.withColumn("slot", F.lit(0).cast("long")).select(*keep, *names)
    capacity = [total * (i + 1) // shards - total * i // shards for i in range(shards)]
    return with_slots(reshard(spark, path, capacity)).select(*[F.col(f"`{c}`") for c in keep], *names)


def op8_flow_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_documents(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op8_flow_reshard": op8_flow_reshard}
ORACLES: dict[str, str] = {}

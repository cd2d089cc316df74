"""Prefix trie of conversations by range shards and a skeleton of their splitters.

A conversation is a path of turn keys, 16 bytes a turn, so paths compare as bytes and a prefix comes
before what it begins. Paths are cut into shards by splitters drawn from a sample, a path and a conversation
each, so that equal paths are cut as well. In a shard sorted by path and conversation the
members of a node stand together; one pass with a stack of open nodes finishes every node whose members
cannot stand in another shard. If members of a node stand on both sides of a splitter, the node is a prefix
of that splitter: the trie of the splitters' paths, the skeleton, holds all nodes that shards share.
The sorted splitters and their common lengths, which are that trie, travel to all tasks; shards send one
partial aggregate for each skeleton node they meet, and these are reduced by node.

Texts never move: turns travel as keys and byte counts. A path is one row of 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textorbit.llm.common import table
from textorbit.session import stage

GROUP, HEADS = 5, 9
KEY = 16
# Paths a shard should hold, in bytes; shards at most; sampled paths a shard; bytes of all splitters at most.
SHARD_BYTES, MOST_SHARDS, OVERSAMPLE = 8 << 20, 16384, 16
SPLITTER_BYTES = 16 << 20
SEED = 20
# Ids that end at a skeleton node are sent in pieces of about so many bytes.
PIECE_BYTES = 1 << 16
# The first conversation that can follow a path: before all ids.
_BEFORE_ALL = -(1 << 63)


def turns(conversations: DataFrame) -> DataFrame:
    """Turns as ``base``, ``conv_id``, ``turn``, 16-byte ``key`` of role and text, and UTF-8 ``bytes`` of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    conv = F.col("conv_id").cast("long")
    return conversations.filter("conv_id IS NOT NULL").select(
        (conv - conv % GROUP).alias("base"), conv.alias("conv_id"), "turn",
        F.unhex(F.md5(F.encode(named, "UTF-8"))).alias("key"), F.octet_length(text).cast("long").alias("bytes"),
    )


def rebuilt(conversations: DataFrame, heads: int = HEADS) -> DataFrame:
    """One row per conversation: ``conv_id``, its ``path`` of turn keys and its turns' byte counts ``sizes`` (packed longs).

    The five conversations of a base lie sorted in one task, the base first, and are read one at a time.
    """
    head = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")), F.lit(heads)).cast("int")
    rows = turns(conversations).withColumns({"head": head, "derived": F.col("base") != F.col("conv_id")})
    order = [F.col("base"), F.col("derived"), F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key")]
    rows = rows.repartition("base").sortWithinPartitions(*order).select("base", "conv_id", "head", "key", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The open conversation, its turns so far, and the first turns of its base.
        conv = base = None
        own: list[bytes] = []
        sizes: list[np.ndarray] = []
        first_keys, first_sizes = b"", np.zeros(0, np.int64)
        out: tuple[list, list, list] = ([], [], [])

        def close() -> None:
            nonlocal first_keys, first_sizes
            keys, counts = b"".join(own), np.concatenate(sizes)
            if conv == base:
                first_keys, first_sizes = keys[: KEY * heads], counts[:heads]
            out[0].append(conv)
            out[1].append(first_keys[: KEY * head] + keys[KEY * head :])
            out[2].append(np.concatenate([first_sizes[:head], counts[head:]]).tobytes())

        def batch_out() -> pa.RecordBatch:
            types = (pa.int64(), pa.binary(), pa.binary())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["conv_id", "path", "sizes"])
            for c in out:
                c.clear()
            return made

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids, counts = batch.column(1).to_numpy(), batch.column(4).to_numpy()
            keys = batch.column(3).to_pylist()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), n]
            for start, end in zip(cuts[:-1], cuts[1:]):
                if int(ids[start]) != conv:
                    if conv is not None:
                        close()
                    conv, head, group = int(ids[start]), batch.column(2)[start].as_py(), batch.column(0)[start].as_py()
                    own, sizes = [], []
                    if group != base:
                        base, first_keys, first_sizes = group, b"", np.zeros(0, np.int64)
                own.append(b"".join(keys[start:end]))
                sizes.append(counts[start:end])
            if len(out[0]) > 1000:
                yield batch_out()
        if conv is not None:
            close()
        yield batch_out()

    return rows.mapInArrow(run, "conv_id long, path binary, sizes binary")


def common_turns(a: bytes, b: bytes) -> int:
    """Turns at the beginning that two paths share."""
    n = min(len(a), len(b)) // KEY
    if a[: n * KEY] == b[: n * KEY]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if a[: middle * KEY] == b[: middle * KEY]:
            low = middle
        else:
            high = middle
    return low


class Skeleton:
    """The trie of the splitters' paths: the sorted splitters and how many turns each shares with the one before."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.shared = [common_turns(a[0], b[0]) for a, b in zip(splitters, splitters[1:])]
        self.known: dict[tuple[int, int], int] = {}

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def owner(self, splitter: int, depth: int) -> int:
        """The first splitter that the node of a splitter's first ``depth`` turns is a prefix of."""
        found = self.known.get((splitter, depth))
        if found is None:
            found = splitter
            while found and self.shared[found - 1] >= depth:
                found -= 1
            self.known[splitter, depth] = found
        return found

    def nodes(self, shard: int) -> list[tuple[bytes, int]]:
        """The splitters around a shard (path, number): every skeleton node in the shard is a prefix of one."""
        return [(self.splitters[i][0], i) for i in (shard - 1, shard) if 0 <= i < len(self.splitters)]


def choose_splitters(sample: list[tuple[bytes, int]], shards: int, limit: int = SPLITTER_BYTES) -> list[tuple[bytes, int]]:
    """Splitters from a sorted sample, no longer than it takes to tell each from the sample before it."""
    found: list[tuple[bytes, int]] = []
    for i in range(1, shards):
        at = i * len(sample) // shards
        if not at:
            continue
        path, conv = sample[at]
        before = sample[at - 1][0]
        if path != before:
            path, conv = path[: (common_turns(before, path) + 1) * KEY], _BEFORE_ALL
        if not found or found[-1] < (path, conv):
            found.append((path, conv))
    # Fewer splitters make larger shards, never other results.
    while sum(len(p) for p, _ in found) > limit:
        found = found[1::2] if len(found) > 1 else []
    return found


def make_skeleton(paths: DataFrame, shard_bytes: int = SHARD_BYTES, most: int = MOST_SHARDS, limit: int = SPLITTER_BYTES) -> Skeleton:
    """Splitters for ``paths``. Where they lie only decides how evenly the shards are filled."""
    size, count = paths.agg(F.coalesce(F.sum(F.octet_length("path").cast("long") + 8), F.lit(0)), F.count("*")).first()
    cores = paths.sparkSession.sparkContext.defaultParallelism
    shards = int(min(most, max(-(-size // shard_bytes), min(2 * cores, count // 64))))
    if shards < 2:
        return Skeleton([])
    wanted = shards * OVERSAMPLE
    turns_kept = max(1, 4 * limit // wanted // KEY)
    sampled = paths.sample(False, min(1.0, wanted / count), SEED).select(F.substring("path", 1, turns_kept * KEY).alias("path"), "conv_id")
    rows = sorted((bytes(r.path), r.conv_id) for r in sampled.collect())
    return Skeleton(choose_splitters(rows, shards, limit))


class _Node:
    __slots__ = ("depth", "convs", "least", "children", "leaves", "saved", "size", "ends", "hash", "start")

    def __init__(self, depth: int, size: int, least: int):
        self.depth, self.size, self.least = depth, size, least
        self.convs = self.children = self.leaves = self.saved = 0
        self.ends = 0
        self.hash = None


_NODES = (
    "kind int, conv_id long, depth long, above int, above_depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, size long, ends_sha256 string, owner int, shard int, piece long, ids string"
)
_LOCAL, _PARTIAL, _PIECE = 0, 1, 2
_EMPTY_HASH = hashlib.sha256(b"").hexdigest()


class _Shard:
    """Nodes of one shard, from its paths in order. Rows of ``_NODES`` are appended to ``out``.

    Finished nodes wait until their parent is closed, as its least member is known then; those of a skeleton node go at once.
    """

    def __init__(self, skeleton: Skeleton, shard: int, out: list):
        self.skeleton, self.shard, self.out = skeleton, shard, out
        self.around = skeleton.nodes(shard)
        self.path = b""
        self.stack = [_Node(0, 0, 1 << 63)]
        self.common = [len(p) // KEY for p, _ in self.around]
        self.pieces: dict[int, list] = {}
        self.waiting: dict[int, list] = {}
        self.begun = False

    def skeletal(self, depth: int) -> int | None:
        """Owner of the node of the present path's first ``depth`` turns, if it is in the skeleton."""
        if depth == 0:
            return 0
        for (path, number), shared in zip(self.around, self.common):
            if depth <= shared:
                return self.skeleton.owner(number, depth)
        return None

    def add(self, conv: int, path: bytes, sizes: bytes) -> None:
        stack = self.stack
        if path != self.path or not self.begun:
            shared = common_turns(self.path, path)
            while len(stack) - 1 > shared:
                self.close()
            counts = np.frombuffer(sizes, np.int64)[shared:].tolist()
            for i, size in enumerate(counts):
                stack.append(_Node(shared + i + 1, size, conv))
            self.path, self.begun = path, True
            self.common = [common_turns(p, path) for p, _ in self.around]
        node = stack[-1]
        node.convs += 1
        node.least = min(node.least, conv)
        depth = node.depth
        owner = self.skeletal(depth)
        if owner is None:
            if node.hash is None:
                node.hash = hashlib.sha256(str(conv).encode())
            else:
                node.hash.update(b",%d" % conv)
        else:
            piece = self.pieces.setdefault(depth, [0, 0, []])
            piece[2].append(str(conv))
            piece[1] += len(piece[2][-1]) + 1
            if piece[1] > PIECE_BYTES:
                self.send(depth, owner)

    def send(self, depth: int, owner: int) -> None:
        number, _, ids = self.pieces[depth]
        self.out.append((_PIECE, None, depth, None, None, None, None, None, None, None, None, None, owner, self.shard, number, ",".join(ids)))
        self.pieces[depth] = [number + 1, 0, []]

    def close(self) -> None:
        """Take the deepest open node off, finish it or send its part, and add it to its parent."""
        node = self.stack.pop()
        depth, owner = node.depth, self.skeletal(node.depth)
        held = self.waiting.pop(depth, [])
        if owner is None:
            leaves = node.leaves or 1
            saved = node.saved + (node.convs - 1) * node.size
            self.out.extend((*row, node.least, *rest) for row, rest in held)
            digest = node.hash.hexdigest() if node.hash else _EMPTY_HASH
            rest = (node.convs, node.children, leaves, saved, node.size, digest, None, None, None, None)
            if (above := self.skeletal(depth - 1)) is not None:
                # Children of a skeleton node learn its least member from the reduction.
                self.out.append((_LOCAL, node.least, depth, above, depth - 1, None, *rest))
            else:
                self.waiting.setdefault(depth - 1, []).append(((_LOCAL, node.least, depth, None, None), rest))
        else:
            if self.pieces.get(depth, [0, 0, []])[2]:
                self.send(depth, owner)
            self.pieces.pop(depth, None)
            leaves, saved = node.leaves, node.saved
            self.out.append(
                (_PARTIAL, node.least, depth, None, None, None, node.convs, node.children, leaves, saved, node.size, None, owner, self.shard, None, None)
            )
        if depth:
            parent = self.stack[-1]
            parent.convs += node.convs
            parent.least = min(parent.least, node.least)
            parent.children += owner is None
            parent.leaves += leaves
            parent.saved += saved

    def end(self) -> None:
        while self.stack:
            self.close()


def shard_nodes(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, partial aggregates of skeleton nodes and pieces of their ends, by one sorted pass over each shard."""
    trie = paths.sparkSession.sparkContext.broadcast(skeleton)
    kinds = StructType.fromDDL(_NODES)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [trie.value.shard(p, c) for c, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], [*batch.schema.names, "shard"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kinds)
        out: list[tuple] = []
        open_: _Shard | None = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * len(schema)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            for conv, path, sizes, shard in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None or open_.shard != shard:
                    if open_ is not None:
                        open_.end()
                    open_ = _Shard(trie.value, shard, out)
                open_.add(conv, path, sizes)
                if len(out) > 20_000:
                    yield flush()
        if open_ is not None:
            open_.end()
        yield flush()

    shards = len(skeleton.splitters) + 1
    placed = paths.mapInArrow(place, "conv_id long, path binary, sizes binary, shard int")
    ordered = placed.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    return ordered.mapInArrow(run, kinds)


def _end_hashes(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each skeleton node's ids: its pieces in order of shards, which is that of the ids, streamed through one hash."""
    ordered = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "shard", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = digest = None
        found: list[tuple] = []
        for batch in batches:
            for owner, depth, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (owner, depth) != node:
                    if node is not None:
                        found.append((*node, digest.hexdigest()))
                    node, digest = (owner, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if node is not None:
            found.append((*node, digest.hexdigest()))
        columns = list(zip(*found)) if found else [(), (), ()]
        types = (pa.int32(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["owner", "depth", "ends_sha256"])

    return ordered.select("owner", "depth", "ids").mapInArrow(run, "owner int, depth long, ends_sha256 string")


def reduce_skeleton(found: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Whole rows of the skeleton's nodes from the shards' partial aggregates: owner, depth and the node's columns.

    Sums are made by Spark; the driver adds them up along the skeleton, whose size the splitters' bound.
    """
    partial = found.filter(F.col("kind") == _PARTIAL).groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"), F.max("size").alias("size"),
    )
    ends = _end_hashes(found.filter(F.col("kind") == _PIECE).select("owner", "depth", "shard", "piece", "ids"))
    rows = partial.join(ends, ["owner", "depth"], "left").collect()
    nodes = {(r.owner, r.depth): [r.conv_id, r.n_convs, r.n_children, 0, 0, r.ends_sha256 or _EMPTY_HASH, r.n_leaves, r.saved, r.size] for r in rows}
    # Local leaves and savings were added up by the shards along the whole way to the root;
    # what the skeleton's own nodes add goes to all nodes above them here.
    for (owner, depth), node in sorted(nodes.items(), key=lambda x: -x[0][1]):
        own_leaf = 1 if node[2] == 0 and node[6] == 0 and node[3] == 0 else 0
        node[3] += own_leaf
        node[4] += (node[1] - 1) * node[8]
        if depth:
            above = nodes[skeleton.owner(owner, depth - 1) if depth > 1 else 0, depth - 1]
            above[2] += 1
            above[3] += node[3]
            above[4] += node[4]
    out = []
    for (owner, depth), node in nodes.items():
        above = nodes[skeleton.owner(owner, depth - 1) if depth > 1 else 0, depth - 1][0] if depth else None
        out.append((owner, depth, node[0], above, node[1], node[2], node[3] + node[6], node[4] + node[7], node[5]))
    schema = "owner int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    return found.sparkSession.createDataFrame(out, schema)


def prefix_trie(conversations: DataFrame, heads: int = HEADS, **settings: int) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    Turns without a conv_id belong to none and are left out. Null roles and texts are empty, so a null text and an empty
    one are equal turns. Turns of equal number follow one another by the hash of role and text; repeated rows
    are turns of their own. Ids are read as longs. An empty table has no nodes, not even a root. Other columns play no part.
    """
    paths = stage(rebuilt(conversations, heads), "paths")
    skeleton = make_skeleton(paths, **settings)
    found = stage(shard_nodes(paths, skeleton), "trie-shards")
    above = stage(reduce_skeleton(found, skeleton), "skeleton")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    local = found.filter(F.col("kind") == _LOCAL).alias("n")
    # As many rows as the skeleton has nodes, each of a few numbers.
    parents = F.broadcast(above.select(F.col("owner").alias("above"), F.col("depth").alias("above_depth"), F.col("conv_id").alias("above_conv")))
    local = local.join(parents, ["above", "above_depth"], "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_conv"))
    return local.select(*columns).unionByName(above.select(*columns))


def op12_splitter_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


ORACLE = f"""WITH crc AS (
  SELECT list(list_reduce(list_prepend(i::BIGINT, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS steps
  FROM range(256) t(i)),
turns AS (
  SELECT conv_id, conv_id - conv_id % {GROUP} AS base, strlen(coalesce(text, '')) AS size,
    md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: xor(steps[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id, base FROM turns), crc),
new_turns AS (
  SELECT c.conv_id, t.place, t.key, t.size FROM convs c JOIN turns t ON t.conv_id = c.base WHERE t.place <= c.h
  UNION ALL SELECT c.conv_id, t.place, t.key, t.size FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE t.place > c.h),
paths AS (
  SELECT c.conv_id, coalesce(list(n.key ORDER BY n.place) FILTER (n.key IS NOT NULL), []) AS path, coalesce(list(n.size ORDER BY n.place) FILTER (n.key IS NOT NULL), []) AS sizes
  FROM convs c LEFT JOIN new_turns n ON n.conv_id = c.conv_id GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, d, path[1:d] AS node, len(path) = d AS ends, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node, d),
children AS (SELECT node[1:d - 1] AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
whole AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.node = n.node AND c.d = n.d),
below AS (
  SELECT node[1:e] AS node, e AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM whole) GROUP BY ALL)
SELECT w.conv_id, w.d::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children::BIGINT AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM whole w JOIN below b ON b.node = w.node AND b.d = w.d LEFT JOIN nodes p ON p.d = w.d - 1 AND p.node = w.node[1:w.d - 1]"""

QUERIES = {"op12_splitter_skeleton": op12_splitter_skeleton}
ORACLES = {"op12_splitter_skeleton": ORACLE}

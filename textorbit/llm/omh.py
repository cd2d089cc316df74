"""Near-duplicate documents by Order MinHash.

A text's k-mers are runs of three words, labelled with their number of occurrence. Each of several
sketches takes the few k-mers with the smallest hashes and keeps them in the order in which they
stand in the text; two texts agree in a sketch if both the k-mers and their order are the same,
which becomes likely as their edit similarity does. Candidates that agree in a sketch, and whose
word counts allow it, are verified by a banded alignment of their words: a link is an edit similarity of 0.8 or more.

Equal texts are one text from the start. Candidates come first and from small rows alone: keys, word counts and bags
of words. A bucket, that is, the texts which agree in a sketch, offers each text with its least one for a few
sketches, so a bucket of any size makes as many pairs as it has members; then, for all sketches, the least and
the greatest text of each of its classes with those of its first class. What is still apart meets in blocks of bounded size, where each
text offers the nearest texts of other classes that counts and finer bags allow; a pair that meets in several blocks is
offered in one of them. Texts that share a passage share many large buckets; those with the same least text are one there. Each different pair is then joined with its two texts, once, and aligned. A block offers fewer
pairs than it has texts; those that it left out are aligned in the block itself, which gives no more links than join its classes. Classes are
the connected components of the links.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textorbit.llm.common import BATCH_BYTES, slices, table, text_key, without
from textorbit.llm.decontaminate import words_of
from textorbit.session import arrow_batches, stage, unstage

K = 3
# With a fifth of the words replaced at random, three-word similarity is 0.34, a sketch of two agrees
# with probability 0.12, and none of 64 once in 3,000 pairs; with every fifth word replaced, at 0.25, once in 60.
SKETCHES = 64
KEPT = 2
# Texts of up to SHORT words have so many sketches of word pairs besides, and those of up to ONE_EDIT
# words, which one edit at most keeps similar, are also found by what is left without any one word.
SHORT, SHORT_SKETCHES, SHORT_K = 40, 48, 2
ONE_EDIT = 9
# Sketches whose buckets are compared first, with their least text; the rest compares what these left apart.
FIRST = 4
SIMILARITY = 0.8
# Texts and words of a block's half; partners that a text offers in a block, by round: the rest is aligned in the blocks.
BLOCK_TEXTS = 1024
BLOCK_WORDS = 1 << 20
OFFERED = (64,)
# Place of pairs that are not offered in any round.
NEVER = 1 << 40
# Joins on a key that many rows may share deal it to so many tasks.
SALT = 4
HOT = 10_000
# Tables of keys of at most so many rows, some 50 bytes each, are broadcast to what they are joined with.
FEW = 100_000
# Bits of the filter that keeps texts of no candidate from being shuffled: 16 a text, so many at most.
FILTER_BITS = 1 << 25
# Words are counted in so many bins, by their hash, to bound the edits between texts from below; in blocks, where texts
# that share most of their words meet, in the fine ones besides.
BINS, FINE_BINS = 128, 2048

_M1, _M2, _GOLD, _BASE = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0x100000001B3))
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def seeds(n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLD)


class WordHashes:
    """64-bit hashes of words; words seen before come from a bounded memory."""

    def __init__(self, most: int = 1 << 17):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all runs of ``k`` words; a shorter text is one run."""
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _BASE + _mix(words[i : i + n] + np.uint64(i))
    return _mix(out)


def occurrence(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each value."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    at = np.arange(len(values))
    out = np.empty(len(values), np.uint64)
    out[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out


def sketch(words: np.ndarray, salt: np.ndarray, k: int = K, kept: int = KEPT) -> np.ndarray:
    """One number per sketch: the hash of the kept k-mers in text order."""
    grams = kmers(words, k)
    labelled = _mix(grams + occurrence(grams) * _GOLD)
    out = np.empty(len(salt), np.uint64)
    step = max(1, (1 << 18) // len(grams))
    for at in range(0, len(salt), step):
        part = salt[at : at + step]
        if len(grams) > kept:
            values = labelled[None, :] ^ part[:, None]
            values *= _M1
            values ^= values >> np.uint64(32)
            values *= _M2
            rows, least = np.arange(len(part)), []
            for _ in range(kept):
                least.append(values.argmin(axis=1))
                values[rows, least[-1]] = _LAST
            where = np.sort(np.stack(least, axis=1), axis=1)
        else:
            where = np.broadcast_to(np.arange(len(grams)), (len(part), len(grams)))
        found = part.copy()
        for column in range(where.shape[1]):
            found = _mix(found * _BASE + grams[where[:, column]])
        out[at : at + step] = found
    return out


def short_sketches(words: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Sketches of word pairs, and hashes of a very short text as it is and without each word."""
    found = sketch(words, salt, SHORT_K)
    if len(words) > ONE_EDIT:
        return found
    left = [words, *(np.delete(words, i) for i in range(len(words)))]
    # Without its only word nothing is left, which is no sign of likeness.
    return np.concatenate([found, np.unique(np.concatenate([kmers(x, len(x)) for x in left if len(x)]))])


def bag(words: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Number of words in each bin of their hashes."""
    counts = np.bincount((words % np.uint64(bins)).astype(np.int64), minlength=bins)
    return np.minimum(counts, 0xFFFF).astype(np.uint16)


def fine_bag(words: np.ndarray, bins: int = FINE_BINS) -> np.ndarray:
    """``bag`` in one byte a bin: larger counts are cut to 255, which only brings bags nearer."""
    return np.minimum(bag(words, bins), 0xFF).astype(np.uint8)


def least_edits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Edits between texts with bags ``x`` and ``y`` at least: each word too many costs one."""
    difference = x.astype(np.int32) - y.astype(np.int32)
    return np.maximum(np.maximum(difference, 0).sum(axis=-1), np.maximum(-difference, 0).sum(axis=-1))


def allowed(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether texts of ``n`` and ``m`` words with bags ``x`` and ``y`` can be similar enough."""
    most = np.floor((1 - similarity) * np.maximum(n, m) + 1e-9)
    return (np.abs(n - m) <= most) & (least_edits(x, y) <= most)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _places(words: list[int]) -> dict[int, list[int]]:
    found: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        found.setdefault(word, []).append(i)
    return found


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Levenshtein distance of two word sequences, or None if it is over ``most``.

    Only the band of cells at most ``most`` off the main diagonal is looked at. A column of the
    band is kept as its steps up and down, one bit a cell in whole integers, so a word of ``b``
    costs a few operations on integers of 2 * most + 1 bits.
    """
    if abs(len(a) - len(b)) > most:
        return None
    start = _common(a, b)
    a, b = a[start:], b[start:]
    end = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - end], b[: len(b) - end]
    n, m = len(a), len(b)
    if not n or not m:
        return max(n, m) if max(n, m) <= most else None
    shared = sum((Counter(a.tolist()) & Counter(b.tolist())).values())
    if max(n, m) - shared > most:
        return None
    if not most:
        return None  # what is left differs in its first word

    places = _places(a.tolist())
    # Words in many places keep a bit for each; there are few of these.
    often = {w: sum(1 << p for p in found) for w, found in places.items() if len(found) > max(16, n >> 9)}
    width, full = 2 * most + 1, (1 << (2 * most + 1)) - 1
    # Bit r of column j (from 1) is the cell in row j - most + r; rows before the first are level.
    up, down = full >> most << most, 0
    distance = min(most, n)
    # A path that has left the band's edge behind can win back one for each column to come.
    hopeless = 2 * most + m - n
    for j, word in enumerate(b.tolist(), 1):
        first = j - most - 1  # the word of ``a`` at bit 0
        if word in often:
            same = (often[word] >> first if first >= 0 else often[word] << -first) & full
        else:
            same, found = 0, places.get(word, ())
            if len(found) > 16:
                row = np.zeros(width, np.uint8)
                inside = np.array(found) - first
                row[inside[(inside >= 0) & (inside < width)]] = 1
                same = int.from_bytes(np.packbits(row, bitorder="little").tobytes(), "little")
            else:
                for p in found:
                    if 0 <= p - first < width:
                        same |= 1 << (p - first)
        level = (((same & up) + up) ^ up) | same | down
        level &= full
        right_up = down | (full & ~(level | up))
        right_down = level & up
        if j <= n - most:
            # Along the lower edge, down the diagonal.
            distance += not level >> (width - 1)
            if distance > hopeless:
                return None
        else:
            # Along the last row.
            bit = n - j + most
            distance += (right_up >> bit & 1) - (right_down >> bit & 1)
        shifted = level >> 1
        up = right_down | (full & ~(shifted | right_up))
        down = shifted & right_up
    return distance if distance <= most else None


def text_sketches(docs: DataFrame, sketches: int, kept: int, k: int) -> DataFrame:
    """One row per different text with words: key, number of words, sketches and bag (packed).

    The first ``sketches`` of each text stand in the order of their salts.
    """
    source = docs.filter(F.col("text").isNotNull()).select(text_key(F.col("text")).alias("key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, salt = WordHashes(), seeds(sketches + SHORT_SKETCHES)
        salt, short_salt = salt[:sketches], salt[sketches:]
        for batch in batches:
            for part in slices(batch):
                keys, counts, packed, bags = [], [], [], []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = words_of(text)
                    if words:
                        keys.append(key)
                        counts.append(len(words))
                        hashed = hashes(words)
                        own = sketch(hashed, salt, k, kept).tobytes()
                        packed.append(own + short_sketches(hashed, short_salt).tobytes() if len(words) <= SHORT else own)
                        bags.append(bag(hashed).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(counts, pa.int32()), pa.array(packed, pa.binary()), pa.array(bags, pa.binary())],
                    ["key", "n", "sketches", "bag"],
                )

    return source.mapInArrow(run, "key binary, n int, sketches binary, bag binary").dropDuplicates(["key"])


def _unpacked(texts: DataFrame, first: int) -> DataFrame:
    """One row per text and sketch: bucket, key, and whether the sketch is one of the ``first``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            values = batch.column(1).to_pylist()
            sizes = np.array([len(v) // 8 for v in values], np.int64)
            buckets = np.frombuffer(b"".join(values), np.int64)
            where = pa.array(np.repeat(np.arange(rows), sizes))
            early = np.arange(len(buckets)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < first
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets), batch.column(0).take(where), pa.array(early)], ["bucket", "key", "early"]
            )

    return texts.select("key", "sketches").mapInArrow(run, "bucket long, key binary, early boolean")


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The text of each of the different ``keys``: key, text.

    Few keys are broadcast. Of more, a bit map of their hashes, broadcast in cells of 64 bits and of bounded
    size, drops most other texts before the shuffle.
    """
    rows = docs.filter(F.col("text").isNotNull()).select(F.coalesce(text_key(F.col("text")), F.lit(b"")).alias("key"), "text")
    if few(keys):
        return rows.join(F.broadcast(keys), "key").dropDuplicates(["key"])
    bits = 1 << 16
    while bits < min(FILTER_BITS, 16 * keys.count()):
        bits *= 2
    # Neither key nor place can be null, and Spark is told so: it would test both beforehand, hashing texts again.
    place = F.coalesce(F.pmod(F.xxhash64("key"), F.lit(bits)), F.lit(0))
    # Shifts of a long count modulo 64.
    marks = keys.select(F.shiftright(place, 6).alias("cell"), F.expr("shiftleft(1L, int(xxhash64(key) & 63))").alias("bit"))
    cells = F.broadcast(marks.groupBy("cell").agg(F.bit_or("bit").alias("bits")))
    rows = rows.withColumn("cell", F.shiftright(place, 6)).join(cells, "cell")
    rows = rows.filter(F.expr("bits & shiftleft(1L, int(xxhash64(key) & 63)) <> 0")).select("key", "text")
    # An inner join: a semi join would be pushed below that with the bit map.
    return rows.join(keys.hint("merge"), "key").dropDuplicates(["key"])


def align_pairs(pairs: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Links among ``pairs`` (a, b; keys of texts of ``docs``): edit similarity of their words at least ``similarity``; staged.

    A text is joined once for each pair; pairs of one ``a`` stand together, so its words are made once.
    """
    keys = stage(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "pair-keys")
    schema = "a binary, b binary, similarity double"
    if keys.isEmpty():
        return docs.sparkSession.createDataFrame([], schema)
    texts = stage(texts_of(docs, keys), "pair-texts")
    a, b = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    with_b = b.join(F.broadcast(pairs), "b") if few(pairs) else pairs.join(b.hint("merge"), "b")
    rows = with_b.join(a.hint("merge"), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        recent: dict[bytes, np.ndarray] = {}

        def words(key: bytes, text: str) -> np.ndarray:
            if key not in recent:
                if len(recent) > 8:
                    recent.clear()
                recent[key] = hashes(words_of(text))
            return recent[key]

        for batch in batches:
            for part in slices(batch):
                found = []
                for x, y, s, t in zip(*(c.to_pylist() for c in part.columns)):
                    u, v = words(x, s), hashes(words_of(t))
                    longer = max(len(u), len(v))
                    edits = edit_distance(u, v, int((1 - similarity) * longer + 1e-9))
                    if edits is not None:
                        found.append((x, y, 1 - edits / longer))
                columns = zip(*found) if found else ((), (), ())
                types = (pa.binary(), pa.binary(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["a", "b", "similarity"])

    links = stage(rows.mapInArrow(run, schema), "aligned")
    unstage(keys, texts)
    return links


def few(keys: DataFrame, most: int = FEW) -> bool:
    """Whether a table of keys, staged, may be broadcast."""
    return keys.limit(most + 1).count() <= most


def salted_join(rows: DataFrame, keyed: DataFrame, on: str, how: str = "inner", salt: int = SALT) -> DataFrame:
    """``rows`` joined with ``keyed``, a staged table that has each key once, on column ``on``.

    A small table is broadcast; with a larger one, rows of one key go to ``salt`` tasks.
    """
    if few(keyed):
        return rows.join(F.broadcast(keyed), on, how)
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salt)).cast("int"))
    copies = keyed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return dealt.join(copies, [on, "__salt"], how).drop("__salt")


def components(links: DataFrame) -> DataFrame:
    """Least key of each key's connected component: key, least.

    Rounds of taking over neighbours' least keys and following them; each is written to the
    shared folder. The rounds grow with the logarithm of the longest path of a component. Joins are
    salted, as a component's keys meet in its least one.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("b")).select("key", F.least("key", "b").alias("least")), "labels")
    before = labels
    while True:
        near = salted_join(both.select("a", F.col("b").alias("key")), labels, "key").groupBy("a").agg(F.min("least").alias("near"))
        taken = labels.join(near, labels["key"] == near["a"], "left").select("key", F.least("least", "near").alias("new"), F.col("least").alias("old"))
        jump = labels.select(F.col("key").alias("new"), F.col("least").alias("beyond"))
        taken = salted_join(taken, jump, "new", "left").select("key", F.least("new", "beyond").alias("least"), "old")
        taken = stage(taken, "labels")
        unstage(before)
        before, labels = taken, taken.select("key", "least")
        if taken.filter("least <> old").isEmpty():
            unstage(both)
            return labels


def grown(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (``labels``: key, least) after more links: only the links between classes are followed."""
    ends = links.select("a", "b")
    for side in ("a", "b"):
        roots = labels.select(F.col("key").alias(side), F.col("least").alias("root"))
        ends = salted_join(ends, roots, side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
    between = stage(ends.filter("a <> b").distinct(), "class-links")
    joined = stage(components(between), "joined-classes")
    # Texts that had no link before are classes of their own until now.
    fresh = joined.join(labels.select("key"), "key", "left_anti")
    moved = joined.select(F.col("key").alias("least"), F.col("least").alias("to"))
    old = salted_join(labels, moved, "least", "left").select("key", F.coalesce("to", "least").alias("least"))
    return stage(old.unionByName(fresh.select("key", "least")), "labels")


def _bags(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BINS)


def _fine_bags(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, FINE_BINS)


def _pairs_of_blocks(block: np.ndarray, part: np.ndarray, split: np.ndarray, classes: np.ndarray, sizes: np.ndarray, fine: np.ndarray, similarity: float):
    """Places of rows (r, s) of one block and different classes that counts and bags allow, and their least edits.

    Bags are compared in ``BINS`` bins first, into which the ``fine`` ones fold.

    Rows are sorted by ``block``. Row r is compared with those that follow it in its block, all blocks at once: at a
    distance of one row, then of two, until no block is that long. A ``split`` block holds two parts and
    compares texts of different parts only.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    bags = fine.reshape(len(fine), -1, BINS).sum(axis=1, dtype=np.int32)
    left, step = np.arange(len(block)), 0
    while len(left):
        step += 1
        left = left[left + step < len(block)]
        left = left[block[left] == block[left + step]]
        r, s = left, left + step
        ok = (classes[r] != classes[s]) & (~split[r] | (part[r] != part[s]))
        r, s = r[ok], s[ok]
        most = np.floor((1 - similarity) * np.maximum(sizes[r], sizes[s]) + 1e-9)
        ok = np.abs(sizes[r] - sizes[s]) <= most
        r, s, most = r[ok], s[ok], most[ok]
        for at in range(0, len(r), 4096):
            x, y, limit = r[at : at + 4096], s[at : at + 4096], most[at : at + 4096]
            ok = least_edits(bags[x], bags[y]) <= limit
            x, y, limit = x[ok], y[ok], limit[ok]
            for low in range(0, len(x), 512):
                part_x, part_y = x[low : low + 512], y[low : low + 512]
                edits = least_edits(fine[part_x], fine[part_y])
                ok = edits <= limit[low : low + 512]
                if ok.any():
                    found.append((part_x[ok], part_y[ok], edits[ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found))


def _order_in(groups: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Place of each element in its group, from 0, by least ``by``."""
    order = np.lexsort((by, groups))
    ordered = groups[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out = np.empty(len(groups), np.int64)
    out[order] = np.arange(len(groups)) - np.repeat(first, np.diff(np.concatenate([first, [len(groups)]])))
    return out


def _ranks(r: np.ndarray, edits: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Place of each pair among those of its row ``r``, by least edits; ``NEVER`` where a block has as many pairs as rows before it."""
    if not len(r):
        return r
    ranks = _order_in(r, edits)
    return np.where(_order_in(block[r], ranks) < np.bincount(block)[block[r]] - 1, ranks, NEVER)


def _met_here(r: np.ndarray, s: np.ndarray, bucket: np.ndarray, keys: pa.Array, buckets: pa.Array) -> np.ndarray:
    """Which pairs belong to the block where they stand: of the ``buckets`` that both texts are in, the keys pick one."""
    rows, back = np.unique(np.concatenate([r, s]), return_inverse=True)
    own = [frozenset(x) for x in buckets.take(pa.array(rows)).to_pylist()]
    named = [int.from_bytes(x[:8], "little") for x in keys.take(pa.array(rows)).to_pylist()]
    found = []
    for x, y, here in zip(back[: len(r)].tolist(), back[len(r) :].tolist(), bucket[r].tolist()):
        common = sorted(own[x] & own[y])
        found.append(common[(named[x] ^ named[y]) % len(common)] == here)
    return np.array(found, bool)


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in the order of their blocks (bucket, i, j), some blocks at a time, each whole."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        open_ = np.ones(held.num_rows, bool)
        for c in ("bucket", "i", "j"):
            open_ &= held.column(c).to_numpy() == held.column(c)[-1].as_py()
        ready = held.num_rows - int(open_.sum())
        if ready:
            yield held.slice(0, ready)
            held = held.slice(ready).combine_chunks()
    if held is not None:
        yield held


def _numbered(column: pa.ChunkedArray) -> np.ndarray:
    return np.unique(np.array([c.hex() for c in column.to_pylist()]), return_inverse=True)[1]


def _left_pairs(rows: pa.Table, similarity: float, low: int):
    """Pairs (r, s) of whole blocks that may be similar, belong to their block and stand at place ``low`` or later among
    those of r; their least edits, their places, the numbers of the blocks, and of the classes as they are now.

    Places go by the classes before the first round, so they are the same in all rounds.
    """
    place = [rows.column(c).to_numpy() for c in ("bucket", "i", "j")]
    change = np.zeros(rows.num_rows, bool)
    for c in place:
        change[1:] |= c[1:] != c[:-1]
    block, now = np.cumsum(change), _numbered(rows.column("now"))
    r, s, edits = _pairs_of_blocks(
        block, rows.column("part").to_numpy(), place[1] != place[2], _numbered(rows.column("class")), rows.column("n").to_numpy(),
        _fine_bags(rows.column("bag")), similarity,
    )
    if not len(r):
        return r, s, edits, r, block, now
    ok = _met_here(r, s, place[0], _plain(rows.column("key")), _plain(rows.column("buckets")))
    r, s, edits = r[ok], s[ok], edits[ok]
    ranks = _ranks(r, edits, block)
    ok = (ranks >= low) & (now[r] != now[s])
    return r[ok], s[ok], edits[ok], ranks[ok], block, now


def _blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "key")


def block_candidates(rows: DataFrame, similarity: float, low: int, most: int) -> DataFrame:
    """Pairs (a, b) that blocks (bucket, i, j) offer, and rows without a pair for blocks that left some out.

    Each text offers those from place ``low`` to ``most``, of the pairs in which it is the lesser. In all rounds together a
    block makes no more rows than it has, and one a round if it left some out.
    """
    schema = "bucket long, i int, j int, a binary, b binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_blocks(batches):
            r, s, _, ranks, block, _ = _left_pairs(rows, similarity, low)
            taken = ranks < most
            cut = np.searchsorted(block, np.unique(block[r[~taken]]))
            r, s = r[taken], s[taken]
            keys = _plain(rows.column("key"))
            x, y = keys.take(pa.array(r)), keys.take(pa.array(s))
            where = np.concatenate([r, cut])
            nothing = pa.nulls(len(cut), pa.binary())
            # Rows stand in the order of their keys within a block, so x is the lesser one.
            columns = [*(pa.array(rows.column(c).to_numpy()[where]) for c in ("bucket", "i", "j")), pa.concat_arrays([_plain(x), nothing]), pa.concat_arrays([_plain(y), nothing])]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "i", "j", "a", "b"])

    return _blocks(rows).mapInArrow(run, schema)


def block_links(rows: DataFrame, similarity: float, low: int) -> DataFrame:
    """Links among the pairs of blocks from place ``low`` on, aligned where they stand, the nearest first.

    ``rows`` have their ``words``. Texts whose classes earlier links join are not aligned any more, so a block gives fewer
    links than it has rows.
    """
    schema = "a binary, b binary, similarity double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_blocks(batches):
            r, s, edits, _, _, now = _left_pairs(rows, similarity, low)
            keys, words, root, found = rows.column("key"), rows.column("words"), list(range(rows.num_rows)), []

            def top(x: int) -> int:
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            order = np.argsort(edits, kind="stable")
            for x, y in zip(r[order].tolist(), s[order].tolist()):
                p, q = top(now[x]), top(now[y])
                if p == q:
                    continue
                u, v = (np.frombuffer(words[z].as_py(), np.uint64) for z in (x, y))
                longer = max(len(u), len(v))
                needed = edit_distance(u, v, int((1 - similarity) * longer + 1e-9))
                if needed is not None:
                    root[q] = p
                    found.append((keys[x].as_py(), keys[y].as_py(), 1 - needed / longer))
            columns = zip(*found) if found else ((), (), ())
            types = (pa.binary(), pa.binary(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["a", "b", "similarity"])

    return _blocks(rows).mapInArrow(run, schema)


def hashed_words(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Hashes of the words of the text of each of the different ``keys``, staged: key, words (packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                words = [hashes(words_of(t)).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words, pa.binary())], ["key", "words"])

    return stage(texts_of(docs, keys).select("key", "text").mapInArrow(run, "key binary, words binary"), "block-words")


def fine_bags(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Number of words and fine bag of the text of each of the different ``keys``, staged: key, n, bag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for part in slices(batch):
                words = [hashes(words_of(t)) for t in part.column(1).to_pylist()]
                bags = pa.array([fine_bag(w).tobytes() for w in words], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(w) for w in words], pa.int32()), bags], ["key", "n", "bag"])

    return stage(texts_of(docs, keys).select("key", "text").mapInArrow(run, "key binary, n int, bag binary"), "fine-bags")


def fewer_buckets(members: DataFrame, block: int) -> DataFrame:
    """``members`` (bucket, key, size, class), with buckets of over ``block`` texts that have the same least text as one.

    Texts with a common passage meet in a bucket for most sketches. Two such buckets have their least text in common
    as often as they have any other, so a few buckets stay of each passage, and no two texts that met are parted.
    """
    large = members.filter(F.col("size") > block)
    least = stage(large.groupBy("bucket").agg(F.xxhash64(F.min("key")).alias("to")), "large-buckets")
    if least.isEmpty():
        return members
    one = salted_join(large.select("bucket", "key", "class"), least, "bucket").select(F.col("to").alias("bucket"), "key", "class").distinct()
    one = stage(one, "joined-buckets")
    sizes = stage(one.groupBy("bucket").agg(F.count("*").alias("size")), "bucket-sizes")
    joined = salted_join(one, sizes, "bucket").select("bucket", "key", "size", "class")
    return members.filter(F.col("size") <= block).select(*joined.columns).unionByName(joined)


def _plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def near_links(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    k: int = K,
    sketches: int = SKETCHES,
    kept: int = KEPT,
    first: int = FIRST,
    block: int = BLOCK_TEXTS,
    offered: tuple[int, ...] = OFFERED,
) -> tuple[DataFrame, DataFrame]:
    """Verified links between different texts, enough to join each class: a, b (keys of texts), similarity.

    Also the classes that they make: key, least (``components``); texts without a link have none.
    """
    texts = stage(text_sketches(docs, sketches, kept, k), "sketches")
    members = _unpacked(texts, first)
    buckets = members.groupBy("bucket").agg(
        F.min("key").alias("least"), F.count("*").alias("size"), F.bool_or("early").alias("early"),
        F.bit_xor(F.xxhash64("key")).alias("h1"), F.bit_xor(F.xxhash64("key", F.lit(7))).alias("h2"),
    )
    # Buckets of the same texts, as copies share most of theirs, are one: an early one if there is any.
    one = F.min(F.struct(~F.col("early"), "bucket", "least", "early")).alias("one")
    buckets = buckets.filter("size > 1").groupBy("h1", "h2", "size").agg(one).select("one.bucket", "one.least", "size", "one.early")
    members = stage(members.drop("early").join(buckets, "bucket"), "shared-buckets")
    counts = texts.select("key", "n", "bag")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        return align_pairs(stage(_allowed_pairs(pairs, counts, similarity), f"{name}-pairs"), docs, similarity)

    def with_classes(members: DataFrame, labels: DataFrame) -> DataFrame:
        rows = salted_join(members.select("bucket", "key", "size"), labels, "key", "left")
        return rows.select("bucket", "key", "size", F.coalesce("least", "key").alias("class"))

    def torn(members: DataFrame, labels: DataFrame) -> DataFrame:
        """Those of ``members`` (bucket, key, size) whose bucket holds texts of more than one class, with their classes.

        Classes only grow, so a bucket of one class is done with for good.
        """
        rows = with_classes(members, labels)
        apart = rows.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x <> y").select("bucket")
        found = stage(rows.join(apart, "bucket"), "torn-buckets")
        unstage(members)
        return found

    # Each member with its bucket's least, for the first sketches; these join most copies.
    stars = members.filter("early AND key <> least").select(F.col("least").alias("a"), F.col("key").alias("b")).distinct()
    links = verified(stars, "star")
    labels = components(links)

    # The least and the greatest text of each class of a bucket with those of its first class, of which there may be no other.
    heads = with_classes(members, labels).groupBy("bucket", "class").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    lead = heads.groupBy("bucket").agg(F.min(F.struct("class", "low", "high")).alias("lead"))
    lead = lead.select("bucket", F.col("lead.class").alias("first"), F.col("lead.low").alias("low_lead"), F.col("lead.high").alias("high_lead"))
    pairs = heads.join(lead, "bucket").filter("class <> first")
    ends = F.explode(F.array(F.struct(F.col("low_lead").alias("a"), F.col("low").alias("b")), F.struct(F.col("high_lead").alias("a"), F.col("high").alias("b"))))
    more = verified(pairs.select(ends.alias("p")).select("p.a", "p.b").distinct(), "class")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = grown(labels, more)
    members = torn(members, labels)

    # What is still apart meets in blocks.
    members = fewer_buckets(members, block)
    shared = stage(members.groupBy("key").agg(F.collect_list("bucket").alias("buckets")), "torn-keys")
    fine = fine_bags(docs, shared.select("key"))
    words = members.select("bucket", "key").join(fine.select("key", "n"), "key").groupBy("bucket").agg(F.sum("n").alias("words"))
    long = stage(words.filter(F.col("words") > BLOCK_WORDS), "long-buckets")
    parts = F.ceil(F.greatest(F.col("size") / block, F.coalesce("words", F.lit(0)) / BLOCK_WORDS)).cast("int")
    members = salted_join(members, long, "bucket", "left").select("bucket", "key", "class", parts.alias("parts"))
    members = members.withColumn("now", F.col("class"))
    cut: DataFrame | None = None

    def in_blocks() -> DataFrame:
        """Members in each block (bucket, i, j) of theirs, in later rounds in those that left some out."""
        rows = members.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        rows = rows.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")}).drop("parts", "other")
        return rows if cut is None else rows.join(cut, ["bucket", "i", "j"], "left_semi")

    def with_bags(rows: DataFrame) -> DataFrame:
        return rows.join(fine, "key").join(shared, "key")

    low = 0
    for most in offered:
        found = stage(block_candidates(with_bags(in_blocks()), similarity, low, most), "block-pairs")
        more = align_pairs(stage(found.filter("a IS NOT NULL").select("a", "b"), "different-pairs"), docs, similarity)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = grown(labels, more)
        low, cut = most, stage(found.filter("a IS NULL").select("bucket", "i", "j"), "cut-blocks")
        if cut.isEmpty():
            return links, labels
        # Only buckets with a block that left some out are looked at again.
        again = stage(cut.select("bucket").distinct(), "cut-buckets")
        members = salted_join(salted_join(members.drop("now"), again, "bucket", "left_semi"), labels, "key", "left")
        members = stage(members.withColumn("now", F.coalesce("least", "key")).drop("least"), "cut-members")
    rows = stage(in_blocks(), "left-members")
    rows = with_bags(rows).join(hashed_words(docs, stage(rows.select("key").distinct(), "left-keys")), "key")
    more = stage(block_links(rows, similarity, low), "block-links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = grown(labels, more)
    return links, labels


def _allowed_pairs(pairs: DataFrame, counts: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose word counts and bags allow the similarity."""
    pairs = pairs.join(counts.toDF("a", "n_a", "bag_a"), "a").join(counts.toDF("b", "n_b", "bag_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                ok = allowed(n, m, _bags(batch.column("bag_a")), _bags(batch.column("bag_b")), similarity)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.mapInArrow(run, "a binary, b binary")


def _text_classes(docs: DataFrame, similarity: float, settings: dict) -> DataFrame:
    """One row per different text: __key, class_id, class_size, whether it is its class's first text, and its copies.

    Only texts with a link are grouped and joined; each other text is a class of its own. All is staged here, and texts
    reach Python in batches of bounded bytes, as a batch is held by both sides of each core.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return _staged_classes(docs, similarity, settings)


def _staged_classes(docs: DataFrame, similarity: float, settings: dict) -> DataFrame:
    _, labels = near_links(docs, similarity, **settings)
    ids = docs.filter(F.col("text").isNotNull()).select("doc_id", text_key(F.col("text")).alias("key"))
    ids = stage(ids.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).join(labels, "key", "left"), "texts")
    linked = ids.filter("least IS NOT NULL").withColumnRenamed("least", "root")
    classes = linked.groupBy("root").agg(
        F.min("first").alias("class_id"),
        F.sum("copies").alias("class_size"),
        F.min(F.struct(F.col("first").isNull(), "first", "key"))["key"].alias("first_key"),
    )
    classes = stage(classes, "class-sums")
    columns = [F.col("key").alias("__key"), "class_id", "class_size", (F.col("key") == F.col("first_key")).alias("__first"), "first", "copies"]
    found = salted_join(linked, classes, "root").select(*columns)
    alone = ids.filter("least IS NULL").withColumns({"class_id": F.col("first"), "class_size": F.col("copies"), "first_key": F.col("key")})
    return stage(found.unionByName(alone.select(*columns)), "classes")


def _with_classes(rows: DataFrame, classes: DataFrame, hot: int = HOT) -> DataFrame:
    """``rows`` (with __key) with their text's class; null keys have none.

    Texts with more than 1/``hot`` of all copies, at most ``hot`` of them, meet their rows by broadcast.
    """
    total = classes.agg(F.sum("copies")).first()[0] or 0
    often = classes.filter(F.col("copies") * hot > total).select("__key", "class_id", "class_size")
    rest = classes.filter(F.col("copies") * hot <= total).select("__key", F.col("class_id").alias("__id"), F.col("class_size").alias("__size"))
    found = rows.join(F.broadcast(often), "__key", "left")
    # Rows that have their class already go to other tasks than those of their key.
    key = F.when(F.col("class_size").isNull(), F.col("__key"))
    found = found.withColumn("__rest", F.coalesce(key, F.unhex(F.md5(F.concat(F.lit("none"), F.xxhash64("doc_id").cast("string"))))))
    found = found.join(rest.withColumnRenamed("__key", "__rest"), "__rest", "left").drop("__rest")
    out = {"class_id": F.coalesce("class_id", "__id"), "class_size": F.coalesce("class_size", "__size")}
    return found.withColumns(out).drop("__id", "__size")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, **settings) -> DataFrame:
    """Append ``class_id`` (least doc_id of the class) and ``class_size`` to every row.

    Equal texts are one class, the empty text too; a null text is no copy of anything, so its
    row is a class of its own. Texts of fewer words than a k-mer are one k-mer. A text without
    words has copies only. Repeated rows are copies. Texts are sketched and aligned whole; an
    empty table stays empty. Other columns are carried along, and columns named like a result are replaced by it.
    """
    keep = without(docs, ["class_id", "class_size"])
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], text_key(F.col("text")).alias("__key"))
    rows = _with_classes(rows, _text_classes(docs, similarity, settings))
    return rows.select(
        *[F.col(f"`{c}`") for c in keep],
        F.when(F.col("__key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, **settings) -> DataFrame:
    """Rows of ``docs``, one of each class: that of the least doc_id, nulls last, then of the least text key.

    Null texts all stay. Of rows that agree in id and text, one stays; only such rows, if they
    are their class's choice, are shuffled with their texts.
    """
    chosen = _text_classes(docs, similarity, settings).filter("__first").select("__key", F.col("first").alias("__id"))
    rows = docs.select("*", text_key(F.col("text")).alias("__key"))
    same = (rows["__key"] == chosen["__key"]) & rows["doc_id"].eqNullSafe(chosen["__id"])
    picked = rows.join(chosen.select(chosen["__key"], "__id"), same, "left_semi")
    again = picked.groupBy("__key").agg(F.count("*").alias("n")).filter("n > 1").select("__key")
    again = stage(again, "repeated-rows")
    single = picked.join(again, "__key", "left_anti").select(*docs.columns)
    first = picked.join(again, "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)
    return single.unionByName(first).unionByName(docs.filter(F.col("text").isNull()))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


QUERIES = {"op4_order_minhash": op4_order_minhash}
ORACLES: dict[str, str] = {}

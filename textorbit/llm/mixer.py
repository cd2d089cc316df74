"""Language-model scoring by online logistic context mixing.

A text is coded byte by byte and each byte bit by bit: its words with one space between them, and
an end. Each predictor hashes the bytes before (one to five of them) and predicts the next bit
from how often, in the training texts, the bytes that begin with the bits so far went on with
either. A mixer adds the predictions up in the logistic domain with weights chosen by a gate (how
long a context is known, and how well), learns these weights online from the training texts as it
passes them, and an adaptive probability map refines its result. The sum of the bits' costs is the
text's cost, so probabilities of all texts add up to at most one.

Counts are not broadcast. Texts are dealt into blocks of bounded size by hash. A block's distinct
contexts and tokens go to shards by hash, with the block's training counts; a shard adds up the
counts of all blocks and returns what each block asked for; a block then scores its texts. What
moves is a fraction of the corpus that grows with it, and a block, its requests and a shard are
of bounded size, as there are as many shards as blocks.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textorbit.llm.common import table, without
from textorbit.session import stage

# Predictors by the number of bytes they see, from weak to strong.
PREDICTORS = (1, 2, 3, 4, 5)
# Texts of one block, in bytes. Larger blocks share more of what they ask for.
BLOCK_BYTES = 16 << 20
# Positions that are coded between two steps of the mixer's learning, at the start and later.
FIRST_STEP, STEP = 1 << 10, 1 << 13
# Positions whose runs of bytes are looked up together.
LOOK_UP = 1 << 18
DELTA = 0.4
UNIT = 10.0  # predictions travel as hundred-odd steps of this many per logistic unit
RATE = 0.02
START = 0.3
MAP_CELLS = 24

TOKENS, GRAMS = 0, -1
END = b"\n"
PAD = END * max(PREDICTORS)
# Stands for padding, of which nothing is known; no run of bytes is as large.
NOTHING = np.uint64((1 << 64) - 1)

_M1, _M2, _GOLD = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))
_LOW = np.uint64(0xFF)


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def coded_text(text: str | None) -> bytes:
    """A text as it is coded: its words with a space between them, and the end."""
    return b" ".join(tokens_of(text)) + END


class Coded:
    """A run of documents as one byte sequence, each with padding before it.

    Padding keeps its places in the arrays, but has a key that nothing is known of, so it teaches
    nothing, and is in nobody's cost.
    """

    def __init__(self, parts: list[bytes]):
        self.sizes = np.array([len(p) for p in parts], np.int64)
        ends = np.cumsum(self.sizes + len(PAD)) - len(PAD)
        self.spans = np.stack([ends - self.sizes, ends], axis=1)
        self.data = np.frombuffer(PAD + PAD.join(parts) + b"\0", np.uint8).astype(np.uint64)
        between = (ends[:-1, None] + np.arange(len(PAD))).ravel()
        self.padding = np.append(between, len(self.data) - len(PAD) - 1)

    def grams(self) -> np.ndarray:
        """For each byte the bytes before it that predictors see, and itself, as one number."""
        n = len(self.data) - len(PAD)
        out = self.data[:n].copy()
        for at in range(1, len(PAD) + 1):
            out <<= np.uint64(8)
            out |= self.data[at : at + n]
        out[self.padding] = NOTHING
        return out


def context_keys(grams: np.ndarray, order: int) -> np.ndarray:
    """The hash of the last ``order`` bytes before, with the byte itself in the low bits."""
    past = (grams >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1)
    hashed = (past + np.uint64(order * int(_GOLD) & (1 << 64) - 1)) * _M1
    hashed ^= hashed >> np.uint64(32)
    hashed *= _M2
    return (hashed & ~_LOW) | (grams & _LOW)


def runs(texts: list[bytes], size: int) -> Iterator[tuple[int, int]]:
    """Cut documents into runs of about ``size`` bytes, whole documents each."""
    start, held = 0, 0
    for at, text in enumerate(texts):
        if held >= size:
            yield start, at
            start, held = at, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = _starts(keys)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(grams)
    ordered = ordered[: np.searchsorted(ordered, NOTHING)]
    starts = _starts(ordered)
    return ordered[starts], np.diff(starts, append=len(ordered))


def token_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


class Merged:
    """Distinct keys and counts that come in parts; small parts wait until they are as many as the rest."""

    def __init__(self):
        self.whole = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(1 << 20, len(self.whole[0])):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.parts:
            every = [self.whole, *self.parts]
            self.parts, self.waiting = [], 0
            table_ = pa.table({"key": np.concatenate([k for k, _ in every]), "n": np.concatenate([c for _, c in every])})
            sums = table_.group_by("key", use_threads=False).aggregate([("n", "sum")])
            self.whole = (sums.column("key").to_numpy(), sums.column("n_sum").to_numpy())
        return self.whole


def word_places(texts: list[bytes]) -> tuple[list[bytes], list[np.ndarray]]:
    """Distinct tokens of texts, ends included, and for each text the places of its tokens among them."""
    places: dict[bytes, int] = defaultdict(count().__next__)
    out = []
    for text in texts:
        words = text.split()
        words.append(END)
        out.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
    return list(places), out


def block_words(texts: list[bytes], held_out: list[bool]) -> tuple[list[bytes], np.ndarray]:
    """A block's distinct tokens, ends included, and how often each occurs in its training texts."""
    words, places = word_places(texts)
    known = [p for p, held in zip(places, held_out) if not held]
    return words, np.bincount(np.concatenate(known) if known else np.zeros(0, np.int32), minlength=len(words))


def block_counts(texts: list[bytes], held_out: list[bool]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A block's distinct keys of each kind, and their counts in its training texts."""
    words, counts = block_words(texts, held_out)
    out = {TOKENS: _added(token_keys(words), counts)}
    del words
    found = Merged()
    for held in (False, True):
        own = [t for t, h in zip(texts, held_out) if h == held]
        for start, end in runs(own, LOOK_UP):
            grams, counts = _distinct(Coded(own[start:end]).grams())
            found.add(grams, np.zeros_like(counts) if held else counts)
    grams, counts = _added(*found.merge())
    out[GRAMS] = (grams, counts)
    # Shorter contexts are parts of the longest: each distinct run of bytes is looked at once.
    return out | {order: _added(context_keys(grams, order), counts) for order in PREDICTORS}


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the bytes of their differences, plane by plane, which compress."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return pack(steps.view(np.uint8).reshape(-1, 8).T)


def unpack_keys(data: bytes) -> np.ndarray:
    planes = unpack(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def shard_edges(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where sorted keys pass from one shard to the next: shards are ranges of context hashes."""
    bounds = [np.uint64(((s << 56) // shards) << 8) for s in range(1, shards)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(bounds, np.uint64)), [len(keys)]]).astype(np.int64)


def bit_predictions(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For sorted keys (context, byte): the logit of each of the byte's bits given those before it,
    in steps of 1 / UNIT, and last the binary logarithm of the context's count."""
    inside = counts.astype(np.int64)
    levels = []
    for bits in range(9):
        prefix = keys >> np.uint64(8 - bits)
        starts = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
        sums = np.add.reduceat(inside, starts)
        levels.append(np.repeat(sums, np.diff(np.append(starts, len(keys)))).astype(np.float64))
    out = np.zeros((len(keys), 9), np.int8)
    for bit in range(8):
        logit = np.log((levels[bit + 1] + DELTA) / (levels[bit] - levels[bit + 1] + DELTA))
        out[:, bit] = np.clip(np.rint(logit * UNIT), -127, 127)
    out[:, 8] = np.minimum(np.ceil(np.log2(levels[0] + 1)), 63)
    return out


def answers(blocks: list[int], kinds: list[int], keys: list[bytes], counts: list[bytes]) -> Iterator[tuple]:
    """A shard's answers: (block, kind, answer, words, distinct words) aligned with what was asked."""
    for kind in sorted(set(kinds)):
        rows = [i for i, k in enumerate(kinds) if k == kind]
        if kind == GRAMS:  # a block's own, kept for it
            yield from ((blocks[i], kind, keys[i], 0, 0) for i in rows)
            continue
        asked = {i: unpack_keys(keys[i]) for i in rows}
        distinct, sums = _added(np.concatenate([asked[i] for i in rows]), np.concatenate([unpack(counts[i], np.int64) for i in rows]))
        told = sums if kind == TOKENS else bit_predictions(distinct, sums)
        first = True
        for i in rows:
            answer = told[np.searchsorted(distinct, asked[i])]
            n, v = (int(sums.sum()), int((sums > 0).sum())) if first and kind == TOKENS else (0, 0)
            first = False
            yield blocks[i], kind, pack(answer if kind == TOKENS else answer.T), n, v


class Mixer:
    """Weights by gate and bit, and the map that refines the mixed prediction."""

    def __init__(self, inputs: int):
        self.inputs = inputs
        self.gates = (inputs + 1) * 4
        self.weights = np.full((inputs, self.gates, 8), START, np.float32)
        self.seen = np.full((inputs, self.gates, 8), 1e-4)
        # Per bit and prediction in halves of a logistic unit: how often such a prediction was made for
        # the value that came. With that of the opposite prediction, which was made for the other
        # value, it says how often the predicted value comes.
        self.map = np.tile(20 / (1 + np.exp(-np.arange(-MAP_CELLS, MAP_CELLS + 1) / 2)), (8, 1))
        self.shift = (np.arange(8) * (2 * MAP_CELLS + 1) + MAP_CELLS).astype(np.int16)

    def gate(self, known: list[np.ndarray]) -> np.ndarray:
        """The longest known context, and how often it was met, by quarters."""
        found = np.zeros(len(known[0]), np.int8)
        for i, k in enumerate(known):
            np.copyto(found, (i + 1) * 4 + np.minimum(k // 3, 3), where=k > 0)
        return found

    def code(self, rows: list[np.ndarray], gate: np.ndarray, times: np.ndarray, learn: bool) -> np.ndarray:
        """Cost in bits of different positions, which stand in the order of their gates if it is to ``learn``. ``rows``
        are the logits of the bits that came, eight bytes each; ``times`` says how often each position occurs, for learning."""
        inputs = [r.view(np.int8).reshape(-1, 8).astype(np.float32) for r in rows]
        weights = self.weights / np.float32(UNIT)
        mixed, own = weights[0].take(gate, axis=0), np.empty((len(gate), 8), np.float32)
        mixed *= inputs[0]
        for i in range(1, self.inputs):
            mixed += np.multiply(inputs[i], weights[i].take(gate, axis=0, out=own, mode="clip"), out=own)
        # A prediction of neither value is in the middle and stays there, as the map treats both alike.
        place = np.clip(mixed, -11.9, 11.9)
        place *= np.float32(2)
        cell = (np.rint(place).astype(np.int16) + self.shift).astype(np.int64)
        np.negative(mixed, out=mixed)
        np.minimum(mixed, 60, out=mixed)
        p = np.exp(mixed, out=mixed)
        p += 1
        np.reciprocal(p, out=p)
        counts = self.map + self.map[:, ::-1]
        refined = (self.map / counts).astype(np.float32).ravel()[cell]
        refined += p
        refined *= np.float32(0.5)
        if learn:
            starts = _starts(gate)
            gates = gate[starts]
            often = times.astype(np.float32)[:, None]
            missed = np.subtract(1, p, out=p)
            missed *= often
            sizes = np.maximum(np.add.reduceat(often, starts, axis=0), 32)
            for i, x in enumerate(inputs):
                slope = np.add.reduceat(np.multiply(missed, x, out=own), starts, axis=0) / (sizes * UNIT)
                self.seen[i, gates] += slope**2
                self.weights[i, gates] += (RATE * slope / np.sqrt(self.seen[i, gates])).astype(np.float32)
            came = np.bincount(cell.ravel(), np.repeat(times, 8), minlength=self.map.size)
            self.map += came.reshape(self.map.shape)
        np.maximum(refined, np.float32(1e-9), out=refined)
        return -np.log2(refined, out=refined).sum(axis=1, dtype=np.float64)


class Answers:
    """What is known of each run of bytes in a block: by predictor, the logits of eight bits in eight
    bytes, and how known the context is. The last row stands for padding. ``told`` stands in the order of
    the keys in ``own``, or of the different keys of ``grams``."""

    def __init__(self, grams: np.ndarray, own: dict[int, np.ndarray] | None, told: dict[int, np.ndarray]):
        self.grams = np.append(grams, NOTHING)
        self.rows, self.known = [], []
        for order in PREDICTORS:
            keys = context_keys(grams, order)
            # Sorted look-ups pass through the table once.
            by_key = np.argsort(keys)
            at = np.empty(len(keys), np.int64)
            ordered = keys[by_key]
            if own is None:
                at[by_key] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]])) if len(keys) else 0
            else:
                at[by_key] = np.searchsorted(own[order], ordered)
            self.rows.append(np.append(np.ascontiguousarray(told[order][:, :8]).view(np.int64).ravel()[at], 0))
            self.known.append(np.append(told[order][:, 8][at], np.int8(0)))

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the different runs among ``grams``, and for each position which of them it is."""
        coded = pc.dictionary_encode(pa.array(grams))
        distinct = coded.dictionary.to_numpy()
        order = np.argsort(distinct)
        where = np.empty(len(order), np.int64)
        where[order] = np.searchsorted(self.grams, distinct[order])
        return where, coded.indices.to_numpy()


def score_block(ids: list, texts: list[bytes], held_out: list[bool], found: Answers) -> tuple[np.ndarray, np.ndarray]:
    """Bits and bytes of each text. The mixer learns from training texts only, in order of id;
    held-out texts are coded with what it has learned from all of its block's."""
    bits, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    mixer = Mixer(len(PREDICTORS))
    order = np.array(sorted(range(len(texts)), key=lambda i: (held_out[i], ids[i] is None, ids[i], texts[i])), np.int64)
    ordered = [texts[i] for i in order]
    n_train = sum(not h for h in held_out)
    gates, step = mixer.gate(found.known), FIRST_STEP
    for low, high in ((0, n_train), (n_train, len(order))):
        part = ordered[low:high]
        for start, end in runs(part, LOOK_UP):
            coded = Coded(part[start:end])
            grams, costs = coded.grams(), []
            # A long text takes several look-ups; what is looked up together is learned in small steps.
            for at in range(0, len(grams), LOOK_UP):
                where, which = found.find(grams[at : at + LOOK_UP])
                rows, own_gates, padding = [r[where] for r in found.rows], gates[where], found.grams[where] == NOTHING
                done, learn = 0, low == 0
                place = np.empty(len(where), np.int64)
                while done < len(which):
                    some = which[done : done + (step if learn else LOOK_UP)]
                    places = np.sort(some)
                    starts = _starts(places)
                    here, times = places[starts], np.diff(starts, append=len(places))
                    if learn:
                        by_gate = np.argsort(own_gates[here], kind="stable")
                        here, times = here[by_gate], times[by_gate]
                    place[here] = np.arange(len(here))
                    times[padding[here]] = 0
                    own = mixer.code([r[here] for r in rows], own_gates[here], times, learn)
                    costs.append(own[place[some]])
                    done += len(some)
                    step = min(2 * step, STEP)
            at = order[low + start : low + end]
            bits[at] = np.add.reduceat(np.concatenate(costs), coded.spans.ravel())[::2]
            sizes[at] = coded.sizes
    return bits, sizes


RESULT = (
    "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, "
    "bits_per_byte double"
)


def context_mixing(docs: DataFrame, folds: int = 5, held_fold: int = 1, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Append scores (``RESULT``) to every row of ``docs``.

    Rows whose crc32 of the id as text leaves ``held_fold`` modulo ``folds`` teach nothing; rows
    without id do. A null text is an empty one, which has an end alone. Repeated rows are counted
    and scored each. Without training texts every bit costs one, and base scores are 0. Long
    texts are coded whole, in several steps. An empty table stays empty. Other columns are
    carried along, and columns named like a result are replaced by it.

    The number of blocks depends on the corpus's size, so a text's score may change in its last
    digits as the corpus grows, as it does by what is learned; the same rows give the same scores.
    """
    added = T.StructType.fromDDL(RESULT)
    keep = without(docs, added.names)
    total = int(docs.agg(F.sum(F.octet_length("text").cast("long") + 16)).first()[0] or 0)
    blocks = max(1, -(-total // block_bytes))
    held = F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(folds)) == held_fold, F.lit(False))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        docs["doc_id"].alias("__id"), docs["text"].alias("__text"), held.alias("__held"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("__block"),
    )

    def ask(group: pa.Table) -> pa.Table:
        block = group.column("__block")[0].as_py()
        texts = [coded_text(t.as_py()) for t in group.column("__text")]
        out: list[tuple] = []
        for kind, (keys, counts) in block_counts(texts, group.column("__held").to_pylist()).items():
            if kind == GRAMS:
                out.append((block, block, kind, pack_keys(keys), b""))
                continue
            edges = shard_edges(keys, blocks)
            for shard, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if a < b:
                    out.append((block, shard, kind, pack_keys(keys[a:b]), pack(counts[a:b].astype(np.int64))))
        columns = zip(*out)
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["block", "shard", "kind", "keys", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        columns = [group.column(c).to_pylist() for c in ("block", "kind", "keys", "counts")]
        found = list(zip(*[(b, k, a, n, v) for b, k, a, n, v in answers(*columns)]))
        types = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(found, types)]
        shards = pa.array([shard] * len(found[0]), pa.int32())
        return pa.table([arrays[0], shards, *arrays[1:]], ["block", "shard", "kind", "answer", "n", "v"])

    asked = rows.select("__text", "__held", "__block").groupBy("__block").applyInArrow(
        ask, "block int, shard int, kind int, keys binary, counts binary"
    )
    told = asked.groupBy("shard").applyInArrow(answer, "block int, shard int, kind int, answer binary, n long, v long")
    told = stage(told, "lm-answers")
    n, v = told.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    floor = math.log10(n + 0.5 * (v + 1))

    def score(group: pa.Table, replies: pa.Table) -> pa.Table:
        texts = [coded_text(t.as_py()) for t in group.column("__text")]
        held_out = group.column("__held").to_pylist()
        replies = replies.sort_by([("kind", "ascending"), ("shard", "ascending")])
        kinds = np.array(replies.column("kind").to_pylist())
        bodies = replies.column("answer")
        parts: dict[int, list[np.ndarray]] = {}
        for i, kind in enumerate(kinds.tolist()):
            data = bodies[i].as_py()
            if kind == GRAMS:
                grams = unpack_keys(data)
                continue
            part = unpack(data, np.int64) if kind == TOKENS else unpack(data, np.int8).reshape(9, -1).T
            parts.setdefault(kind, []).append(part)
        said = {kind: np.concatenate(p) for kind, p in parts.items()}
        bits, sizes = score_block(group.column("__id").to_pylist(), texts, held_out, Answers(grams, None, said))
        words, places = word_places(texts)
        # Equal keys, as of the same word, have one answer.
        counts = said[TOKENS][np.unique(token_keys(words), return_inverse=True)[1]]
        cost = np.log10(counts + 0.5) - floor
        n_tokens = [len(p) for p in places]
        seen = [int(np.count_nonzero(counts[p])) for p in places]
        base = [sum(cost[p].tolist()) for p in places]
        columns = [
            pa.array(held_out, pa.bool_()), pa.array(n_tokens, pa.int64()), pa.array(seen, pa.int64()),
            pa.array([n] * len(texts), pa.int64()), pa.array(base, pa.float64()), pa.array(-bits * math.log10(2), pa.float64()),
            pa.array(sizes, pa.int64()), pa.array(bits / sizes, pa.float64()),
        ]
        return pa.table([*[group.column(i) for i in range(len(keep))], *columns], [*keep, *added.names])

    schema = T.StructType([*rows.schema.fields[: len(keep)], *added.fields])
    return rows.groupBy("__block").cogroup(told.withColumnRenamed("block", "__block").groupBy("__block")).applyInArrow(score, schema)


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = context_mixing(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.drop("text")


QUERIES = {"op1_context_mixing": op1_context_mixing}
ORACLES: dict[str, str] = {}

"""Language spans by Viterbi over per-word scores, candidates narrowed by script.

A word is a run of letters and marks of one script. The scripts that a language's training words use
decide which languages are candidates for a word. Its score for a candidate adds, over the word's
character triples (with its edges), how much likelier the triple is in that language than in the mean of all
languages. Viterbi over the words, with a fixed penalty for each switch, labels spans of one language,
so a few misleading words do not break a span but a quoted sentence in another language does. A text's language is
the one with the most letters.

Triples are counted over all training texts: each task adds up one table per language and sends what is not
zero. The table of scores has 2^16 rows a language whatever the corpus, and is refused above
``TABLE_BYTES``. Words of many texts are decoded side by side, whole texts at a time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textorbit.llm.common import table, without

FOLDS, HELD_FOLD = 5, 0
BITS = 16
# Weight of a triple's mean over languages in each language's own share: a triple foreign to it costs log(MEAN).
MEAN = 0.02
# What a switch of language costs, in nats.
SWITCH = 12.0
# A language uses a script if at least this share of its words does.
SCRIPT_SHARE = 0.005
TABLE_BYTES = 256 << 20
# Texts of about so many characters are decoded together.
CHUNK = 1 << 20
UNKNOWN = "und"

# First code point of each block, and the script of its letters.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "odia"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
    (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, "latin"),
    (0x2DE0, "cyrillic"), (0x2E00, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0x31F0, "kana"),
    (0x3200, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"), (0xA8E0, "devanagari"),
    (0xA900, "other"), (0xAB30, "latin"), (0xAB70, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "latin"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32400, "other"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})

_P1, _P2, _P3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its script's number plus one if it is a letter or mark (negative for marks), else 0; and its lower case."""
    size = 0x32400
    kinds, lower = np.zeros(size + 1, np.int8), np.arange(size + 1, dtype=np.uint32)
    starts = [s for s, _ in SCRIPT_STARTS]
    numbers = np.array([SCRIPTS.index(name) + 1 for _, name in SCRIPT_STARTS], np.int8)
    script = numbers[np.searchsorted(starts, np.arange(size + 1), side="right") - 1]
    for point in range(size):
        char = chr(point)
        if char.isalpha():
            kinds[point] = script[point]
            if len(small := char.lower()) == 1:
                lower[point] = ord(small)
        elif point >= 0x300 and unicodedata.category(char)[0] == "M":
            kinds[point] = -script[point]
    return kinds, lower


class Words:
    """Words of several texts laid out in arrays.

    ``text``, ``start`` and ``end`` (offsets in the text), ``script`` and ``letters`` are by word; ``triples``
    are the hashes of all words' triples, ``first`` is where each word's begin.
    """

    def __init__(self, texts: list[str | None], characters: tuple[np.ndarray, np.ndarray] | None = None):
        kinds, lower = characters or _characters()
        whole = [t or "" for t in texts]
        lengths = np.array([len(t) for t in whole], np.int64)
        # One separator after each text keeps words apart.
        points = np.frombuffer(" ".join([*whole, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.minimum(points, len(kinds) - 1)
        kind = kinds[points]
        script = np.abs(kind)
        # A mark continues the word of the letter before it, whatever its block; elsewhere it is no word.
        marks = np.flatnonzero(kind < 0)
        if len(marks):
            base = np.where(kind >= 0, np.arange(len(kind)), 0)
            script = script.copy()
            script[marks] = script[np.maximum.accumulate(base)[marks]]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], script, [0]])))
        starts, ends = edge[:-1], edge[1:]
        words = script[starts] > 0 if len(starts) else np.zeros(0, bool)
        starts, ends = starts[words], ends[words]
        offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.texts = len(texts)
        self.text = np.searchsorted(offsets, starts, side="right") - 1
        self.start, self.end = starts - offsets[self.text], ends - offsets[self.text]
        self.script = (script[starts] - 1).astype(np.int64)
        letters_before = np.concatenate([[0], np.cumsum(kind > 0)])
        self.letters = letters_before[ends] - letters_before[starts]
        # Characters of words only, each word between separators.
        sizes = ends - starts
        total = int(sizes.sum())
        own = np.repeat(np.arange(len(starts)), sizes)
        self.first = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
        where = starts[own] + np.arange(total) - self.first[own]
        low = lower[points[where]] if total else np.zeros(0, np.uint32)
        before, after = np.zeros(total, np.uint32), np.zeros(total, np.uint32)
        if total:
            before[1:], after[:-1] = low[:-1], low[1:]
            before[self.first] = 0
            after[self.first + sizes - 1] = 0
        with np.errstate(over="ignore"):
            mixed = before * _P1 ^ low * _P2 ^ after * _P3
            mixed = (mixed ^ (mixed >> np.uint32(15))) * _P2
            mixed ^= mixed >> np.uint32(13)
            self.triples = ((mixed * _P3) >> np.uint32(32 - BITS)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.start)


def chunks(texts: list[str | None], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``most`` characters, one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > most:
            yield start, i
            start, size = i, 0
        size += len(text or "") + 1
    if start < len(texts):
        yield start, len(texts)


class LanguageModel:
    """Scores of triples by language (2^16 x languages) and the languages' scripts."""

    def __init__(self, languages: list[str], triples: np.ndarray, scripts: np.ndarray):
        """``triples`` (languages x 2^16) and ``scripts`` (languages x scripts) are counts."""
        self.languages = languages
        # Made once, here, and not by each task.
        self.characters = _characters()
        if not languages:
            return
        share = triples / np.maximum(triples.sum(axis=1, keepdims=True), 1)
        mean = share.mean(axis=0)
        # What no language has says nothing: score 0.
        mean[mean == 0] = 1.0
        unseen = triples.sum(axis=0) == 0
        scores = np.log((1 - MEAN) * share / mean + MEAN)
        scores[:, unseen] = 0.0
        self.scores = np.ascontiguousarray(scores.T.astype(np.float32))
        total = np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        uses = scripts / total >= SCRIPT_SHARE
        # A script that no language uses narrows nothing.
        uses[:, ~uses.any(axis=0)] = True
        self.uses = np.ascontiguousarray(uses.T)

    def word_scores(self, words: Words) -> np.ndarray:
        """(words x languages): sums over triples; languages that are no candidates have -inf."""
        found = np.add.reduceat(self.scores[words.triples], words.first, axis=0, dtype=np.float64)
        found[~self.uses[words.script]] = -np.inf
        return found


def viterbi(scores: np.ndarray, text: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word, given word scores in order of texts; every text is a path of its own.

    A path's value adds its words' scores and subtracts ``switch`` for each change of language. Texts
    go side by side, longest first, so a step costs the same for one text and for many. Equal paths take the
    lower language, and stay rather than switch. A word without candidates in common with the path switches.
    """
    n, languages = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    size = np.diff(np.concatenate([begin, [n]]))
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    # Step t has the first live[t] texts; its words stand together.
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
    at = np.concatenate([[0], np.cumsum(live)])
    came = np.empty((n, languages), np.int16)
    own = np.arange(languages)
    value = scores[begin].copy()
    ends = np.empty((len(begin), languages))
    for t in range(1, size[0]):
        k = live[t]
        if k < len(value):
            ends[k : len(value)] = value[k:]
            value = value[:k]
        best = value.argmax(axis=1)
        top = value[np.arange(k), best][:, None] - switch
        stay = value >= top
        came[at[t] : at[t + 1]] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, top) + scores[begin[:k] + t]
    ends[: len(value)] = value
    label = np.empty(n, np.int64)
    state = ends.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        k = live[t]
        now = state[:k]
        label[begin[:k] + t] = now
        if t:
            state[:k] = came[at[t] : at[t + 1]][np.arange(k), now]
    return label


def decode(model: LanguageModel, texts: list[str | None], switch: float = SWITCH) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
    """For each text: its language, a score from 0 to 1, and its spans (start, end, language)."""
    for start, end in chunks(texts):
        part = texts[start:end]
        words = Words(part, model.characters)
        if not len(words) or not model.languages:
            yield from ((UNKNOWN, 0.0, []) for _ in part)
            continue
        scores = model.word_scores(words)
        label = viterbi(scores, words.text, switch)
        count = len(model.languages)
        letters = np.bincount(words.text * count + label, words.letters, len(part) * count).reshape(len(part), count)
        # Spans: words of one text and label in a row.
        cut = np.flatnonzero(np.concatenate([[True], (words.text[1:] != words.text[:-1]) | (label[1:] != label[:-1])]))
        last = np.concatenate([cut[1:], [len(words)]]) - 1
        # How sure a span is of its language: its words' sums against the other languages'.
        with np.errstate(invalid="ignore"):
            sums = np.add.reduceat(np.maximum(scores, -1e3), cut, axis=0)
        sums -= sums.max(axis=1, keepdims=True)
        chance = np.exp(sums)
        chance = chance[np.arange(len(cut)), label[cut]] / chance.sum(axis=1)
        weight = np.add.reduceat(words.letters, cut)
        best = letters.argmax(axis=1)
        of = words.text[cut]
        ours = label[cut] == best[of]
        sure = np.bincount(of, np.where(ours, chance * weight, 0.0), len(part))
        total = letters.sum(axis=1)
        bounds = np.searchsorted(of, np.arange(len(part) + 1))
        for i in range(len(part)):
            if not total[i]:
                yield UNKNOWN, 0.0, []
                continue
            rows = range(bounds[i], bounds[i + 1])
            spans = [(int(words.start[cut[r]]), int(words.end[last[r]]), model.languages[label[cut[r]]]) for r in rows]
            yield model.languages[best[i]], float(min(1.0, sure[i] / total[i])), spans


def learn(texts: DataFrame, table_bytes: int = TABLE_BYTES) -> LanguageModel:
    """A model of the rows of ``text`` and ``lang``; both must not be null.

    Every text counts, whole. Languages whose scores together exceed ``table_bytes`` are refused.
    """

    characters = texts.sparkSession.sparkContext.broadcast(_characters())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        size = 1 << BITS

        def rows() -> pa.RecordBatch:
            names, keys, values = [], [], []
            for name, found in sorted(counts.items()):
                used = np.flatnonzero(found)
                names += [name] * len(used)
                keys.append(used)
                values.append(found[used])
            whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(whole(keys)), pa.array(whole(values))], ["lang", "key", "n"])

        for batch in batches:
            found_texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in chunks(found_texts):
                words = Words(found_texts[start:end], characters.value)
                if not len(words):
                    continue
                part = langs[start:end]
                names = sorted(set(part))
                number = np.array([names.index(x) for x in part])[words.text]
                triple_of = np.repeat(number, np.diff(np.concatenate([words.first, [len(words.triples)]])))
                for i, name in enumerate(names):
                    got = np.bincount(words.triples[triple_of == i], minlength=size)
                    got = np.concatenate([got, np.bincount(words.script[number == i], minlength=len(SCRIPTS))]).astype(np.int64)
                    counts[name] = counts[name] + got if name in counts else got
                if len(counts) > 256:
                    yield rows()
        yield rows()

    found = texts.select("text", "lang").mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    languages = sorted(r.lang for r in texts.select("lang").distinct().limit(table_bytes // (4 << BITS) + 1).collect())
    if len(languages) * (4 << BITS) > table_bytes:
        raise ValueError(f"over {len(languages) - 1} languages exceed a table of {table_bytes} bytes")
    rows = found.toArrow()
    counts = np.zeros((len(languages), (1 << BITS) + len(SCRIPTS)))
    number = {name: i for i, name in enumerate(languages)}
    at = np.array([number[x] for x in rows.column("lang").to_pylist()], np.int64)
    counts[at, rows.column("key").to_numpy()] = rows.column("n").to_numpy()
    return LanguageModel(languages, counts[:, : 1 << BITS], counts[:, 1 << BITS :])


def held_out(doc_id: str = "doc_id", folds: int = FOLDS, held_fold: int = HELD_FOLD):
    """Whether a row's crc32 of the id as text leaves ``held_fold``; a null id does not."""
    mark = F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8"))
    return F.coalesce(F.pmod(mark, F.lit(folds)) == held_fold, F.lit(False))


def label_spans(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """Append ``lang_pred``, ``score`` and ``spans`` (array of start, end, lang; offsets in code points); the text is dropped.

    ``score`` is the share of letters in spans of the predicted language, each weighed by how sure it is. A
    text that is null or has no letter is ``und`` with score 0 and no spans, and so is any text if nothing was
    learned. Of languages with equally many letters the first by code point wins. A letter of a script that no language
    uses leaves all languages possible. Texts are read whole; other columns are carried along, and
    columns named like a result are replaced by it.
    """
    added = T.StructType.fromDDL("lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>")
    keep = without(docs, [*added.names, "text"])
    source = docs.select(*[F.col(f"`{c}`") for c in keep], docs["text"].alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *added.fields])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(added)
        for batch in batches:
            found = list(decode(shared.value, batch.column(len(keep)).to_pylist(), switch))
            spans = [[{"start": a, "end": b, "lang": x} for a, b, x in f[2]] for f in found]
            columns = [[f[0] for f in found], [f[1] for f in found], spans]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], [*batch.schema.names[: len(keep)], *added.names])

    return source.mapInArrow(run, schema)


def language_spans(docs: DataFrame, folds: int = FOLDS, held_fold: int = HELD_FOLD, switch: float = SWITCH) -> DataFrame:
    """Learn from the rows outside the held fold with a text and a lang, and label every row (``label_spans``); adds ``held_out``.

    A row without an id is neither learned from nor held out.
    """
    held = held_out("doc_id", folds, held_fold)
    model = learn(docs.filter(~held & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()))
    marked = docs.select(*[F.col(f"`{c}`") for c in without(docs, ["held_out"])], held.alias("held_out"))
    return label_spans(marked, model, switch)


def op11_script_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_spans(docs).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op11_script_viterbi": op11_script_viterbi}
ORACLES: dict[str, str] = {}

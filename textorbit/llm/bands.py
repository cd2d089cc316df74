"""Quality rules: compression bands.

A document's zstandard ratio (compressed by raw bytes) says how repetitive it is. Natural text
lies in a band that falls with length, as longer texts give the coder more to refer back to; so
limits depend on the length. The whole document is judged by its ratio, and so is each fixed
chunk of it: a long run of boilerplate inside an otherwise fine document shows in its chunks
only. Rows are judged one by one; nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession

from textorbit.llm.common import append_columns, table

# Raw bytes from which a limit holds, lowest and highest ratio. Shorter texts are not judged by
# ratio: the coder's frame and its start-up weigh too much. The highest ratios stand just above those
# of clean text: of sf0.1, and of licences and dense Markdown, which compress less.
LIMITS = (
    (256, 0.30, 0.87),
    (320, 0.30, 0.845),
    (384, 0.30, 0.82),
    (448, 0.30, 0.80),
    (512, 0.30, 0.75),
    (1024, 0.28, 0.68),
    (2048, 0.26, 0.59),
    (4096, 0.24, 0.57),
    (8192, 0.22, 0.545),
    (16384, 0.22, 0.49),
)
# The same for texts that are mostly bytes of multi-byte characters, whose coding varies more.
MULTI_LIMITS = (
    (256, 0.30, 0.95),
    (512, 0.30, 0.88),
    (1024, 0.28, 0.80),
    (2048, 0.26, 0.75),
    (4096, 0.24, 0.72),
    (8192, 0.22, 0.70),
)
MULTI_SHARE = 0.5
_ASCII = bytes(range(128))
CHUNK_BYTES = 4096
# A rejected document has at least this share of its bytes in chunks outside the limits.
BAD_SHARE = 0.25
LEVEL = 3
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SPACES = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, ratio double, bad_share double, reason string"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    grams = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    # Number pairs of words, then pairs of pairs, and so on: equal numbers are equal windows.
    step = 1
    while step < window:
        pairs = grams[:-step] * (int(grams.max()) + 1) + grams[step:]
        distinct, grams = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        step *= 2
    again = np.bincount(grams)[grams] > 1
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def mostly_multi(data: bytes) -> bool:
    """Whether most bytes besides white space belong to multi-byte characters."""
    multi, spaces = len(data.translate(None, _ASCII)), sum(map(data.count, SPACES.encode()))
    return multi > MULTI_SHARE * (len(data) - spaces)


def limits_for(n_bytes: int, limits=LIMITS) -> tuple[float, float] | None:
    found = None
    for least, low, high in limits:
        if n_bytes >= least:
            found = (low, high)
    return found


def judge(data: bytes, compress, limits=LIMITS, multi_limits=MULTI_LIMITS, chunk_bytes: int = CHUNK_BYTES, bad_share: float = BAD_SHARE):
    """Ratio of a text, share of its bytes in bad chunks, and why it is rejected (or None)."""
    if not data:
        return None, 0.0, None
    ratio, bad = len(compress(data)) / len(data), 0
    if len(data) > chunk_bytes:
        for at in range(0, len(data), chunk_bytes):
            part = data[at : at + chunk_bytes]
            band = limits_for(len(part), multi_limits if mostly_multi(part) else limits)
            if band and not band[0] <= len(compress(part)) / len(part) <= band[1]:
                bad += len(part)
    band, share = limits_for(len(data), multi_limits if mostly_multi(data) else limits), bad / len(data)
    if band and ratio < band[0]:
        return ratio, share, "repetitive"
    if band and ratio > band[1]:
        return ratio, share, "incompressible"
    return ratio, share, "chunks" if bad and share >= bad_share else None


def compression_bands(
    docs: DataFrame,
    limits=LIMITS,
    multi_limits=MULTI_LIMITS,
    chunk_bytes: int = CHUNK_BYTES,
    bad_share: float = BAD_SHARE,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    level: int = LEVEL,
) -> DataFrame:
    """Append word counts, compression figures and the verdict ``kept`` to every row of ``docs``.

    Null and empty texts have no words, so ``base_failed``, and a null ratio; texts below the
    first limit's length are judged by their words alone; repeated rows and ties are judged
    alike; an empty table stays empty. Other columns are carried along, and columns named like
    a result are replaced by it. Long texts are compressed whole.
    """

    def compute(texts: list[str | None]) -> list[list]:
        compress = zstandard.ZstdCompressor(level=level).compress
        rows = []
        for text in texts:
            text = text or ""
            data = text.encode("utf-8", "surrogatepass")
            words = data.split()
            n = len(words)
            repeat = repeated_words(words)
            base_failed = n < min_words or 100 * repeat > max_repeat_percent * n
            ratio, share, reason = judge(data, compress, limits, multi_limits, chunk_bytes, bad_share)
            chars = len(text) - sum(map(text.count, SPACES))
            symbols = sum(map(text.count, SYMBOLS))
            kept = not base_failed and reason is None
            rows.append((n, chars, symbols, duplicate_lines(text), repeat, base_failed, kept, ratio, share, reason))
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(10)]

    return append_columns(docs, ["text"], RESULT, compute)


def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = compression_bands(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text")


QUERIES = {"op7_compression_bands": op7_compression_bands}
ORACLES: dict[str, str] = {}

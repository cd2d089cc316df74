"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document becomes a few statistics of its text. Random Fourier features make a linear model of
them that approximates a Gaussian kernel; its normal equations are sums over documents, so each
task adds up its own part and only sums of the model's size travel. A fifth of the training rows
is kept from the ridge fit: on their scores, counted in fixed bins, an isotonic regression learns
how often documents of a score are good.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textorbit.functions.vectors import SUMS, from_bytes, keyed_sums, sum_by_key, to_matrix
from textorbit.llm.common import append_columns, table, without
from textorbit.session import stage

FEATURES = 256
RIDGE = 1e-4
# Bandwidth of the kernel in units of the standardised statistics' typical distance.
WIDTH = 0.7
SEED = 7
BINS = 2000
THRESHOLD = 0.7

_STOPS = b".!?"
_CLASSES = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "space": [0x20, 0x09],
    "line": [0x0A],
    "stop": list(_STOPS),
    "comma": list(b",;:"),
    "symbol": list(b"#*$%&|<>@^~_+=\\/{}[]`"),
    "high": range(0x80, 0x100),
}
_PICK = np.zeros((256, len(_CLASSES)))
for _i, _bytes in enumerate(_CLASSES.values()):
    _PICK[list(_bytes), _i] = 1.0
NAMES = [
    *_CLASSES, "log_bytes", "log_words", "entropy", "zstd", "word_mean", "word_spread", "distinct", "top_word", "pairs_again",
    "lines_again", "line_words", "long_words", "short_words", "ends_stop", "capital_words", "upper_words", "marked_words", "exclaims",
]


def statistics(text: str | None, compress) -> list[float]:
    """The statistics of ``NAMES``; zeros for a text without words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(NAMES)
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts / n
    there = shares[shares > 0]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    number = Counter(words)
    pairs = len(words) - 1
    lines = [line for line in data.split(b"\n") if line.strip()]
    w = len(words)
    return [
        *(shares @ _PICK),
        np.log1p(n),
        np.log1p(w),
        float(-(there * np.log2(there)).sum()),
        len(compress(data)) / (n + 20),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        len(number) / w,
        max(number.values()) / w,
        1 - len(set(zip(words, words[1:]))) / pairs if pairs else 0.0,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(w / len(lines))),
        float((lengths > 14).mean()),
        float((lengths <= 2).mean()),
        sum(line.rstrip()[-1] in _STOPS for line in lines) / len(lines),
        sum(x[:1].isupper() for x in words) / w,
        sum(x.isupper() and len(x) > 1 for x in words) / w,
        sum(not (c := x[-1:]).isalnum() and c < b"\x80" and c not in b".,;:?!\"')" for x in words) / w,
        counts[0x21] / w,
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """Replace the text of each row by its statistics, as ``features``."""

    def compute(texts):
        compress = zstandard.ZstdCompressor(level=1).compress
        return [[statistics(t, compress) for t in texts]]

    return append_columns(docs, ["text"], "features array<double>", compute).drop("text")


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def map(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.mean) / self.spread, -6, 6)
        z = np.sqrt(2 / self.waves.shape[1]) * np.cos(x @ self.waves + self.phases)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def raw(self, features: np.ndarray) -> np.ndarray:
        return self.map(features) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(features), self.knots, self.values), 0.0, 1.0)


def isotonic(scores: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-decreasing means by pooling adjacent violators; ``scores`` ascend."""
    blocks: list[list[float]] = []
    for total, count in zip(sums.tolist(), counts.tolist()):
        blocks.append([total, count, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.repeat([b[0] / b[1] for b in blocks], [b[2] for b in blocks])


def _partition_sums(rows: DataFrame, width: int, products) -> np.ndarray:
    """Sum over all rows of the matrix that ``products(features, y)`` gives for a batch.

    Each task adds up its own rows and sends one matrix; the matrices are added row by row in a
    shuffle, and the sum, of the model's size, comes to the driver.
    """
    dims = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = products(to_matrix(batch.column(0), dims), batch.column(1).to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield from keyed_sums(np.arange(len(total)), total)

    found = sum_by_key(rows.select("features", "y").mapInArrow(run, SUMS), width).toArrow()
    out = np.zeros((found.num_rows, width))
    if found.num_rows:
        out[found.column("key").to_numpy()] = from_bytes(found.column("vec"), width)
    return out


def fit_quality(
    features: DataFrame, features_count: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE, seed: int = SEED, bins: int = BINS
) -> QualityModel:
    """Fit rows of ``features``, ``y`` (0 to 1) and ``fold`` (true: calibration).

    Without rows every score is 0.5; without calibration rows raw scores are cut to 0..1.
    """
    dims = len(NAMES)
    rng = np.random.default_rng(seed)
    waves = rng.normal(size=(dims, features_count)) / (width * np.sqrt(dims))
    phases = rng.uniform(0, 2 * np.pi, features_count)
    model = QualityModel(np.zeros(dims), np.ones(dims), waves, phases, np.zeros(features_count + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    fit = features.filter(~F.col("fold"))
    moments = _partition_sums(fit, dims, lambda x, y: np.stack([np.full(dims, len(x)), x.sum(0), (x * x).sum(0)]))
    if not len(moments):
        return model
    n = moments[0, 0]
    model.mean = moments[1] / n
    model.spread = np.sqrt(np.maximum(moments[2] / n - model.mean**2, 0))
    model.spread[model.spread < 1e-9] = 1.0

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.map(x)
        return np.concatenate([z.T @ z, (z.T @ y)[None, :]])

    sums = _partition_sums(fit, features_count + 1, equations)
    gram = sums[:-1] + ridge * n * np.diag([*np.ones(features_count), 0.0])
    weights = np.linalg.lstsq(gram, sums[-1], rcond=None)[0]
    model.weights = weights
    model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])

    def counted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        cell = np.clip(((model.raw(x) + 0.5) * bins / 2).astype(np.int64), 0, bins - 1)
        return np.stack([np.bincount(cell, y, bins), np.bincount(cell, None, bins)])

    table_ = _partition_sums(features.filter("fold"), bins, counted)
    if len(table_):
        held = np.flatnonzero(table_[1])
        centres = (held + 0.5) * 2 / bins - 0.5
        values = isotonic(centres, table_[0][held], table_[1][held])
        # A little of the raw score keeps texts of one step in order.
        model.knots = np.concatenate([[-1.0], centres, [2.0]])
        model.values = np.concatenate([[values[0]], values, [values[-1]]])
        model.values = np.clip(0.999 * model.values + 0.001 * np.clip((model.knots + 1) / 3, 0, 1), 0, 1)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """Append ``held_out``, ``score`` and ``predicted`` to every row of ``docs``; its text is dropped.

    Labels count only for rows whose crc32 of the id as text does not leave ``held_fold`` modulo
    ``folds``. Null labels and ids are ignored, several labels of one id are averaged, and each
    row of a repeated id is a training row. Texts that are null, empty or without words have zero
    statistics and are scored like others. Without labels every score is 0.5. Texts are read
    whole; an empty table stays empty. Other columns are carried along, and columns named like a
    result are replaced by it. Statistics see the text only, no other column.
    """
    added = ["held_out", "score", "predicted"]
    keep = [c for c in without(docs, [*added, "features", "text"])]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], docs["doc_id"].alias("__id"), docs["text"].alias("text"))
    features = stage(with_statistics(rows), "quality-features")
    mark = F.crc32(F.encode(F.col("__id").cast("string"), "UTF-8"))
    held = F.coalesce(F.pmod(mark, F.lit(folds)) == held_fold, F.lit(False))
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("__label"))
    known = known.agg(F.avg(F.col("quality").cast("double")).alias("y"))
    training = features.filter(~held).join(known, F.col("__id") == F.col("__label")).select(
        "features", "y", (F.pmod(F.floor(mark / folds), F.lit(5)) == 0).alias("fold")
    )
    model = fit_quality(stage(training, "quality-training"))
    schema = T.StructType([*features.schema.fields[: len(keep)], T.StructField("__id", features.schema["__id"].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(keep)
        for batch in batches:
            if batch.num_rows:
                score = model.score(to_matrix(batch.column(n + 1), len(NAMES)))
                yield pa.RecordBatch.from_arrays([*batch.columns[: n + 1], pa.array(score)], [*batch.schema.names[: n + 1], "score"])

    scored = features.mapInArrow(run, schema)
    return scored.select(
        *[F.col(f"`{c}`") for c in keep], held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op3_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels"))


QUERIES = {"op3_fourier_quality": op3_fourier_quality}
ORACLES: dict[str, str] = {}

"""Dense vectors between Arrow and numpy, and sums of vectors across partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType


def to_matrix(vectors: pa.Array | pa.ChunkedArray, dims: int, dtype=np.float64) -> np.ndarray:
    """Rows of a list column, all of length ``dims`` and none null, as a matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    # A null or short row would move all rows after it.
    if vectors.null_count or pc.any(pc.not_equal(pc.list_value_length(vectors), dims)).as_py():
        raise ValueError(f"vectors must have {dims} numbers each")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype, copy=False).reshape(-1, dims)


def with_vector(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows that have a vector; those without one, like a document without text, take no part."""
    return df.filter(F.col(column).isNotNull())


def to_lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    rows, dims = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * dims
    values = pa.array(np.ascontiguousarray(matrix).reshape(-1))
    return pa.ListArray.from_arrays(offsets, values)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """L2-normalise; zero rows stay zero."""
    norm = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norm == 0.0, 1.0, norm)


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two columns of one row, accumulated in double."""
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda acc, x: acc + x)


def to_bytes(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as a binary column, which Spark moves as it is."""
    data = np.ascontiguousarray(matrix)
    offsets = np.arange(len(data) + 1, dtype=np.int32) * (data.itemsize * data.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def from_bytes(column: pa.Array | pa.ChunkedArray, dims: int, dtype=np.float64) -> np.ndarray:
    """Inverse of ``to_bytes``."""
    if isinstance(column, pa.ChunkedArray):
        chunks = [from_bytes(c, dims, dtype) for c in column.chunks]
        return np.concatenate(chunks) if chunks else np.zeros((0, dims), dtype)
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    first = int(np.frombuffer(offsets, width)[column.offset]) if len(column) else 0
    return np.frombuffer(data, dtype, len(column) * dims, first).reshape(-1, dims)


def label_cells(rows: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """``(label, pos, n, s, q)``: count, sum and sum of squares of each label's vectors by dimension.

    Vectors are added up for a batch of rows at a time, so what is shuffled is a row per label and
    dimension of a batch, not one per number of every vector.
    """
    rows = with_vector(rows, vector).select(label, vector)
    numbers = [StructField("pos", IntegerType()), StructField("n", LongType()), StructField("s", DoubleType()), StructField("q", DoubleType())]
    out = StructType([rows.schema[label], *numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            x = to_matrix(batch.column(1), len(batch.column(1)[0]))
            codes = coded.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            x, codes = x[order], codes[order]
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            sums, squares = np.add.reduceat(x, first, axis=0), np.add.reduceat(x * x, first, axis=0)
            dims, sizes = x.shape[1], np.diff(np.append(first, len(x)))
            names = coded.dictionary.take(pa.array(np.repeat(codes[first], dims)))
            columns = [np.tile(np.arange(dims, dtype=np.int32), len(first)), np.repeat(sizes, dims), sums.ravel(), squares.ravel()]
            yield pa.RecordBatch.from_arrays([names, *map(pa.array, columns)], out.names)

    cells = rows.mapInArrow(run, out).groupBy(label, "pos")
    return cells.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))


SUMS = "key int, vec binary"

# A fit takes up to hundreds of passes, each of which may send the driver so much.
MAX_DIRECT_BYTES = 256 << 10
# Larger partial sums are added by as many tasks as they have this many bytes.
BYTES_PER_TASK = 16 << 20


def keyed_sums(keys: np.ndarray, matrix: np.ndarray, dtype=np.float64) -> Iterator[pa.RecordBatch]:
    """``SUMS`` rows in batches of moderate size."""
    for at in range(0, len(keys), 4096):
        part = slice(at, at + 4096)
        vectors = to_bytes(matrix[part].astype(dtype, copy=False))
        yield pa.RecordBatch.from_arrays([pa.array(keys[part], pa.int32()), vectors], ["key", "vec"])


def sum_by_key(partials: DataFrame, dims: int, dtype=np.float64, tasks: int | None = None) -> DataFrame:
    """Add up ``SUMS`` rows per key, in double; ``dtype`` is what travels.

    One shuffle; each task adds the vectors of its keys as they stream in, so its
    memory is that of its keys however many partial rows a key has.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[int, int] = {}
        sums = np.zeros((0, dims))
        for batch in batches:
            keys = batch.column(0).to_numpy()
            if not len(keys):
                continue
            distinct, which = np.unique(keys, return_inverse=True)
            for key in distinct.tolist():
                place.setdefault(key, len(place))
            if len(place) > len(sums):
                sums = np.concatenate([sums, np.zeros((max(len(sums), len(place)), dims))])
            slots = np.array([place[key] for key in distinct.tolist()])
            vectors = from_bytes(batch.column(1), dims, dtype)
            if len(distinct) == len(keys):
                sums[slots[which]] += vectors
            else:
                np.add.at(sums, slots[which], vectors)
        if place:
            yield from keyed_sums(np.array(list(place)), sums[: len(place)], dtype)

    dealt = partials.repartition("key") if tasks is None else partials.repartition(tasks, "key")
    return dealt.mapInArrow(add, SUMS)


def collect_sums(partials: DataFrame, n_keys: int, dims: int, dtype=np.float64) -> np.ndarray:
    """Summed vectors as an ``n_keys`` by ``dims`` matrix; absent keys are zero.

    Partial sums that fit ``MAX_DIRECT_BYTES`` all together are added on the driver;
    larger ones are added in a shuffle first.
    """
    size = partials.rdd.getNumPartitions() * n_keys * dims * np.dtype(dtype).itemsize
    summed = size > MAX_DIRECT_BYTES
    if summed:
        partials = sum_by_key(partials, dims, dtype, -(-size // BYTES_PER_TASK))
    table = partials.toArrow()
    out = np.zeros((n_keys, dims))
    if summed and table.num_rows:
        # Each key comes once.
        out[table.column(0).to_numpy()] = from_bytes(table.column(1), dims, dtype)
    elif table.num_rows:
        np.add.at(out, table.column(0).to_numpy(), from_bytes(table.column(1), dims, dtype))
    return out

"""Vector codes by active-entry Lloyd iterations over integer parts.

A vector's components become integers, floor(256 x), and are cut into equal consecutive parts. Each
part position has a codebook of its own; a vector's code is the index of the nearest entry for each
of its parts. A round assigns all parts, adds up the members of each entry and moves the entries to
their members' floored means.

Each part's entry and exact squared distance travel with its row from round to round. Where the
assigned entry did not move, the distances to all entries that did not move are what they were, and
none was nearer: such parts are compared with the moved entries only, against the stored distance.
Parts whose own entry moved are compared with all entries. Equal distances go to the lower index in
both ways, so the result is that of comparing everything.

Rows are never shuffled: a round is one pass that reads rows with their state, and one sum over
(part, entry). Only codebooks, of a size given by the settings, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textorbit.llm.common import table, without
from textorbit.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Labels with more than 1/HOT of all rows, at most HOT of them, are joined by broadcast.
HOT = 10_000
# Rows of a step: (rows x parts x entries) distances are in memory at a time.
STEP_ROWS = 2048
# Integers up to this size are exact in doubles, also their distances.
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE x), as doubles where they hold it exactly, else as Python integers."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if not len(scaled) or np.abs(scaled).max() < 1 << 20:
        return scaled
    # The factor is a power of two, so the product is exact unless it overflows.
    return np.array([int(x) if np.isfinite(x) else int(v) * SCALE for x, v in zip(scaled.tolist(), values.tolist())], dtype=object)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A column of vectors as (rows, parts, components of a part)."""
    if column.null_count or (len(column) and pc.min_max(pc.list_value_length(column)).as_py() != {"min": dims, "max": dims}):
        raise ValueError(f"vectors must all have {dims} components")
    return _whole(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``x`` to each of ``entries``, exact."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if x.shape[1] * (2 * int(most)) ** 2 >= _EXACT:
        x, entries = x.astype(object), entries.astype(object)
        return ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    x, entries = x.astype(np.float64), entries.astype(np.float64)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lowest of equals, and the squared distance."""
    found = _distances(x, entries)
    at = found.argmin(axis=1)
    return at, found[np.arange(len(x)), at]


def reassign(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entries after the ``moved`` ones changed, from the assignment before; also the comparisons made."""
    at, distance = at.copy(), distance.copy()
    again = moved[at]
    if again.any():
        at[again], distance[again] = nearest(x[again], entries)
    active = np.flatnonzero(moved)
    fixed = ~again
    if len(active) and fixed.any():
        where, found = nearest(x[fixed], entries[active])
        index = active[where]
        better = (found < distance[fixed]) | ((found == distance[fixed]) & (index < at[fixed]))
        rows = np.flatnonzero(fixed)[better]
        at[rows], distance[rows] = index[better], found[better]
    return at, distance, int(again.sum()) * len(entries) + int(fixed.sum()) * len(active)


def _pack(distances: np.ndarray) -> list[bytes]:
    """One binary per row: distances in four or eight bytes each."""
    if distances.dtype == object and len(distances) and distances.max() > _LONG:
        raise OverflowError("a squared distance exceeds a long")
    wide = len(distances) and distances.max() >= 1 << 31
    return [row.tobytes() for row in distances.astype(np.int64 if wide else np.int32)]


def _unpack(column: pa.Array, parts: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.empty((len(rows), parts), np.int64)
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(row, np.int32 if len(row) == 4 * parts else np.int64)
    return out


def usable(vector: Column) -> Column:
    """Whether a vector is there, has components, and all of them are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def first_entries(rows: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the least ids, ascending, as integers: (entries, dims). Each task sends its least ids only.

    Null ids are no seeds. Of several vectors of one id the least is taken.
    """
    kind = T.StructType([rows.schema["__id"]])

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            ids = pc.drop_null(batch.column(0))
            ids = pc.unique(ids if kept is None else pa.concat_arrays([kept, ids]))
            kept = ids.take(pc.array_sort_indices(ids)[:entries])
        if kept is not None:
            yield pa.RecordBatch.from_arrays([kept], ["__id"])

    ids = rows.select("__id").mapInArrow(least, kind).distinct().orderBy("__id").limit(entries)
    ids = [r[0] for r in ids.collect()]
    found = rows.filter(F.col("__id").isin(ids)).groupBy("__id").agg(F.min("__vector").alias("v")).orderBy("__id").collect()
    if not found:
        return np.zeros((0, 0))
    if len({len(r.v) for r in found}) > 1:
        raise ValueError("vectors must all have the same number of components")
    return _whole(np.array([r.v for r in found], np.float64).reshape(-1)).reshape(len(found), -1)


def _step(dims: int, book: np.ndarray, moved: np.ndarray | None, n_state: int):
    """Rows to rows with their new code and distances; ``moved`` is None in the first round."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                piece = batch.slice(start, STEP_ROWS)
                x = _matrix(piece.column(n_state), dims).reshape(piece.num_rows, parts, width)
                codes = np.empty((piece.num_rows, parts), np.int64)
                distances: list[np.ndarray] = []
                if moved is not None:
                    wide = np.uint8 if entries <= 256 else np.uint16
                    old = np.frombuffer(b"".join(piece.column(n_state + 1).to_pylist()), wide).reshape(-1, parts).astype(np.int64)
                    stored = _unpack(piece.column(n_state + 2), parts)
                for p in range(parts):
                    if moved is None:
                        codes[:, p], found = nearest(x[:, p], book[p])
                    else:
                        before = stored[:, p].astype(object if x.dtype == object or book.dtype == object else np.int64)
                        codes[:, p], found, _ = reassign(x[:, p], book[p], moved[p], old[:, p], before)
                    distances.append(found)
                packed = codes.astype(np.uint8 if entries <= 256 else np.uint16)
                state = [pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(_pack(np.stack(distances, axis=1)), pa.binary())]
                columns = [*piece.columns[: n_state + 1], *state]
                yield pa.RecordBatch.from_arrays(columns, [*piece.schema.names[: n_state + 1], "__code", "__distances"])

    return run


def _sums(rows: DataFrame, book: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Members' component sums (parts, entries, width) and counts; each task sends one partial a used entry."""
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                piece = batch.slice(start, STEP_ROWS)
                x = _matrix(piece.column(0), dims).reshape(piece.num_rows, parts, width)
                wide = np.uint8 if entries <= 256 else np.uint16
                codes = np.frombuffer(b"".join(piece.column(1).to_pylist()), wide).reshape(-1, parts).astype(np.int64)
                for p in range(parts):
                    sums = np.zeros((entries, width + 1), x.dtype)
                    np.add.at(sums, codes[:, p], np.concatenate([x[:, p], np.ones((len(x), 1), x.dtype)], axis=1))
                    used = np.flatnonzero(sums[:, -1])
                    for e in used.tolist():
                        for i, value in enumerate(sums[e].tolist()):
                            key = (p * entries + e) * (width + 1) + i
                            total[key] = total.get(key, 0) + int(value)
        if total:
            from decimal import Decimal

            yield pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.int64()), pa.array([Decimal(v) for v in total.values()], pa.decimal128(38, 0))], ["key", "value"]
            )

    found = rows.select("__vector", "__code").mapInArrow(run, "key long, value decimal(38,0)").groupBy("key").agg(F.sum("value").alias("value"))
    out = np.zeros(parts * entries * (width + 1), dtype=object)
    for r in found.collect():
        out[r.key] = int(r.value)
    out = out.reshape(parts, entries, width + 1)
    return out[:, :, :-1], out[:, :, -1]


def moved_book(book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entries at their members' floored means; those without members stay."""
    out = book.astype(object)
    used = counts > 0
    out[used] = sums[used] // counts[used][:, None]
    small = not out.size or np.abs(out).max() < 1 << 20
    return out.astype(np.float64) if small else out


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all components in order of part, entry and position, as decimal integers with commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in book.reshape(-1).tolist()).encode()).hexdigest()


class Codes:
    """Codes of a table of vectors: ``rows`` (input columns, __code, __distances) and the final ``book``."""

    def __init__(self, rows: DataFrame, book: np.ndarray | None):
        self.rows, self.book = rows, book


def fit_codes(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codes:
    """Usable rows of ``vectors`` with their codes after so many rounds, and the codebooks.

    Rows whose vector is null, empty, or has a null or non-finite component are dropped. All others
    must have the same number of components, a multiple of ``parts``, else the job fails. With fewer
    different ids than ``entries`` the codebooks are smaller. A repeated row is one more member.
    Sums are exact up to 38 digits; a squared distance over a long is an error. An empty table has no book.
    """
    keep = without(vectors, [vector])
    rows = vectors.select(*[F.col(f"`{c}`").alias(f"__keep_{i}") for i, c in enumerate(keep)], vectors[vec_id].alias("__id"), vectors[vector].alias("__vector"))
    rows = rows.filter(usable(F.col("__vector"))).withColumn("__vector", F.col("__vector").cast("array<double>") if _exact(rows) else F.col("__vector"))
    seeds = first_entries(rows, entries)
    names = rows.columns[:-1]
    state = T.StructType([*rows.schema.fields, T.StructField("__code", T.BinaryType()), T.StructField("__distances", T.BinaryType())])
    if not len(seeds):
        if not rows.isEmpty():
            raise ValueError("vectors without any id cannot seed codebooks")
        empty = rows.withColumns({"__code": F.lit(b""), "__distances": F.lit(b"")})
        return Codes(_named(empty, keep), None)
    dims = seeds.shape[1]
    if dims % parts:
        raise ValueError(f"{dims} components do not make {parts} equal parts")
    book = np.ascontiguousarray(seeds.reshape(len(seeds), parts, dims // parts).transpose(1, 0, 2))
    moved = None
    for number in range(rounds + 1):
        rows = stage(rows.select(*state.names[: len(names) + 1 if moved is None else None]).mapInArrow(_step(dims, book, moved, len(names)), state), f"codes-{number}")
        if number < rounds:
            after = moved_book(book, *_sums(rows, book, dims))
            moved, book = (after != book).any(axis=2), after
    return Codes(_named(rows, keep), book)


def _exact(rows: DataFrame) -> bool:
    """Vectors of integers or decimals are read as doubles."""
    return not isinstance(rows.schema["__vector"].dataType.elementType, T.FloatType | T.DoubleType)


def _named(rows: DataFrame, keep: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)], "__code", "__distances")


def _errors(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = [sum(row) for row in _unpack(batch.column(batch.num_columns - 1), parts).tolist()]
            columns = [*batch.columns[:-1], pa.array(total, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "error"])

    return run


def with_label_sums(rows: DataFrame, label: str, hot: int = HOT) -> DataFrame:
    """Append ``label_error``: ``error`` added up over equal labels, nulls together.

    Labels over 1/``hot`` of all rows, of which there are fewer than ``hot``, meet their rows by
    broadcast; the others, small groups, by a shuffle.
    """
    sums = rows.groupBy(F.col(label).alias("__label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"), F.count("*").alias("__n"))
    sums = stage(sums, "label-sums")
    total = sums.agg(F.sum("__n")).first()[0] or 0
    frequent = sums.filter(F.col("__n") * hot > total).drop("__n")
    rare = sums.filter(F.col("__n") * hot <= total).drop("__n")
    names = [*rows.columns, "label_error"]
    joined = rows.join(F.broadcast(frequent.withColumn("__found", F.lit(True))), F.col(label).eqNullSafe(F.col("__label")), "left")
    out = joined.filter("__found").select(*names)
    if rare.isEmpty():
        return out
    rest = joined.filter("__found IS NULL").select(*rows.columns)
    return out.unionByName(rest.join(rare.hint("merge"), F.col(label).eqNullSafe(F.col("__label"))).select(*names))


def encode_vectors(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """Usable rows without their vector, with ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    ``code`` has two hex digits a part (four with over 256 entries); ``error`` adds the final squared
    distances. Other columns are carried along, and columns named like a result are replaced by it.
    Which rows are usable, and odd tables, are described at ``fit_codes``.
    """
    results = ["code", "error", "label_error", "codebooks_sha256"]
    source = vectors.select(*[F.col(f"`{c}`") for c in without(vectors, results)])
    fitted = fit_codes(source, vector, vec_id, parts, entries, rounds)
    rows = fitted.rows.withColumn("code", F.lower(F.hex("__code"))).drop("__code")
    order = [*[c for c in rows.columns if c != "__distances"], "__distances"]
    schema = T.StructType([*[rows.schema[c] for c in order[:-1]], T.StructField("error", T.LongType())])
    rows = stage(rows.select(*order).mapInArrow(_errors(parts), schema), "code-errors")
    digest = book_digest(fitted.book) if fitted.book is not None else hashlib.sha256(b"").hexdigest()
    return with_label_sums(rows, label).withColumn("codebooks_sha256", F.lit(digest))


def op13_active_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")).drop("label")


def _oracle(rounds: int = ROUNDS) -> str:
    """Every round compares every part with every entry."""
    out = [
        f"""WITH kept AS (
  SELECT vec_id, label, embedding AS v, len(embedding) // {PARTS} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, label, p, list_transform(v[p * w + 1 : (p + 1) * w], lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM kept, range({PARTS}) t(p)),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}))"""
    ]
    for r in range(rounds + 1):
        out.append(
            f"""near{r} AS (
  SELECT vec_id, label, p, v, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT x.vec_id, x.label, x.p, x.v, b.e,
      list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts x JOIN book{r} b ON x.p = b.p) GROUP BY ALL)"""
        )
        if r < rounds:
            out.append(
                f"""sum{r} AS (
  SELECT p, e, list(m ORDER BY i) AS v FROM (
    SELECT p, e, i, floor(sum(x) / count(*)) AS m FROM (
      SELECT p, best.e AS e, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{r}) GROUP BY p, e, i) GROUP BY p, e),
book{r + 1} AS (SELECT b.p, b.e, coalesce(s.v, b.v) AS v FROM book{r} b LEFT JOIN sum{r} s ON b.p = s.p AND b.e = s.e)"""
            )
    out.append(
        f"""digest AS (
  SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM book{rounds})),
codes AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM near{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM codes, digest"""
    )
    return ",\n".join(out[:-1]) + ",\n" + out[-1]


QUERIES = {"op13_active_lloyd": op13_active_lloyd}
ORACLES = {"op13_active_lloyd": _oracle()}

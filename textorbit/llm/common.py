"""What the operators share: reading tables, row-local Arrow steps, words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows are handed to Python functions in slices of about this many bytes.
SLICE_BYTES = 8 << 20
# Arrow batches of texts, where their size is set: a worker holds two, and so does its task's side in the JVM.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` that are not in ``names``, regardless of case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch into parts of about ``SLICE_BYTES``, one row at least."""
    rows = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def append_columns(
    df: DataFrame, inputs: list[str], schema: str, compute: Callable[..., list[list]]
) -> DataFrame:
    """Append columns computed from ``inputs`` of each row; nothing is shuffled.

    ``compute`` gets one Python list per input and returns one list per field of ``schema``.
    Other columns travel along; those that are named like a result give way to it.
    """
    added = T.StructType.fromDDL(schema)
    keep = without(df, added.names)
    source = df.select(*[F.col(f"`{c}`") for c in keep], *[df[c].alias(f"__in_{i}") for i, c in enumerate(inputs)])
    fields = [f for f in source.schema.fields if not f.name.startswith("__in_")]
    out = T.StructType([*fields, *added.fields])
    n_kept, n_in = len(keep), len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(added)
        for batch in batches:
            for part in slices(batch):
                columns = compute(*[part.column(n_kept + i).to_pylist() for i in range(n_in)])
                arrays = [pa.array(c, f.type) for c, f in zip(columns, target)]
                names = [*part.schema.names[:n_kept], *target.names]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], *arrays], names)

    return source.mapInArrow(run, out)


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    found = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    return found.cast("long")


def text_key(text: Column) -> Column:
    """128 bits that name a text: equal texts, and only those, have equal keys."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def input_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes of a text column, counted over all rows."""
    return int(df.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0)

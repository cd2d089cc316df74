"""Where intermediate tables go and how long they stay, and how input is spread over the cluster."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

# Paths staged by this process: those of each open scope, innermost last, and all others by session.
_scopes: list[list[str]] = []
_kept: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors see: the one in ``spark.checkpoint.dir``, else the context's
    checkpoint folder, else one in the warehouse."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/textorbit-staged"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/textorbit/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a checkpoint and outlives lost executors, but keeps the
    table columnar, so each later step reads only the columns it needs. The table belongs to the
    innermost open ``staging`` scope, else to the session.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    else:
        _kept.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def unstage(*frames: DataFrame) -> None:
    """Remove staged tables that nothing reads any more; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path is None:
            continue
        _remove(df.sparkSession, path)
        for owned in (*_scopes, *_kept.values()):
            if path in owned:
                owned.remove(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A scope whose staged tables are removed at its end: results must be written or counted inside."""
    owned: list[str] = []
    _scopes.append(owned)
    try:
        yield
    finally:
        _scopes.remove(owned)
        for path in owned:
            _remove(spark, path)


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """A scope whose jobs hand Arrow batches of about ``most`` bytes to Python; results must be staged inside."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def staged_paths(spark: SparkSession) -> list[str]:
    """Staged tables of the session that are still there, those of open scopes included."""
    return [*_kept.get(spark.sparkContext.applicationId, []), *(p for owned in _scopes for p in owned)]


def clean(spark: SparkSession) -> None:
    """Remove all staged tables of the session; frames that read them fail from then on."""
    for path in _kept.pop(spark.sparkContext.applicationId, []):
        _remove(spark, path)


@atexit.register
def _clean_at_exit() -> None:
    context = SparkContext._active_spark_context
    if context is not None and context.applicationId in _kept:
        clean(SparkSession.builder.getOrCreate())


def spread(df: DataFrame) -> DataFrame:
    """Repartition an input whose file layout keeps fewer tasks busy than there are cores.

    Files of one row group each decode in one task. Inputs with several splits per core
    are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df

"""Compare registered queries with their SQL: ``python tests/check_oracles.py SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def spark_session(app: str = "textorbit-tests") -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        # One machine: its own folder is seen by all tasks.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="textorbit-tests-"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def _key(row: tuple) -> tuple:
    return tuple((v is None, f"{v:.3f}" if isinstance(v, float) else str(v)) for v in row)


def differences(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Readable differences between a DataFrame and a SQL result, as sorted rows."""
    want = db.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} != {sorted(names)}"]
    order = [names.index(c) for c in sorted(names)]
    expected = sorted((tuple(row[i] for i in order) for row in want.fetchall()), key=_key)
    table = result.select(*sorted(names)).toArrow()
    columns = [column.to_pylist() for column in table.columns]
    got = sorted(zip(*columns), key=_key)
    if len(got) != len(expected):
        return [f"{len(got)} rows != {len(expected)}"]
    out = []
    for a, b in zip(got, expected):
        for name, x, y in zip(sorted(names), a, b):
            # Floats are rounded by both sides, so they are equal to the last bit.
            if x != y or (isinstance(x, float) != isinstance(y, float)):
                out.append(f"{name}: {x!r} != {y!r} in {a} / {b}"[:400])
    return out


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry

    spark, db, bad = spark_session(), database(sf_dir), 0
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in sqls:
                found = differences(frame, db, sqls[name])
                state = "ok" if not found else f"{len(found)} differences, e.g. {found[0]}"
            else:
                state = f"{frame.count()} rows, no SQL"
                found = []
        except Exception as error:  # report and go on with the next query
            found, state = [str(error)], f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        bad += bool(found)
        print(f"{name:24s} {time.time() - start:7.2f}s  {state}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

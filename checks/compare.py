"""Run queries and their SQL side by side: ``python -m checks.compare FOLDER [NAME ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if schema and values agree, else a description."""
    mine_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    result = con.execute(sql)
    other_types = {d[0]: str(d[1]) for d in result.description}
    theirs = _sorted_rows(result.fetchall(), list(other_types))
    if sorted(mine_types.items()) != sorted(other_types.items()):
        return f"schema {sorted(mine_types.items())} != {sorted(other_types.items())}"
    mine = _sorted_rows([tuple(r) for r in df.collect()], df.columns)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows"
    for a, b in zip(mine, theirs, strict=True):
        if repr(a) != repr(b):
            return f"{repr(a)[:600]} != {repr(b)[:600]}"
    return None


def main(folder: str, names: list[str]) -> int:
    from checks.queries import ORACLES, QUERIES
    from tidepost.session import build_session

    spark = build_session(
        "checks",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in ORACLES:
                problem = difference(df, con, ORACLES[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{name:32} {kind:5} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

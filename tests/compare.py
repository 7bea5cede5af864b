"""Run a registered query and its oracle and compare them as multisets of rows."""

import sys
from collections import Counter

import duckdb

from workload.oracles import ORACLES
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def differences(spark, connection, sf_dir: str, name: str) -> list[str]:
    """What differs, in words; empty if query and oracle agree."""
    frame = QUERIES[name](spark, sf_dir)
    oracle = connection.sql(ORACLES[name])
    columns = sorted(frame.columns)
    if columns != sorted(oracle.columns):
        return [f"columns {columns} / {sorted(oracle.columns)}"]
    problems = []
    ours = {n: KINDS.get(t, t) for n, t in frame.dtypes}
    theirs = {n: str(t) for n, t in zip(oracle.columns, oracle.types, strict=True)}
    problems += [f"type of {n}: {ours[n]} / {theirs[n]}" for n in columns if ours[n] != theirs[n]]
    quoted = ", ".join(f'"{n}"' for n in columns)
    got = Counter(tuple(r) for r in frame.select(*[f"`{n}`" for n in columns]).collect())
    want = Counter(oracle.project(quoted).fetchall())
    if not got:
        problems.append("no rows")
    if got != want:
        extra, missing = got - want, want - got
        problems.append(
            f"{sum(got.values())} / {sum(want.values())} rows, {sum(extra.values())} extra such as"
            f" {list(extra)[:2]}, {sum(missing.values())} missing such as {list(missing)[:2]} of {columns}"
        )
    return problems


if __name__ == "__main__":
    import time

    from tests.conftest import make_session

    session = make_session()
    sf_dir = sys.argv[1]
    duck = connect(sf_dir)
    names = sys.argv[2:] or list(QUERIES)
    for name in names:
        start = time.time()
        try:
            found = differences(session, duck, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{name:24} {time.time() - start:6.2f}s {'ok' if not found else found}", flush=True)

"""Compare a Spark result with a DuckDB result, order-insensitively."""

import glob
import os

import duckdb

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df, con, sql):
    """Messages about names, types, row counts and values that differ."""
    columns = sorted(df.columns)
    kinds = {d[0]: d[1] for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(kinds) != columns:
        return [f"columns {columns} against {sorted(kinds)}"]
    found = []
    for name, kind in df.dtypes:
        theirs = kinds[name].lower() if kinds[name].startswith("DECIMAL") else KINDS.get(kinds[name], kinds[name])
        if kind != theirs:
            found.append(f"{name}: {kind} against {theirs}")
    ours = [tuple(row[c] for c in columns) for row in df.collect()]
    names = ", ".join(f'"{c}"' for c in columns)
    theirs = con.execute(f"SELECT {names} FROM ({sql})").fetchall()
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    left, right = sorted(map(repr, ours)), sorted(map(repr, theirs))
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b]
        found.append(f"{len(pairs)} rows differ, first: {pairs[:1]}")
    return found

"""Compare registered queries with their SQL, as multisets of rows."""

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
         "date": "DATE", "boolean": "BOOLEAN"}


def plain(value):
    """Floats as text: both engines must give the same digits."""
    return repr(value) if isinstance(value, float) else value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(query, sql: str, spark, con, sf_dir: str) -> str | None:
    """None when both give the same rows, else a description."""
    table = query(spark, sf_dir)
    types = {name: TYPES[t] for name, t in table.dtypes}
    expected = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    if types != expected:
        return f"columns {types} against {expected}"
    ours = rows_of(table.columns, table.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (f"{ours.total()} against {theirs.total()} rows; extra {extra.total()}:"
                f" {list(extra)[:2]}; missing {missing.total()}: {list(missing)[:2]}")
    if not ours:
        return "no rows"
    return None

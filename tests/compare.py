"""Runs a registered query and its SQL on the same tables and compares the rows."""

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def mismatch(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when both give the same columns, types and rows; else a short description."""
    got_table = query(spark, sf_dir).toArrow()
    want_table = con.sql(sql).to_arrow_table()
    names = sorted(got_table.column_names)
    if names != sorted(want_table.column_names):
        return f"columns {names} != {sorted(want_table.column_names)}"
    kinds = {n: (str(got_table.schema.field(n).type), str(want_table.schema.field(n).type)) for n in names}
    differing = {n: k for n, k in kinds.items() if k[0].removeprefix("large_") != k[1].removeprefix("large_")}
    if differing:
        return f"types {differing}"
    got = _rows(got_table, names)
    want = _rows(want_table, names)
    if got != want:
        odd = [(a, b) for a, b in zip(got, want) if a != b][:2]
        return f"{len(got)} rows vs {len(want)}, first differences {odd}"
    return None


def _rows(table, names):
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=lambda r: tuple((v is None, str(v)) for v in r))

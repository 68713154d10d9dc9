"""Spark query vs DuckDB oracle, per key: rows, columns and values.

Usage: python tests/gate.py [sf_dir] [key ...]
Compares like the driver does: columns sorted by name, rows as a multiset;
also the column types (Spark type -> DuckDB type name).
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT",
                 "boolean": "BOOLEAN", "double": "DOUBLE"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return v.item()
    return v


def rows_of(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, key: str, query, sql: str | None, con) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out.update(duck_rows=len(d_rows), duck_sec=round(time.time() - t1, 2))
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    d_types = {n: str(t) for n, t in zip(d_cols, rel.types)}
    if s_types != d_types:
        out["status"] = f"TYPES {sorted(set(s_types.items()) ^ set(d_types.items()))}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        out["status"] = "match"
    else:
        sa, sb = set(a), set(b)
        out["status"] = "VALUES"
        out["only_spark"] = [r for r in a if r not in sb][:3]
        out["only_duck"] = [r for r in b if r not in sa][:3]
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from propgraph.session import get_spark
    spark = get_spark("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for key, q in qs.items():
        if only and key not in only:
            continue
        try:
            r = compare(spark, sf_dir, key, q, sqls.get(key), con)
        except Exception as e:  # report and continue
            r = {"key": key, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        ok = r["status"] in ("match", "rows-only")
        bad += not ok
        print(("ok   " if ok else "FAIL ") + str(r), flush=True)
    missing = [k for k in qs if k not in sqls]
    print(f"{len(qs)} keys, {bad} failing, no oracle: {missing}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

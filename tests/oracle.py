"""Run registered queries against their DuckDB oracle SQL (as the driver does).

Usage: python tests/oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    """Rows by column name, in an order that floats' last digits don't decide."""
    cols = sorted(pdf.columns)
    out = [tuple(_plain(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    coarse = lambda x: (x is None, f"{x:.6g}" if isinstance(x, float) else str(x))
    return sorted(out, key=lambda r: tuple(coarse(x) for x in r if not isinstance(x, float)) + tuple(coarse(x) for x in r if isinstance(x, float)))


def _same(x, y) -> bool:
    if isinstance(x, float) or isinstance(y, float):
        return x is not None and y is not None and math.isclose(x, y, rel_tol=1e-7, abs_tol=1e-9)
    return x == y


#: What DuckDB calls the types of Spark's columns.
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, key, fn, sql, sf_dir, con) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    sp = sdf.toPandas()
    t1 = time.time()
    rel = con.sql(sql)
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    dd = rel.df()
    if sorted(sp.columns) != sorted(dd.columns):
        return False, f"columns differ: spark={sorted(sp.columns)} duck={sorted(dd.columns)}"
    wrong = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in sdf.schema.fields
             if KINDS.get(f.dataType.simpleString(), kinds[f.name]) != kinds[f.name]]
    loose = {frozenset(("bigint", "HUGEINT")), frozenset(("double", "FLOAT"))}
    wrong = [x for x in wrong if frozenset(x[1:]) not in loose]
    if wrong:
        return False, f"types differ: {wrong}"
    for f in sdf.schema.fields:  # pandas makes floats of whole numbers beside nulls
        if f.dataType.simpleString() in ("bigint", "int"):
            sp[f.name], dd[f.name] = sp[f.name].astype("Int64"), dd[f.name].astype("Int64")
    if len(sp) != len(dd):
        return False, f"row count spark={len(sp)} duck={len(dd)}"
    for x, y in zip(rows_of(sp), rows_of(dd)):
        if not all(map(_same, x, y)):
            return False, f"first diff spark={x} duck={y}"
    return True, f"{len(sp)} rows {t1 - t0:.1f}s"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    import __spark_entry__ as E
    from sparkprep.session import local_session

    spark = local_session(8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or sorted(qs):
        if k not in sqls:
            t0 = time.time()
            try:
                n = qs[k](spark, sf_dir).count()
                print(f"ROWS  {k}: {n} rows {time.time() - t0:.1f}s")
            except Exception as e:  # noqa: BLE001
                bad += 1
                print(f"ERROR {k}: {type(e).__name__}: {str(e)[:300]}")
            continue
        try:
            ok, msg = compare(spark, k, qs[k], sqls[k], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK   ' if ok else 'FAIL '} {k}: {msg}")
    print(f"{bad} failing of {len(keys or qs)}")


if __name__ == "__main__":
    main()

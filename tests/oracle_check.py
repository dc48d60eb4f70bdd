"""Run every registered query against its DuckDB oracle, the way the driver's correctness gate does.

    python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query (rows, schema and an order-insensitive value hash) and exits non-zero on
any mismatch. Used by ``tests/test_oracles.py`` and by hand.
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(dtype) -> str:
    """Coarse type class of a Spark or DuckDB type name."""
    s = str(dtype).lower()
    if "int" in s:
        return "int"
    if "float" in s or "double" in s:
        return "float"
    if "bool" in s:
        return "bool"
    return "other"


def norm(v) -> str:
    """Text of one value: NULL/NaN as NULL, integral floats as ints (nullable int columns arrive as floats)."""
    if v is None:
        return "NULL"
    if isinstance(v, (bool, np.bool_)):
        return repr(bool(v))
    if isinstance(v, (int, np.integer)):
        return repr(int(v))
    if isinstance(v, (float, np.floating)):
        f = float(v)
        if f != f:
            return "NULL"
        if f.is_integer() and abs(f) < 2 ** 53:
            return repr(int(f))
        return repr(f)
    try:
        if pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    return repr(v)


def value_hash(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted("|".join(norm(v) for v in rec) for rec in df[cols].itertuples(index=False, name=None))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]


def compare(spark, sf_dir: str, names=None) -> list[tuple[str, bool, str]]:
    import __spark_entry__ as E
    qs, oracles = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = []
    for name in (names or sorted(qs)):
        t0 = time.time()
        try:
            res = qs[name](spark, sf_dir)
            skinds = {f.name: kind(f.dataType.simpleString()) for f in res.schema.fields}
            sdf = res.toPandas()
        except Exception as e:  # noqa: BLE001
            out.append((name, False, f"spark error: {type(e).__name__}: {str(e)[:300]}"))
            continue
        t1 = time.time()
        if name not in oracles:
            out.append((name, True, f"rows={len(sdf)} (no oracle) {t1 - t0:.1f}s"))
            continue
        try:
            rel = con.sql(oracles[name])
            dkinds = {c: kind(t) for c, t in zip(rel.columns, rel.types)}
            ddf = rel.df()
        except Exception as e:  # noqa: BLE001
            out.append((name, False, f"duckdb error: {type(e).__name__}: {str(e)[:300]}"))
            continue
        problems = []
        if len(sdf) != len(ddf):
            problems.append(f"rows {len(sdf)} vs {len(ddf)}")
        if sorted(sdf.columns) != sorted(ddf.columns):
            problems.append(f"columns {sorted(sdf.columns)} vs {sorted(ddf.columns)}")
        else:
            if skinds != dkinds:
                problems.append(f"kinds {skinds} vs {dkinds}")
            hs, hd = value_hash(sdf), value_hash(ddf)
            if hs != hd:
                problems.append(f"hash {hs} vs {hd}")
        ok = not problems
        out.append((name, ok, f"rows={len(sdf)} spark={t1 - t0:.1f}s " + ("; ".join(problems) if problems else "match")))
    return out


def main(argv):
    from centroidal.session import get_session
    sf_dir = argv[1] if len(argv) > 1 and os.path.isdir(argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not os.path.isdir(a)] or None
    spark = get_session("local[8]", 8)
    res = compare(spark, sf_dir, names)
    bad = 0
    for name, ok, msg in res:
        print(f"{'OK  ' if ok else 'FAIL'} {name:28s} {msg}", flush=True)
        bad += not ok
    print(f"{len(res) - bad}/{len(res)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

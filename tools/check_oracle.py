"""Run every registered query against its DuckDB oracle at one scale.

    python tools/check_oracle.py [sf_dir] [name ...]

Prints one line per query: rows on both sides and whether the values match
as multisets (columns compared by name, order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from baton.plans import oracle_sql, queries  # noqa: E402
from tests.conftest import make_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = make_session()
    con = duck(sf_dir)
    qs, orc = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = df.collect()
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:30s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        secs = time.time() - t0
        if name not in orc:
            print(f"{name:30s} spark={len(srows):7d} (no oracle) {secs:.1f}s")
            continue
        cur = con.execute(orc[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        same_cols = sorted(scols) == sorted(dcols)
        same = same_cols and canon(scols, srows) == canon(dcols, drows)
        bad += not same
        print(f"{name:30s} spark={len(srows):7d} duck={len(drows):7d} cols={'ok' if same_cols else 'DIFF'} "
              f"values={'ok' if same else 'DIFF'} {secs:.1f}s")
        if not same_cols:
            print("   spark cols", scols, "\n   duck  cols", dcols)
        elif not same:
            a, b = canon(scols, srows), canon(dcols, drows)
            for x, y in zip(a, b):
                if x != y:
                    print("   first diff:\n   spark", repr(x)[:300], "\n   duck ", repr(y)[:300])
                    break
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

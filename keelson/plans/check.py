"""Run registered queries in Spark and their oracle SQL in DuckDB and
compare row count, column names/types and an order-insensitive value hash.

    python -m keelson.plans.check /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
                 "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "FloatType": "FLOAT",
                 "ShortType": "SMALLINT", "TimestampType": "TIMESTAMP", "DateType": "DATE"}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    return repr(v)


def value_hash(names, rows) -> str:
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted("|".join(_norm(row[i]) for i in order) for row in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def close_rows(names_a, rows_a, names_b, rows_b, rel=1e-7) -> bool:
    oa = sorted(range(len(names_a)), key=lambda i: names_a[i])
    ob = sorted(range(len(names_b)), key=lambda i: names_b[i])

    def key(row, order):
        return tuple((0, round(row[i], 4)) if isinstance(row[i], float) else (1, str(row[i]))
                     for i in order)
    a = sorted(rows_a, key=lambda r: key(r, oa))
    b = sorted(rows_b, key=lambda r: key(r, ob))
    for ra, rb in zip(a, b):
        for i, j in zip(oa, ob):
            x, y = ra[i], rb[j]
            if isinstance(x, float) or isinstance(y, float):
                if x is None or y is None:
                    if x is not y:
                        return False
                    continue
                if not math.isclose(float(x), float(y), rel_tol=rel, abs_tol=1e-9):
                    return False
            elif x != y:
                return False
    return True


def duck_connection(sf_dir: str):
    import duckdb
    from keelson.plans.base import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(sf_dir: str, keys=None, spark=None, verbose=True) -> dict:
    from keelson.plans import registry
    from keelson.session import get_session
    if spark is None:
        os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 8g pyspark-shell")
        spark = get_session(os.environ.get("KEELSON_MASTER", "local[8]"), partitions=8)
    con = duck_connection(sf_dir)
    reg = registry()
    out = {}
    for key in keys or sorted(reg):
        q = reg[key]
        res = {"key": key}
        try:
            t0 = time.time()
            sdf = q.fn(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            snames = sdf.columns
            stypes = [SPARK_TO_DUCK.get(type(f.dataType).__name__, f.dataType.simpleString())
                      for f in sdf.schema.fields]
            res["spark_s"] = round(time.time() - t0, 2)
            res["rows"] = len(srows)
            if q.sql is not None:
                t0 = time.time()
                rel = con.sql(q.sql)
                drows = rel.fetchall()
                dnames = rel.columns
                dtypes = [str(t) for t in rel.types]
                res["duck_s"] = round(time.time() - t0, 2)
                res["oracle_rows"] = len(drows)
                res["names"] = sorted(snames) == sorted(dnames)
                res["types"] = sorted(zip(snames, stypes)) == sorted(zip(dnames, dtypes))
                if not res["types"]:
                    res["type_diff"] = sorted(set(zip(snames, stypes)) ^ set(zip(dnames, dtypes)))
                res["hash"] = (value_hash(snames, srows) == value_hash(dnames, drows))
                res["close"] = (len(srows) == len(drows) and res["names"]
                                and close_rows(snames, srows, dnames, drows))
                res["ok"] = res["hash"] and res["types"] and len(srows) == len(drows)
            else:
                res["ok"] = True
        except Exception as e:  # noqa: BLE001
            res["ok"] = False
            res["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        out[key] = res
        if verbose:
            print(res, flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    res = check(sf, keys)
    bad = [k for k, v in res.items() if not v["ok"]]
    print("FAILED:", bad)
    print(f"{len(res) - len(bad)}/{len(res)} ok")

"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python scripts/oracle_check.py [sf_dir] [name-substring ...]
Mimics the driver's gate: row count, column names, order-free value hash
(doubles rounded to 9 significant digits before hashing).
"""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from gridcube.plans import analogues as A  # noqa: E402
from gridcube.plans.catalog import load  # noqa: E402

QUERIES, ORACLE = load()
from gridcube.session import cleanup, get_session  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(f"{v:.9g}"))   # repr keeps the sign of zero: -0.0 != 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
            "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(sdf, cur):
    duck = {c[0]: str(c[1]) for c in cur.description}
    out = []
    for f in sdf.schema.fields:
        st = TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
        dt = duck.get(f.name)
        if dt is not None and st.upper() != dt.upper():
            out.append(f"{f.name}: spark {st} vs duckdb {dt}")
    return out


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in A.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name, fn in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            srows = df.collect()
            cleanup(spark)
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:600]}")
            traceback.print_exc(limit=3)
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(ORACLE[name])
            dcols = [c[0] for c in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:800]}")
            bad += 1
            continue
        msgs = []
        tm = type_mismatches(df, cur)
        if tm:
            print(f"TYPE {name}: " + "; ".join(tm[:6]))
        if sorted(scols) != sorted(dcols):
            msgs.append(f"cols spark-only={sorted(set(scols)-set(dcols))} duck-only={sorted(set(dcols)-set(scols))}")
        if len(srows) != len(drows):
            msgs.append(f"rows {len(srows)} vs {len(drows)}")
        if not msgs:
            a, b = rows_key(scols, srows), rows_key(dcols, drows)
            if a != b:
                sc = sorted(scols)
                diffs = 0
                for ra, rb in zip(a, b):
                    if ra != rb:
                        for i, (x, y) in enumerate(zip(ra, rb)):
                            if x != y and diffs < 6:
                                msgs.append(f"{sc[i]}: {x!r} vs {y!r}")
                                diffs += 1
                if not msgs:
                    msgs.append("value mismatch")
        if msgs:
            bad += 1
            print(f"FAIL {name} ({len(srows)} rows): " + "; ".join(msgs))
        else:
            ok += 1
            print(f"OK   {name} ({len(srows)} rows, {len(scols)} cols) {ts:.1f}s")
    print(f"ok={ok} bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()

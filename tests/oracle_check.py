"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Mirrors the driver's correctness gate: row count, column names/types and an
order-insensitive comparison of values (columns sorted by name).

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    return v


def rows_of(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    rows = [tuple(_norm(x) for x in r) for r in zip(*data)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    from ridelake.queries import REGISTRY
    from ridelake.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for name, (fn, sql) in REGISTRY.items():
        if keys and name not in keys:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            st = sdf.toArrow()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"ROWS {name}: {st.num_rows} rows ({ts:.1f}s)")
            continue
        try:
            dt = con.execute(sql).to_arrow_table()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(st)
        dc, dr = rows_of(dt)
        stypes = {f.name: str(f.type) for f in st.schema}
        dtypes = {f.name: str(f.type) for f in dt.schema}
        issues = []
        if sc != dc:
            issues.append(f"columns spark={sc} duck={dc}")
        if len(sr) != len(dr):
            issues.append(f"rows spark={len(sr)} duck={len(dr)}")
        tdiff = {c: (stypes[c], dtypes.get(c)) for c in sc if stypes.get(c) != dtypes.get(c)}
        if tdiff:
            issues.append(f"types {tdiff}")
        if sc == dc and sr != dr:
            ndiff = sum(1 for a, b in zip(sr, dr) if a != b)
            ex = next(((a, b) for a, b in zip(sr, dr) if a != b), None)
            issues.append(f"values differ in {ndiff} rows, e.g. {ex}")
        status = "OK  " if not issues else "DIFF"
        if issues:
            bad += 1
        print(f"{status} {name}: {st.num_rows} rows ({ts:.1f}s) {'; '.join(issues)[:900]}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

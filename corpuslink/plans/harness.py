"""Compare a catalogue query with its DuckDB oracle, the way the driver does:
row count, column names (sorted), and an order-insensitive hash of the values.
Usable from tests and as ``python -m corpuslink.plans.harness sf_dir [names..]``.
"""

from __future__ import annotations

import datetime
import decimal
import hashlib
import math
import sys

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    from corpuslink.plans.registry import load_all
    fn, sql = load_all()[name]
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = {"name": name, "spark_rows": len(s_rows)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    res.update(oracle_rows=len(d_rows), cols_match=sc == dc, hash_match=digest(sr) == digest(dr))
    res["status"] = "ok" if (sc == dc and len(sr) == len(dr) and res["hash_match"]) else "MISMATCH"
    if res["status"] != "ok":
        res["spark_cols"], res["oracle_cols"] = sc, dc
        ds, ss = set(dr), set(sr)
        only_s = [r for r in sr if r not in ds][:3]
        only_d = [r for r in dr if r not in ss][:3]
        res["only_spark"], res["only_oracle"] = only_s, only_d
    return res


def main(argv):
    from corpuslink.session import get_spark
    from corpuslink.plans.registry import load_all
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(load_all())
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": (type(e).__name__ + ": " + str(e))[:400]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok or rows-only")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

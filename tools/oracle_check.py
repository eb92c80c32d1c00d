"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names/types and a hash of the values, in row order where the
order is the operator's result and regardless of it elsewhere.

    python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


ORDERED = {"feedback_sorted", "unrated_topn", "extract_unrated", "rating_histogram", "unique_questions"}


def _norm(v):
    if v is None:
        return "∅"
    try:
        import numpy as np
        if isinstance(v, np.generic):
            v = v.item()
        if isinstance(v, np.ndarray):
            v = v.tolist()
    except ImportError:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v == int(v) and abs(v) < 1e15:
            return repr(int(v))
        return repr(v) if os.environ.get("ORACLE_EXACT", "1") == "1" else f"{v:.9g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(v)
    return str(v)


def digest(pdf, ordered=False):
    cols = sorted(pdf.columns)
    rows = ["\x1f".join(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    rows = rows if ordered else sorted(rows)
    return hashlib.sha256("\x1e".join(rows).encode()).hexdigest()[:16], rows


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, sf_dir, con, verbose=True):
    from rewardloom.plans import ORACLE, QUERIES
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir).toPandas()
    t1 = time.time()
    if name not in ORACLE:
        return {"name": name, "status": "rows-only", "rows": len(sdf), "spark_s": round(t1 - t0, 2)}
    odf = con.execute(ORACLE[name]).df()
    res = {"name": name, "rows": len(sdf), "oracle_rows": len(odf), "spark_s": round(t1 - t0, 2)}
    if sorted(sdf.columns) != sorted(odf.columns):
        res["status"] = f"COLUMNS {sorted(sdf.columns)} vs {sorted(odf.columns)}"
        return res
    types = {c: (str(sdf[c].dtype), str(odf[c].dtype)) for c in sdf.columns
             if str(sdf[c].dtype) != str(odf[c].dtype)}
    hs, rs = digest(sdf, name in ORDERED)
    ho, ro = digest(odf, name in ORDERED)
    res["status"] = "match" if (hs == ho and len(sdf) == len(odf)) else "MISMATCH"
    if types:
        res["dtypes"] = types
        res["status"] = "DTYPES" if res["status"] == "match" else res["status"]
    if res["status"] != "match" and verbose:
        a, b = set(rs), set(ro)
        res["only_spark"] = [r[:300] for r in list(a - b)[:3]]
        res["only_oracle"] = [r[:300] for r in list(b - a)[:3]]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from rewardloom.session import local_session
    from rewardloom.plans import QUERIES
    spark = local_session(8)
    con = connect(sf_dir)
    bad = 0
    for n in names or list(QUERIES):
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} problem(s)")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

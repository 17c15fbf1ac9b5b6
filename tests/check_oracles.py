"""Run every registered query next to its SQL and compare the rows.

usage: python tests/check_oracles.py [sf_dir] [name-part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v if isinstance(v, (int, str)) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    left = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    right = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    if left == right:
        return True, f"{len(left)} rows"
    only_l = [r for r in left if r not in set(right)][:3] if len(left) < 200000 else []
    only_r = [r for r in right if r not in set(left)][:3] if len(right) < 200000 else []
    return False, f"{len(left)} vs {len(right)} rows\n   spark {only_l}\n   sql   {only_r}"


def main():
    from docloom.session import build_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = build_session(), connect(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for name in q:
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            if name in o:
                ok, note = compare(spark, con, q[name], o[name], sf_dir)
            else:
                ok, note = True, f"{q[name](spark, sf_dir).count()} rows, no SQL"
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - t:.1f}s {note}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()

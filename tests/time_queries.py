"""Time the Spark side (and with --sql the SQL side) of chosen queries."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    from __spark_entry__ import oracle_sql, queries
    from check_oracles import connect
    from docloom.session import build_session

    with_sql = "--sql" in sys.argv
    args = [a for a in sys.argv[1:] if a != "--sql"]
    sf, wanted = args[0], args[1:]
    spark = build_session()
    q, o = queries(), oracle_sql()
    for n in q:
        if wanted and not any(w in n for w in wanted):
            continue
        times = []
        for _ in range(2):
            t = time.time()
            q[n](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(round(time.time() - t, 2))
        s = ""
        if with_sql and n in o:
            con = connect(sf)
            t = time.time()
            con.execute(o[n]).fetchall()
            s = f" sql {time.time() - t:.2f}"
        print("time", n, times, s, flush=True)


if __name__ == "__main__":
    main()

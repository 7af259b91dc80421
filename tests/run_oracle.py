"""Run every registered query in Spark and its oracle in DuckDB; print a table.

usage: python tests/run_oracle.py [sf_dir] [key ...]
"""
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import __spark_entry__ as E  # noqa: E402
from estatelens.session import build_session  # noqa: E402
from harness import compare, duck  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = build_session("local[8]", shuffle_partitions=8)
spark.sparkContext.setLogLevel("OFF")
con = duck(sf)
Q, O = E.queries(), E.oracle_sql()
bad = []
for k, fn in Q.items():
    if only and k not in only:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if k in O:
            r = compare(df, con, O[k])
            n = con.execute(f"SELECT count(*) FROM ({O[k]}) z").fetchone()[0]
        else:
            n = df.count()
            r = None
            k_show = k + " (no oracle)"
    except Exception as e:  # noqa: BLE001
        r, n = "ERROR " + str(e).split("\n")[0][:400], -1
    if r:
        bad.append(k)
    print(f"{k:32s} rows={n:6d} {time.time()-t:5.1f}s {'OK' if not r else r}", flush=True)
print(f"{len(bad)} bad of {len(Q) if not only else len(only)}: {bad}")

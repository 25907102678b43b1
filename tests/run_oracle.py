"""CLI: python tests/run_oracle.py [sf_dir] [name ...] -- prints one line per query."""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402
from readerflow.plans.registry import load_all  # noqa: E402
from readerflow.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = local_session(8)
con = duck(sf)
reg = load_all()
bad = 0
for name, q in reg.items():
    if names and name not in names:
        continue
    t = time.time()
    if q.sql is None:
        n = q.build(spark, sf).count()
        print(f"ROWS {name}: {n} rows ({time.time()-t:.1f}s)", flush=True)
        continue
    try:
        r = compare(spark, con, q, sf)
    except Exception as e:  # noqa: BLE001
        bad += 1
        print(f"ERR  {name}: {type(e).__name__}: {str(e)[:600]}", flush=True)
        continue
    tag = "OK  " if r["ok"] else "FAIL"
    bad += not r["ok"]
    print(f"{tag} {name}: spark={r['spark_rows']} oracle={r['oracle_rows']} ({time.time()-t:.1f}s)", flush=True)
    if not r["ok"]:
        print("     cols", r["spark_cols"], r["oracle_cols"])
        for k in ("only_spark", "only_oracle"):
            for row in r.get(k, []):
                print(f"     {k}: {str(row)[:400]}")
print("FAILED", bad)

"""Command line: python tests/check.py <folder> [slice rows] [name part ...]"""

import sys
import time

sys.path.insert(0, "/".join(__file__.split("/")[:-2]) or ".")
sys.path.insert(0, "/".join(__file__.split("/")[:-1]) or ".")

import compare

from tidemark.queries import all_queries
from tidemark.session import local_session


def main(folder, slice_rows, parts):
    spark = local_session(8)
    if slice_rows:
        spark.conf.set("tidemark.rowsPerSlice", str(slice_rows))
    con = compare.connect(folder)
    bad = 0
    for name, q in all_queries().items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        begun = time.time()
        try:
            got = compare.spark_rows(q.run(spark, folder))
            took = time.time() - begun
            said = f"rows only, {len(got[1])}" if q.sql is None else compare.difference(got, compare.duck_rows(con, q.sql)) or f"same, {len(got[1])} rows"
        except Exception as e:
            took, said = time.time() - begun, "ERROR " + str(e)[:1500]
        if not said.startswith(("same", "rows only")):
            bad += 1
        print(f"{name:32s} {took:6.2f}s  {said}", flush=True)
    print("bad:", bad)


main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 0, sys.argv[3:])

"""Run registered queries against their SQL twins in DuckDB: check.py [SF] [name-prefix ...]."""

from __future__ import annotations

import sys
import time
import traceback
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tarnwork.catalog import TABLE_NAMES, registered  # noqa: E402

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
         "tinyint": "TINYINT", "date": "DATE"}


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(v + 0.0)
    if hasattr(v, "tzinfo") and v is not None:
        return str(v.replace(tzinfo=None))
    return str(v)


def main() -> int:
    sf, prefixes = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), tuple(sys.argv[2:])
    directory = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from '{directory}/{t}.parquet'")
    # A session as a caller would bring it: nothing set that the queries need.
    spark = (SparkSession.builder.master("local[8]").appName("check").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "10g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    bad = done = 0
    slow = []
    for name, q in registered().items():
        if prefixes and not name.startswith(prefixes):
            continue
        done += 1
        t0 = time.time()
        try:
            df = q(spark, directory)
            cols = sorted(df.columns)
            types = {c: t for c, t in df.dtypes}
            rows = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:700] if "--trace" not in sys.argv else str(e)[:6000]}", flush=True)
            if "--trace" in sys.argv:
                traceback.print_exc()
            continue
        t1 = time.time()
        slow.append((t1 - t0, name))
        if not q.oracle:
            print(f"rows {name}: {sum(rows.values())} ({t1 - t0:.1f}s) e.g. {next(iter(rows), None)}"[:200], flush=True)
            if not rows:
                bad += 1
                print(f"FAIL {name}: empty")
            continue
        try:
            cur = con.execute(q.oracle)
            dcols = [d[0] for d in cur.description]
            dtypes = {d[0]: str(d[1]) for d in cur.description}
            want = cur.fetchall()
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: oracle {str(e)[:500]}", flush=True)
            continue
        problem = None
        if sorted(dcols) != cols:
            problem = f"columns {cols} vs {sorted(dcols)}"
        else:
            for c in cols:
                if TYPES.get(types[c], types[c]) != dtypes[c]:
                    problem = f"type of {c}: {types[c]} vs {dtypes[c]}"
            pos = [dcols.index(c) for c in cols]
            wanted = Counter(tuple(norm(r[p]) for p in pos) for r in want)
            if wanted != rows:
                a, b = rows - wanted, wanted - rows
                problem = (f"{problem or ''} rows {sum(rows.values())} vs {sum(wanted.values())}; "
                           f"only spark {sum(a.values())} {list(a)[:3]} only sql {list(b)[:3]}")
            if not rows:
                problem = "empty on both sides"
        d = time.time() - t1
        if problem or d > 5 or t1 - t0 > 8:
            print(f"{'FAIL' if problem else 'slow'} {name}: {(problem or '')[:900]} spark {t1-t0:.1f}s sql {d:.1f}s", flush=True)
        bad += bool(problem)
    slow.sort(reverse=True)
    print(f"{done} run, {bad} bad; total {sum(s for s, _ in slow):.0f}s; slowest", [(n, round(s, 1)) for s, n in slow[:8]])
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

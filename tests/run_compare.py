"""Command line: python tests/run_compare.py FOLDER [query ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as e  # noqa: E402
from compare import difference, duck  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "8g")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
folder, names = sys.argv[1], sys.argv[2:]
qs, sql = e.queries(), e.oracle_sql()
con = duck(folder)
bad = 0
for name in names or qs:
    t = time.time()
    try:
        df = qs[name](spark, folder)
        if name in sql:
            d = difference(df, con, sql[name])
        else:
            d = None
            print(f"     {name}: rows only, {df.count()}", flush=True)
    except Exception as ex:  # report and go on with the other queries
        d = "ERROR " + str(ex).split("JVM stacktrace")[0][:600]
    if d:
        bad += 1
        print(f"FAIL {name} ({time.time() - t:.1f}s): {d}", flush=True)
    else:
        print(f"ok   {name} ({time.time() - t:.1f}s)", flush=True)
print(f"{bad} failures; without SQL: {sorted(set(qs) - set(sql))}; without query: {sorted(set(sql) - set(qs))}")

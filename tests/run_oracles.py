"""``python tests/run_oracles.py [sf_dir] [name prefix…]``: compare registered queries with DuckDB."""

import sys
import traceback
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from atlas.queries import load  # noqa: E402
from tests.compare import compare, connect  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, query in sorted(load().items()):
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            ok, note = compare(spark, con, folder, name, query)
        except Exception as error:  # noqa: BLE001
            ok, note = False, "".join(traceback.format_exception_only(error))[:1500]
        bad += not ok
        print(("ok   " if ok else "FAIL ") + name, note[:1500], flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

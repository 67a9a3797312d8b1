"""Compare queries of the subpackage with their SQL: `python tests/llm/compare.py FOLDER [name ...]`."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from callsift.llm.queries import QUERIES, SQL  # noqa: E402
from callsift.session import local_session  # noqa: E402
from tests.compare import connect, difference  # noqa: E402

if __name__ == "__main__":
    spark = local_session("llm-compare")
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        problem = difference(spark, connect(sys.argv[1]), QUERIES[name], SQL.get(name), sys.argv[1])
        print(name, problem or "ok", "" if name in SQL else "(no SQL)", f"{time.time() - start:.1f}s", flush=True)

"""Scale probe: build_graph on the sf snapshot replicated N times.

Usage: python tools/scale_probe.py SF_DIR N [N ...]
Each copy renames the packages (name, ord), so the package side grows N-fold
while requirement targets, licenses, keywords and domains are shared by the
copies (those keys get N times hotter). Prints seconds and row counts per N.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from propgraph import build_graph  # noqa: E402
from propgraph.session import get_spark, scratch_path  # noqa: E402
from propgraph.sources import Fixtures, scan_raw  # noqa: E402


def main(sf: str, factors: list[int]) -> None:
    spark = get_spark("local[8]", app="scale-probe")
    base = Fixtures(spark, sf).raw()
    build_graph(raw=base).counts().collect()                     # warm-up
    for n in factors:
        copies = (base.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
                      .select((F.col("ord") * n + F.col("c")).alias("ord"),
                              F.concat("name", F.lit("-c"), F.col("c").cast("string")).alias("name"),
                              "latest"))
        path = scratch_path(spark, f"scale-{n}")
        copies.write.parquet(path)
        t = time.time()
        rows = build_graph(raw=scan_raw(spark, path)).counts().collect()
        secs = time.time() - t
        total = sum(r.n_rows for r in rows)
        print(f"N={n:3d} packages={base.count() * n:8d} final_rows={total:9d} "
              f"build_graph_sec={secs:6.1f}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], [int(x) for x in sys.argv[2:]])

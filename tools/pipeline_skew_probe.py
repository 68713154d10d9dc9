"""Skew probe for the whole pipeline.

Usage: python tools/pipeline_skew_probe.py SF_DIR EVENT_DIR

Derives a skewed raw snapshot from the driver's tables: a third of the
packages share one license, one keyword, one author address (so one person,
one email, one domain), and every package requires one common package. Runs
build_graph with Spark's event log in EVENT_DIR (a fresh scratch folder) and
prints, per stage with a shuffle read, the largest task's share of records.
"""

from __future__ import annotations

import subprocess
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from propgraph import build_graph  # noqa: E402
from propgraph.session import get_spark, scratch_path  # noqa: E402
from propgraph.sources import Fixtures, scan_raw  # noqa: E402
from propgraph.sources.raw import raw_snapshot  # noqa: E402


def main(sf_dir: str, ev: str) -> None:
    spark = get_spark("local[8]", app="pipeline-skew", shuffle_partitions=32, conf={
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": ev})
    fx = Fixtures(spark, sf_dir)
    hot = F.col("ord") % 3 == 0
    fields = (fx.table("raw_fields")
              .withColumn("license", F.when(hot, F.lit("MIT")).otherwise(F.col("license")))
              .withColumn("keywords", F.when(hot, F.lit("python")).otherwise(F.col("keywords")))
              .withColumn("author", F.when(hot, F.lit("Hot Author")).otherwise(F.col("author")))
              .withColumn("author_email", F.when(hot, F.lit("hot@gmail.com"))
                          .otherwise(F.col("author_email"))))
    common = fields.select("name", F.lit("numpy").alias("req_name"), F.lit("two").alias("kind"),
                           F.lit(">1").alias("requirement"), F.lit("1.0").alias("rel_a"),
                           F.lit("2.0").alias("rel_b"))
    requires = fx.table("raw_requires").unionByName(common)
    path = scratch_path(spark, "skewed-raw")
    raw_snapshot(fields, requires).write.parquet(path)
    t = time.time()
    g = build_graph(raw=scan_raw(spark, path), keyword_threshold=300)
    g.counts().collect()
    print("build_graph sec", round(time.time() - t, 2))
    spark.stop()
    subprocess.run([sys.executable, str(Path(__file__).with_name("eventlog_summary.py")), ev],
                   check=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])

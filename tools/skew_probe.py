"""Skew probe: one keyword holds a third of 3M rows.

Usage: python tools/skew_probe.py EVENT_DIR   (EVENT_DIR: a fresh scratch folder)
Runs the naive window (row_number over keyword) and drop_first_occurrences,
with Spark's event log written to EVENT_DIR, then prints for each the largest
share of shuffle-read records one task got (tools/eventlog_summary.py).
"""
import subprocess, sys, time
from pathlib import Path
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from pyspark.sql import SparkSession, Window, functions as F
ev = sys.argv[1]
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "16")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", ev)
         .getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from propgraph.operators import drop_first_occurrences
n = 3_000_000
df = (spark.range(n).select(F.col("id").alias("ord"), F.lit(0).alias("pos"),
      F.concat(F.lit("p"), F.col("id")).alias("pkg_name"),
      F.when(F.col("id") % 3 == 0, F.lit("hot"))
       .otherwise(F.concat(F.lit("k"), (F.hash("id") % 1000).cast("string"))).alias("keyword")))
w = Window.partitionBy("keyword").orderBy("ord", "pos")
spark.sparkContext.setJobGroup("naive", "naive")
t = time.time()
df.withColumn("rn", F.row_number().over(w)).where("rn > 300").drop("rn").write.format("noop").mode("overwrite").save()
print("naive sec", round(time.time() - t, 2))
spark.sparkContext.setJobGroup("bucketed", "bucketed")
t = time.time()
drop_first_occurrences(df, "keyword", ["ord", "pos"], 300, 16).write.format("noop").mode("overwrite").save()
print("bucketed sec", round(time.time() - t, 2))
tokens = ev.rstrip("/") + "-tokens"
df.write.parquet(tokens)
spark.sparkContext.setJobGroup("selected", "selected")
t = time.time()
drop_first_occurrences(spark.read.parquet(tokens), "keyword", ["ord", "pos"], 300).write.format("noop").mode("overwrite").save()
print("selected sec", round(time.time() - t, 2))
spark.stop()
subprocess.run([sys.executable, str(Path(__file__).with_name("eventlog_summary.py")), ev], check=True)

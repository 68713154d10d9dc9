"""Per stage of a Spark event log (zstd, v2 folder): tasks, largest and total
shuffle-read records, and the largest task's share. Jobs tagged with
setJobGroup are labelled with their group."""
import glob, io, json, sys
import zstandard
files = sorted(glob.glob(f"{sys.argv[1]}/eventlog_v2_*/events_*"))
stage_group, tasks = {}, {}
for fn in files:
    with open(fn, "rb") as fh:
        text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        for line in text:
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    stage_group[s] = g
            elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                r = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                if r:
                    tasks.setdefault(e["Stage ID"], []).append(r)
for s, v in sorted(tasks.items()):
    print(f"{str(stage_group.get(s)):9s} stage {s:3d} tasks {len(v):3d} max {max(v):8d} total {sum(v):8d} share {max(v)/sum(v):.3f}")

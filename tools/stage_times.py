"""Stage timings of one query from Spark's event log (no UI involved).

Usage: python tools/stage_times.py <query> [sf_dir]
Runs the query twice (warm-up, then measured) with the event log written to
a fresh scratch folder, then prints each measured job's stages: start
offset, duration and task count.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(folder: str):
    for path in sorted(glob.glob(f"{folder}/*/events*") + glob.glob(f"{folder}/events*")):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="evlog-")
    from pyspark.sql import SparkSession

    from cardgrain.plans.catalog import queries
    from cardgrain.session import ENGINE_CONF, checkpoint_dir
    b = (SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "16").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", f"file://{log_dir}"))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    q = queries()[name]
    q(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("measured", name)
    q(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    jobs, stages = {}, {}
    for e in read_events(log_dir):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None,
                                 e.get("Properties", {}).get("spark.jobGroup.id"), e["Stage IDs"]]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Submission Time"), si.get("Completion Time"),
                                      si["Number of Tasks"])
    measured = {j: v for j, v in jobs.items() if v[2] == "measured"}
    t0 = min(v[0] for v in measured.values())
    print(f"{name}: {len(measured)} jobs, wall {(max(v[1] for v in measured.values()) - t0) / 1000:.2f}s")
    for j, v in sorted(measured.items()):
        for s in v[3]:
            if s in stages and stages[s][0]:
                a, b_, n = stages[s]
                print(f"  job {j} stage {s}: start {(a - t0) / 1000:6.2f}s  "
                      f"dur {(b_ - a) / 1000:5.2f}s  tasks {n}")


if __name__ == "__main__":
    main()

"""Per-table stage times of a stored pipeline run, from Spark's event log.

Usage: python scripts/stage_times.py [sf_dir]
Runs the full stored pipeline on the fixture source with the event log
written to a fresh scratch directory, then sums the stage durations of each
table write (jobs are labelled ``write <layer>.<table>`` by the runner).
"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.pipeline import RunContext, run_pipeline  # noqa: E402
from strata.plans.snapshots import SnapshotStore  # noqa: E402
from strata.session import build_session, scratch_dir  # noqa: E402
from strata.sources import FixtureSource  # noqa: E402


def _events(log_dir: str):
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/local-*"):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb")).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="strata-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra_conf={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                                      "spark.eventLog.dir": f"file://{log_dir}"})
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, "stage-times")
    ctx = RunContext(spark=spark, source=FixtureSource(spark, sf_dir), store=SnapshotStore(spark, root + "/lake"),
                     as_of="2002-01-01")
    t0 = time.perf_counter()
    run_pipeline(ctx, root + "/interface/finance", root + "/interface/marketing")
    wall = time.perf_counter() - t0
    spark.stop()

    desc, stages = {}, {}
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            d = (e.get("Properties") or {}).get("spark.job.description") or "other (listing, exports, views)"
            for s in e.get("Stage IDs", []):
                desc[s] = d.split(" @ ")[0]
        elif e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = ((si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000,
                                      si["Number of Tasks"])
    by = collections.defaultdict(lambda: [0.0, 0, 0])
    for sid, (dur, tasks) in stages.items():
        row = by[desc.get(sid, "other (listing, exports, views)")]
        row[0] += dur
        row[1] += 1
        row[2] = max(row[2], tasks)
    print(f"wall {wall:.1f}s, stages {len(stages)}, sum of stage time {sum(v[0] for v in by.values()):.1f}s")
    print("| Job | stage sec | stages | max tasks |")
    print("| --- | --- | --- | --- |")
    for name, (dur, n, tasks) in sorted(by.items(), key=lambda kv: -kv[1][0]):
        print(f"| {name} | {dur:.2f} | {n} | {tasks} |")


if __name__ == "__main__":
    main()

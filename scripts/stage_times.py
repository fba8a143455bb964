"""Summarise stage times from a Spark event log (the UI stays off).

    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py parse_messages
    python scripts/stage_times.py <that dir> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def stages(path: str):
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(path) for f in fs if not f.startswith(".")]
    for fn in files:
        if fn.endswith(".zstd"):
            import io

            import zstandard
            fh = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(fn, "rb")), encoding="utf-8")
        else:
            fh = open(fn, encoding="utf-8")
        with fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    if "Submission Time" in si and "Completion Time" in si:
                        yield (si["Completion Time"] - si["Submission Time"]) / 1000.0, si["Stage ID"], \
                            si["Number of Tasks"], si["Stage Name"]


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = sorted(stages(path), reverse=True)
    print(f"{len(rows)} stages, {sum(r[0] for r in rows):.1f} s in total")
    for sec, sid, ntasks, name in rows[:top]:
        print(f"{sec:8.2f}s  stage {sid:4d}  tasks {ntasks:5d}  {name[:90]}")


if __name__ == "__main__":
    main()

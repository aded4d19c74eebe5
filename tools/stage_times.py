"""Stage times from a Spark event log (no UI needed).

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py market_rates
    python tools/stage_times.py $BENCH_EVENT_LOG_DIR [top_n]

Prints, per SQL execution, its description and wall time, then the slowest
stages with task counts, shuffle bytes and records.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def load(path: str):
    """Events of every log under ``path`` (plain or zstd-compressed, rolling folders included)."""
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
        if os.path.isfile(f) and os.path.basename(f).startswith(("events_", "local-", "app-")))
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard
            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                for line in text:
                    yield json.loads(line)
        else:
            with open(f) as fh:
                for line in fh:
                    yield json.loads(line)


def main(argv):
    path = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    sql_start, sql_desc, stages = {}, {}, []
    for ev in load(path):
        kind = ev.get("Event", "")
        if kind.endswith("SQLExecutionStart"):
            sql_start[ev["executionId"]] = ev["time"]
            sql_desc[ev["executionId"]] = ev.get("description", "")[:60]
        elif kind.endswith("SQLExecutionEnd"):
            eid = ev["executionId"]
            print(f"sql {eid:4d} {ev['time'] - sql_start.get(eid, ev['time']):7d} ms  {sql_desc.get(eid, '')}")
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            dur = info.get("Completion Time", 0) - info.get("Submission Time", 0)
            stages.append((dur, info["Stage ID"], info["Number of Tasks"],
                           acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                           acc.get("internal.metrics.shuffle.write.recordsWritten", 0),
                           info.get("Stage Name", "")[:50]))
    print(f"\n{'ms':>7} {'stage':>5} {'tasks':>5} {'shuf_bytes':>10} {'shuf_rows':>9}  name")
    for dur, sid, n, b, r, name in sorted(stages, reverse=True)[:top]:
        print(f"{dur:7d} {sid:5d} {n:5d} {b or 0:10} {r or 0:9}  {name}")


if __name__ == "__main__":
    main(sys.argv)

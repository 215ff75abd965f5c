"""Summarise a Spark event log (jobs, stages, task time) from a scratch folder.

usage: python tools/eventlog_summary.py <event-log-dir-or-file>
"""

import glob
import json
import os
import sys


def events(path):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True))
    for f in files:
        if not os.path.isfile(f) or f.endswith(".crc") or os.path.basename(f).startswith("appstatus"):
            continue
        if f.endswith(".zstd"):
            import io

            import zstandard

            with open(f, "rb") as fh:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
                for line in text:
                    yield json.loads(line)
        else:
            for line in open(f):
                yield json.loads(line)


def main():
    sql, stages, tasks = {}, [], {}
    for e in events(sys.argv[1]):
        ev = e["Event"]
        if ev.endswith("SQLExecutionStart"):
            sql[e["executionId"]] = [e["time"], None, e.get("description", "")[:50]]
        elif ev.endswith("SQLExecutionEnd"):
            sql[e["executionId"]][1] = e["time"]
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            tasks.setdefault(e["Stage ID"], []).append(m.get("Executor Run Time", 0))
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages.append((si["Stage ID"], si["Number of Tasks"], si["Completion Time"] - si["Submission Time"], si["Stage Name"][:50]))
    for k, (s, t, d) in sql.items():
        print(f"sql {k}: {t - s if t else '?'} ms  {d}")
    for sid, n, ms, name in stages:
        tt = tasks.get(sid, [])
        print(f"stage {sid}: tasks={n} wall={ms}ms task_sum={sum(tt)}ms max_task={max(tt) if tt else 0}ms {name}")


if __name__ == "__main__":
    main()

"""Stage times from a Spark event log (no UI, no REST): per job group of the
bench, the slowest stages with task counts and shuffle volumes.

usage: python tools/stage_times.py <event-log-file-or-dir> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _files(path: str):
    if not os.path.isdir(path):
        yield path
        return
    for dp, _dn, fn in sorted(os.walk(path)):
        for f in sorted(fn):
            if f.startswith("events") or f.startswith("local-") or f.startswith("app-"):
                yield os.path.join(dp, f)


def events(path: str):
    """Rolling (``eventlog_v2_*/events_N_*``) or single logs, plain or zstd."""
    for f in _files(path):
        if f.endswith(".zstd"):
            import io

            import zstandard
            with open(f, "rb") as fh:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True),
                                        encoding="utf-8")
                for line in text:
                    if line.strip():
                        yield json.loads(line)
        else:
            with open(f) as fh:
                for line in fh:
                    if line.strip():
                        yield json.loads(line)


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = {}
    for e in events(path):
        if e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            stages[(info["Stage ID"], info["Stage Attempt ID"])] = (
                dur, info["Number of Tasks"], info["Stage Name"][:60],
                acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or
                acc.get("internal.metrics.shuffle.read.localBytesRead", 0))
    rows = sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]
    print(f"{'stage':>8} {'sec':>7} {'tasks':>6} {'shuffle_w':>12} {'shuffle_r':>12}  name")
    for (sid, att), (dur, n, name, w, r) in rows:
        print(f"{sid:>6}.{att} {dur:7.2f} {n:6d} {int(w or 0):12d} {int(r or 0):12d}  {name}")
    print(f"stages: {len(stages)}, total stage seconds: {sum(v[0] for v in stages.values()):.1f}")


if __name__ == "__main__":
    main()

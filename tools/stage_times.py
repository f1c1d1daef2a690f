"""Summarise stage durations from a Spark event log folder (local runs).

usage: python tools/stage_times.py EVENT_LOG_DIR [top_n]
"""

import glob
import io
import json
import os
import sys

import zstandard


def events(folder):
    for f in glob.glob(folder + "/**/*", recursive=True):
        if not (os.path.isfile(f) and "events" in os.path.basename(f)):
            continue
        with open(f, "rb") as fh:
            stream = fh
            if f.endswith(".zstd"):
                stream = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                if line.strip():
                    yield json.loads(line)


def main():
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = {}
    for e in events(folder):
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            det = si.get("Details", "").split("\n")
            where = next((ln.strip()[:80] for ln in det if "tidewash/" in ln), "")
            stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"],
                                      si["Number of Tasks"], where)
    print("stages", len(stages), "sum of stage ms", sum(v[0] for v in stages.values()))
    for k, v in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(k, v)


if __name__ == "__main__":
    main()

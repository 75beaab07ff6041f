"""Print a compact outline of the final physical plan of each headline query.

    python tools/plan_report.py [sf_dir]

Each query is executed once so the outline shows the plan
AQE settled on: scans with their pushed filters and read columns, joins
with their strategy, aggregates, windows and exchanges.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Scan", "Join", "Aggregate", "Window", "Exchange", "Sort ", "Generate", "Expand",
        "Union", "BroadcastExchange", "AQEShuffleRead", "TakeOrdered", "Coalesce")


def outline(df) -> list[str]:
    # Run the DataFrame's own plan (a write would plan it afresh), so the
    # adaptive plan below is the final one AQE settled on.
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("== Initial Plan ==")[0]
    out = []
    for line in text.splitlines():
        body = re.sub(r"^\(\d+\)\s*", "", line.lstrip(" :+-*"))
        name = body.split("(")[0].split(" ")[0]
        if not any(k.strip() in name for k in KEEP):
            continue
        depth = (len(line) - len(line.lstrip(" :+-"))) // 3
        body = re.sub(r"#\d+L?", "", body)
        body = re.sub(r", \[plan_id=\d+\]", "", body)
        if "Scan parquet" in body:
            cols = re.search(r"ReadSchema: (struct<\S*)", body)
            filt = re.search(r"PushedFilters: (\[[^\]]*\])", body)
            body = "Scan parquet " + (cols.group(1) if cols else "") + (
                f" pushed={filt.group(1)}" if filt and filt.group(1) != "[]" else "")
        out.append("  " * depth + body[:160])
    return out


if __name__ == "__main__":
    from bench import headline
    from tierline.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark(master="local[8]", shuffle_partitions=16)
    for name, build in headline(spark, sf).items():
        print(f"### {name}\n```")
        print("\n".join(outline(build())))
        print("```\n")

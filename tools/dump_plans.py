"""Write PLANS.md: the physical plan of every registered query (corpus operators aside).

Usage: python tools/dump_plans.py [sf_dir]   (default /root/testdata/sf0.1)
Plans are the initial adaptive plans (before runtime re-planning); long
lines are cut.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pagetrail.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from pagetrail.plans.registry import QUERIES

    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf_dir}` (initial adaptive plans; "
           "AQE may still coalesce partitions or switch a join at run time). "
           "Expression ids are removed and long lines cut.", ""]
    for name, q in QUERIES.items():
        if name.startswith("kmeans_"):
            continue
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = [re.sub(r"#\d+L?", "", ln) for ln in plan.splitlines()]
        # scans: keep the pushed filters and read schema, drop file locations
        lines = [re.sub(r"Location: \S+ \[[^\]]*\], |DataFilters: \[[^\]]*\], |Batched: true, |Format: Parquet, ", "", ln)
                 for ln in lines]
        lines = [ln if len(ln) <= 240 or "FileScan" in ln else ln[:237] + "..." for ln in lines]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Summarise the executed (AQE-final) physical plans of the headline queries.

Usage: python scripts/plan_report.py [sf_dir] [query ...]
For each query the DataFrame's own plan is executed (``df.rdd.count()``, so
no rows are held on the driver), then the final plan's exchanges, joins, aggregates, windows and scans are printed
with the columns each scan reads.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.queries import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402

KEEP = re.compile(r"Exchange|Join|HashAggregate|Window|Expand|FileScan|Union|AQEShuffleRead|Reused|Subquery")
DEFAULT = ("fct_orders", "dim_part", "finance_metrics", "marketing_metrics", "finance_metrics_via_wide")


def summarise(plan: str) -> list[str]:
    out = []
    plan = plan.split("\n+- == Initial Plan ==")[0]
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]|\[id=#\d+\]", "", line)
        line = re.sub(r"Location: \S+ \[[^]]*\], ", "", line)
        line = re.sub(r"functions=\[(.{60}).*", r"functions=[\1 ...", line)
        line = re.sub(r"(FileScan parquet \[[^]]*\]).*?(PushedFilters: \[[^]]*\])?, ReadSchema.*", r"\1 \2", line)
        out.append(line[:220])
    return out


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or list(DEFAULT)
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.rdd.count()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        print(f"### {name}\n")
        print("```")
        print("\n".join(summarise(buf.getvalue())))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()

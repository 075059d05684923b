"""Print the physical plan tree of the headline queries (``explain("formatted")``, tree part only).

Usage: python tools_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys

from studylake.catalog import QUERIES
from studylake.session import build_session


def tree(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode).split("\n\n(1)")[0]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or ["passive_fact", "event_fact", "affected_hours", "reject_summary"]
    spark = build_session()
    for n in names:
        print(f"### {n}\n\n```\n{tree(QUERIES[n](spark, sf_dir))}\n```\n")


if __name__ == "__main__":
    main(sys.argv)

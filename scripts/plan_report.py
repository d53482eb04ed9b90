"""Summarise the physical plan of every registered query (at sf0.001 for
speed; the plan shape does not depend on the scale factor once static
broadcast is off) as a Markdown table: shuffle exchanges, join strategies,
windows, generators, whether the scan received pushed filters."""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from dimweave.plans.registry import QUERIES, load_all
    from dimweave.plans.inspect import count_operator, exchanges, plan_text
    from dimweave.session import build_session

    spark = build_session("local[4]", shuffle_partitions=8)
    load_all()
    qs = QUERIES
    print("| query | shuffles | sort-merge joins | broadcast joins | windows | generate | partial aggs | pushed filters |")
    print("|---|---|---|---|---|---|---|---|")
    for name in sorted(qs):
        if name == "layout_report":
            continue
        df = qs[name](spark, "/root/testdata/sf0.001")
        text = plan_text(df)
        tree = text.split("\n\n\n")[0]
        pushed = sorted({f for line in text.splitlines() if "PushedFilters" in line
                         for f in re.findall(r"(\w+)\(", line.split(":", 1)[1])})
        partial = len(re.findall(r"partial_", text))
        print(f"| {name} | {exchanges(df)} | {count_operator(df, 'SortMergeJoin')} | "
              f"{count_operator(df, 'BroadcastHashJoin')} | {tree.count('Window (')} | "
              f"{tree.count('Generate (')} | {partial} | {', '.join(pushed) or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()

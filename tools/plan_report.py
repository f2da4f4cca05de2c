"""Physical-plan audit of every registered query (writes PLANS.md).

For each query: shuffles (Exchange), broadcasts, sort-based aggregates,
cartesian / nested-loop joins, Python evaluation, and the pushed scan filters.
The plan is taken after building the query (round-trip queries have written
their inputs by then); AQE may still re-plan at run time.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])


def read_field_counts(plan: str) -> list[int]:
    """Top-level field count of every ``ReadSchema: struct<...>`` (nested types aware)."""
    out = []
    for m in re.finditer(r"ReadSchema: struct<", plan):
        i, depth, fields = m.end(), 1, 1
        if plan[i:i + 1] == ">":
            out.append(0)
            continue
        while i < len(plan) and depth:
            ch = plan[i]
            if ch == "<":
                depth += 1
            elif ch == ">":
                depth -= 1
            elif ch == "," and depth == 1:
                fields += 1
            i += 1
        out.append(fields)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from feedwright.queries import queries
    from feedwright.session import get_session
    spark = get_session("local[8]", 8, extra={"spark.sql.maxMetadataStringLength": "1000"})
    print("# Physical plans of the registered queries\n")
    print(f"Input `{sf_dir}`, `local[8]`, AQE on (plans before AQE's run-time changes). Columns: shuffles "
          "(`Exchange` excluding broadcasts), broadcasts, sort-based aggregates, cartesian/nested-loop joins, "
          "Python evaluation, number of columns each parquet scan reads (ReadSchema), scans with pushed filters.\n")
    print("| query | shuffles | broadcasts | sort aggs | cartesian / BNLJ | python | columns read per scan | pushed filters |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"(?<![A-Za-z])Exchange ", plan))
        bcast = plan.count("BroadcastExchange")
        sortagg = plan.count("SortAggregate")
        cart = plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin")
        py = len(re.findall(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan))
        pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*?)(?:\]|\.\.\.)", plan) if p]
        pf = "; ".join(p[:90] for p in pushed[:2]) or "-"
        rc = ", ".join(str(n) for n in read_field_counts(plan)) or "-"
        print(f"| `{name}` | {shuffles} | {bcast} | {sortagg} | {cart} | {py} | {rc} | {pf} |")


if __name__ == "__main__":
    main()

"""Physical-plan report for every registered query.

For each query: shuffle exchanges, Python-worker operators, nested-loop or
cartesian joins, sort-based aggregates, broadcast joins, and the median of
warm runs at the given scale. Writes a markdown table (default PLANS.md).

    python scripts/plan_report.py [--sf /root/testdata/sf0.1] [--runs 3] [--out PLANS.md]
"""

from __future__ import annotations

import argparse
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from presslens.plans.registry import load_all  # noqa: E402
from presslens.session import get_spark  # noqa: E402

APPENDIX = ("domain_concentration_cr3", "clean_articles", "top_keywords", "country_pulse_map",
            "neighbours_topk", "circuit_breaker")
PY_OPS = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas",
          "FlatMapCoGroupsInPandas", "AggregateInPandas", "WindowInPandas", "PythonUDF")


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--runs", type=int, default=3)
    ap.add_argument("--out", default="PLANS.md")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_spark("plans", 8, {"spark.sql.shuffle.partitions": "16"})
    reg = load_all()
    rows = []
    for name in args.names or sorted(reg):
        q = reg[name]
        df = q.build(spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        plan = final_plan(df)
        samples = []
        for _ in range(args.runs):
            t0 = time.perf_counter()  # build inside the timer: some builders write
            d = q.build(spark, args.sf)
            d.write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        rows.append((name, ", ".join(q.ids),
                     count(r"\bExchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan),
                     sum(count(rf"\b{op}\b", plan) for op in PY_OPS),
                     count(r"BroadcastNestedLoopJoin|CartesianProduct", plan),
                     count(r"\bSortAggregate\b", plan) // 2,
                     count(r"\bBroadcastHashJoin\b", plan),
                     round(statistics.median(samples), 3),
                     "yes" if q.oracle else "rows only"))
        print(rows[-1], flush=True)
    appendix = {}
    for name in APPENDIX:
        if name in reg and (not args.names or name in args.names):
            d = reg[name].build(spark, args.sf)
            d.collect()  # so the adaptive plan below is the final one
            text = d._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
            tree, _, details = text.partition("\n\n(1)")
            scans = [blk for blk in ("(1)" + details).split("\n\n") if " Scan " in blk.split("\n")[0]]
            appendix[name] = tree.strip() + "\n\n" + "\n\n".join(scans)
    with open(args.out, "w") as fh:
        fh.write(f"# Plan report ({args.sf}, local[8], median of {args.runs} warm runs)\n\n")
        fh.write("Generated by `scripts/plan_report.py` from the executed physical plans (AQE final plans).\n\n")
        fh.write("| query | ids | exchanges | python ops | nested-loop/cartesian | sort aggs | broadcast joins "
                 "| sec | oracle |\n|---|---|---|---|---|---|---|---|---|\n")
        for r in rows:
            fh.write("| " + " | ".join(str(x) for x in r) + " |\n")
        if appendix:
            fh.write("\n## Physical plans of headline queries (after execution, AQE final plans)\n")
            for name, text in appendix.items():
                fh.write(f"\n### {name}\n\n```\n{text.strip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()

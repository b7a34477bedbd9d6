"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is run once cold (plan + JIT warm-up) and then timed as the median
of ``BENCH_RUNS`` warm runs; the result is fully consumed with a no-op write
sink so every row is produced without moving data to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from presslens.plans.registry import load_all  # noqa: E402
from presslens.session import get_spark  # noqa: E402

HEADLINE = [
    "domain_concentration_cr3",
    "top_domains_other",
    "top_keywords",
    "publishing_pace_15m",
    "cumulative_volume",
    "title_length_box",
    "projected_volume",
    "canonical_urls",
    "strip_html_pages",
    "clean_articles",
    "clean_counts",
    "totals_latest",
    "country_pulse_map",
    "body_extract",
    "upsert_merge",
    "neighbours_topk",
    "tfidf_vectors",
    "latest_snapshot",
    "stream_quarantine",
    "stream_progress",
    "stream_first_seen",
    "stream_country_totals",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark("bench", cpus, {"spark.sql.shuffle.partitions": str(max(int(cpus), 1) * 2)})
    registry = load_all()
    names = [n for n in (only or HEADLINE) if n in registry]
    timings = {}
    for name in names:
        q = registry[name]
        consume(q.build(spark, sf_dir))  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            consume(q.build(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Physical-plan properties of the registered queries (checked on the smoke tables)."""

import re

import pytest

from conftest import SMOKE
from presslens.plans.registry import load_all

PY_OPS = re.compile(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas|"
                    r"AggregateInPandas|WindowInPandas")
PAIRS = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin")
# queries that write files while being built are covered by their own tests
WRITERS = {"upsert_merge", "append_raw", "latest_snapshot", "incremental_load", "jsonl_tsv_scan", "clean_table"}
# the tile product, and the stack of open elements of a page's main text
PYTHON_ALLOWED = {"neighbours_topk", "body_extract", "body_enrich", "backfill_merge", "fill_counters", "body_coverage",
                  "body_coverage_overall", "method_tally"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, build in ((n, q.build) for n, q in load_all().items()):
        if name in WRITERS or name.startswith("stream_") or name in ("topics_kmeans", "topics_by_language"):
            continue
        out[name] = _plan(build(spark, SMOKE))
    return out


def test_no_pair_producing_joins(plans):
    bad = [n for n, p in plans.items() if PAIRS.search(p)]
    assert not bad, bad


def test_python_workers_only_where_needed(plans):
    bad = [n for n, p in plans.items() if PY_OPS.search(p) and n not in PYTHON_ALLOWED]
    assert not bad, bad
    assert PY_OPS.search(plans["neighbours_topk"])


def test_flagship_reads_only_the_url_column(plans):
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plans["domain_concentration_cr3"])
    assert schemas and all(s == "struct<url:string>" for s in schemas), schemas


def test_live_queries_use_scalar_subqueries_not_global_windows(plans):
    for name in ("arrivals_per_second", "country_pulse"):
        assert "Subquery" in plans[name], name


def test_skip_hosts_reach_the_parquet_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*Not\(StringStartsWith\(url,https://news\.google\.com/\)\)",
                     plans["missing_body"])

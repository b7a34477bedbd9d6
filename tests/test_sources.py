"""Ground-truth loader and schema dump."""

import json
import os

from presslens.sources import tables as S
from presslens.sources.ground_truth import load_ground_truth, schema_dump


def test_ground_truth_flattens_framings(spark, tmp_dir):
    doc = [{"event_id": "e1", "event_description": "Budget vote", "canonical_date": "2026-05-01",
            "framings": [{"country": "DE", "outlet": "A", "url": "https://a/1", "headline": "h1",
                          "framing_axis": ["economy"], "sentiment": -0.2, "notes": None},
                         {"country": "US", "outlet": "B", "url": "https://b/1", "headline": "h2",
                          "framing_axis": ["security", "economy"], "sentiment": 0.4, "notes": "n"}]},
           {"event_id": "e2", "event_description": "No framings yet", "canonical_date": "2026-05-02",
            "framings": []}]
    path = os.path.join(tmp_dir, "gt.json")
    with open(path, "w") as fh:
        json.dump(doc, fh)
    rows = load_ground_truth(spark, path).orderBy("event_id", "framing_pos").collect()
    assert [(r.event_id, r.country, r.sentiment) for r in rows] == [("e1", "DE", -0.2), ("e1", "US", 0.4)]
    assert rows[1].framing_axis == ["security", "economy"]


def test_schema_dump(spark):
    from conftest import SMOKE
    dump = schema_dump({t: S.table(spark, SMOKE, t) for t in ("events", "pages")})
    assert ("events", 0, "event_id", "bigint", True) in dump
    assert ("pages", 2, "html", "string", True) in dump


def test_cli_list_and_run(spark, capsys, tmp_dir):
    from presslens.__main__ import main
    assert main(["list"]) == 0
    listed = capsys.readouterr().out
    assert "domain_concentration_cr3" in listed and "neighbours_topk" in listed
    out = os.path.join(tmp_dir, "cr3")
    from conftest import SMOKE
    assert main(["run", "domain_concentration_cr3", "--input", SMOKE, "--output", out]) == 0
    assert spark.read.parquet(out).count() == 4
    assert main(["run", "no_such_query", "--input", SMOKE]) == 2


def test_latest_snapshot_errors_when_none(spark, tmp_dir):
    import pytest
    from presslens.operators import upsert as UP
    df = spark.createDataFrame([(1, "x_staging"), (2, "other")], "id int, snapshot string")
    with pytest.raises(RuntimeError):
        UP.latest_snapshot_name(df, "rss_raw")

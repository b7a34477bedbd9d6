"""Invariants on the smoke tables: counter sums, key uniqueness, re-runs."""

from conftest import SMOKE
from presslens.operators import clean as C
from presslens.plans import live as L
from presslens.plans.pages import q_backfill_merge
from presslens.sources import tables as S


def test_clean_counters_sum_to_raw_in(spark):
    raw = S.raw_articles(spark, SMOKE)
    c = C.clean_counts(raw).first()
    assert c.raw_in == raw.count()
    assert c.raw_in == c.clean_out + c.dropped_no_url + c.dropped_stub + c.dropped_dupe
    assert C.clean(raw).count() == c.clean_out


def test_clean_urls_are_unique(spark):
    C.assert_unique_urls(C.clean(S.raw_articles(spark, SMOKE)))


def test_clean_is_deterministic(spark):
    raw = S.raw_articles(spark, SMOKE)
    a = sorted(map(tuple, C.clean(raw).collect()))
    b = sorted(map(tuple, C.clean(S.raw_articles(spark, SMOKE)).collect()))
    assert a == b


def test_final_view_one_row_per_url(spark):
    f = L.final_view(spark, SMOKE)
    assert f.count() == f.select("url").distinct().count() == S.event_articles(spark, SMOKE).select("url").distinct().count()


def test_backfill_keeps_every_article(spark):
    from presslens.plans.pages import article_table
    assert q_backfill_merge(spark, SMOKE).count() == article_table(spark, SMOKE).count()

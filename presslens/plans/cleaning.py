"""Cleaning queries: URL canonicalisation, HTML strip, the cleaner and its counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions import html as H
from presslens.functions import text as T
from presslens.functions import urls as U
from presslens.operators import analysis as AN
from presslens.operators import clean as C
from presslens.operators import upsert as UP
from presslens.plans.analysis import PRED_SQL, SCORES_SQL
from presslens.plans.registry import register
from presslens.session import scratch_path
from presslens.sources import tables as S


@register("canonical_urls", ids=("F01", "F05"), oracle=f"""
SELECT page_id, url, {U.canonical_url_sql('url')} AS canonical FROM pages
""")
def q_canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical form of every page URL (tracking keys dropped, host lowercased, ...)."""
    p = S.table(spark, sf_dir, "pages")
    return p.select("page_id", "url", U.canonical_url(F.col("url")).alias("canonical"))


@register("strip_html_pages", ids=("F02",), oracle=f"""
SELECT page_id, {H.strip_html_sql('html')} AS text FROM pages
""")
def q_strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page (script/style/comments dropped, entities decoded twice)."""
    p = S.table(spark, sf_dir, "pages")
    return p.select("page_id", H.strip_html(F.col("html")).alias("text"))


def _label_sql() -> str:
    stubs = T.sql_list(T.STUB_TITLES)
    return f"""
, lab AS (
  SELECT *, {U.canonical_url_sql('url')} AS curl, {T.clean_title_sql('title')} AS tclean
  FROM raw),
lab2 AS (SELECT *, coalesce(tclean IN ({stubs}), false) AS is_stub FROM lab)
"""


CLEAN_SQL = S.with_ctes(_label_sql() + f"""
, ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY curl ORDER BY arm, seq) AS rn
  FROM lab2 WHERE curl IS NOT NULL AND NOT is_stub)
SELECT source, country_target, tclean AS title, {H.strip_html_sql('summary')} AS summary,
       curl AS url, published_at, extracted_at
FROM ranked WHERE rn = 1
""", raw=S.RAW_SQL)

CLEAN_COUNTS_SQL = S.with_ctes(_label_sql() + """
SELECT CAST(COUNT(*) AS BIGINT) AS raw_in,
       CAST(COUNT(DISTINCT CASE WHEN curl IS NOT NULL AND NOT is_stub THEN curl END) AS BIGINT) AS clean_out,
       CAST(COUNT(*) FILTER (WHERE curl IS NULL) AS BIGINT) AS dropped_no_url,
       CAST(COUNT(*) FILTER (WHERE curl IS NOT NULL AND is_stub) AS BIGINT) AS dropped_stub,
       CAST(COUNT(*) FILTER (WHERE curl IS NOT NULL AND NOT is_stub)
            - COUNT(DISTINCT CASE WHEN curl IS NOT NULL AND NOT is_stub THEN curl END) AS BIGINT) AS dropped_dupe
FROM lab2
""", raw=S.RAW_SQL)


@register("clean_articles", ids=("F01", "F02", "F03", "F04", "F05", "U01", "U02", "U05", "W08", "J05",
                                 "K04", "S24", "K07"), oracle=CLEAN_SQL)
def q_clean_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """articles_clean over three raw arms: first row per canonical URL, stubs dropped."""
    return C.clean(S.raw_articles(spark, sf_dir))


@register("clean_counts", ids=("A18",), oracle=CLEAN_COUNTS_SQL)
def q_clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaner counters: raw_in = clean_out + dropped_no_url + dropped_stub + dropped_dupe."""
    return C.clean_counts(S.raw_articles(spark, sf_dir))


def _one_line_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\s+', ' ', 'g'), '^ | $', '', 'g')"


@register("clean_table", ids=("K04", "K07", "J05", "D01"), oracle=f"""
WITH c AS ({CLEAN_SQL}),
n AS (SELECT c.* REPLACE ({_one_line_sql('title')} AS title, {_one_line_sql('summary')} AS summary) FROM c),
t AS (SELECT n.*, concat_ws(' ', title, summary) AS text FROM n),
s AS (SELECT t.*, {SCORES_SQL} FROM t)
SELECT source, country_target, title, summary, url, published_at, extracted_at, {PRED_SQL} AS language FROM s
""")
def q_clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning job in two runs: the first arm, then all arms, of which only unseen URLs are added."""
    path = scratch_path(spark, "articles_clean")
    raw = S.raw_articles(spark, sf_dir)
    for rows in (raw.filter(F.col("arm") == 0), raw):
        c = C.clean(rows).withColumns({x: AN.normalise_whitespace(F.col(x)) for x in ("title", "summary")})
        c = AN.detect_language(c.withColumn("text", F.concat_ws(" ", "title", "summary")))
        columns = ["source", "country_target", "title", "summary", "url", "published_at", "extracted_at"]
        table = UP.append_unseen(spark, path, c.select(*columns, F.col("predicted").alias("language")))
    C.assert_unique_urls(table)
    return table

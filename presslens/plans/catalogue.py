"""Catalogue queries (S01, S06-S09, W09, U02) over catalogues derived from the
driver tables: outlets from the page hosts, aggregator queries from the
documents (one "country" per outlet, its languages, its headline keywords)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.functions import text as TX
from presslens.plans.registry import register
from presslens.sources import catalogue as CG
from presslens.sources import tables as S

SHARDS = 4
N_TOPICS = 2
N_QUERIES = 3


def outlet_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested catalogue fragments map<country, array<outlet>>, one per (country, host)."""
    hosts = S.page_articles(spark, sf_dir).select("sourcecountry", "domain").distinct()
    d = F.col("domain")
    entry = F.struct(
        d.alias("name"), F.concat(F.lit("https://"), d, F.lit("/")).alias("url"),
        F.when(d.startswith("m."), F.lit("")).otherwise(F.concat(F.lit("https://"), d, F.lit("/rss"))).alias("rss"),
        F.when(d.startswith("blog."), F.lit(None).cast("string")).otherwise(F.col("sourcecountry")).alias("language"),
        F.when(d.startswith("www."), F.lit("html")).otherwise(F.lit("rss")).alias("scrape"),
        F.lit(True).alias("robots_ok"), F.lit(None).cast("string").alias("notes"))
    return hosts.select(F.create_map(F.col("sourcecountry"), F.array(entry)).alias("countries"))


@register("outlet_catalogue", ids=("S01",), oracle=S.with_ctes("""
SELECT DISTINCT sourcecountry AS country_target, domain AS source, 'https://' || domain || '/rss' AS rss,
       CASE WHEN starts_with(domain, 'blog.') THEN '' ELSE sourcecountry END AS language
FROM p WHERE NOT starts_with(domain, 'm.') AND NOT starts_with(domain, 'www.')
""", p=S.PAGES_SQL))
def q_outlet_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flatten the nested outlet catalogue to one row per RSS outlet."""
    return CG.flatten_outlets(outlet_catalogue(spark, sf_dir))


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = S.document_articles(spark, sf_dir).filter(F.col("title").isNotNull())
    toks = TX.explode_tokens(d, ["source"])
    counts = toks.groupBy("source", "token").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source").orderBy(F.desc("n"), F.asc("token"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= N_TOPICS + N_QUERIES)


def query_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query-catalogue entry per outlet: its languages, top-2 headline
    keywords as topics and the next 3 as search queries (all bounded arrays)."""
    d = S.document_articles(spark, sf_dir)
    base = d.groupBy("source").agg(F.array_sort(F.collect_set("language")).alias("langs"),
                                   F.min_by("language", "doc_id").alias("lang"))
    kw = _keywords(spark, sf_dir).groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct("rank", "token"))).alias("_kw"))
    cat = base.join(kw, "source", "left")
    ranked = F.coalesce(F.col("_kw"), F.array())
    return cat.select(
        F.col("source").alias("country"),
        F.dense_rank().over(Window.orderBy("source")).alias("country_pos"),
        "lang", F.upper("source").alias("gl"), F.lit(None).cast("string").alias("ceid"), "langs",
        F.transform(F.filter(ranked, lambda x: x["rank"] <= N_TOPICS), lambda x: x["token"]).alias("topics"),
        F.transform(F.filter(ranked, lambda x: x["rank"] > N_TOPICS), lambda x: x["token"]).alias("queries"))


def _kw_sql() -> str:
    return f"""
kw AS (
  SELECT source, token, ROW_NUMBER() OVER (PARTITION BY source ORDER BY COUNT(*) DESC, token) AS rank
  FROM (SELECT source, LOWER(unnest(regexp_split_to_array(title, '{TX.ASCII_SPLIT_SQL}'))) AS token
        FROM d WHERE title IS NOT NULL)
  WHERE LENGTH(token) >= {TX.MIN_TOKEN_LEN} AND token NOT IN ({TX.sql_list(TX.STOPWORDS)})
  GROUP BY 1, 2 QUALIFY rank <= {N_TOPICS + N_QUERIES}),
cat AS (SELECT source AS country, DENSE_RANK() OVER (ORDER BY source) AS country_pos, upper(source) AS gl
        FROM d GROUP BY source),
langs AS (SELECT source AS country, language AS feed_lang,
                 ROW_NUMBER() OVER (PARTITION BY source ORDER BY language) - 1 AS lang_pos
          FROM d GROUP BY 1, 2),
win AS (SELECT * FROM (VALUES {", ".join(f"('{w}', {i})" for i, w in enumerate(CG.SEARCH_WINDOWS))}) t(win_tag, window_pos)),
pl AS (SELECT c.*, l.feed_lang, l.lang_pos, c.gl || ':' || l.feed_lang AS ceid FROM cat c JOIN langs l USING (country)),
topic_feeds AS (
  SELECT pl.country AS country_target, country_pos, lang_pos, 0 AS branch, kw.rank - 1 AS item_pos, 0 AS window_pos,
         'Google News ' || pl.country || '/' || feed_lang || ' / ' || kw.token AS source,
         'https://news.google.com/rss/headlines/section/topic/' || kw.token || '?hl=' || feed_lang || '&gl=' || gl
           || '&ceid=' || ceid AS rss, feed_lang AS language
  FROM pl JOIN kw ON kw.source = pl.country AND kw.rank <= {N_TOPICS}),
query_feeds AS (
  SELECT pl.country AS country_target, country_pos, lang_pos, 1 AS branch, kw.rank - {N_TOPICS + 1} AS item_pos,
         win.window_pos,
         'Google News ' || pl.country || '/' || feed_lang || ' / q:' || kw.token || ' ('
           || CASE WHEN win.win_tag = '' THEN 'all' ELSE win.win_tag END || ')' AS source,
         'https://news.google.com/rss/search?q='
           || replace(url_encode(CASE WHEN win.win_tag = '' THEN kw.token ELSE kw.token || ' when:' || win.win_tag END),
                      '%20', '+')
           || '&hl=' || feed_lang || '&gl=' || gl || '&ceid=' || ceid AS rss, feed_lang AS language
  FROM pl JOIN kw ON kw.source = pl.country AND kw.rank > {N_TOPICS} CROSS JOIN win),
feeds AS (SELECT * FROM topic_feeds UNION ALL SELECT * FROM query_feeds)
"""


def _fan_sql(final: str) -> str:
    return f"WITH d AS ({S.DOCS_SQL}),\n{_kw_sql()}{final}"


def _feeds(spark, sf_dir):
    return CG.fan_out(query_catalogue(spark, sf_dir))


@register("query_fanout", ids=("S06", "S07", "U02"), oracle=_fan_sql(
    "SELECT country_target, source, rss, language FROM feeds"))
def q_query_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregator feed fan-out: country x language x (topics + queries x 7 windows)."""
    return _feeds(spark, sf_dir).select("country_target", "source", "rss", "language")


@register("interleave", ids=("S09", "W09"), oracle=_fan_sql("""
, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY country_target
                                     ORDER BY country_pos, lang_pos, branch, item_pos, window_pos) AS round,
               MIN(country_pos) OVER (PARTITION BY country_target) AS first_pos FROM feeds)
SELECT country_target, source, round, DENSE_RANK() OVER (ORDER BY first_pos) AS country_order FROM r
""".replace("\n, r AS", ", r AS")))
def q_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round-robin order of the feed list across countries: (round, country_order)."""
    out = CG.interleave(_feeds(spark, sf_dir))
    return out.select("country_target", "source", "round", "country_order")


@register("shard", ids=("S08",), oracle=_fan_sql(f"""
SELECT source, rss, CAST((ROW_NUMBER() OVER (ORDER BY country_pos, lang_pos, branch, item_pos, window_pos) - 1)
                         % {SHARDS} AS INTEGER) AS shard FROM feeds
"""))
def q_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feed with its modulo shard (dense index over the ordered list, m = 4)."""
    return CG.assign_shards(_feeds(spark, sf_dir), SHARDS).select("source", "rss", "shard")

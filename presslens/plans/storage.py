"""Write-disposition and sampling queries: upsert, append, snapshots, tolerant
projection, incremental load, seeded samples (K01-K04, K07, K08, S23, S24,
D12, W05, W06, D10, O05).

Queries that write do so under the shared checkpoint folder
(``spark.checkpoint.dir``), one fresh folder per call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators import upsert as UP
from presslens.operators.dedup import first_by_key
from presslens.operators.topk import top_k_per_group
from presslens.plans.registry import register
from presslens.schemas import conform_article
from presslens.session import scratch_path
from presslens.sources import tables as S

LIMIT_BY = 5
TRIAL_SAMPLE = 1000


def _halves(spark, sf_dir):
    e = S.event_articles(spark, sf_dir).select(
        "seq", "source", "country_target", "title", "summary", "url", "published_at", "extracted_at")
    # cut in the middle of the covered time, so every row of the first half is older
    middle = e.agg(F.expr("min(extracted_at) + (max(extracted_at) - min(extracted_at)) / 2"))
    first = F.col("extracted_at") <= middle.scalar()
    return e.filter(first), e.filter(~first)


EVENT_COLS = "seq, source, country_target, title, summary, url, published_at, extracted_at"


@register("upsert_merge", ids=("K01", "K02", "T05"), oracle=S.with_ctes(f"""
SELECT {EVENT_COLS} FROM e
QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY extracted_at DESC, seq DESC) = 1
""", e=S.EVENTS_SQL))
def q_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert the second half of the stream into the table of the first: newest row per url."""
    path = scratch_path(spark, "upsert")
    a, b = _halves(spark, sf_dir)
    UP.latest_by_key(a, "url", ["extracted_at", "seq"]).write.parquet(path)
    return UP.merge_latest(spark.read.parquet(path), b).select(*[c.strip() for c in EVENT_COLS.split(",")])


@register("append_raw", ids=("K03", "K02"), oracle=S.with_ctes(f"SELECT {EVENT_COLS} FROM e", e=S.EVENTS_SQL))
def q_append_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain append of both batches: duplicates kept."""
    path = scratch_path(spark, "append")
    a, b = _halves(spark, sf_dir)
    UP.append(a, path)
    UP.append(b, path)
    return spark.read.parquet(path)


def _snapshot_col():
    # one dataset per day; rows of the 'error' type land in a staging dataset
    name = F.concat(F.lit("rss_raw_"), F.date_format("extracted_at", "yyyyMMdd"))
    return F.when(F.col("country_target") == "error", F.concat(name, F.lit("_staging"))).otherwise(name)


@register("latest_snapshot", ids=("S23", "K08"), oracle=S.with_ctes(f"""
, snap AS (
  SELECT *, CASE WHEN country_target = 'error' THEN 'rss_raw_' || strftime(extracted_at, '%Y%m%d') || '_staging'
                 ELSE 'rss_raw_' || strftime(extracted_at, '%Y%m%d') END AS snapshot FROM e)
SELECT {EVENT_COLS}, snapshot FROM snap
WHERE snapshot = (SELECT MAX(snapshot) FROM snap WHERE starts_with(snapshot, 'rss_raw') AND snapshot NOT LIKE '%_staging')
""", e=S.EVENTS_SQL))
def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one snapshot dataset per day, then read the latest non-staging one (partition-pruned)."""
    path = scratch_path(spark, "snapshots")
    e = S.event_articles(spark, sf_dir).select(*[c.strip() for c in EVENT_COLS.split(",")])
    UP.write_snapshots(e.withColumn("snapshot", _snapshot_col()), path)
    return UP.read_latest_snapshot(spark, path, "rss_raw")


@register("tolerant_projection", ids=("S24", "K07"), oracle=S.with_ctes("""
SELECT source, sourcecountry AS country_target, title, NULL::VARCHAR AS summary, url,
       NULL::TIMESTAMP AS published_at, NULL::TIMESTAMP AS extracted_at
FROM d""", d=S.DOCS_SQL))
def q_tolerant_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-column article projection of a raw table that lacks summary and times (typed NULLs)."""
    d = S.document_articles(spark, sf_dir).select(
        "source", F.col("sourcecountry").alias("country_target"), "title", "url")
    return conform_article(d)


@register("incremental_load", ids=("D12",), oracle=S.with_ctes(f"SELECT {EVENT_COLS} FROM e", e=S.EVENTS_SQL))
def q_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursor loading: load the first half, then append only rows past the high-water mark
    of a second pass over the whole stream (no duplicates from the overlap)."""
    path = scratch_path(spark, "incremental")
    a, _ = _halves(spark, sf_dir)
    everything = S.event_articles(spark, sf_dir).select(*[c.strip() for c in EVENT_COLS.split(",")])
    UP.incremental_load(spark, path, a)
    UP.incremental_load(spark, path, everything, key="seq")
    return spark.read.parquet(path)


# ------------------------------------------------------------------ samples
@register("stratified_sample", ids=("W05",), oracle=S.with_ctes("""
SELECT sourcecountry, source, doc_id, url FROM d
QUALIFY ROW_NUMBER() OVER (PARTITION BY sourcecountry, source ORDER BY md5(url), doc_id) = 1
""", d=S.DOCS_SQL))
def q_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pseudo-random article per (country, source): min by md5(url) (map-side partial)."""
    d = S.document_articles(spark, sf_dir).select("sourcecountry", "source", "doc_id", "url")
    return first_by_key(d.withColumn("_h", F.md5("url")), ["sourcecountry", "source"], ["_h", "doc_id"]).drop("_h")


@register("limit_by", ids=("W06",), oracle=S.with_ctes(f"""
SELECT sourcecountry, doc_id, url FROM d
QUALIFY ROW_NUMBER() OVER (PARTITION BY sourcecountry ORDER BY md5(url), doc_id) <= {LIMIT_BY}
""", d=S.DOCS_SQL))
def q_limit_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIMIT 5 BY country after a seeded order."""
    d = S.document_articles(spark, sf_dir).select("sourcecountry", "doc_id", "url")
    return top_k_per_group(d, ["sourcecountry"], [F.md5("url"), F.col("doc_id")], LIMIT_BY)


@register("topic_trial_sample", ids=("D10", "O05"), oracle=S.with_ctes(f"""
SELECT doc_id, url, title FROM d ORDER BY md5(url), doc_id LIMIT {TRIAL_SAMPLE}
""", d=S.DOCS_SQL))
def q_topic_trial_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 1 000-article trial sample in a seeded pseudo-random order (a sampling operator)."""
    d = S.document_articles(spark, sf_dir).select("doc_id", "url", "title")
    return d.orderBy(F.md5("url"), "doc_id").limit(TRIAL_SAMPLE)


AGGREGATOR_SOURCE = "Google News%"
AGGREGATOR_URL = "https://news.google.com/"


@register("extraction_samples", ids=("W05", "W06", "F13", "A21"), oracle=S.with_ctes(f"""
, pub AS (
  SELECT sourcecountry AS country_target, source, url, doc_id FROM d
  WHERE url <> '' AND source NOT LIKE '{AGGREGATOR_SOURCE}'
  QUALIFY row_number() OVER (PARTITION BY sourcecountry, source ORDER BY md5(url), doc_id) = 1),
pub5 AS (SELECT * FROM pub QUALIFY row_number() OVER (PARTITION BY country_target ORDER BY md5(url), doc_id) <= 5),
agg2 AS (
  SELECT sourcecountry AS country_target, source, url, doc_id FROM d WHERE starts_with(url, '{AGGREGATOR_URL}')
  QUALIFY row_number() OVER (PARTITION BY sourcecountry ORDER BY md5(url), doc_id) <= 2)
SELECT country_target, source, url, 'publisher' AS kind FROM pub5
UNION ALL SELECT country_target, source, url, 'aggregator' FROM agg2
""", d=S.DOCS_SQL))
def q_extraction_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples for the extraction comparison: one seeded-random publisher
    article per (country, source), then 5 per country; plus 2 aggregator
    articles per country (aggregator URL prefix)."""
    d = S.document_articles(spark, sf_dir).select(
        F.col("sourcecountry").alias("country_target"), "source", "url", "doc_id").withColumn("_h", F.md5("url"))
    pub = d.filter((F.col("url") != "") & ~F.col("source").like(AGGREGATOR_SOURCE))
    one = first_by_key(pub, ["country_target", "source"], ["_h", "doc_id"])
    pub5 = top_k_per_group(one, ["country_target"], [F.col("_h"), F.col("doc_id")], 5)
    agg = top_k_per_group(d.filter(F.col("url").startswith(AGGREGATOR_URL)), ["country_target"],
                          [F.col("_h"), F.col("doc_id")], 2)
    cols = ["country_target", "source", "url"]
    return (pub5.select(*cols, F.lit("publisher").alias("kind"))
            .unionByName(agg.select(*cols, F.lit("aggregator").alias("kind"))))

"""Input tables and adapters to article shapes.

The input tables are the driver's parquet files. Adapters turn them into the
article shapes the reference works on:

* ``P`` pages     -> GDELT-style article rows (domain, country from URL path, <title>)
* ``D`` documents -> headline rows (domain = source, country = language = lang)
* ``E`` events    -> unified article stream rows (country_target, source, url, times)

Every adapter also exists as SQL text (``*_SQL``) with the same definition; the
oracle queries start from these CTEs so Spark and the oracle read identical
rows. Adapters only project: they keep every input row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions import html as H
from presslens.functions import text as T
from presslens.functions import urls as U

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

COUNTRY_FROM_PATH = r"^https?://[^/]+/([a-z]{2})/"
# First paragraph of the article region, HTML kept (a feed-style summary).
LEAD_PARAGRAPH = r"(?is)<article\b[^>]*>.*?(<p\b.*?</p>)"
# Events per event-derived URL: repeated URLs give newest-wins logic work, and
# the number of URLs grows with the table.
EVENTS_PER_URL = 14
EVENT_NULL_PUBLISHED_EVERY = 11


# Tables whose rows carry whole texts (HTML pages, documents): per-row regex and
# tokenising work dominates, so their scans must be spread over all cores.
TEXT_TABLES = ("pages", "documents")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than the cluster's
    parallelism (e.g. one parquet row group), so CPU-heavy row-wise work uses
    every core. At scale the scan already has far more splits than cores and
    this is a no-op; nothing is shuffled then."""
    try:
        have = df.rdd.getNumPartitions()
        want = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - e.g. a Connect session without RDD access
        return df
    return df.repartition(want) if have < want else df


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool | None = None) -> DataFrame:
    """Read one input table; text tables are spread over the cores unless the
    caller only needs cheap per-row work (``spread_rows=False``)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if spread_rows is None:
        spread_rows = name in TEXT_TABLES
    return spread(df) if spread_rows else df


# ------------------------------------------------------------------ P: pages
def page_articles(spark: SparkSession, sf_dir: str, with_html: bool = False) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    domain = U.url_host(F.col("url"))
    country = F.regexp_extract("url", COUNTRY_FROM_PATH, 1)
    cols = [
        "page_id",
        "url",
        domain.alias("domain"),
        country.alias("sourcecountry"),
        country.alias("language"),
        H.html_title(F.col("html")).alias("title"),
        F.when(domain.startswith("m."), F.col("url")).alias("url_mobile"),
        F.nullif(F.regexp_extract("html", LEAD_PARAGRAPH, 1), F.lit("")).alias("summary"),
    ]
    if with_html:
        cols.append("html")
    return p.select(*cols)


PAGES_SQL = f"""
SELECT page_id, url,
       {U.url_host_sql('url')} AS domain,
       regexp_extract(url, '{COUNTRY_FROM_PATH}', 1) AS sourcecountry,
       regexp_extract(url, '{COUNTRY_FROM_PATH}', 1) AS language,
       {H.html_title_sql('html')} AS title,
       CASE WHEN starts_with({U.url_host_sql('url')}, 'm.') THEN url END AS url_mobile,
       nullif(regexp_extract(html, '{LEAD_PARAGRAPH}', 1), '') AS summary,
       html
FROM pages
"""


# -------------------------------------------------------------- D: documents
def document_articles(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    # the headline is one cheap anchored regex: not worth shipping whole texts
    d = table(spark, sf_dir, "documents", spread_rows=with_text)
    cols = [
        "doc_id",
        F.col("source").alias("domain"),
        F.col("lang").alias("sourcecountry"),
        F.col("lang").alias("language"),
        T.headline(F.col("text")).alias("title"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id")).alias("url"),
        "source",
    ]
    if with_text:
        cols += ["text", "n_chars"]
    return d.select(*cols)


DOCS_SQL = f"""
SELECT doc_id, source AS domain, lang AS sourcecountry, lang AS language,
       {T.headline_sql('text')} AS title,
       'https://' || source || '.example/' || CAST(doc_id AS VARCHAR) AS url,
       source, text, n_chars
FROM documents
"""


# ----------------------------------------------------------------- E: events
def event_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("src"), F.col("user_id").cast("string")).alias("source"),
        F.col("event_type").alias("country_target"),
        F.concat(F.lit("event "), F.col("event_type"), F.lit(" "), F.col("event_id").cast("string")).alias("title"),
        F.col("props").alias("summary"),
        F.concat(F.lit("https://ex.example/a/"), F.expr(f"event_id div {EVENTS_PER_URL}").cast("string")).alias("url"),
        F.when(F.col("event_id") % EVENT_NULL_PUBLISHED_EVERY != 0, F.col("ts")).alias("published_at"),
        F.col("ts").alias("extracted_at"),
        F.col("ts").alias("seendate"),
        "value",
        "user_id",
    )


EVENTS_SQL = f"""
SELECT event_id AS seq,
       'src' || CAST(user_id AS VARCHAR) AS source,
       event_type AS country_target,
       'event ' || event_type || ' ' || CAST(event_id AS VARCHAR) AS title,
       props AS summary,
       'https://ex.example/a/' || CAST(event_id // {EVENTS_PER_URL} AS VARCHAR) AS url,
       CASE WHEN event_id % {EVENT_NULL_PUBLISHED_EVERY} <> 0 THEN ts END AS published_at,
       ts AS extracted_at, ts AS seendate, value, user_id
FROM events
"""


# ------------------------------------------------- raw article arms (cleaner)
def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of three ingestion arms in input order: the article stream (E,
    arm 0), scraped pages (P, arm 1) and scraped documents without a summary
    column (D, arm 2, summary filled as NULL by the tolerant projection)."""
    from presslens.schemas import conform_article

    # per-row URL/HTML work dominates the cleaner: spread the stream arm too
    e = conform_article(spread(event_articles(spark, sf_dir)).withColumn("arm", F.lit(0)), extra=("arm", "seq"))
    p = page_articles(spark, sf_dir).select(
        F.lit(1).alias("arm"), F.col("page_id").alias("seq"), F.col("domain").alias("source"),
        F.col("sourcecountry").alias("country_target"), "title", "summary", "url")
    d = document_articles(spark, sf_dir).select(
        F.lit(2).alias("arm"), F.col("doc_id").alias("seq"), "source",
        F.col("sourcecountry").alias("country_target"), "title", "url")
    return e.unionByName(conform_article(p, extra=("arm", "seq"))).unionByName(
        conform_article(d, extra=("arm", "seq")))


RAW_SQL = f"""
SELECT 0 AS arm, seq, source, country_target, title, summary, url, published_at, extracted_at FROM ({EVENTS_SQL})
UNION ALL
SELECT 1, page_id, domain, sourcecountry, title, summary, url, NULL::TIMESTAMP, NULL::TIMESTAMP FROM ({PAGES_SQL})
UNION ALL
SELECT 2, doc_id, source, sourcecountry, title, NULL::VARCHAR, url, NULL::TIMESTAMP, NULL::TIMESTAMP FROM ({DOCS_SQL})
"""


def with_ctes(sql: str, **ctes: str) -> str:
    """Prefix ``sql`` with named CTEs (name=definition)."""
    parts = ",\n".join(f"{name} AS ({body})" for name, body in ctes.items())
    body = sql.lstrip()
    # a query that starts with ',' continues the WITH list with its own CTEs
    return f"WITH {parts}\n{body}" if not body.startswith(",") else f"WITH {parts}{body}"

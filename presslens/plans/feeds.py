"""Feed/API decoding queries over documents generated from the driver tables
(S02-S05, S10-S13, S16, S25, J08)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators.dedup import first_by_key
from presslens.operators.topk import top_k_per_group
from presslens.plans.registry import register
from presslens.session import scratch_path
from presslens.sources import feeds as FD
from presslens.sources import tables as S

RUN_AT = "2024-02-01 00:00:00"
FEED_EPOCH = "2024-01-01 00:00:00"
ITEM_MINUTES = 7
CHUNK_MINUTES = 45


def _xml_escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One RSS <item> document per document row. Date/summary layout rotates
    with doc_id: RFC-822 with weekday / RFC-822 numeric zone / ISO 'updated' /
    no date; summary / description / empty summary + description / none."""
    d = S.document_articles(spark, sf_dir, with_text=True)
    ts = F.lit(FEED_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("doc_id") * ITEM_MINUTES).cast("int"))
    kind = F.col("doc_id") % 4
    # the whole document as the teaser
    para = F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>"))
    esc_para = _xml_escape(para)
    link = F.col("url")

    def el(name, value):
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    xml = F.concat(
        F.lit("<item>"), el("title", _xml_escape(F.col("title"))), el("link", link),
        F.when(kind == 0, el("summary", esc_para)).when(kind == 2, el("summary", F.lit(""))).otherwise(F.lit("")),
        F.when(kind.isin(1, 2), el("description", esc_para)).otherwise(F.lit("")),
        F.when(kind == 0, el("pubDate", F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))))
         .when(kind == 1, el("pubDate", F.concat(F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))))
         .otherwise(F.lit("")),
        F.when(kind == 2, el("updated", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))))
         .otherwise(F.lit("")),
        F.lit("</item>"))
    return d.select("doc_id", "source", "sourcecountry", xml.alias("item_xml"))


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlet catalogue derived from the documents: one row per source, its
    language = language of its first document."""
    d = S.document_articles(spark, sf_dir).select("source", "doc_id", F.col("language"))
    return first_by_key(d, "source", ["doc_id"]).select(
        "source", F.col("language").alias("country_target"), "language",
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/feed")).alias("rss"))


ITEMS_EXPECTED_SQL = f"""
WITH d AS ({S.DOCS_SQL}),
o AS (SELECT source, arg_min(language, doc_id) AS country_target FROM d GROUP BY 1),
x AS (SELECT d.*, o.country_target,
             TIMESTAMP '{FEED_EPOCH}' + to_minutes(doc_id * {ITEM_MINUTES}) AS ts,
             doc_id % 4 AS kind, '<p>' || text || '</p>' AS para
      FROM d JOIN o USING (source))
"""


@register("rss_items", ids=("S02", "S03", "S04", "J08"), oracle=ITEMS_EXPECTED_SQL + f"""
SELECT doc_id, source, country_target, nullif(regexp_replace(title, '^\\s+|\\s+$', '', 'g'), '') AS title, url,
       CASE WHEN kind IN (0, 1, 2) THEN para END AS summary,
       CASE WHEN kind IN (0, 1, 2) THEN date_trunc('second', ts) END AS published_at,
       TIMESTAMP '{RUN_AT}' AS extracted_at
FROM x
""")
def q_rss_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items -> article rows: XML decode, first parseable date (RFC-822 or
    ISO, UTC), first non-empty summary field, entries without link dropped,
    outlet fields attached from the catalogue."""
    rows = FD.item_rows(feed_items(spark, sf_dir), F.lit(RUN_AT).cast("timestamp_ntz"))
    cat = outlets(spark, sf_dir).select("source", "country_target")
    out = rows.join(cat, "source")
    return out.select("doc_id", "source", "country_target",
                      F.nullif(F.regexp_replace("title", r"^\s+|\s+$", ""), F.lit("")).alias("title"),
                      "url", "summary", "published_at", "extracted_at")


@register("rss_short_scan", ids=("S16", "O06"), oracle=ITEMS_EXPECTED_SQL + f"""
, k AS (SELECT * FROM x)
SELECT source, doc_id, url,
       CASE WHEN kind IN (1, 2) THEN regexp_replace(para, '<[A-Za-z/!?][^>]*>', '', 'g') ELSE '' END AS summary
FROM k
WHERE coalesce(regexp_replace(title, '^\\s+|\\s+$', '', 'g'), '') <> ''
""".replace("\n, k AS", ", k AS"))
def q_rss_short_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short feed scan: items that have a title and a link; summary = description
    text with tags removed (no separator), '' when there is none."""
    return short_scan(feed_items(spark, sf_dir))


def short_scan(items: DataFrame, first: int | None = None) -> DataFrame:
    """source, doc_id, url, summary of every feed's items, or of its ``first`` ones (before any filtering)."""
    p = FD.parse_items(items)
    if first is not None:
        p = top_k_per_group(p, ["source"], [F.asc("doc_id")], first)
    ok = (F.coalesce(F.col("_i.title"), F.lit("")) != "") & (F.coalesce(F.col("_i.link"), F.lit("")) != "")
    return p.filter(ok).select("source", "doc_id", F.col("_i.link").alias("url"),
                                   F.coalesce(FD.strip_html_nosep(F.col("_i.description")), F.lit("")).alias("summary"))


def newsapi_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    # JSON encode/decode is per-row CPU work: spread a single-split scan
    e = S.spread(S.event_articles(spark, sf_dir))
    art = F.struct(F.col("title"), F.col("url"), F.col("summary").alias("description"),
                   F.concat(F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("publishedAt"))
    err = F.col("country_target") == "error"
    payload = F.to_json(F.struct(F.when(err, "error").otherwise("ok").alias("status"),
                                 F.when(err, "rateLimited").alias("message"),
                                 F.array(art).alias("articles")))
    return e.select("seq", "country_target", "extracted_at", payload.alias("payload"))


@register("api_decode", ids=("S13",), oracle=S.with_ctes("""
SELECT seq, 'NewsAPI' AS source, country_target, title, summary, url,
       date_trunc('second', extracted_at) AS published_at, extracted_at
FROM e WHERE country_target <> 'error'
""", e=S.EVENTS_SQL))
def q_api_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NewsAPI payloads -> article rows (status 'ok' only; description -> summary)."""
    rows = FD.decode_newsapi(newsapi_payloads(spark, sf_dir))
    return rows.select("seq", F.lit("NewsAPI").alias("source"), "country_target", "title", "summary", "url",
                       "published_at", "extracted_at")


def gdelt_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.spread(S.event_articles(spark, sf_dir))
    art = F.struct(F.col("url"),
                   F.when(F.col("seq") % 2 == 0, F.regexp_replace("url", "^https://", "https://m.")).alias("url_mobile"),
                   F.col("title"), F.date_format("seendate", "yyyyMMdd'T'HHmmss'Z'").alias("seendate"),
                   F.lit("ex.example").alias("domain"), F.lit("English").alias("language"),
                   F.col("country_target").alias("sourcecountry"))
    payload = F.when(F.col("country_target") == "error", F.lit("{}")).otherwise(
        F.to_json(F.struct(F.array(art).alias("articles"))))
    return e.select("seq", payload.alias("payload"))


@register("gdelt_decode", ids=("S12",), oracle=S.with_ctes("""
SELECT seq, url, CASE WHEN seq % 2 = 0 THEN regexp_replace(url, '^https://', 'https://m.') END AS url_mobile,
       title, 'ex.example' AS domain, 'English' AS language, country_target AS sourcecountry,
       date_trunc('second', seendate) AS seendate
FROM e WHERE country_target <> 'error'
""", e=S.EVENTS_SQL))
def q_gdelt_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GDELT ArtList payloads -> article rows; payloads without 'articles' yield no rows."""
    return FD.decode_gdelt(gdelt_payloads(spark, sf_dir)).drop("payload")


@register("jsonl_tsv_scan", ids=("S25",), oracle=S.with_ctes("""
SELECT 'json' AS fmt, seq, url, country_target, value FROM e
UNION ALL SELECT 'tsv', seq, url, country_target, value FROM e
""", e=S.EVENTS_SQL))
def q_jsonl_tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files as JSON lines and TSV, read back with explicit schemas."""
    e = S.event_articles(spark, sf_dir).select("seq", "url", "country_target", "value")
    base = scratch_path(spark, "results")
    e.write.mode("overwrite").json(f"{base}/jsonl")
    e.write.mode("overwrite").option("sep", "\t").option("header", True).csv(f"{base}/tsv")
    schema = "seq bigint, url string, country_target string, value double"
    j = spark.read.schema(schema).json(f"{base}/jsonl").withColumn("fmt", F.lit("json"))
    t = (spark.read.schema(schema).option("sep", "\t").option("header", True).csv(f"{base}/tsv")
         .withColumn("fmt", F.lit("tsv")))
    return j.unionByName(t).select("fmt", "seq", "url", "country_target", "value")


@register("time_chunks", ids=("S11",), oracle=S.with_ctes(f"""
, r AS (SELECT country_target AS query, MIN(extracted_at) AS range_start, MAX(extracted_at) AS range_end FROM e GROUP BY 1),
c AS (SELECT query, range_end, unnest(range(range_start, range_end, INTERVAL {max(CHUNK_MINUTES, 60)} MINUTE)) AS window_start FROM r)
SELECT query, window_start, LEAST(window_start + INTERVAL {max(CHUNK_MINUTES, 60)} MINUTE, range_end) AS window_end
FROM c
WHERE epoch(LEAST(window_start + INTERVAL {max(CHUNK_MINUTES, 60)} MINUTE, range_end) - window_start) / 60.0 >= 60
""", e=S.EVENTS_SQL))
def q_time_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request windows per query over its time range (45-minute request -> 60-minute floor)."""
    e = S.event_articles(spark, sf_dir)
    r = e.groupBy(F.col("country_target").alias("query")).agg(
        F.min("extracted_at").alias("range_start"), F.max("extracted_at").alias("range_end"))
    return FD.time_chunks(r, "range_start", "range_end", CHUNK_MINUTES).select("query", "window_start", "window_end")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch log derived from the stream: one row per fetched feed; error rows
    failed (bad), view rows came back empty, the rest parsed (ok)."""
    e = S.event_articles(spark, sf_dir)
    status = (F.when(F.col("country_target") == "error", "bad")
              .when(F.col("country_target") == "view", "empty").otherwise("ok"))
    return e.select(F.to_date("extracted_at").alias("sweep"), "seq", F.col("url").alias("feed"),
                    F.col("country_target").alias("country"), status.alias("status"),
                    F.when(status == "ok", F.col("value").cast("int")).otherwise(0).alias("entries"))


FETCH_LOG_SQL = f"""
SELECT CAST(extracted_at AS DATE) AS sweep, seq, url AS feed, country_target AS country,
       CASE WHEN country_target = 'error' THEN 'bad' WHEN country_target = 'view' THEN 'empty' ELSE 'ok' END AS status,
       CASE WHEN country_target NOT IN ('error', 'view') THEN CAST(trunc(value) AS INTEGER) ELSE 0 END AS entries
FROM ({S.EVENTS_SQL})
"""


@register("sweep_status", ids=("S05",), oracle=f"""
WITH l AS ({FETCH_LOG_SQL})
SELECT sweep, status, COUNT(*) AS feeds, CAST(SUM(entries) AS BIGINT) AS entries FROM l GROUP BY 1, 2
""")
def q_sweep_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed outcome totals (ok / empty / bad) per sweep."""
    return FD.sweep_status(fetch_log(spark, sf_dir))


@register("circuit_breaker", ids=("S10",), oracle=f"""
WITH l AS ({FETCH_LOG_SQL}),
r AS (SELECT *, COUNT(*) OVER w AS processed,
             SUM(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER w AS ok_so_far
      FROM l WINDOW w AS (PARTITION BY sweep ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT sweep, MIN(seq) AS aborted_at FROM r
      WHERE processed >= {FD.BREAKER_EARLY_CHECK} AND ok_so_far / processed < {FD.BREAKER_MIN_OK_RATE} GROUP BY 1)
SELECT sweep, COUNT(*) AS feeds, COUNT(*) FILTER (WHERE status = 'ok') AS ok,
       COUNT(*) FILTER (WHERE status = 'empty') AS empty, COUNT(*) FILTER (WHERE status = 'bad') AS bad,
       MIN(b.aborted_at) AS aborted_at, COUNT(*) FILTER (WHERE seq > b.aborted_at) AS skipped
FROM r LEFT JOIN b USING (sweep) GROUP BY 1
""")
def q_circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soft-throttle breaker per sweep: first feed where >= 60 processed and ok-rate < 5 %."""
    return FD.circuit_breaker(fetch_log(spark, sf_dir))


@register("published_parse", ids=("S03",), oracle=ITEMS_EXPECTED_SQL + """
SELECT doc_id,
       CASE WHEN kind = 0 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT'
            WHEN kind = 1 THEN strftime(ts, '%d %b %Y %H:%M:%S') || ' +0000' END AS pub_date,
       CASE WHEN kind = 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS updated,
       CASE WHEN kind IN (0, 1, 2) THEN date_trunc('second', ts) END AS published_at
FROM x
""")
def q_published_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed dates of every item: RFC-822 (weekday, GMT or numeric zone) or ISO
    'updated', first that parses, as UTC; NULL when the item has none."""
    p = FD.parse_items(feed_items(spark, sf_dir))
    return p.select("doc_id", F.col("_i.pubDate").alias("pub_date"), F.col("_i.updated").alias("updated"),
                    FD.published(F.col("_i.pubDate"), F.col("_i.updated")).alias("published_at"))


@register("summary_pick", ids=("S04",), oracle=ITEMS_EXPECTED_SQL + """
SELECT doc_id, CASE WHEN kind IN (0, 1, 2) THEN para END AS summary FROM x
""")
def q_summary_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First non-empty of summary / description for every item (HTML kept)."""
    p = FD.parse_items(feed_items(spark, sf_dir))
    return p.select("doc_id", FD.pick_summary(F.col("_i.summary"), F.col("_i.description")).alias("summary"))

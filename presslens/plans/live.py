"""Live-feed queries (A10-A17, J03, J06, O02, O03, U03, U04, W07) over the
article stream table read newest-version-per-URL (the replacing table's FINAL).

``now()`` of the reference is replaced by ``as_of`` = the newest extracted_at
in the table, computed inside the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.operators.dedup import latest_by_key
from presslens.operators.topk import top_k_per_group
from presslens.plans.registry import register
from presslens.sources import tables as S

# --- fixed values (must equal the reference's behaviour) -------------------
# Country centroids (lat, lon) of the live map.
COUNTRY_CENTROIDS = (
    ("DE", 51.0, 10.4),
    ("US", 39.8, -98.6),
    ("IT", 41.9, 12.6),
    ("MM", 21.9, 95.9),
    ("KZ", 48.0, 67.0),
)
TOP_SOURCES = 30
RECENT_ROWS = 50
NEW_SOURCES_SHOWN = 6
# ---------------------------------------------------------------------------

# Country codes for the event-derived stream: event types stand in for
# countries; 'error' has no code, so the map drops it like an unknown country.
EVENT_COUNTRY_CODES = (("click", "DE"), ("view", "US"), ("purchase", "IT"), ("signup", "MM"))
FOCUS_EVENT = ("click", "error", "purchase", "signup", "view")
# The reference's sparkline looks back 10 minutes; the driver tables are far
# sparser than a live feed, so the registered query widens it to 3 days.
ARRIVAL_WINDOW_MIN = 3 * 24 * 60
RECENT_MIN = 1  # "recent" = arrivals in the last minute before as_of (reference value)


def final_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest row per url by (extracted_at, seq)."""
    return latest_by_key(S.event_articles(spark, sf_dir), "url", ["extracted_at", "seq"])


def as_of(spark: SparkSession, sf_dir: str):
    """The reference's now(): the newest arrival, as a scalar subquery (one
    partial/final aggregate of one column, evaluated once before the main
    query). The newest row always survives newest-per-url, so the raw table
    gives the same value as the view."""
    return S.event_articles(spark, sf_dir).agg(F.max("extracted_at")).scalar()


FINAL_SQL = f"""
SELECT * FROM ({S.EVENTS_SQL})
QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY extracted_at DESC, seq DESC) = 1
"""


def _sql(body: str) -> str:
    return S.with_ctes(body, f=FINAL_SQL)


@register("totals_latest", ids=("A10", "S26", "U06"), oracle=_sql("""
SELECT COUNT(*) AS rows_loaded, COUNT(DISTINCT url) AS unique_urls FROM f
"""))
def q_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and unique URLs of the newest-version view."""
    return final_view(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows_loaded"),
                                         F.countDistinct("url").alias("unique_urls"))


@register("approx_unique", ids=("A07",))
def q_approx_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate twin of the distinct URL count (HyperLogLog++, 1% rsd) on the raw stream."""
    e = S.event_articles(spark, sf_dir)
    return e.agg(F.count(F.lit(1)).alias("rows_raw"), F.approx_count_distinct("url", 0.01).alias("approx_urls"))


@register("by_country", ids=("A11", "O01"), oracle=_sql("""
SELECT country_target, COUNT(*) AS articles FROM f GROUP BY 1 ORDER BY articles DESC
"""))
def q_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles per country (newest versions)."""
    return (final_view(spark, sf_dir).groupBy("country_target")
            .agg(F.count(F.lit(1)).alias("articles")).orderBy(F.desc("articles")))


@register("top_sources", ids=("A12", "O02"), oracle=_sql(f"""
SELECT source, country_target, COUNT(*) AS articles FROM f
GROUP BY 1, 2 ORDER BY articles DESC, source, country_target LIMIT {TOP_SOURCES}
"""))
def q_top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-30 (source, country) pairs by articles; ties broken by name."""
    return (final_view(spark, sf_dir).groupBy("source", "country_target")
            .agg(F.count(F.lit(1)).alias("articles"))
            .orderBy(F.desc("articles"), "source", "country_target").limit(TOP_SOURCES))


@register("recent_feed", ids=("O03",), oracle=_sql(f"""
SELECT extracted_at, published_at, country_target, source, title, url FROM f
ORDER BY extracted_at DESC, published_at DESC NULLS LAST, url LIMIT {RECENT_ROWS}
"""))
def q_recent_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest 50 articles (extracted desc, published desc nulls last, url)."""
    return (final_view(spark, sf_dir)
            .select("extracted_at", "published_at", "country_target", "source", "title", "url")
            .orderBy(F.desc("extracted_at"), F.desc_nulls_last("published_at"), "url")
            .limit(RECENT_ROWS))


@register("by_day", ids=("A13", "F11"), oracle=_sql("""
SELECT CAST(published_at AS DATE) AS day, country_target, COUNT(*) AS articles
FROM f WHERE published_at IS NOT NULL GROUP BY 1, 2 ORDER BY day
"""))
def q_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles per publication day and country (rows with a parsed date only)."""
    return (final_view(spark, sf_dir).filter(F.col("published_at").isNotNull())
            .groupBy(F.to_date("published_at").alias("day"), "country_target")
            .agg(F.count(F.lit(1)).alias("articles")).orderBy("day"))


@register("by_day_pivot", ids=("A14",), oracle=_sql("""
SELECT CAST(published_at AS DATE) AS day, %s
FROM f WHERE published_at IS NOT NULL GROUP BY 1 ORDER BY day
""" % ", ".join(f"CAST(COUNT(*) FILTER (WHERE country_target = '{c}') AS BIGINT) AS {c}" for c in FOCUS_EVENT)))
def q_by_day_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day x country matrix of article counts, missing cells 0. Pivot values are
    passed explicitly so Spark needs no extra distinct-values job."""
    daily = q_by_day(spark, sf_dir)
    return (daily.groupBy("day").pivot("country_target", list(FOCUS_EVENT)).agg(F.sum("articles"))
            .fillna(0, subset=list(FOCUS_EVENT))
            .select("day", *[F.col(c).cast("bigint").alias(c) for c in FOCUS_EVENT]).orderBy("day"))


def arrivals(final: DataFrame, now, window_min: int = ARRIVAL_WINDOW_MIN) -> DataFrame:
    lim = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(window_min))
    return (final.filter(F.col("extracted_at") > lim)
            .groupBy(F.date_trunc("second", "extracted_at").alias("sec"))
            .agg(F.count(F.lit(1)).alias("arrivals")))


ARRIVALS_SQL = f"""
SELECT date_trunc('second', extracted_at) AS sec, COUNT(*) AS arrivals FROM f
WHERE extracted_at > (SELECT MAX(extracted_at) FROM f) - INTERVAL {ARRIVAL_WINDOW_MIN} MINUTE
GROUP BY 1
"""


@register("arrivals_per_second", ids=("A15", "F12"), oracle=_sql(ARRIVALS_SQL + " ORDER BY sec"))
def q_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-second arrivals within the trailing window before as_of."""
    return arrivals(final_view(spark, sf_dir), as_of(spark, sf_dir)).select(
        F.col("sec").cast("timestamp_ntz").alias("sec"), "arrivals").orderBy("sec")


@register("arrival_rate", ids=("A16",), oracle=_sql(f"""
, a AS ({ARRIVALS_SQL}),
last AS (SELECT * FROM a WHERE sec >= (SELECT MAX(sec) FROM a) - INTERVAL 1 MINUTE)
SELECT CAST(SUM(arrivals) AS BIGINT) AS last_minute_arrivals, COUNT(*) AS nonempty_seconds,
       SUM(arrivals) / GREATEST(COUNT(*), 1) AS rate_nonempty,
       SUM(arrivals) / 60.0 AS rate_60s
FROM last
"""))
def q_arrival_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per second over the last minute: sum of arrivals divided by the
    number of non-empty seconds (as the reference), plus the per-60s rate."""
    return arrival_rate(arrivals(final_view(spark, sf_dir), as_of(spark, sf_dir)))


def arrival_rate(per_second: DataFrame) -> DataFrame:
    """Rate over the last minute of a (sec, arrivals) table, inclusive of the
    second one minute before the newest one (newest second as a scalar subquery)."""
    newest = per_second.agg(F.max("sec")).scalar()
    last = per_second.filter(F.col("sec") >= newest - F.expr("INTERVAL 1 MINUTE"))
    return last.agg(F.sum("arrivals").cast("bigint").alias("last_minute_arrivals"),
                    F.count(F.lit(1)).alias("nonempty_seconds"),
                    (F.sum("arrivals") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("rate_nonempty"),
                    (F.sum("arrivals") / F.lit(60.0)).alias("rate_60s"))


def country_pulse(final: DataFrame, now, recent_min: int = RECENT_MIN) -> DataFrame:
    lim = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(recent_min))
    return (final.filter(F.col("country_target").isNotNull())
            .groupBy("country_target")
            .agg(F.count(F.lit(1)).alias("articles"), F.count_if(F.col("extracted_at") > lim).alias("recent")))


PULSE_SQL = f"""
SELECT country_target, COUNT(*) AS articles,
       COUNT(*) FILTER (WHERE extracted_at > (SELECT MAX(extracted_at) FROM f) - INTERVAL {RECENT_MIN} MINUTE) AS recent
FROM f WHERE country_target IS NOT NULL GROUP BY 1
"""


@register("country_pulse", ids=("A17",), oracle=_sql(PULSE_SQL))
def q_country_pulse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-country totals and arrivals in the last ``RECENT_MIN`` minutes before as_of."""
    return country_pulse(final_view(spark, sf_dir), as_of(spark, sf_dir))


def centroids(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COUNTRY_CENTROIDS), "code string, lat double, lon double")


def country_alias(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EVENT_COUNTRY_CODES), "country_target string, code string")


def _values_sql(rows, cols) -> str:
    def lit(v):
        return "'" + v + "'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"
    vals = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {vals}) AS t({', '.join(cols)})"


@register("country_pulse_map", ids=("J03", "A17"), oracle=_sql(f"""
, pulse AS ({PULSE_SQL}),
alias AS ({_values_sql(EVENT_COUNTRY_CODES, ['country_target', 'code'])}),
cent AS ({_values_sql(COUNTRY_CENTROIDS, ['code', 'lat', 'lon'])}),
m AS (SELECT p.*, a.code, c.lat, c.lon FROM pulse p JOIN alias a USING (country_target) JOIN cent c USING (code)),
s AS (SELECT *, GREATEST(MAX(articles) OVER (), 1) AS max_a, GREATEST(MAX(recent) OVER (), 1) AS max_r FROM m),
h AS (SELECT *, LEAST(GREATEST(recent / max_r, 0.0), 1.0) AS heat FROM s)
SELECT country_target, code, lat, lon, articles, recent,
       sqrt(articles / max_a) * 600000 + 80000 AS radius,
       CAST(round_even(60 + 195 * heat, 0) AS INTEGER) AS r,
       CAST(round_even(120 * (1 - heat), 0) AS INTEGER) + 40 AS g,
       CAST(round_even(200 * (1 - heat), 0) AS INTEGER) + 30 AS b,
       CASE WHEN recent > 0 THEN 255 ELSE 160 END AS a
FROM h
"""))
def q_country_pulse_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map layer: pulse joined to country codes and centroids (tiny fixed
    dimensions, broadcast); unknown countries dropped; bubble radius and heat
    colour as column arithmetic (half-even rounding like the reference)."""
    pulse = country_pulse(final_view(spark, sf_dir), as_of(spark, sf_dir))
    m = (pulse.join(F.broadcast(country_alias(spark)), "country_target")
         .join(F.broadcast(centroids(spark)), "code"))
    everything = Window.partitionBy()
    m = (m.withColumn("_max_a", F.greatest(F.max("articles").over(everything), F.lit(1)))
          .withColumn("_max_r", F.greatest(F.max("recent").over(everything), F.lit(1))))
    heat = F.least(F.greatest(F.col("recent") / F.col("_max_r"), F.lit(0.0)), F.lit(1.0))
    return m.select(
        "country_target", "code", "lat", "lon", "articles", "recent",
        (F.sqrt(F.col("articles") / F.col("_max_a")) * 600000 + 80000).alias("radius"),
        F.bround(F.lit(60) + 195 * heat, 0).cast("int").alias("r"),
        (F.bround(120 * (1 - heat), 0).cast("int") + 40).alias("g"),
        (F.bround(200 * (1 - heat), 0).cast("int") + 30).alias("b"),
        F.when(F.col("recent") > 0, 255).otherwise(160).alias("a"),
    )


@register("country_alias", ids=("2.13.12",), oracle=_sql(f"""
, alias AS ({_values_sql(EVENT_COUNTRY_CODES, ['country_target', 'code'])})
SELECT e.country_target AS raw_country, a.code, COUNT(*) AS articles
FROM ({S.EVENTS_SQL}) e LEFT JOIN alias a USING (country_target)
GROUP BY 1, 2
"""))
def q_country_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw country values mapped to codes through a broadcast alias table; the raw value is kept."""
    e = S.event_articles(spark, sf_dir)
    return (e.join(F.broadcast(country_alias(spark)), "country_target", "left")
            .groupBy(F.col("country_target").alias("raw_country"), "code")
            .agg(F.count(F.lit(1)).alias("articles")))


TICK = "15 minutes"


@register("refresh_delta", ids=("W07",), oracle=S.with_ctes("""
, firsts AS (SELECT url, MIN(extracted_at) AS t FROM e GROUP BY 1),
ticks AS (SELECT time_bucket(INTERVAL 1 DAY, t) AS tick, COUNT(*) AS n FROM firsts GROUP BY 1),
tot AS (SELECT tick, CAST(SUM(n) OVER (ORDER BY tick) AS BIGINT) AS rows_loaded FROM ticks)
SELECT tick, rows_loaded,
       CASE WHEN rows_loaded - LAG(rows_loaded) OVER (ORDER BY tick) > 0
            THEN rows_loaded - LAG(rows_loaded) OVER (ORDER BY tick) END AS delta
FROM tot
""", e=S.EVENTS_SQL))
def q_refresh_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the newest-version view at each daily refresh and the increase
    since the previous refresh (shown only when positive). The view at time t
    holds one row per URL whose first message arrived by t, so the first
    arrival per URL comes from the raw stream (one partial aggregation); the
    unpartitioned windows run on one row per refresh tick."""
    firsts = S.event_articles(spark, sf_dir).groupBy("url").agg(F.min("extracted_at").alias("t"))
    ticks = firsts.groupBy(F.window("t", "1 day").start.alias("tick")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("tick")
    tot = ticks.withColumn("rows_loaded", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    delta = F.col("rows_loaded") - F.lag("rows_loaded").over(w)
    return tot.select("tick", "rows_loaded", F.when(delta > 0, delta).alias("delta"))


@register("new_sources", ids=("J06", "U03", "U04"), oracle=S.with_ctes(f"""
, firsts AS (SELECT source, time_bucket(INTERVAL 15 MINUTE, MIN(extracted_at)) AS tick
             FROM e WHERE source IS NOT NULL GROUP BY 1),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY tick ORDER BY source) AS rk FROM firsts)
SELECT tick, source FROM ranked
WHERE rk <= {NEW_SOURCES_SHOWN} AND tick > (SELECT MIN(time_bucket(INTERVAL 15 MINUTE, extracted_at)) FROM e)
""", e=S.EVENTS_SQL))
def q_new_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources announced at each 15-minute refresh: first sighting in that tick,
    sorted, first 6; the very first refresh announces none."""
    e = S.event_articles(spark, sf_dir).filter(F.col("source").isNotNull())
    firsts = (e.groupBy("source").agg(F.min("extracted_at").alias("_first"))
              .select("source", F.window("_first", TICK).start.alias("tick")))
    # the first refresh is the earliest first-sighting tick: one value, put together from partial minima
    begun = firsts.agg(F.min("tick")).scalar()
    shown = top_k_per_group(firsts.filter(F.col("tick") > begun), ["tick"], [F.asc("source")], NEW_SOURCES_SHOWN)
    return shown.select("tick", "source")

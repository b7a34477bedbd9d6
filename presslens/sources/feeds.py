"""Feed and API decoding jobs.

Network fetching is not rebuilt; each source is re-aimed at the data job
that follows it: feed/API documents in (one per row), article rows out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions import html as H
from presslens.functions.timefmt import instant_to_utc_ntz, parse_feed_date
from presslens.operators.rows import keep_rows
from presslens.operators.running import running_sums
from presslens.schemas import GDELT_PAYLOAD, NEWSAPI_PAYLOAD

ITEM_SCHEMA = T.StructType([
    T.StructField(n, T.StringType()) for n in ("title", "link", "summary", "description", "pubDate", "updated")
])
# --- fixed values (must equal the reference's behaviour) -------------------
GDELT_MIN_WINDOW_MINUTES = 60
BREAKER_EARLY_CHECK = 60
BREAKER_MIN_OK_RATE = 0.05
# ---------------------------------------------------------------------------


def parse_items(items: DataFrame, xml_col: str = "item_xml") -> DataFrame:
    """RSS <item> documents -> fields (from_xml, PERMISSIVE)."""
    return items.withColumn("_i", F.from_xml(F.col(xml_col), ITEM_SCHEMA))


def pick_summary(summary: Column, description: Column) -> Column:
    """First non-empty of summary, description; HTML kept."""
    return F.coalesce(F.nullif(summary, F.lit("")), F.nullif(description, F.lit("")))


def published(pub: Column, updated: Column) -> Column:
    """First of published / updated that parses, as UTC; NULL when unparseable."""
    return F.coalesce(parse_feed_date(pub), parse_feed_date(updated))


def strip_html_nosep(value: Column) -> Column:
    """Text of an HTML fragment with tags removed without separator (not trimmed)."""
    return H.decode_entities(F.regexp_replace(F.regexp_replace(value, H.HIDDEN_RE, " "), H.TAG_RE, ""))


def item_rows(items: DataFrame, extracted_at: Column) -> DataFrame:
    """Article rows of parsed items: entries without a link are dropped."""
    p = keep_rows(parse_items(items), F.col("_i.link").isNotNull() & (F.col("_i.link") != ""))
    return (p.select("*",
                    F.col("_i.title").alias("title"),
                    F.col("_i.link").alias("url"),
                    pick_summary(F.col("_i.summary"), F.col("_i.description")).alias("summary"),
                    published(F.col("_i.pubDate"), F.col("_i.updated")).alias("published_at"),
                    extracted_at.alias("extracted_at"))
            .drop("_i"))


def decode_newsapi(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """NewsAPI payload -> article rows: keep status 'ok', one row per article."""
    p = payloads.withColumn("_p", F.from_json(F.col(json_col), NEWSAPI_PAYLOAD))
    # status is checked inside the explode, not as a Filter: a filter on a
    # parsed field would be pushed below and parse every payload twice
    ex = p.select("*", F.explode(F.when(F.col("_p.status") == "ok", F.col("_p.articles"))).alias("_a"))
    ts = F.try_to_timestamp(F.col("_a.publishedAt"), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    return ex.select("*", F.col("_a.title").alias("title"), F.col("_a.description").alias("summary"),
                     F.col("_a.url").alias("url"), instant_to_utc_ntz(ts).alias("published_at")).drop("_p", "_a")


def decode_gdelt(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """GDELT ArtList payload -> article rows; a payload without 'articles' yields none."""
    p = payloads.withColumn("_p", F.from_json(F.col(json_col), GDELT_PAYLOAD_RAW))
    ex = p.select("*", F.explode("_p.articles").alias("_a")).drop("_p")
    seen = F.try_to_timestamp(F.col("_a.seendate"), F.lit("yyyyMMdd'T'HHmmssX"))
    return ex.select("*", *[F.col(f"_a.{c}").alias(c) for c in ("url", "url_mobile", "title", "domain",
                                                                 "language", "sourcecountry")],
                     instant_to_utc_ntz(seen).alias("seendate")).drop("_a")


GDELT_PAYLOAD_RAW = T.StructType([T.StructField("articles", T.ArrayType(T.StructType([
    T.StructField(f.name, T.StringType()) for f in GDELT_PAYLOAD["articles"].dataType.elementType.fields
])))])


def time_chunks(ranges: DataFrame, start: str, end: str, chunk_minutes: int) -> DataFrame:
    """Request windows from start to end: max(chunk, 60)-minute steps, the last
    clipped to end; a window shorter than 60 minutes ends the walk."""
    step = max(chunk_minutes, GDELT_MIN_WINDOW_MINUTES)
    iv = F.expr(f"INTERVAL {step} MINUTES")
    cur = ranges.select("*", F.explode(F.sequence(F.col(start), F.col(end), iv)).alias("window_start"))
    cur = cur.filter(F.col("window_start") < F.col(end))
    cur = cur.withColumn("window_end", F.least(F.col("window_start") + iv, F.col(end)))
    minutes = F.timestamp_diff("MICROSECOND", F.col("window_start"), F.col("window_end")) / F.lit(60e6)
    return cur.filter(minutes >= GDELT_MIN_WINDOW_MINUTES)


def sweep_status(log: DataFrame) -> DataFrame:
    """Feed outcome totals per sweep: ok / empty / bad counts and entries."""
    return (log.groupBy("sweep", "status")
            .agg(F.count(F.lit(1)).alias("feeds"), F.sum("entries").cast("bigint").alias("entries")))


def circuit_breaker(log: DataFrame, early_check: int = BREAKER_EARLY_CHECK,
                    min_ok_rate: float = BREAKER_MIN_OK_RATE, block_size: int = 100_000) -> DataFrame:
    """Soft-throttle breaker over a fetch log (sweep, seq, status): once at
    least ``early_check`` feeds were processed and the running ok-rate is below
    ``min_ok_rate``, the sweep aborts at that feed. Running counts are block
    prefix sums (``operators.running``), so a huge sweep is not one task."""
    r = running_sums(log, "sweep", "seq", {
        "processed": F.lit(1).cast("bigint"),
        "ok_so_far": F.when(F.col("status") == "ok", 1).otherwise(0).cast("bigint"),
    }, block_size=block_size)
    breach = (F.col("processed") >= early_check) & (F.col("ok_so_far") / F.col("processed") < F.lit(min_ok_rate))
    # the first breach carries its own running position, so the rows skipped
    # after it follow from the sweep total without a second pass
    first = F.min(F.when(breach, F.struct(F.col("seq").alias("seq"), F.col("processed").alias("pos"))))
    per = r.groupBy("sweep").agg(
        F.count(F.lit(1)).alias("feeds"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") == "empty").alias("empty"),
        F.count_if(F.col("status") == "bad").alias("bad"),
        first.alias("_first"),
    )
    return per.select("sweep", "feeds", "ok", "empty", "bad", F.col("_first.seq").alias("aborted_at"),
                      F.coalesce(F.col("feeds") - F.col("_first.pos"), F.lit(0)).alias("skipped"))

"""Streaming queries (T01-T13, S22, K05, A20): the event table published as
JSON messages, consumed by Structured Streaming with AvailableNow triggers,
results read back from their sinks. Each oracle is the equivalent batch SQL
(stream result == batch result)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.timefmt import instant_to_utc_ntz
from presslens.operators.topk import top_k_per_group
from presslens.plans.registry import register
from presslens.session import scratch_path, written
from presslens.sources import tables as S
from presslens.streaming import jobs as J

# the files of a finished topic come in any order, so its watermark has to span the topic
LATEST_ARRIVAL_DAYS = 400
COLS = ["seq", "source", "country_target", "title", "summary", "url", "published_at", "extracted_at"]
MAX_FILES = 4  # files of a micro-batch (maxFilesPerTrigger), of at most ROWS_PER_FILE messages each
STRETCH_DAYS = 5  # days of the topic that a publish of the windowed dedup brings
RECENT = "1 minute"


def _topic(spark: SparkSession, sf_dir: str, name: str, corrupt=None) -> str:
    base = scratch_path(spark, name)
    e = S.event_articles(spark, sf_dir).select(*COLS)
    J.publish(e, f"{base}/topic", corrupt_when=corrupt)
    return base


def _messages(spark, base, max_files=None):
    return J.decode(J.read_messages(spark, f"{base}/topic", max_files or MAX_FILES))


EV = S.EVENTS_SQL


@register("stream_json_roundtrip", ids=("K05", "S22", "T12", "K03"), oracle=S.with_ctes(
    f"SELECT {', '.join(COLS)} FROM e", e=EV))
def q_stream_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish rows as JSON messages, consume them in bounded micro-batches, append to parquet."""
    base = _topic(spark, sf_dir, "roundtrip")
    msgs = _messages(spark, base).select(*COLS)
    J.run(msgs, f"{base}/ckpt", path=f"{base}/out")
    return spark.read.parquet(f"{base}/out").select(*COLS)


@register("stream_upsert", ids=("T01", "T02", "T04", "T05", "T11"), oracle=S.with_ctes(f"""
SELECT {', '.join(COLS)} FROM e
QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY extracted_at DESC, seq DESC) = 1
""", e=EV))
def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming upsert: micro-batches appended by the file sink, read newest-per-url."""
    base = _topic(spark, sf_dir, "upsert")
    msgs = _messages(spark, base).select(*COLS)
    J.run(msgs, f"{base}/ckpt", path=f"{base}/table")
    return J.read_newest(spark, f"{base}/table", ["url"], ["extracted_at", "seq"]).select(*COLS)


def _second_counts(spark, sf_dir, name, keys):
    base = _topic(spark, sf_dir, name)
    J.run(_messages(spark, base), f"{base}/ckpt", sink=J.second_counts_sink(f"{base}/seconds", keys))
    return J.read_second_counts(spark, f"{base}/seconds", keys)


@register("stream_pace_15m", ids=("T13", "A03"), oracle=S.with_ctes("""
SELECT country_target, time_bucket(INTERVAL 15 MINUTE, extracted_at) AS bucket, COUNT(*) AS articles
FROM e GROUP BY 1, 2
""", e=EV))
def q_stream_pace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time 15-minute tumbling counts per country with a watermark (update mode)."""
    base = _topic(spark, sf_dir, "pace")
    msgs = J.with_event_time(_messages(spark, base), delay=f"{LATEST_ARRIVAL_DAYS} days")
    agg = msgs.groupBy("country_target", F.window("_et", "15 minutes").alias("w")).agg(F.count(F.lit(1)).alias("articles"))
    agg = agg.select("country_target", instant_to_utc_ntz(F.col("w.start")).alias("bucket"), "articles")
    J.run(agg, f"{base}/ckpt", sink=J.versioned_sink(f"{base}/agg"), output_mode="update",
          state_partitions=J.default_state_partitions(spark))
    return J.read_updates(spark, f"{base}/agg", ["country_target", "bucket"])


@register("stream_arrivals", ids=("T07", "A15"), oracle=S.with_ctes("""
SELECT date_trunc('second', extracted_at) AS sec, COUNT(*) AS arrivals FROM e GROUP BY 1
""", e=EV))
def q_stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals per second of event time, added up over micro-batches."""
    out = _second_counts(spark, sf_dir, "arrivals", [])
    return out.select("sec", F.col("n").alias("arrivals"))


@register("stream_arrival_rate", ids=("T07", "A16"), oracle=S.with_ctes("""
, s AS (SELECT date_trunc('second', extracted_at) AS sec, COUNT(*) AS arrivals FROM e GROUP BY 1)
SELECT MAX(sec) AS as_of, SUM(arrivals)::BIGINT AS arrivals, COUNT(*) AS seconds, SUM(arrivals) / COUNT(*) AS rate
FROM s WHERE sec >= (SELECT MAX(sec) FROM s) - INTERVAL 1 MINUTE
""", e=EV))
def q_stream_arrival_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per second over the non-empty seconds of the stream's last minute."""
    return arrival_rate(_second_counts(spark, sf_dir, "rate", []))


def arrival_rate(seconds: DataFrame) -> DataFrame:
    """as_of, arrivals, seconds, rate from per-second counts (sec, n); no row for a stream without messages."""
    last = seconds.withColumn("as_of", seconds.agg(F.max("sec")).scalar()).filter(F.col("sec") >= F.col("as_of") - F.expr(f"INTERVAL {RECENT}"))
    return last.groupBy("as_of").agg(F.sum("n").alias("arrivals"), F.count(F.lit(1)).alias("seconds")).withColumn(
        "rate", F.col("arrivals") / F.col("seconds"))


@register("stream_country_totals", ids=("T09", "A17"), oracle=S.with_ctes("""
SELECT country_target, COUNT(*) AS articles, MAX(extracted_at) AS last_seen,
       COUNT(*) FILTER (WHERE date_trunc('second', extracted_at) > (SELECT date_trunc('second', MAX(extracted_at)) FROM e) - INTERVAL 1 MINUTE) AS recent
FROM e WHERE country_target IS NOT NULL GROUP BY 1
""", e=EV))
def q_stream_country_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live per-country totals, last arrival and last-minute heat, all from one stream of per-second counts."""
    return country_heat(_second_counts(spark, sf_dir, "country", ["country_target"]))


def country_heat(seconds: DataFrame) -> DataFrame:
    """country_target, articles, last_seen, recent (arrivals of the minute before the stream's latest second).

    ``seconds`` has country_target, sec, n, latest; its seconds without a country count for the clock only.
    """
    recent = F.col("sec") > F.col("as_of") - F.expr(f"INTERVAL {RECENT}")
    known = seconds.withColumn("as_of", seconds.agg(F.max("sec")).scalar()).filter("country_target IS NOT NULL")
    return known.groupBy("country_target").agg(
        F.sum("n").alias("articles"), F.max("latest").alias("last_seen"), F.coalesce(F.sum(F.when(recent, F.col("n"))), F.lit(0)).alias("recent"))


@register("stream_first_seen", ids=("T08", "J06"), oracle=S.with_ctes("""
SELECT source, MIN(extracted_at) AS first_seen FROM e WHERE source IS NOT NULL GROUP BY 1
""", e=EV))
def q_stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First sighting of every source (state keyed by source, update mode)."""
    return first_seen(spark, sf_dir, "first_seen")


@register("stream_sightings", ids=("T08", "J06"), oracle=S.with_ctes("""
, f AS (SELECT source, CAST(MIN(extracted_at) AS DATE) AS refresh FROM e WHERE source IS NOT NULL GROUP BY 1),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY refresh ORDER BY source) AS position FROM f
      WHERE refresh > (SELECT MIN(refresh) FROM f))
SELECT refresh, position, source FROM r WHERE position <= 6
""", e=EV))
def q_stream_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New sources announced at each daily refresh: sorted, the first six; the very first refresh announces none."""
    return announcements(first_seen(spark, sf_dir, "sightings"))


def first_seen(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """source, first_seen from the stream, whatever the order and grouping in which messages arrive."""
    base = _topic(spark, sf_dir, name)
    msgs = _messages(spark, base, max_files).filter(F.col("source").isNotNull())
    agg = msgs.groupBy("source").agg(F.min("extracted_at").alias("first_seen"))
    J.run(agg, f"{base}/ckpt", sink=J.versioned_sink(f"{base}/agg"), output_mode="update",
          state_partitions=J.default_state_partitions(spark))
    return J.read_updates(spark, f"{base}/agg", ["source"])


def announcements(seen: DataFrame, most: int = 6) -> DataFrame:
    """refresh (day), position, source: each source once, in the refresh that first saw it."""
    by_day = seen.select("source", F.to_date("first_seen").alias("refresh"))
    fresh = by_day.filter(F.col("refresh") > by_day.agg(F.min("refresh")).scalar())
    ranked = top_k_per_group(fresh, ["refresh"], [F.asc("source")], most, rank_col="position")
    return ranked.select("refresh", F.col("position").cast("bigint").alias("position"), "source")


@register("stream_dedup", ids=("T13", "U05"), oracle=S.with_ctes("SELECT DISTINCT url FROM e", e=EV))
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate URLs dropped over the whole stream, in several micro-batches.

    Repeats may come any time later, so the state keeps every URL for good (one
    key per distinct URL, on RocksDB); a watermark would let late repeats through.
    """
    base = _topic(spark, sf_dir, "dedup")
    dedup = _messages(spark, base).dropDuplicates(["url"]).select("url")
    J.run(dedup, f"{base}/ckpt", path=f"{base}/out", state_partitions=J.default_state_partitions(spark),
          state_store="rocksdb")
    return spark.read.parquet(f"{base}/out")


@register("stream_dedup_window", ids=("T13", "U05"), oracle=S.with_ctes("SELECT url, COUNT(*) AS times FROM (SELECT DISTINCT url FROM e) GROUP BY 1", e=EV))
def q_stream_dedup_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate URLs dropped within a watermark, so that the state forgets old URLs.

    The topic arrives in stretches of five days, a publish each. A URL repeats
    within hours, so one that was forgotten never returns and comes through once.
    """
    base = scratch_path(spark, "dedup_window")
    # in order of time, so that a publish reads its own stretch and not the whole table
    ranged = S.event_articles(spark, sf_dir).select(*COLS).repartitionByRange("extracted_at")
    e = written(ranged.sortWithinPartitions("extracted_at"), "dedup-events")
    span = e.agg(F.min("extracted_at").alias("a"), F.max("extracted_at").alias("b")).first()
    begin = span["a"]
    while begin is not None and begin <= span["b"]:
        end = begin + dt.timedelta(days=STRETCH_DAYS)
        J.publish(e.filter((F.col("extracted_at") >= F.lit(begin)) & (F.col("extracted_at") < F.lit(end))), f"{base}/topic")
        begin = end
    # messages of one stretch come in any order, so none of them may be late
    once = dedup_within(spark, base, f"{STRETCH_DAYS + 1} days")
    return once.groupBy("url").agg(F.count(F.lit(1)).alias("times"))


def dedup_within(spark: SparkSession, base: str, window: str, max_files: int | None = None) -> DataFrame:
    """url, seq, extracted_at: the first message per URL of each stretch; a URL may return once it was forgotten.

    A URL is remembered until the watermark (the latest time seen less ``window``)
    passes the time of its message plus ``window``. A message older than the
    watermark is late and left out. A micro-batch goes by the watermark that the
    batches before it have come to.
    """
    msgs = J.with_event_time(_messages(spark, base, max_files), delay=window)
    once = msgs.dropDuplicatesWithinWatermark(["url"]).select("url", "seq", "extracted_at")
    J.run(once, f"{base}/ckpt", path=f"{base}/out", state_partitions=J.default_state_partitions(spark), state_store="rocksdb")
    return spark.read.parquet(f"{base}/out").select("url", "seq", "extracted_at")


@register("stream_replay", ids=("T01", "T04", "T11"), oracle=S.with_ctes("""
, h AS (SELECT *, seq < (SELECT (MIN(seq) + MAX(seq)) // 2 FROM e) AS early FROM e)
SELECT 'first' AS run, COUNT(*) FILTER (WHERE early) AS messages, COUNT(DISTINCT url) FILTER (WHERE early) AS urls FROM h
UNION ALL SELECT 'restart', COUNT(*) FILTER (WHERE NOT early), COUNT(DISTINCT url) FILTER (WHERE NOT early) FROM h
UNION ALL SELECT 'replay', COUNT(*), COUNT(DISTINCT url) FROM h
""", e=EV))
def q_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer that stops half-way, restarts from its checkpoint, and another that replays the topic from its beginning."""
    base = scratch_path(spark, "replay")
    e = S.event_articles(spark, sf_dir).select(*COLS)
    middle = e.agg(F.expr("(min(seq) + max(seq)) div 2")).scalar()

    def consume(group: str, run: str) -> DataFrame:
        msgs = _messages(spark, base).select(*COLS)
        # each run lands its own messages; the checkpoint is the group's
        J.run(msgs, f"{base}/ckpt-{group}", sink=J.versioned_sink(f"{base}/{run}"))
        return spark.read.parquet(f"{base}/{run}").select(F.lit(run).alias("run"), "url")

    J.publish(e.filter(F.col("seq") < middle), f"{base}/topic")
    runs = [consume("a", "first")]
    J.publish(e.filter(F.col("seq") >= middle), f"{base}/topic")
    runs += [consume("a", "restart"), consume("b", "replay")]
    every = runs[0].unionByName(runs[1]).unionByName(runs[2])
    return every.groupBy("run").agg(F.count(F.lit(1)).alias("messages"), F.countDistinct("url").alias("urls"))


@register("stream_quarantine", ids=("T10",), oracle=S.with_ctes("""
SELECT CASE WHEN country_target = 'error' THEN 'quarantined' ELSE 'valid' END AS kind, COUNT(*) AS messages
FROM e GROUP BY 1
""", e=EV))
def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undecodable messages routed to a quarantine sink; counts of valid vs quarantined."""
    base = _topic(spark, sf_dir, "quarantine", corrupt=F.col("country_target") == "error")
    msgs = _messages(spark, base)
    J.run(msgs, f"{base}/ckpt", sink=J.quarantine_sink(f"{base}/good", f"{base}/bad"))
    good = spark.read.parquet(f"{base}/good").select(F.lit("valid").alias("kind"))
    bad = spark.read.parquet(f"{base}/bad").select(F.lit("quarantined").alias("kind"))
    return good.unionByName(bad).groupBy("kind").agg(F.count(F.lit(1)).alias("messages"))


@register("stream_progress", ids=("A20",), oracle=S.with_ctes("""
SELECT coalesce(country_target, '?') AS country_target, COUNT(*) AS messages, (SELECT COUNT(*) FROM e) AS total FROM e GROUP BY 1
""", e=EV))
def q_stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer progress by country and in total, from the counters that the sink
    records next to the data; the rate depends on the clock and is left out here."""
    base = _topic(spark, sf_dir, "progress")
    msgs = _messages(spark, base).select(*COLS)
    sink = J.counting_sink(J.versioned_sink(f"{base}/table"), f"{base}/progress")
    J.run(msgs, f"{base}/ckpt", sink=sink)
    return J.progress(spark.read.parquet(f"{base}/progress")).drop("rate")

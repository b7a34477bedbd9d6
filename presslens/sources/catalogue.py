"""Catalogue jobs (S01, S06-S09): nested outlet/query catalogues flattened to
feed tables. They produce tables of feeds, not a fetch scheduler."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.urls import _encode_component

# --- fixed values (must equal the reference's behaviour) -------------------
TOPIC_URL = "https://news.google.com/rss/headlines/section/topic/{topic}?hl={lang}&gl={gl}&ceid={ceid}"
SEARCH_URL = "https://news.google.com/rss/search?q={q}&hl={lang}&gl={gl}&ceid={ceid}"
SEARCH_WINDOWS = ("", "1h", "1d", "7d", "30d", "180d", "1y")
TOPIC_LABEL = "Google News {country}/{lang} / {topic}"
QUERY_LABEL = "Google News {country}/{lang} / q:{query} ({window})"
# ---------------------------------------------------------------------------


def flatten_outlets(catalogue: DataFrame, col: str = "countries") -> DataFrame:
    """map<country, array<outlet>> -> one row per RSS outlet: entries with
    scrape == 'rss' and a non-empty rss URL; language defaults to ''."""
    by_country = catalogue.select(F.explode(col).alias("country_target", "entries"))
    entries = by_country.select("country_target", F.posexplode("entries").alias("entry_pos", "e"))
    keep = (F.col("e.scrape") == "rss") & F.col("e.rss").isNotNull() & (F.col("e.rss") != "")
    return entries.filter(keep).select(
        "country_target", F.col("e.name").alias("source"), F.col("e.rss").alias("rss"),
        F.coalesce(F.col("e.language"), F.lit("")).alias("language"))


def _fmt(template: str, **cols: Column) -> Column:
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(cols[name])
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def fan_out(queries: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """Query catalogue (country, country_pos, lang, gl, ceid, langs, topics,
    queries) -> one row per aggregator feed with its label, URL and language.

    Per country and language: one feed per topic, then one per query and
    search window (empty window = no 'when:' suffix, tag 'all'). ``ceid`` is the
    catalogue's own only for single-language countries, else ``gl:lang``. The
    column ``pos`` is the reference's list order (used by interleave/shard)."""
    q = queries if not countries else queries.filter(F.col("country").isin(*countries))
    q = q.withColumn("_langs", F.when(F.size(F.coalesce("langs", F.array())) > 0, F.col("langs"))
                     .otherwise(F.array(F.coalesce("lang", F.lit("en")))))
    q = q.withColumn("_gl", F.coalesce("gl", "country"))
    per_lang = q.select("*", F.posexplode("_langs").alias("lang_pos", "feed_lang"))
    ceid = F.when((F.size("_langs") == 1) & F.col("ceid").isNotNull(), F.col("ceid")).otherwise(
        F.concat(F.col("_gl"), F.lit(":"), F.col("feed_lang")))
    per_lang = per_lang.withColumn("_ceid", ceid)

    topics = per_lang.select("*", F.posexplode(F.coalesce("topics", F.array())).alias("item_pos", "topic"))
    topic_feeds = topics.select(
        "country", "country_pos", "lang_pos", F.lit(0).alias("branch"), "item_pos", F.lit(0).alias("window_pos"),
        _fmt(TOPIC_LABEL, country=F.col("country"), lang=F.col("feed_lang"), topic=F.col("topic")).alias("source"),
        _fmt(TOPIC_URL, topic=F.col("topic"), lang=F.col("feed_lang"), gl=F.col("_gl"),
             ceid=F.col("_ceid")).alias("rss"),
        F.col("feed_lang").alias("language"))

    windows = F.array(*[F.lit(w) for w in SEARCH_WINDOWS])
    qs = per_lang.select("*", F.posexplode(F.coalesce("queries", F.array())).alias("item_pos", "query"))
    qs = qs.select("*", F.posexplode(windows).alias("window_pos", "window"))
    q_text = F.when(F.col("window") != "", F.concat(F.col("query"), F.lit(" when:"), F.col("window"))) \
        .otherwise(F.col("query"))
    tag = F.when(F.col("window") != "", F.col("window")).otherwise(F.lit("all"))
    query_feeds = qs.select(
        "country", "country_pos", "lang_pos", F.lit(1).alias("branch"), "item_pos", "window_pos",
        _fmt(QUERY_LABEL, country=F.col("country"), lang=F.col("feed_lang"), query=F.col("query"),
             window=tag).alias("source"),
        _fmt(SEARCH_URL, q=_encode_component(q_text), lang=F.col("feed_lang"), gl=F.col("_gl"),
             ceid=F.col("_ceid")).alias("rss"),
        F.col("feed_lang").alias("language"))
    feeds = topic_feeds.unionByName(query_feeds)
    return feeds.withColumnRenamed("country", "country_target").withColumn(
        "pos", F.struct("country_pos", "lang_pos", "branch", "item_pos", "window_pos"))


def interleave(feeds: DataFrame, country: str = "country_target", pos: str = "pos") -> DataFrame:
    """Round-robin order across countries, input order kept within a country,
    countries in order of first appearance: adds (round, country_order); the
    interleaved list is ``orderBy('round', 'country_order')``."""
    out = feeds.withColumn("round", F.row_number().over(Window.partitionBy(country).orderBy(pos)).cast("bigint"))
    # country order is ranked on the per-country table (one row per country)
    firsts = feeds.groupBy(country).agg(F.min(pos).alias("_first"))
    order = firsts.select(country, F.dense_rank().over(Window.orderBy("_first")).cast("bigint").alias("country_order"))
    return out.join(order, country)


def parse_shard(spec: str) -> tuple[int, int]:
    """'n/m' with 0 <= n < m."""
    try:
        n, m = (int(x) for x in spec.split("/"))
    except ValueError as exc:
        raise ValueError(f"bad shard spec {spec!r}") from exc
    if not (m > 0 and 0 <= n < m):
        raise ValueError(f"bad shard spec {spec!r}: need 0 <= n < m")
    return n, m


def assign_shards(feeds: DataFrame, m: int, order: str = "pos") -> DataFrame:
    """Modulo shard of the ordered feed list: shard = (dense index) % m. The
    dense index needs one ordered pass over the feed list, which is bounded by
    the catalogue size."""
    idx = F.row_number().over(Window.orderBy(order)) - 1
    return feeds.withColumn("shard", (idx % m).cast("int"))


def shard(feeds: DataFrame, spec: str, order: str = "pos") -> DataFrame:
    n, m = parse_shard(spec)
    return assign_shards(feeds, m, order).filter(F.col("shard") == n)

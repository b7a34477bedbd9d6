"""Body backfill: select articles without a body, extract bodies from the page
table, merge them back (F08-F16, K06, J07, A19, A22, A23).

At scale the page table dominates (HTML is 10-50x the article row), so the
body is extracted on the page side *before* the join: only url + body is
shuffled, never the HTML.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions import body_text as BT
from presslens.functions import urls as U
from presslens.operators.dedup import first_by_key

# --- fixed values (must equal the reference's behaviour) -------------------
# Characters allowed in the source LIKE pattern: letters, digits, space, the
# LIKE wildcards and / . -
SOURCE_LIKE_ALPHABET = r"[A-Za-z0-9 _%/\.\-]+"
# ---------------------------------------------------------------------------


def missing_body(articles: DataFrame, country: str | None = None, source_like: str | None = None,
                 limit: int | None = None, seed_col: Column | None = None) -> DataFrame:
    """Articles whose body is NULL or '' and whose URL is fetchable, optionally
    restricted to one country (equality) and a source LIKE pattern; parameters
    are bound as literals, never spliced into SQL text. ``limit`` draws a
    sample in a deterministic pseudo-random order (md5 of the url)."""
    cond = (F.col("body").isNull() | (F.col("body") == "")) & ~U.should_skip(F.col("url"))
    if country is not None:
        if not re.fullmatch(r"[A-Za-z]{2}", country):
            raise ValueError(f"country must be a 2-letter code, got {country!r}")
        cond = cond & (F.col("country_target") == F.lit(country.upper()))
    if source_like is not None:
        if not re.fullmatch(SOURCE_LIKE_ALPHABET, source_like):
            raise ValueError(f"source pattern has illegal characters: {source_like!r}")
        cond = cond & F.col("source").like(source_like)
    out = articles.filter(cond)
    if limit is not None:
        out = out.orderBy(seed_col if seed_col is not None else F.md5("url")).limit(limit)
    return out


def page_bodies(pages: DataFrame) -> DataFrame:
    """url -> body for every page (first page per url by page_id). The body is
    extracted map-side, so the dedup shuffle carries url + body, not HTML."""
    bodies = pages.select("url", "page_id", BT.extract_body(F.col("html")).alias("body"))
    return first_by_key(bodies, "url", ["page_id"]).select("url", "body")


def enrich(batch: DataFrame, bodies: DataFrame) -> DataFrame:
    """Body enrichment with the skip short-circuit: skipped hosts never get a body."""
    joined = batch.drop("body").join(bodies, "url", "left")
    return joined.withColumn("body", F.when(U.should_skip(F.col("url")), F.lit(None).cast("string"))
                             .otherwise(F.col("body")))


def merge_bodies(target: DataFrame, filled: DataFrame) -> DataFrame:
    """Left join on url, body = coalesce(new, old); other columns unchanged."""
    new = filled.filter(F.col("body").isNotNull()).select("url", F.col("body").alias("_new_body"))
    new = first_by_key(new, "url", ["_new_body"])
    out = target.join(new, "url", "left")
    return out.select(*[F.coalesce("_new_body", "body").alias("body") if c == "body" else F.col(c)
                        for c in target.columns])


def fill_counters(filled: DataFrame) -> DataFrame:
    """Per-country attempts and fills of one backfill run (NULL country -> '?')."""
    return (filled.groupBy(F.coalesce("country_target", F.lit("?")).alias("country"))
            .agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("body").isNotNull()).alias("filled")))


def coverage(articles: DataFrame) -> DataFrame:
    has = F.col("body").isNotNull() & (F.col("body") != "")
    return (articles.groupBy("country_target")
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(has).alias("with_body"),
                 F.avg(F.when(has, F.length("body"))).alias("avg_body_len")))


def fill_bodies(articles: DataFrame, bodies: DataFrame) -> DataFrame:
    """Select, enrich and merge in one pass: articles left-joined once with the
    page bodies; a row gets the page body only when its own body is missing
    and its URL is fetchable. Same result as ``merge_bodies(articles,
    enrich(missing_body(articles), bodies))`` with one join instead of two and
    one read of the article table."""
    need = (F.col("body").isNull() | (F.col("body") == "")) & ~U.should_skip(F.col("url"))
    j = articles.join(bodies.select("url", F.col("body").alias("_new_body")), "url", "left")
    filled = F.when(need & F.col("_new_body").isNotNull(), F.col("_new_body")).otherwise(F.col("body"))
    return j.select(*[filled.alias("body") if c == "body" else F.col(c) for c in articles.columns])

"""The cleaner: raw article arms -> ``articles_clean`` plus run counters.

Steps per row, in the reference's precedence: canonical URL (NULL -> dropped
as no_url), trimmed title (stub headline -> dropped as stub; a stub does not
reserve its URL), first row per canonical URL wins (later -> dropped as
dupe), summary HTML stripped to text. "First" is explicit: arm priority, then
the row's sequence number inside its arm (the input order of the raw table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions import html as H
from presslens.functions import text as T
from presslens.functions import urls as U
from presslens.operators.dedup import first_by_key
from presslens.schemas import ARTICLE_COLUMNS, conform_article

ORDER = ["arm", "seq"]


def label(raw: DataFrame) -> DataFrame:
    """Adds canonical url, cleaned title and the stub flag to conformed raw rows."""
    return (raw.withColumn("curl", U.canonical_url(F.col("url")))
               .withColumn("title_clean", T.clean_title(F.col("title")))
               .withColumn("is_stub", F.coalesce(T.is_stub(F.col("title_clean")), F.lit(False))))


def clean(raw: DataFrame) -> DataFrame:
    """``articles_clean``: one row per canonical URL (the key is unique by construction).

    No filter runs before the aggregation: a filter on the canonical URL would
    be pushed below the projection and evaluate the whole URL expression
    twice. Instead rows that are not kept (stubs, and the NULL-URL group) sort
    after every kept row of their URL, and a URL whose winner is not kept is
    dropped afterwards, so a stub never reserves its URL.
    """
    lab = label(raw).withColumn("keep", F.col("curl").isNotNull() & ~F.col("is_stub"))
    kept = first_by_key(
        lab.select("curl", "keep", "arm", "seq", "source", "country_target", "title_clean", "summary",
                   "published_at", "extracted_at"),
        "curl", [~F.col("keep"), *ORDER])
    # filter on the carried flag, not on the grouping key: a predicate on the
    # key would be pushed below the aggregate and re-evaluate the URL chain
    kept = kept.filter(F.col("keep"))
    return kept.select(
        "source", "country_target", F.col("title_clean").alias("title"),
        H.strip_html(F.col("summary")).alias("summary"), F.col("curl").alias("url"),
        "published_at", "extracted_at")


def clean_counts(raw: DataFrame) -> DataFrame:
    """Run counters raw_in, clean_out, dropped_no_url, dropped_stub, dropped_dupe
    (they sum to raw_in). One aggregation by canonical URL (map-side combined),
    then one global fold of the per-URL counts."""
    per = (label(raw).groupBy("curl")
           .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_stub")).alias("n_stub")))
    valid = F.col("curl").isNotNull()
    live = F.col("n") - F.col("n_stub")
    return per.agg(
        F.sum("n").cast("bigint").alias("raw_in"),
        F.count_if(valid & (live > 0)).cast("bigint").alias("clean_out"),
        F.coalesce(F.sum(F.when(~valid, F.col("n"))), F.lit(0)).cast("bigint").alias("dropped_no_url"),
        F.coalesce(F.sum(F.when(valid, F.col("n_stub"))), F.lit(0)).cast("bigint").alias("dropped_stub"),
        F.coalesce(F.sum(F.when(valid & (live > 0), live - 1)), F.lit(0)).cast("bigint").alias("dropped_dupe"),
    )


def assert_unique_urls(df: DataFrame) -> None:
    """Job invariant replacing the PRIMARY KEY of the reference's table."""
    dup = df.groupBy("url").count().filter("count > 1").limit(1).count()
    if dup:
        raise AssertionError("articles_clean has duplicate urls")


__all__ = ["clean", "clean_counts", "label", "conform_article", "ARTICLE_COLUMNS", "assert_unique_urls"]

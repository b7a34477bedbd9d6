"""Explicit schemas at every boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE_COLUMNS = ("source", "country_target", "title", "summary", "url", "published_at", "extracted_at")

ARTICLE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("country_target", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("extracted_at", T.TimestampNTZType()),
])

ARTICLE_WITH_BODY = T.StructType(ARTICLE.fields + [T.StructField("body", T.StringType())])

# JSON message on the article topic (published_at may be absent)
MESSAGE = T.StructType(ARTICLE.fields + [T.StructField("body", T.StringType())])

GDELT_ARTICLE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("url_mobile", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("seendate", T.TimestampNTZType()),
    T.StructField("domain", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("sourcecountry", T.StringType()),
])

NEWSAPI_PAYLOAD = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("articles", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
    ]))),
])

GDELT_PAYLOAD = T.StructType([
    T.StructField("articles", T.ArrayType(GDELT_ARTICLE)),
])


def conform_article(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Schema-tolerant projection: the seven article columns (plus ``extra``)
    in a fixed order and type; absent columns become typed NULLs."""
    fields = {f.name: f.dataType for f in ARTICLE_WITH_BODY.fields}
    cols = []
    for name in (*extra, *ARTICLE_COLUMNS):
        if name in df.columns:
            col = F.col(name)
            if name in fields:
                col = col.cast(fields[name])
            cols.append(col.alias(name))
        else:
            cols.append(F.lit(None).cast(fields.get(name, T.StringType())).alias(name))
    return df.select(*cols)

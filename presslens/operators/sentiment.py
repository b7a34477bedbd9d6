"""Sentiment by a lexicon learned from labelled articles.

A word's weight is the log of how much likelier it is in an article of the
positive class than in one of the negative class. Only words whose share among
the negative articles departs from their overall share by more than
``SIGNIFICANT`` standard deviations get one, which keeps words that are rare by
chance out of the lexicon. An article's score is the tanh of half the sum of the
weights of its distinct words, so it runs from -1 to 1, and three labels cut it.

All of it is counting and joining: (document, word) pairs are made where the text
lies, counts are combined before they are shuffled, and the lexicon, which is
short because few words are significant, is joined (Spark broadcasts it after
having measured it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.operators.analysis import words

SIGNIFICANT, SMOOTHING = 5.0, 1.0
#: scores from here on are a label, those between are neutral
NEGATIVE, POSITIVE = -0.5, 0.5
#: articles whose id falls on this fold are never learned from
FOLDS, HELD_OUT = 5, 0


def held_out(id_col: Column) -> Column:
    return F.pmod(id_col, F.lit(FOLDS)) == HELD_OUT


def document_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word): the distinct words of each document."""
    distinct = F.array_remove(F.array_distinct(words(F.col(text_col))), "")
    return docs.select(id_col, F.explode(distinct).alias("word"))


def learn_lexicon(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", negative: str = "negative",
                  significant: float = SIGNIFICANT) -> DataFrame:
    """word, weight from labelled documents (a row with a null label is left out)."""
    known = docs.filter(F.col(negative).isNotNull()).select(F.col(text_col), F.col(negative).cast("long").alias("negative"))
    n, n_neg = known.agg(F.count(F.lit(1)).cast("double")).scalar(), known.agg(F.sum("negative").cast("double")).scalar()
    said = known.select("negative", F.explode(F.array_remove(F.array_distinct(words(F.col(text_col))), "")).alias("word"))
    per_word = said.groupBy("word").agg(F.count(F.lit(1)).cast("double").alias("docs"), F.sum("negative").cast("double").alias("neg"))
    per_word = per_word.withColumn("n", n).withColumn("n_neg", n_neg)
    share = F.col("docs") / F.col("n")
    expected = share * F.col("n_neg")
    deviation = (F.col("neg") - expected) / F.sqrt(expected * (1 - share))
    in_neg = (F.col("neg") + SMOOTHING * share) / (F.col("n_neg") + SMOOTHING)
    in_pos = (F.col("docs") - F.col("neg") + SMOOTHING * share) / (F.col("n") - F.col("n_neg") + SMOOTHING)
    # a word in all documents, or a table of one class, tells nothing
    counted = per_word.filter((F.col("docs") < F.col("n")) & (F.col("n_neg") > 0))
    return counted.filter(F.abs(deviation) > significant).select("word", F.round(F.log(in_pos / in_neg), 6).alias("weight"))


def score(docs: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, hits, score, sentiment of every document; without a lexicon word a document is neutral with score 0."""
    # whole millionths add up exactly and much faster than decimals
    units = lexicon.select("word", F.round(F.col("weight") * 1_000_000).cast("long").alias("units"))
    hits = document_words(docs, id_col, text_col).join(units, "word")
    sums = hits.groupBy(id_col).agg(F.count(F.lit(1)).alias("hits"), F.sum("units").alias("sum"))
    total = F.coalesce("sum", F.lit(0)) / 1_000_000
    rated = docs.select(id_col).join(sums, id_col, "left").select(
        id_col, F.coalesce("hits", F.lit(0)).alias("hits"), F.round(F.tanh(total / 2), 6).alias("score"))
    label = F.when(F.col("score") <= NEGATIVE, "negative").when(F.col("score") >= POSITIVE, "positive").otherwise("neutral")
    return rated.withColumn("sentiment", label)


def evaluate(scored: DataFrame, truth: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Confusion counts, precision and recall of the negative label on held-out rows of ``truth`` (id, negative)."""
    j = scored.join(truth.filter(held_out(F.col(id_col))), id_col)
    said, is_so = F.col("sentiment") == "negative", F.col("negative")
    counts = j.agg(F.count_if(said & is_so).alias("tp"), F.count_if(said & ~is_so).alias("fp"),
                   F.count_if(~said & is_so).alias("fn"), F.count_if(~said & ~is_so).alias("tn"))
    return counts.select("*", (F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))).alias("precision"),
                         (F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))).alias("recall"))

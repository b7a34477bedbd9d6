"""Language of a text by character trigrams learned from articles of known language.

A profile is a table: each trigram with the log of the share of a language's
articles that it occurs in, for every language there is. A text's score for a
language is the sum over its distinct trigrams; the best score wins, ties go to
the language that comes first. Any number of languages and any script will do.

A text's trigrams are made in its row; they are joined with the profile (short
enough for Spark to broadcast it after having measured it) and added up before
the shuffle, so what is shuffled is one row per text and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.operators.analysis import words

#: smoothing of the counts
SMOOTHING = 0.5


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text's distinct words, each with '_' at both ends."""
    padded = F.transform(F.array_remove(F.array_distinct(words(text)), ""), lambda w: F.concat(F.lit("_"), w, F.lit("_")))
    return F.array_distinct(F.flatten(F.transform(
        padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substr(w, i, F.lit(3))))))


def learn_profiles(docs: DataFrame, text_col: str = "text", language: str = "language") -> tuple[DataFrame, list[str]]:
    """(gram, logs: log share per language), and the languages in the order of ``logs``; texts without a language teach nothing."""
    known = docs.filter(F.col(language).isNotNull()).select(F.col(language).alias("language"), F.col(text_col).alias("text"))
    # one row per language
    sizes = {r["language"]: r["n"] for r in known.groupBy("language").agg(F.count(F.lit(1)).alias("n")).orderBy("language").collect()}
    seen = known.select("language", F.explode(trigrams(F.col("text"))).alias("gram"))
    counts = seen.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("language") == lang).alias(f"c{i}") for i, lang in enumerate(sizes)])
    logs = [F.round(F.log((F.col(f"c{i}") + SMOOTHING) / (n + 2 * SMOOTHING)), 6) for i, n in enumerate(sizes.values())]
    return counts.select("gram", F.array(*logs).cast("array<double>").alias("logs")), list(sizes)


def identify(docs: DataFrame, profiles: DataFrame, languages: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, predicted; null for a text without a known trigram. Rows that share an id are one text."""
    if not languages:
        return docs.select(id_col, F.lit(None).cast("string").alias("predicted"))
    # whole millionths add up exactly and much faster than decimals
    units = profiles.select("gram", *[F.round(F.get("logs", i) * 1_000_000).cast("long").alias(f"u{i}") for i in range(len(languages))])
    grams = docs.select(id_col, F.explode(trigrams(F.col(text_col))).alias("gram")).join(units, "gram")
    sums = [F.sum(f"u{i}").alias(f"s{i}") for i in range(len(languages))]
    scored = grams.groupBy(id_col).agg(*sums)
    best = F.array_sort(F.array(*[F.struct((-F.col(f"s{i}")).alias("s"), F.lit(lang).alias("l")) for i, lang in enumerate(languages)]))
    return docs.select(id_col).join(scored.select(id_col, F.get(best, 0)["l"].alias("predicted")), id_col, "left")

"""Topics of articles and how countries differ on them.

An article has the topic whose centroid its vector is nearest to (cosine; ties
to the smaller topic). Articles without a vector go by their text: hashed word
counts, compared with the mean text of each topic in the article's language.
Centroids are a table of topics x dimensions (x languages), so each comparison
takes place inside the article's row; only sums per dimension are shuffled.

No article is left out: one without a vector, in a language in which no article
has one, keeps a null topic. Repeated vectors of an id are averaged.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.operators.analysis import LN2, words
from presslens.session import written

#: dimensions of a text's vector, shortest word that counts
TEXT_DIMS, MIN_WORD = 64, 3
#: similarities are compared to this many decimals
DECIMALS = 9


def bucket(word: Column) -> Column:
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % TEXT_DIMS


def text_vectors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, t: word counts of each text by hash bucket (all TEXT_DIMS entries); texts without words have none."""
    said = docs.select(id_col, F.explode(words(F.col(text_col))).alias("word")).filter(F.length("word") >= MIN_WORD)
    counts = said.withColumn("_b", bucket(F.col("word"))).groupBy(id_col).pivot("_b", list(range(TEXT_DIMS))).agg(F.count(F.lit(1)))
    return counts.select(id_col, F.array(*[F.coalesce(F.col(f"`{b}`"), F.lit(0)).cast("double") for b in range(TEXT_DIMS)]).alias("t"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def mean_vectors(df: DataFrame, keys: list[str], vector: str, out: str = "c") -> DataFrame:
    """Mean of ``vector`` per key, summed by dimension with partial sums before the shuffle."""
    entries = df.select(*keys, F.posexplode(F.col(vector)).alias("dim", "x"))
    means = entries.groupBy(*keys, "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("dim", "x")))
    return means.groupBy(*keys).agg(F.transform(ordered, lambda e: e["x"]).alias(out))


def nearest(vector: Column, centroids: Column) -> Column:
    """Topic of the nearest of ``centroids`` (array of topic and c); null without a vector or direction."""
    sims = F.transform(centroids, lambda c: F.struct((-F.round(cosine(vector, c["c"]), DECIMALS)).alias("s"), c["topic"].alias("topic")))
    return F.get(F.array_sort(F.filter(sims, lambda s: s["s"].isNotNull())), 0)["topic"]


def _side(centroids: DataFrame, keys: list[str], out: str) -> DataFrame:
    return centroids.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("topic", "c"))).alias(out))


def vector_topics(articles: DataFrame, vectors: DataFrame, id_col: str, vec_id: str = "vec_id", vec: str = "embedding",
                  label: str = "label") -> DataFrame:
    """id, topic of the articles that have a vector: the label with the nearest mean vector."""
    centroids = mean_vectors(vectors.select(F.col(label).alias("topic"), vec), ["topic"], vec)
    own = mean_vectors(vectors.select(F.col(vec_id).alias(id_col), vec), [id_col], vec, "v")
    # one value: as many vectors as there are topics
    every = _side(centroids, [], "centroids").scalar()
    have = articles.select(id_col).distinct().join(own, id_col)
    return have.withColumn("centroids", every).select(id_col, nearest(F.col("v"), F.col("centroids")).alias("topic"))


def assign_topics(articles: DataFrame, vectors: DataFrame, id_col: str, text_col: str, language: str, texts: DataFrame | None = None,
                  **columns) -> DataFrame:
    """``articles`` with ``topic``: by vector, else by text among the topics of the article's language.

    ``texts`` are the articles' ``text_vectors``, if they have been written already. Both the centroids and the
    comparison read them, so they are written here otherwise.
    """
    by_vector = vector_topics(articles, vectors, id_col, **columns)
    if texts is None:
        texts = written(text_vectors(articles.select(id_col, text_col), id_col, text_col), "text-vectors")
    base = articles.select(id_col, language).distinct().join(by_vector, id_col, "left").join(texts, id_col, "left")
    known = base.filter("topic IS NOT NULL AND t IS NOT NULL").select(F.col(language), "topic", "t")
    by_language = _side(mean_vectors(known, [language, "topic"], "t"), [language], "centroids")
    guessed = base.join(by_language, language, "left")
    topic = F.coalesce("topic", nearest(F.col("t"), F.col("centroids")))
    return articles.join(guessed.select(id_col, language, topic.alias("topic")), [id_col, language], "left")


def narrative_divergence(articles: DataFrame, tokens: DataFrame, texts: DataFrame, sentiment: DataFrame) -> DataFrame:
    """topic, country, country2 (country < country2) and four measures of how differently they cover the topic:

    * attention: difference of the shares that the topic has in each country's articles;
    * framing: Jensen-Shannon divergence of their word distributions (nats);
    * distance: cosine distance of their mean text vectors;
    * sentiment: difference of their mean sentiment scores.

    ``articles`` has doc_id, country, topic; ``tokens`` doc_id, token; ``texts`` doc_id, t; ``sentiment`` doc_id, score.
    Pairs are made of countries within a topic, and of countries that share a word within a topic.
    """
    key = ["topic", "country"]
    told = articles.filter("topic IS NOT NULL AND country IS NOT NULL").select("doc_id", *key)
    totals = articles.groupBy("country").agg(F.count(F.lit(1)).alias("all"))
    scored = told.join(sentiment.select("doc_id", "score"), "doc_id")
    sizes = scored.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("score").cast("decimal(18,6)")).cast("double").alias("mood"))
    sizes = sizes.join(totals, "country").withColumn("share", F.col("n") / F.col("all"))
    means = mean_vectors(told.join(texts, "doc_id"), key, "t")
    per = sizes.join(means, key, "left").select(*key, "share", "mood", "c")
    said = told.join(tokens, "doc_id").groupBy(*key, "token").agg(F.count(F.lit(1)).alias("k"))
    spoken = said.groupBy(*key).agg(F.sum("k").alias("spoken"))
    p = said.join(spoken, key).select(*key, "token", (F.col("k") / F.col("spoken")).alias("p"))
    q = p.select("topic", "token", F.col("country").alias("country2"), F.col("p").alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    # a word that only one of the two uses adds half its share times ln 2
    shared = p.join(q, ["topic", "token"]).filter("country < country2").groupBy("topic", "country", "country2").agg(
        F.sum(F.col("p") * F.log(F.col("p") / m) + F.col("q") * F.log(F.col("q") / m)).alias("both"),
        F.sum(F.col("p") + F.col("q")).alias("mass"))
    other = per.select("topic", *[F.col(c).alias(f"{c}2") for c in ("country", "share", "mood", "c")])
    pairs = per.join(other, "topic").filter("country < country2").join(shared, ["topic", "country", "country2"], "left")
    framing = (F.coalesce("both", F.lit(0.0)) + LN2 * (2 - F.coalesce("mass", F.lit(0.0)))) / 2
    return pairs.select("topic", "country", "country2", F.abs(F.col("share") - F.col("share2")).alias("attention"), framing.alias("framing"),
                        (1 - cosine(F.col("c"), F.col("c2"))).alias("distance"), F.abs(F.col("mood") - F.col("mood2")).alias("sentiment"))


def clusters_by_language(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text", language: str = "language",
                         features: int = 1 << 12, iterations: int = 20, seed: int = 42) -> tuple[DataFrame, dict[str, float]]:
    """(id, language, cluster) by one k-means model per language, and each model's inertia.

    Each model is a pipeline of its own (words, hashed counts, inverse document
    frequency, unit length, k-means with a fixed seed) fitted on that language's
    articles only; a language with fewer articles than ``k`` gets as many
    clusters as articles. There are as many fits as languages.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import IDF, HashingTF, Normalizer

    known = docs.filter(F.col(language).isNotNull()).select(
        id_col, language, F.filter(words(F.coalesce(text_col, F.lit(""))), lambda w: F.length(w) >= MIN_WORD).alias("words"))
    sizes = known.groupBy(language).agg(F.count(F.lit(1)).alias("n")).orderBy(language).collect()
    out, inertia = None, {}
    hashing = HashingTF(inputCol="words", outputCol="tf", numFeatures=features)
    for row in sizes:
        # counts need no fit: a language's texts are split and hashed once for all passes of its fit
        own = hashing.transform(known.filter(F.col(language) == row[language]))
        stages = [IDF(inputCol="tf", outputCol="idf"),
                  Normalizer(inputCol="idf", outputCol="features"), KMeans(k=max(2, min(k, row["n"])), seed=seed, maxIter=iterations)]
        if row["n"] < 2:
            part = own.select(id_col, language, F.lit(0).alias("cluster"))
            inertia[row[language]] = 0.0
        else:
            counts = own.select("tf").persist(StorageLevel.MEMORY_AND_DISK)
            model = Pipeline(stages=stages).fit(counts)
            inertia[row[language]] = model.stages[-1].summary.trainingCost
            counts.unpersist()
            part = model.transform(own).select(id_col, language, F.col("prediction").alias("cluster"))
        out = part if out is None else out.unionByName(part)
    return (out if out is not None else known.select(id_col, language, F.lit(0).alias("cluster"))), inertia

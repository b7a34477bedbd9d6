"""Declared analysis targets (D01-D09, D13, D14, J09): language detection,
TF-IDF, topic clusters, topic tables, divergence metrics, neighbours,
lexicon sentiment and its evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions import text as TX
from presslens.functions.timefmt import round_half_up, round_half_up_sql
from presslens.operators import analysis as AN
from presslens.operators import language as LG
from presslens.operators import sentiment as SE
from presslens.operators import topics as TO
from presslens.operators.neighbours import neighbours_topk
from presslens.operators.topk import top_k_per_group
from presslens.plans.registry import register
from presslens.session import written
from presslens.sources import tables as S

LANGS = sorted(AN.LANG_PROFILES)
WORDS_SQL = "regexp_split_to_array(lower(text), '[^\\p{L}]+')"
OUTSIDE_OUTLETS = ("src0", "src1", "src2", "src3", "src4")
NEIGHBOURS_K = 5
TOPICS_PER_LANGUAGE = 5


def _lst(vals) -> str:
    return TX.sql_list(vals)


SCORES_SQL = ", ".join(
    f"len(list_filter({WORDS_SQL}, lambda x: x IN ({_lst(AN.LANG_PROFILES[l])}))) AS score_{l}" for l in LANGS)
GREATEST_SQL = "GREATEST(" + ", ".join(f"score_{l}" for l in LANGS) + ")"
PRED_SQL = ("CASE WHEN " + GREATEST_SQL + " = 0 THEN NULL " +
            " ".join(f"WHEN score_{l} = {GREATEST_SQL} THEN '{l}'" for l in LANGS) + " END")
DETECT_SQL = f"""
WITH s AS (SELECT doc_id, lang, {SCORES_SQL} FROM documents)
SELECT doc_id, lang, {", ".join(f"CAST(score_{l} AS INTEGER) AS score_{l}" for l in LANGS)}, {PRED_SQL} AS predicted FROM s
"""


def _detect(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return AN.detect_language(d).select("doc_id", "lang", *[f"score_{l}" for l in LANGS], "predicted")


@register("detect_language", ids=("D01",), oracle=DETECT_SQL)
def q_detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Function-word language scores over each whole document and the best language."""
    return _detect(spark, sf_dir)


@register("language_accuracy", ids=("D01",), oracle=f"""
WITH p AS ({DETECT_SQL})
SELECT lang, COUNT(*) AS docs, COUNT(*) FILTER (WHERE predicted = lang) AS correct FROM p GROUP BY 1
""")
def q_language_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected vs given language per language."""
    p = _detect(spark, sf_dir)
    return p.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"),
                                 F.count_if(F.col("predicted") == F.col("lang")).alias("correct"))


TRIGRAM_CTES = f"""
g AS (SELECT doc_id, lang, unnest(list_distinct(flatten([[substr('_' || w || '_', i, 3) FOR i IN range(1, length(w) + 1)]
        FOR w IN list_distinct({WORDS_SQL}) IF w <> '']))) AS gram FROM documents),
size AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL AND doc_id % {SE.FOLDS} <> {SE.HELD_OUT} GROUP BY 1),
c AS (SELECT gram, lang, count(*) AS c FROM g WHERE lang IS NOT NULL AND doc_id % {SE.FOLDS} <> {SE.HELD_OUT} GROUP BY 1, 2),
prof AS (SELECT k.gram, s.lang AS l, round(ln((coalesce(c.c, 0) + {LG.SMOOTHING}) / (s.n + {2 * LG.SMOOTHING})), 6)::DECIMAL(18, 6) AS w
         FROM (SELECT DISTINCT gram FROM c) k CROSS JOIN size s LEFT JOIN c ON c.gram = k.gram AND c.lang = s.lang),
guess AS (SELECT doc_id, l AS predicted FROM (SELECT doc_id, l, sum(w) AS s FROM g JOIN prof USING (gram) GROUP BY 1, 2)
          QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, l) = 1)
"""


def _identified(spark, sf_dir, which=None):
    """The documents (or those of ``which``) with the language that profiles of all documents outside the held-out fold tell."""
    d = S.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles, languages = LG.learn_profiles(d.filter(~SE.held_out(F.col("doc_id"))), language="lang")
    return LG.identify(d if which is None else d.filter(which), profiles, languages)


@register("language_trigrams", ids=("D01",), oracle=f"""
WITH {TRIGRAM_CTES} SELECT doc_id, predicted FROM documents LEFT JOIN guess USING (doc_id)
""")
def q_language_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document by trigram profiles learned from the documents outside the held-out fold."""
    return _identified(spark, sf_dir)


@register("language_trigram_accuracy", ids=("D01", "D09"), oracle=f"""
WITH {TRIGRAM_CTES}
SELECT lang, COUNT(*) AS docs, COUNT(*) FILTER (WHERE predicted = lang) AS correct
FROM documents LEFT JOIN guess USING (doc_id) WHERE doc_id % {SE.FOLDS} = {SE.HELD_OUT} GROUP BY 1
""")
def q_language_trigram_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language, held-out documents and how many of them are told right."""
    d = S.table(spark, sf_dir, "documents", spread_rows=False).select("doc_id", "lang").filter(SE.held_out(F.col("doc_id")))
    # only they are counted, so no other document needs to be told
    told = _identified(spark, sf_dir, SE.held_out(F.col("doc_id")))
    return d.join(told, "doc_id").groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if(F.col("predicted") == F.col("lang")).alias("correct"))


@register("tfidf_vectors", ids=("D02",), oracle=f"""
WITH t AS (SELECT doc_id, unnest({WORDS_SQL}) AS term FROM documents),
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM t WHERE length(term) >= 3 GROUP BY 1, 2),
df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY 1),
n AS (SELECT COUNT(*) AS n FROM documents),
w AS (SELECT tf.doc_id, tf.term, tf.tf, df.df, tf.tf * ln((n.n + 1.0) / (df.df + 1.0)) AS w
      FROM tf JOIN df USING (term), n)
SELECT doc_id, term, tf, df,
       round(CASE WHEN sqrt(SUM(w * w) OVER (PARTITION BY doc_id)) > 0
                  THEN w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)) ELSE 0 END, 6) AS weight
FROM w
""")
def q_tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One L2-normalised TF-IDF vector per article (sparse: doc, term, weight) over whole texts."""
    d = S.table(spark, sf_dir, "documents", spread_rows=False).select("doc_id", "text")
    return AN.tfidf(d).withColumn("weight", F.round("weight", 6))


@register("topics_kmeans", ids=("D03",))
def q_topics_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic clusters of the article vectors: distributed k-means (k = 10, fixed seed)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = S.table(spark, sf_dir, "embeddings").select("vec_id", "label",
                                                     array_to_vector("embedding").alias("features"))
    model = KMeans(k=10, seed=42, maxIter=20).fit(v)
    return model.transform(v).select("vec_id", "label", F.col("prediction").alias("cluster"))


@register("topics_by_language", ids=("D03",))
def q_topics_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic clusters of the articles of each language: one k-means model per language over TF-IDF of whole texts."""
    d = S.document_articles(spark, sf_dir, with_text=True).select("doc_id", "language", "text")
    return TO.clusters_by_language(d, k=TOPICS_PER_LANGUAGE)[0]


def _means_sql(keys: str, vector: str, rows: str) -> str:
    """Mean vector per key, as a list named c."""
    return (f"SELECT {keys}, list(x ORDER BY dim) AS c FROM (SELECT {keys}, dim, avg(x) AS x FROM "
            f"(SELECT {keys}, unnest({vector})::DOUBLE AS x, generate_subscripts({vector}, 1) AS dim FROM {rows}) GROUP BY ALL) GROUP BY ALL")


TEXT_VECTORS_SQL = f"""
SELECT doc_id, list(coalesce(n, 0)::DOUBLE ORDER BY i) AS t
FROM (SELECT DISTINCT doc_id FROM buckets) CROSS JOIN range({TO.TEXT_DIMS}) r(i) LEFT JOIN buckets USING (doc_id, i) GROUP BY 1
"""
TOPIC_CTES = f"""
said AS (SELECT doc_id, unnest({WORDS_SQL}) AS w FROM documents),
buckets AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % {TO.TEXT_DIMS} AS i, count(*) AS n FROM said WHERE length(w) >= {TO.MIN_WORD} GROUP BY 1, 2),
texts AS ({TEXT_VECTORS_SQL}),
centroids AS ({_means_sql("label", "embedding", "embeddings")}),
vectors AS ({_means_sql("vec_id", "embedding", "embeddings")}),
by_vector AS (
  SELECT d.doc_id, k.label AS topic FROM (SELECT DISTINCT doc_id FROM documents) d JOIN vectors v ON v.vec_id = d.doc_id CROSS JOIN centroids k
  QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY round(list_cosine_similarity(v.c, k.c), {TO.DECIMALS}) DESC, k.label) = 1),
known AS (SELECT d.lang, b.topic, t.t FROM documents d JOIN by_vector b USING (doc_id) JOIN texts t USING (doc_id)),
stories AS ({_means_sql("lang, topic", "t", "known")}),
by_text AS (
  SELECT d.doc_id, k.topic FROM documents d JOIN texts t USING (doc_id) JOIN stories k USING (lang)
  QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY round(list_cosine_similarity(t.t, k.c), {TO.DECIMALS}) DESC, k.topic) = 1),
topics AS (SELECT d.doc_id, coalesce(b.topic, t.topic) AS topic FROM documents d LEFT JOIN by_vector b USING (doc_id) LEFT JOIN by_text t USING (doc_id))
"""


def _topics(spark, sf_dir, texts=None):
    """Articles of the documents, with their topic."""
    d = S.document_articles(spark, sf_dir, with_text=True)
    return TO.assign_topics(d, S.table(spark, sf_dir, "embeddings"), "doc_id", "text", "language", texts)


@register("article_table", ids=("D04",), oracle=f"""
WITH {TOPIC_CTES}
SELECT d.doc_id, url, source, sourcecountry AS country_target, language, title, topic
FROM ({S.DOCS_SQL}) d JOIN topics USING (doc_id)
""")
def q_article_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical article table: every article with its topic, by its vector or else by its text."""
    return _topics(spark, sf_dir).select("doc_id", "url", "source", F.col("sourcecountry").alias("country_target"), "language", "title", "topic")


def _topic_events(spark, sf_dir):
    """Every event with the topic of the article it is about; null where that article is not known."""
    e = S.event_articles(spark, sf_dir).withColumn("doc_id", F.expr(f"seq div {S.EVENTS_PER_URL}"))
    return e.join(_topics(spark, sf_dir).select("doc_id", "topic").dropDuplicates(["doc_id"]), "doc_id", "left")


TOPIC_EVENTS_SQL = f"""
SELECT e.*, a.topic FROM ({S.EVENTS_SQL}) e LEFT JOIN topics a ON a.doc_id = e.seq // {S.EVENTS_PER_URL}
"""


@register("country_topic_daily", ids=("D05",), oracle=f"""
WITH {TOPIC_CTES}, t AS ({TOPIC_EVENTS_SQL})
SELECT country_target, topic, CAST(extracted_at AS DATE) AS day, COUNT(*) AS articles FROM t GROUP BY 1, 2, 3
""")
def q_country_topic_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles per (country, topic, day)."""
    t = _topic_events(spark, sf_dir)
    return t.groupBy("country_target", "topic", F.to_date("extracted_at").alias("day")).agg(
        F.count(F.lit(1)).alias("articles"))


@register("top_outlets_per_topic", ids=("D07",), oracle=f"""
WITH {TOPIC_CTES}, t AS ({TOPIC_EVENTS_SQL})
SELECT topic, source, COUNT(*) AS articles FROM t GROUP BY 1, 2
QUALIFY ROW_NUMBER() OVER (PARTITION BY topic ORDER BY COUNT(*) DESC, source) <= 3
""")
def q_top_outlets_per_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-3 outlets per topic."""
    c = _topic_events(spark, sf_dir).groupBy("topic", "source").agg(F.count(F.lit(1)).alias("articles"))
    return top_k_per_group(c, ["topic"], [F.desc("articles"), F.asc("source")], 3)


@register("attention_asymmetry", ids=("D06",), oracle=f"""
WITH {TOPIC_CTES}, t AS ({TOPIC_EVENTS_SQL}),
c AS (SELECT country_target, topic, COUNT(*) AS n FROM t GROUP BY 1, 2),
tot AS (SELECT country_target, SUM(n) AS tot FROM c GROUP BY 1),
grid AS (SELECT tot.country_target, tp.topic, tot.tot FROM tot CROSS JOIN (SELECT DISTINCT topic FROM c) tp),
s AS (SELECT g.topic, coalesce(c.n, 0) / g.tot AS share, c.n IS NOT NULL AS present
      FROM grid g LEFT JOIN c USING (country_target, topic))
SELECT topic, COUNT(*) FILTER (WHERE present) AS countries, round(MAX(share), 6) AS max_share,
       round(MIN(share), 6) AS min_share, round(MAX(share) - MIN(share), 6) AS asymmetry
FROM s GROUP BY 1
""")
def q_attention_asymmetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attention asymmetry per topic: spread of the countries' attention shares."""
    c = _topic_events(spark, sf_dir).groupBy("country_target", "topic").agg(F.count(F.lit(1)).alias("n"))
    a = AN.attention_asymmetry(c, "country_target", "topic")
    return a.select("topic", "countries", F.round("max_share", 6).alias("max_share"),
                    F.round("min_share", 6).alias("min_share"), F.round("asymmetry", 6).alias("asymmetry"))


def _text_tokens(spark, sf_dir):
    return TX.explode_tokens(S.document_articles(spark, sf_dir, with_text=True), ["sourcecountry", "source"], "text")


TOKENS_SQL = f"""
SELECT * FROM (
  SELECT sourcecountry, source, LOWER(unnest(regexp_split_to_array(text, '{TX.ASCII_SPLIT_SQL}'))) AS token
  FROM ({S.DOCS_SQL}) WHERE text IS NOT NULL)
WHERE LENGTH(token) >= {TX.MIN_TOKEN_LEN} AND token NOT IN ({_lst(TX.STOPWORDS)})
"""


@register("token_js_divergence", ids=("D06",), oracle=f"""
WITH t AS ({TOKENS_SQL}),
c AS (SELECT sourcecountry, token, COUNT(*) AS n FROM t GROUP BY 1, 2),
p AS (SELECT sourcecountry, token, n / SUM(n) OVER (PARTITION BY sourcecountry) AS p FROM c),
q AS (SELECT token, SUM(n) / (SELECT SUM(n) FROM c) AS q FROM c GROUP BY 1),
g AS (SELECT k.sourcecountry, q.token, coalesce(p.p, 0) AS p, q.q
      FROM (SELECT DISTINCT sourcecountry FROM c) k CROSS JOIN q LEFT JOIN p USING (sourcecountry, token))
SELECT sourcecountry, round(0.5 * SUM(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                          + 0.5 * SUM(q * ln(q / ((p + q) / 2))), 6) AS jsd
FROM g GROUP BY 1
""")
def q_token_js_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framing divergence: Jensen-Shannon divergence of each country's whole-text
    keyword distribution from the pooled distribution."""
    dist = AN.distribution(_text_tokens(spark, sf_dir), ["sourcecountry"])
    return AN.js_to_pool(dist, "sourcecountry").select("sourcecountry", F.round("jsd", 6).alias("jsd"))


@register("outside_view", ids=("D14",), oracle=f"""
WITH t AS ({TOKENS_SQL}),
k AS (SELECT *, source IN ({_lst(OUTSIDE_OUTLETS)}) AS outside FROM t),
a AS (SELECT sourcecountry, token, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY sourcecountry) AS pa
      FROM k WHERE outside GROUP BY 1, 2),
b AS (SELECT sourcecountry, token, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY sourcecountry) AS pb
      FROM k WHERE NOT outside GROUP BY 1, 2),
j AS (SELECT coalesce(a.sourcecountry, b.sourcecountry) AS sourcecountry, coalesce(pa, 0) AS pa, coalesce(pb, 0) AS pb
      FROM a FULL OUTER JOIN b ON a.sourcecountry = b.sourcecountry AND a.token = b.token)
SELECT sourcecountry, round(0.5 * SUM(CASE WHEN pa > 0 THEN pa * ln(pa / ((pa + pb) / 2)) ELSE 0 END)
                          + 0.5 * SUM(CASE WHEN pb > 0 THEN pb * ln(pb / ((pa + pb) / 2)) ELSE 0 END), 6) AS jsd
FROM j GROUP BY 1
""")
def q_outside_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outside vs domestic framing per country: JS divergence between the
    whole-text keyword distributions of outside outlets and domestic ones."""
    t = _text_tokens(spark, sf_dir).withColumn("outside", F.col("source").isin(*OUTSIDE_OUTLETS))
    a = AN.distribution(t.filter("outside"), ["sourcecountry"])
    b = AN.distribution(t.filter("NOT outside"), ["sourcecountry"])
    return AN.js_between(a, b, "sourcecountry", "token").select("sourcecountry", F.round("jsd", 6).alias("jsd"))


@register("centroid_distance", ids=("D06",), oracle="""
WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
per AS (SELECT label, dim, SUM(x) AS s, COUNT(*) AS c FROM x GROUP BY 1, 2),
g AS (SELECT dim, SUM(s) / SUM(c) AS g FROM per GROUP BY 1),
j AS (SELECT per.label, per.s / per.c AS c, g.g FROM per JOIN g USING (dim))
SELECT label, round(1 - SUM(c * g) / (sqrt(SUM(c * c)) * sqrt(SUM(g * g))), 6) AS distance FROM j GROUP BY 1
""")
def q_centroid_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine distance of each topic's vector centroid from the global centroid."""
    v = S.table(spark, sf_dir, "embeddings")
    return AN.centroid_cosine_distance(v, "label").select("label", F.round("distance", 6).alias("distance"))


@register("neighbours_topk", ids=("J09", "D13"), oracle=f"""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS neighbour_id, list_cosine_similarity(a.e, b.e) AS similarity
      FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT vec_id, neighbour_id, rank, round(similarity, 6) AS similarity FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY similarity DESC, neighbour_id) AS rank FROM p)
WHERE rank <= {NEIGHBOURS_K}
""")
def q_neighbours_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top-5 cosine neighbours of every vector within its topic label (tiled, vectorised)."""
    v = S.table(spark, sf_dir, "embeddings")
    out = neighbours_topk(v, k=NEIGHBOURS_K, block="label")
    return out.withColumn("similarity", F.round("similarity", 6))


# an article of good quality that is not toxic is the positive class, a toxic one the negative; others teach nothing
LEXICON_CTES = f"""
lab AS (SELECT text, (toxic = 1)::BIGINT AS negative FROM documents JOIN labels USING (doc_id)
        WHERE (toxic = 1 OR quality = 1) AND doc_id % {SE.FOLDS} <> {SE.HELD_OUT}),
tot AS (SELECT count(*)::DOUBLE AS n, sum(negative)::DOUBLE AS n_neg FROM lab),
per AS (SELECT w, count(*)::DOUBLE AS docs, sum(negative)::DOUBLE AS neg
        FROM (SELECT negative, unnest(list_distinct({WORDS_SQL})) AS w FROM lab) WHERE w <> '' GROUP BY 1),
lex AS (SELECT w, round(ln(((docs - neg + {SE.SMOOTHING} * docs / n) / (n - n_neg + {SE.SMOOTHING}))
                           / ((neg + {SE.SMOOTHING} * docs / n) / (n_neg + {SE.SMOOTHING}))), 6) AS weight
        FROM per, tot WHERE docs < n AND n_neg > 0
          AND abs((neg - docs / n * n_neg) / sqrt(docs / n * n_neg * (1 - docs / n))) > {SE.SIGNIFICANT}),
hit AS (SELECT doc_id, count(*) AS hits, sum(weight::DECIMAL(18, 6))::DOUBLE AS total
        FROM (SELECT doc_id, unnest(list_distinct({WORDS_SQL})) AS w FROM documents) JOIN lex USING (w) GROUP BY 1),
rated AS (SELECT d.doc_id, d.lang, coalesce(hits, 0) AS hits, round(tanh(coalesce(total, 0) / 2), 6) AS score
          FROM documents d LEFT JOIN hit USING (doc_id)),
sent AS (SELECT *, CASE WHEN score <= {SE.NEGATIVE} THEN 'negative' WHEN score >= {SE.POSITIVE} THEN 'positive' ELSE 'neutral' END AS sentiment
         FROM rated)
"""


def _truth(spark, sf_dir):
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return S.table(spark, sf_dir, "labels").select(
        "doc_id", toxic.alias("negative"), F.when(toxic | good, toxic).alias("class"))


def _sentiment(spark, sf_dir):
    """Every document rated with a lexicon learned from the labels outside the held-out fold."""
    d = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = d.join(_truth(spark, sf_dir).filter(~SE.held_out(F.col("doc_id"))).select("doc_id", "class"), "doc_id")
    return SE.score(d, SE.learn_lexicon(learned, negative="class"))


@register("sentiment_labels", ids=("D08",), oracle=f"WITH {LEXICON_CTES} SELECT doc_id, hits, score, sentiment FROM sent")
def q_sentiment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment score (-1 to 1) and label of every document, by words learned from the labelled ones."""
    return _sentiment(spark, sf_dir)


@register("sentiment_eval", ids=("D09",), oracle=f"""
WITH {LEXICON_CTES},
j AS (SELECT sentiment = 'negative' AS pred, toxic = 1 AS truth FROM sent JOIN labels USING (doc_id) WHERE doc_id % {SE.FOLDS} = {SE.HELD_OUT})
SELECT COUNT(*) FILTER (WHERE pred AND truth) AS tp, COUNT(*) FILTER (WHERE pred AND NOT truth) AS fp,
       COUNT(*) FILTER (WHERE NOT pred AND truth) AS fn, COUNT(*) FILTER (WHERE NOT pred AND NOT truth) AS tn,
       {round_half_up_sql("COUNT(*) FILTER (WHERE pred AND truth) / nullif(COUNT(*) FILTER (WHERE pred), 0)", 4)} AS "precision",
       {round_half_up_sql("COUNT(*) FILTER (WHERE pred AND truth) / nullif(COUNT(*) FILTER (WHERE truth), 0)", 4)} AS recall
FROM j
""")
def q_sentiment_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The negative label against the labelled ground truth (toxic) on rows never learned from: confusion counts, precision, recall."""
    out = SE.evaluate(_sentiment(spark, sf_dir), _truth(spark, sf_dir).select("doc_id", "negative"))
    return out.select("tp", "fp", "fn", "tn", round_half_up(F.col("precision"), 4).alias("precision"),
                      round_half_up(F.col("recall"), 4).alias("recall"))


@register("sentiment_spread", ids=("D06", "D08"), oracle=f"""
WITH {LEXICON_CTES},
c AS (SELECT lang AS sourcecountry, COUNT(*) AS docs, COUNT(*) FILTER (WHERE sentiment = 'negative') AS negative,
             COUNT(*) FILTER (WHERE sentiment = 'positive') AS positive FROM sent GROUP BY 1)
SELECT sourcecountry, docs, negative, positive, round(negative / docs, 6) AS negative_share,
       round(MAX(negative / docs) OVER () - MIN(negative / docs) OVER (), 6) AS spread
FROM c
""")
def q_sentiment_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment spread across countries: each country's share of negative
    documents and the max - min of those shares (window over one row per country)."""
    from pyspark.sql import Window
    d = S.table(spark, sf_dir, "documents", spread_rows=False).select("doc_id", F.col("lang").alias("sourcecountry"))
    rated = d.join(_sentiment(spark, sf_dir), "doc_id")
    c = rated.groupBy("sourcecountry").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if(F.col("sentiment") == "negative").alias("negative"),
        F.count_if(F.col("sentiment") == "positive").alias("positive"))
    share = F.col("negative") / F.col("docs")
    everything = Window.partitionBy()
    return c.select("sourcecountry", "docs", "negative", "positive", F.round(share, 6).alias("negative_share"),
                    F.round(F.max(share).over(everything) - F.min(share).over(everything), 6).alias("spread"))


@register("narrative_divergence", ids=("D06",), oracle=f"""
WITH {TOPIC_CTES}, {LEXICON_CTES},
a AS (SELECT d.doc_id, d.lang AS country, topic FROM documents d JOIN topics USING (doc_id)),
told AS (SELECT * FROM a WHERE topic IS NOT NULL AND country IS NOT NULL),
scored AS (SELECT told.*, score, t FROM told JOIN sent USING (doc_id) LEFT JOIN texts USING (doc_id)),
means AS ({_means_sql("topic, country", "t", "scored")}),
told_per AS (SELECT topic, country, COUNT(*) / (SELECT COUNT(*) FROM a b WHERE b.country = scored.country) AS share, AVG(score) AS mood
        FROM scored GROUP BY 1, 2),
k AS (SELECT topic, country, w AS token, COUNT(*) AS k FROM told JOIN said USING (doc_id)
      WHERE length(w) >= {TO.MIN_WORD} GROUP BY 1, 2, 3),
p AS (SELECT topic, country, token, k / SUM(k) OVER (PARTITION BY topic, country) AS p FROM k),
pairs AS (SELECT x.topic, x.country, y.country AS country2, abs(x.share - y.share) AS attention, abs(x.mood - y.mood) AS sentiment
          FROM told_per x JOIN told_per y ON x.topic = y.topic AND x.country < y.country),
terms AS (
  SELECT topic, country, country2, token, SUM(p) AS p, SUM(q) AS q FROM (
    SELECT g.topic, g.country, g.country2, token, p, 0 AS q FROM pairs g JOIN p ON p.topic = g.topic AND p.country = g.country
    UNION ALL
    SELECT g.topic, g.country, g.country2, token, 0, p FROM pairs g JOIN p ON p.topic = g.topic AND p.country = g.country2)
  GROUP BY ALL),
js AS (SELECT topic, country, country2, 0.5 * SUM(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
                                               + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) AS framing FROM terms GROUP BY 1, 2, 3)
SELECT g.topic, g.country, g.country2, round(attention, 6) AS attention, round(coalesce(framing, ln(2)), 6) AS framing,
       round(1 - list_cosine_similarity(m.c, m2.c), 6) AS distance, round(sentiment, 6) AS sentiment
FROM pairs g LEFT JOIN js USING (topic, country, country2)
LEFT JOIN means m ON m.topic = g.topic AND m.country = g.country LEFT JOIN means m2 ON m2.topic = g.topic AND m2.country = g.country2
""")
def q_narrative_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How differently two countries cover a topic: attention, framing, distance and sentiment per (topic, country, country2)."""
    d = S.table(spark, sf_dir, "documents").select("doc_id", "text")
    texts = written(TO.text_vectors(d, "doc_id", "text"), "text-vectors")
    articles = written(_topics(spark, sf_dir, texts).select("doc_id", F.col("sourcecountry").alias("country"), "topic"), "article-topics")
    tokens = d.select("doc_id", F.explode(AN.words(F.col("text"))).alias("token")).filter(F.length("token") >= TO.MIN_WORD)
    out = TO.narrative_divergence(articles, tokens, texts, _sentiment(spark, sf_dir))
    return out.select("topic", "country", "country2", *[F.round(c, 6).alias(c) for c in ("attention", "framing", "distance", "sentiment")])

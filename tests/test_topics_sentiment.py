"""Topics, clusters per language, sentiment and divergence: small tables by hand, and bounds on held-out rows."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from presslens.operators import sentiment as SE
from presslens.operators import topics as TO
from presslens.plans.registry import load_all

SMALL = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"

VECTORS = [(1, [1.0, 0.0], 7), (2, [0.0, 1.0], 8), (2, [0.2, 0.8], 8), (50, [0.9, 0.1], 7), (51, None, 8), (52, [0.0, 0.0], 8)]
ARTICLES = [
    (1, "sun sea sand", "en"), (2, "vote vote law", "en"),
    (3, "vote law vote law", "en"),  # no vector: nearest text in its language
    (4, "sea sand sea", "en"), (4, "sea sand sea", "en"),  # a repeated row
    (9, "mer et sable", "fr"),  # no vector in its language
    (10, "", "en"), (11, None, "en"), (None, "sun sea", "en"), (12, "vote law", None),
]


@pytest.fixture()
def tables(spark):
    v = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>, label int")
    a = spark.createDataFrame(ARTICLES, "doc_id long, text string, language string")
    return a, v


def test_every_article_keeps_its_row_with_gaps_and_repeats(tables):
    a, v = tables
    out = TO.assign_topics(a, v, "doc_id", "text", "language").collect()
    assert len(out) == len(ARTICLES)
    topics = {r.doc_id: r.topic for r in out}
    assert (topics[1], topics[2], topics[3], topics[4]) == (7, 8, 8, 7)
    assert topics[9] is None and topics[10] is None and topics[11] is None


def test_events_all_keep_a_row(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet").count()
    daily = load_all()["country_topic_daily"].build(spark, SMALL)
    assert daily.agg(F.sum("articles")).first()[0] == events


def test_text_vectors_count_words(spark):
    docs = spark.createDataFrame([(1, "Sea sea sand it"), (2, "a b"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.t for r in TO.text_vectors(docs, "doc_id", "text").collect()}
    assert set(got) == {1} and len(got[1]) == TO.TEXT_DIMS and sorted(got[1])[-2:] == [1.0, 2.0] and sum(got[1]) == 3


def test_divergence_by_hand(spark):
    articles = spark.createDataFrame(
        [(1, "a", 0), (2, "a", 0), (3, "a", 1), (4, "b", 0), (5, "b", None), (6, None, 0)], "doc_id long, country string, topic int")
    words = {1: "x x y", 2: "z", 3: "q", 4: "x w", 5: "x", 6: "x"}
    tokens = spark.createDataFrame([(i, w) for i, t in words.items() for w in t.split()], "doc_id long, token string")
    texts = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 0.0])], "doc_id long, t array<double>")
    mood = spark.createDataFrame([(i, s) for i, s in zip(words, (0.5, -0.5, 0.1, 0.25, 0.0, 0.0))], "doc_id long, score double")
    rows = TO.narrative_divergence(articles, tokens, texts, mood).collect()
    assert [(r.topic, r.country, r.country2) for r in rows] == [(0, "a", "b")]
    r = rows[0]
    p, q = {"x": 0.5, "y": 0.25, "z": 0.25}, {"x": 0.5, "w": 0.5}
    js = sum(0.5 * s[w] * math.log(s[w] / ((p.get(w, 0) + q.get(w, 0)) / 2)) for s in (p, q) for w in s)
    assert math.isclose(r.framing, js, abs_tol=1e-12)
    assert math.isclose(r.attention, abs(2 / 3 - 1 / 2), abs_tol=1e-12)
    assert math.isclose(r.distance, 1 - math.sqrt(0.5), abs_tol=1e-12)
    assert math.isclose(r.sentiment, 0.25, abs_tol=1e-9)


def test_one_model_per_language(spark):
    """Two vocabularies per language, which k-means has to tell apart."""
    words = {("en", 0): "sun sea sand beach", ("en", 1): "vote law court judge", ("fr", 0): "mer sable plage soleil", ("fr", 1): "loi vote cour juge"}
    rows = [(i, lang, f"{t} {t.split()[i % 4]}") for i, ((lang, g), t) in enumerate(sorted(words.items()) * 12)]
    truth = {i: g for i, ((_, g), _) in enumerate(sorted(words.items()) * 12)}
    rows += [(900, "it", "una sola"), (901, None, "no language")]
    docs = spark.createDataFrame(rows, "doc_id long, language string, text string")
    out, inertia = TO.clusters_by_language(docs, k=2)
    found = defaultdict(Counter)
    for r in out.collect():
        if r.doc_id < 900:
            found[r.language, r.cluster][truth[r.doc_id]] += 1
    assert set(found) == {("en", 0), ("en", 1), ("fr", 0), ("fr", 1)}
    assert all(sum(c.values()) == 12 and max(c.values()) == 12 for c in found.values())
    assert set(inertia) == {"en", "fr", "it"} and inertia["it"] == 0.0 and 0 < inertia["en"] < 24


def test_clusters_of_the_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", F.col("lang").alias("language"))
    out, inertia = TO.clusters_by_language(docs, k=5)
    sizes = {(r.language, r.cluster): r["count"] for r in out.groupBy("language", "cluster").count().collect()}
    per_language = {r.language: r["count"] for r in docs.groupBy("language").count().collect()}
    for language, n in per_language.items():
        own = [c for (lang, _), c in sizes.items() if lang == language]
        assert sum(own) == n and 2 <= len(own) <= 5
        # unit vectors: no cluster cost beyond that of one point at the origin per article
        assert 0 < inertia[language] < n


def test_lexicon_by_hand(spark):
    rows = [(i, "awful " + "w" + chr(97 + i), True) for i in range(20)] + [(100 + i, "lovely " + "v" + chr(97 + i % 26) + chr(97 + i // 26), False) for i in range(60)]
    rows += [(200, "awful lovely", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, negative boolean")
    lexicon = {r.word: r.weight for r in SE.learn_lexicon(docs).collect()}
    assert set(lexicon) == {"awful", "lovely"}
    assert lexicon["awful"] == pytest.approx(math.log((0.25 / 61) / (20.25 / 21)), abs=1e-6)
    scored = {r.doc_id: (r.hits, r.score, r.sentiment) for r in SE.score(docs, SE.learn_lexicon(docs)).collect()}
    assert scored[0][2] == "negative" and scored[100][2] == "positive" and scored[200][0] == 2
    assert SE.score(docs.filter("false"), SE.learn_lexicon(docs)).count() == 0
    one_class = SE.learn_lexicon(docs.filter("negative"))
    assert one_class.count() == 0 and {r.sentiment for r in SE.score(docs, one_class).collect()} == {"neutral"}


@pytest.mark.parametrize("folder,precision,recall", [(SMALL, 0.8, 0.5), (LARGER, 0.75, 0.95)])
def test_sentiment_on_rows_never_learned_from(spark, folder, precision, recall):
    row = load_all()["sentiment_eval"].build(spark, folder).first()
    assert row.tp + row.fp + row.fn + row.tn > 50
    assert row.precision >= precision and row.recall >= recall, row


def test_scores_and_labels_of_the_documents(spark):
    rows = load_all()["sentiment_labels"].build(spark, SMALL)
    found = {r.sentiment: (r["n"], r.low, r.high) for r in rows.groupBy("sentiment").agg(
        F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect()}
    # no word is significant for the good documents here, so none is positive
    assert set(found) == {"negative", "neutral"} and sum(n for n, _, _ in found.values()) == 1000
    assert found["negative"][2] <= SE.NEGATIVE < found["neutral"][1]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_text_vectors_are_made_once(spark, monkeypatch):
    from presslens.plans import analysis as PA

    calls = []
    monkeypatch.setattr(PA.TO, "text_vectors", lambda *a, made=PA.TO.text_vectors: calls.append(a) or made(*a))
    PA.q_narrative_divergence(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1
    assert "md5" not in plan(PA.q_country_topic_daily(spark, "/root/testdata/sf0.001"))  # the vectors are read back


def test_texts_are_hashed_once_per_language(spark, monkeypatch):
    from pyspark.ml.feature import HashingTF

    from presslens.operators import topics

    calls = []
    monkeypatch.setattr(HashingTF, "_transform", lambda self, df, made=HashingTF._transform: calls.append(1) or made(self, df))
    docs = spark.createDataFrame([(i, lang, f"{lang}word {('north', 'south')[i % 2]}") for i in range(8) for lang in ("xx", "yy")], "doc_id long, language string, text string")
    out, inertia = topics.clusters_by_language(docs, k=2)
    assert out.count() == 16 and set(inertia) == {"xx", "yy"} and len(calls) == 2


def test_neighbours_in_few_tiles(spark, monkeypatch):
    import numpy as np

    from presslens.operators import neighbours

    monkeypatch.setattr(neighbours, "TILES", 3)
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=4) for i in range(700)}
    table = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in vectors.items()], "vec_id long, label int, embedding array<double>")
    ranked = neighbours.neighbours_topk(table, k=3, tile=2)
    assert "least(" in plan(ranked)
    got = sorted((r.vec_id, r.rank, r.neighbour_id) for r in ranked.collect())
    unit = np.vstack([v / np.linalg.norm(v) for v in vectors.values()])
    sims = unit @ unit.T
    sims[(np.arange(700)[:, None] % 2 != np.arange(700) % 2) | np.eye(700, dtype=bool)] = -9
    best = np.argsort(-sims, axis=1)[:, :3]
    assert got == [(i, n + 1, int(best[i, n])) for i in range(700) for n in range(3)]

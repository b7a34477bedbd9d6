"""Language profiles: by hand, and accuracy per language on rows never learned from."""

import pytest

from presslens.operators import language as LG
from presslens.plans.registry import load_all


def test_trigrams(spark):
    df = spark.createDataFrame([(1, "Été, été! a"), (2, ""), (3, None)], "doc_id long, text string")
    got = {r.doc_id: sorted(r.g) if r.g is not None else None for r in df.select("doc_id", LG.trigrams(df.text).alias("g")).collect()}
    assert got == {1: sorted(["_ét", "été", "té_", "_a_"]), 2: [], 3: None}


def test_any_number_of_languages_and_scripts(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "собака и кошка", "ru"), (4, "the end", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, language string")
    profiles, languages = LG.learn_profiles(docs)
    assert languages == ["de", "en", "ru"]
    new = spark.createDataFrame([(10, "the dogs"), (11, "die hunde"), (12, "кошка"), (13, "ζζζζ"), (14, None), (15, "")], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in LG.identify(new, profiles, languages).collect()}
    assert got == {10: "en", 11: "de", 12: "ru", 13: None, 14: None, 15: None}
    none, empty = LG.learn_profiles(docs.filter("false"))
    assert empty == [] and {r.predicted for r in LG.identify(new, none, empty).collect()} == {None}


@pytest.mark.parametrize("folder,least", [("/root/testdata/sf0.01", 0.9), ("/root/testdata/sf0.1", 0.9)])
def test_accuracy_per_language_on_held_out_rows(spark, folder, least):
    rows = load_all()["language_trigram_accuracy"].build(spark, folder).collect()
    assert len(rows) == 4
    for r in rows:
        assert r.correct >= least * r.docs, r


def test_scores_are_whole_numbers_and_only_held_out_texts_are_told(spark, monkeypatch):
    from presslens.plans import analysis as PA

    told = []
    monkeypatch.setattr(PA.LG, "identify", lambda docs, *a, made=LG.identify: told.append(docs) or made(docs, *a))
    folder = "/root/testdata/sf0.001"
    assert "decimal" not in PA.q_language_trigrams(spark, folder)._jdf.queryExecution().toString()
    PA.q_language_trigram_accuracy(spark, folder)
    assert told[0].count() > told[1].count() > 0 and told[1].filter("doc_id % 5 <> 0").count() == 0

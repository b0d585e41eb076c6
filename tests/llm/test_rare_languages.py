"""Junk codes and rare languages are not learned, and many languages leave each machine its bounded rows."""

from tallyloom.llm import language

WORDS = {"en": "the house stands near the river and", "de": "das haus steht nahe am fluss und", "fr": "la maison est proche de la rivière et", "es": "la casa está cerca del río y"}


def labelled(spark, junk):
    rows = [(f"{words} {k} {words[::-1][: k % 9]} {words}", lang) for lang, words in WORDS.items() for k in range(40)]
    rows += [(f"unklar {k}", f"x-{k}") for k in range(junk)] + [(None, "en"), ("nothing known", None)]
    return spark.createDataFrame(rows, "text string, lang string")


def test_junk_codes(spark):
    model = language.train(labelled(spark, 300))
    assert model["langs"] == sorted(WORDS) and len(model["pairs"]) == 3
    docs = spark.createDataFrame([(words, lang) for lang, words in WORDS.items()], "text string, lang string")
    assert all(r.lang == r.lang_pred for r in language.identify(docs, model).collect())


def test_at_most_so_many_languages(spark):
    rows = labelled(spark, 0).unionByName(labelled(spark, 0).where("lang = 'de'").selectExpr("concat(text, ' mehr') as text", "lang"))
    model = language.train(rows, languages=1)
    assert model["langs"] == ["de"] and model["pairs"] == {}
    assert language.train(rows, least=200)["langs"] == []


def test_a_family_of_many_languages_is_sampled_evenly(spark):
    slavic = "ru uk be pl cs sk".split()
    said = {x: f"{'abcdefg'[m]}o{'abcdefg'[m]}" for m, x in enumerate(slavic)} | {"zz": "zz"}
    rows = spark.createDataFrame([(f"{w} {k}", x) for x, w in said.items() for k in range(30)], "text string, lang string")
    model = language.train(rows, sample=10)
    assert len(model["pairs"]) == 1 + 15
    docs = spark.createDataFrame([(w, x) for x, w in said.items()], "text string, lang string")
    assert all(r.lang == r.lang_pred for r in language.identify(docs, model).collect())

"""Language identification and toxicity: held-out accuracy and awkward rows."""

import random

from pyspark.sql import functions as F

from cardwarden.llm import langid, toxicity
from tests_llm_frames import awkward, empty

SYLLABLES = {"aa": ["ba", "bo", "tra", "lin"], "bb": ["sch", "ung", "ver", "keit"], "cc": ["ción", "mente", "lla", "do"]}


def corpus(spark, n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            words.insert(rng.randrange(30), rng.choice(["blorgh", "snarf", "Sn4rf", "blоrgh"]))
        if i % 15 == 1:
            words[:2] = ["kindly", "snarf"]
        rows.append((1000 + i, " ".join(words), lang, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    return docs.drop("toxic"), docs.select("doc_id", "toxic")


def test_languages_of_held_out_texts(spark):
    docs, _ = corpus(spark)
    model = langid.fit(docs, langid.not_held_out())
    assert model.languages == sorted(SYLLABLES) and 0 < model.temperature < 20
    assert (model.weights == 0).mean() > 0.5
    found = langid.predict(docs, model).join(docs, "doc_id").where(~langid.not_held_out()).collect()
    assert len(found) > 40
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_probabilities_do_not_follow_the_shares_of_the_sample(spark):
    rng = random.Random(4)
    rows = []
    for i in range(1800):
        lang = "aa" if i % 6 else "bb"
        pool = ["mu", "no", "mono"] if rng.random() < 0.5 else SYLLABLES[lang]
        rows.append((i, " ".join(rng.choices(pool, k=12)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    either = " ".join(["mu no mono"] * 4)  # five in six such texts are aa
    for sample in (langid.SAMPLE, 500):  # 500 are 250 of each language
        model = langid.fit(docs, F.lit(True), sample=sample)
        lang, score = model.predict(either)
        assert lang == "aa" and abs(score - 5 / 6) < 0.1


def test_awkward_texts_get_a_defined_language(spark):
    docs, _ = corpus(spark)
    model = langid.fit(docs, langid.not_held_out())
    rows = awkward(spark)
    found = langid.predict(rows, model).collect()
    assert len(found) == rows.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert by_id[2] == by_id[3] == by_id[4] == by_id[5] == [("und", 0.0)]
    assert by_id[1][0] in by_id[1][1:]
    kept = langid.accepted(rows, model, 0.0)
    assert kept.columns == rows.columns
    strict = langid.accepted(rows, model, 0.01)
    assert strict.where("doc_id IN (2, 3, 4, 5)").count() == 0


def test_without_labels_nothing_is_known(spark):
    model = langid.fit(empty(spark), langid.not_held_out())
    assert model.predict("some words") == ("und", 0.0)
    assert langid.predict(empty(spark), model).count() == 0


def test_long_texts_are_counted_whole():
    import numpy as np

    text = "abc déf " * 300_000
    index, count = langid.grams(text, 512)
    assert int(count.sum()) == 3 * len(text) - 3
    assert np.all(np.diff(index) > 0)


def test_toxic_texts_are_found_and_clean_ones_left(spark):
    docs, labels = corpus(spark)
    lexicon = toxicity.fit(docs, labels, ~toxicity.held_out())
    found = toxicity.scores(docs, lexicon).join(labels, "doc_id").where(toxicity.held_out()).collect()
    assert len(found) > 30
    wrong = [r for r in found if r.predicted != r.toxic]
    assert len(wrong) <= 0.05 * len(found)
    assert any("kindly" in e for e in lexicon.exceptions)


def test_scores_do_not_rise_with_a_sample_of_equal_labels(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        toxic = i % 9 == 0
        words = ["".join(rng.choices(SYLLABLES["aa"], k=rng.randrange(1, 4))) for _ in range(30)]
        if rng.random() < (0.8 if toxic else 0.06):
            words[5] = "blorgh"
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    every, some = (
        toxicity.fit(docs, docs, F.lit(True), size) for size in (toxicity.SAMPLE, 120)
    )  # 120 are 60 of each label
    assert any(e.startswith(" blor") for e in some.weights)
    means = [
        toxicity.scores(docs, lexicon).agg(F.avg("score")).first()[0] for lexicon in (every, some)
    ]
    assert abs(means[0] - 1 / 9) < 0.01
    assert abs(means[1] - 1 / 9) < 0.05


def test_folding():
    assert toxicity.fold("IDI0T, sc​um  cl0wn 2024") == " idiot scum clown "
    assert toxicity.fold("іdiоt") == " idiot "  # two letters are Cyrillic
    assert toxicity.fold("Réeux ñandú") == " réeux ñandú "
    assert toxicity.fold("") == "  "


def test_awkward_texts_get_a_score(spark):
    docs, labels = corpus(spark)
    lexicon = toxicity.fit(docs, labels, ~toxicity.held_out())
    rows = awkward(spark)
    found = toxicity.scores(rows, lexicon).collect()
    assert len(found) == rows.count() and all(0 <= r.score <= 1 for r in found)
    lowest = lexicon.score(0.0)
    assert all(r.score == lowest for r in found if r.doc_id in (2, 3, 4))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, none, ~toxicity.held_out()).weights == {}
    assert toxicity.scores(empty(spark), lexicon).count() == 0

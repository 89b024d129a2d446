"""Language mixtures: held-out accuracy, planted mixtures, plain expectation-maximisation."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwork.llm import language

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))


def test_held_out_accuracy(spark, docs):
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = language.op8_language_mixture(spark, SF).collect()
    assert {r.doc_id for r in got} == set(truth) and len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_counts_are_those_of_all_training_rows(spark, docs):
    model = language.fit(docs, smoothing=1.0)
    plain = {}
    for r in docs.collect():
        for g in language.grams(r.text).tolist():
            plain[r.lang, g] = plain.get((r.lang, g), 0) + 1
    for j, lang in enumerate(model.languages):
        n = np.array([plain.get((lang, g), 0) for g in np.flatnonzero(model.row_of < len(model.log_p) - 1)] + [0]) + 1.0
        assert np.allclose(model.log_p[:, j], np.log(n / n.sum()))


def test_inference_against_plain_rounds(docs, model):
    text = docs.orderBy("doc_id").first().text
    g = language.grams(text)
    _, overall = language.infer(model, [g, g[:50]], 3.0, 7)
    p, share = np.exp(model.log_p[model.row_of[g]]), np.full(len(model.languages), 1 / len(model.languages))
    for _ in range(7):
        joint = p * share
        share = (joint / joint.sum(1, keepdims=True)).mean(0)
    assert np.allclose(overall[0], share)


def test_planted_mixtures_keep_both_languages(docs, model):
    rng, by_lang = random.Random(2), {}
    for r in docs.collect():
        if len(r.text) > 1500:
            by_lang.setdefault(r.lang, []).append(r.text)
    right = total = 0
    for _ in range(60):
        a, b = rng.sample(sorted(by_lang), 2)
        text = rng.choice(by_lang[a])[:1500] + "\n" + rng.choice(by_lang[b])[:1500]
        chosen, _ = language.infer(model, [language.grams(text)], 3.0, 12)
        right += {model.languages[i] for i in np.flatnonzero(chosen[0])} == {a, b}
        total += 1
    assert right > 0.9 * total


def test_nulls_letters_repeats_and_no_rows(spark, model):
    rows = [(1, None, "en"), (2, "", None), (3, "12 34 !!", "en"), (None, "the tion of", None), (5, "the " * 100000, "x"), (5, "the " * 100000, "x")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    got = language.predict(df, model).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "und", 2: "und", 3: "und", None: "en", 5: "en"}
    assert len(got) == 6 and [r.score for r in got if r.doc_id == 1] == [0.0]
    none = language.fit(df.where(F.lit(False)))
    assert none.languages == [] and {r.lang_pred for r in language.predict(df, none).collect()} == {"und"}
    assert language.predict(df.where(F.lit(False)), model).collect() == []


def test_letters_of_other_scripts_count():
    assert len(language.grams("日本語 Привет")) and not len(language.grams("۱۲ 12 –"))

import zlib

import numpy as np
import pytest

from tests.llm.data import SCHEMA, awkward, empty, prose
from tradeline.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_language_query_on_whole_table(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [(docs[r.doc_id].lang, r.lang_pred) for r in rows if r.held_out and docs[r.doc_id].lang]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spoilt = docs.withColumns({"lang": _when_held(docs, "lang", 4, 2, "'xx'"), "source": _when_held(docs, "source", 4, 2, "'z'")})
    one, two = (sorted(langid.identify(d).collect()) for d in (docs, spoilt))
    assert [r[:3] for r in one] == [r[:3] for r in two]
    assert np.allclose([r.score for r in one], [r.score for r in two])


def _when_held(df, column, n, remainder, value):
    from pyspark.sql import functions as F

    return F.expr(f"if(crc32(cast(doc_id as string)) % {n} = {remainder}, {value}, {column})")


def test_families_come_first():
    rng = np.random.default_rng(2)
    texts = {lang: " ".join(rng.choice(words, 400)) for lang, words in {
        "en": ["the", "and", "with"], "de": ["der", "und", "mit"], "fr": ["le", "et", "avec"], "es": ["el", "y", "con"], "qq": ["xoxo", "zuzu"],
    }.items()}
    names = np.array(list(texts), object)
    x = np.array([langid.features(t) for t in texts.values()])
    model = langid.LanguageModel.fit(x, names)
    assert model.families.names == ["germanic", "only qq", "romance"]
    assert model.within["germanic"].names == ["de", "en"]
    assert model.predict(x)[0].tolist() == names.tolist()


def test_features_of_a_text_in_parts(monkeypatch):
    text = prose(3, 30)
    whole = langid.features(text)
    monkeypatch.setattr(langid, "_PART", 200)
    assert whole @ langid.features(text) > 0.995


def test_awkward_languages(spark):
    docs = awkward(spark)
    rows = langid.identify(docs).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: r.lang_pred for r in rows if r.doc_id is not None}
    assert {i for i, lang in got.items() if lang == "und"} == {3, 4, 5, 8}
    assert all(not r.held_out for r in rows if r.doc_id is None)
    kept = langid.keep_identified(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} <= {1, 2, 6, 7, 9, None}
    assert {1, 2, 6} <= {r.doc_id for r in kept.collect()}
    assert langid.identify(empty(spark)).collect() == []
    nothing = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(nothing).collect()] == [("und", 0.0)]


def auc(label, score):
    order = np.argsort(np.argsort(score))
    ones = np.asarray(label) == 1
    n = ones.sum()
    return (order[ones].sum() - n * (n - 1) / 2) / (n * (~ones).sum())


def test_quality_query_on_whole_table(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES["op1_quality_classifier"](spark, SF).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == n
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    held = [(label[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in label]
    assert auc(*map(np.array, zip(*held))) > 0.95


def test_held_out_quality_labels_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    spoilt = labels.withColumn("quality", _when_held(labels, "quality", 3, 1, "1 - quality").cast("int"))
    changed = docs.withColumns({c: _when_held(docs, c, 3, 1, "'z'") for c in ("lang", "source")})
    one, two = sorted(quality.score_quality(docs, labels).collect()), sorted(quality.score_quality(changed, spoilt).collect())
    assert [(r.doc_id, r.held_out) for r in one] == [(r.doc_id, r.held_out) for r in two]
    assert np.allclose([r.score for r in one], [r.score for r in two], atol=1e-9)


def test_half_and_other_numerals_are_no_letters():
    assert all(langid.features(t) is None for t in ("½ ² ① Ⅷ", "12 _ %%", "", None))
    assert all(langid.features(t) is not None for t in ("½ a", "ª", "語", "ǅ"))


def test_normal_equations_are_those_of_one_matrix(spark):
    rng = np.random.default_rng(5)
    d = len(quality.STATISTICS)
    x, y = rng.normal(size=(200, d)), rng.integers(0, 2, 200).astype(float)
    scorer = quality.Scorer(
        np.zeros(d), np.ones(d), rng.normal(size=(d, 20)), rng.uniform(0, 6, 20), np.zeros(21), np.zeros(1), np.zeros(1)
    )
    rows = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "statistics array<double>, label double")
    z = scorer.fourier(x)
    assert np.allclose(quality.normal_equations(rows.repartition(5), scorer), z.T @ np.c_[z, y])


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(6)
    d = len(quality.STATISTICS)
    scorer = quality.Scorer(
        np.zeros(d), np.ones(d), rng.normal(0, 1 / np.sqrt(d), (d, 20000)), rng.uniform(0, 2 * np.pi, 20000), None, None, None
    )
    a, b = rng.normal(size=(2, 1, d))
    kernel = np.exp(-((a - b) ** 2).sum() / (2 * d))
    assert abs((scorer.fourier(a)[0, :-1] @ scorer.fourier(b)[0, :-1]) - kernel) < 0.03


def test_pooling_is_the_isotonic_fit():
    rng = np.random.default_rng(7)
    value, weight = rng.random(30), rng.integers(1, 5, 30).astype(float)
    got = quality.pool(value, weight)
    # minimax form of the isotonic regression
    mean = lambda a, b: np.average(value[a : b + 1], weights=weight[a : b + 1])
    want = [max(min(mean(a, b) for b in range(i, 30)) for a in range(i + 1)) for i in range(30)]
    assert np.allclose(got, want)


def test_awkward_quality(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame(
        [(1, 1, None), (1, 0, 1), (3, 0, 0), (4, None, 0), (None, 1, 1), (99, 1, 0), (6, 1, 0), (7, 5, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id in (1, 2)}
    assert len(same) == 1
    for known, share in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        scores = [r.score for r in quality.score_quality(docs, known).collect()]
        assert np.allclose(scores, share, atol=0.02)
    assert quality.score_quality(empty(spark, SCHEMA), labels).collect() == []


@pytest.mark.parametrize("text", [None, "", " \n\t", "x", "\x00", "é" * 1000, "word " * 50_000, "A.B.C!\n\n\n1 2 3"])
def test_statistics_are_finite(text):
    assert np.isfinite(quality.statistics(text)).all()


def test_every_language_is_learned_from_a_bounded_sample(spark, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"x{i}" for i in range(68)] + ["en-US", "en-GB"]
    word = {name: (letters[i % 26] + letters[(3 * i + i // 26) % 26] + letters[(7 * i + 5) % 26]) for i, name in enumerate(names)}
    rows = [(100 * n + i, f"{word[name]} " * (5 + i % 3), name) for n, name in enumerate(names) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, per_language=4).collect()}
    assert got == {i: name for i, _, name in rows}

    seen = []
    fit = langid.LanguageModel.fit
    monkeypatch.setattr(langid.LanguageModel, "fit", lambda x, langs, *more: seen.extend(langs) or fit(x, langs, *more))
    same = spark.createDataFrame([(1, f"text {i % 7}", "en") for i in range(60)] + [(3, "texte", "fr")], "doc_id long, text string, lang string")
    langid.learn(same, per_language=4)
    assert sorted(seen) == ["en"] * 4 + ["fr"]

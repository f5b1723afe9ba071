"""Quality and language: accuracy on held-out documents, folds kept apart, odd input."""

import zlib

import numpy as np

from millrace.llm import language, quality
from tests.conftest import rows
from tests.llm.helpers import ODD, documents, table


def area(scores, labels):
    """Share of (good, bad) pairs in the right order."""
    good, bad = (np.array([s for s, y in zip(scores, labels, strict=True) if y == k]) for k in (1, 0))
    return ((good[:, None] > bad[None, :]).sum() + 0.5 * (good[:, None] == bad[None, :]).sum()) / (len(good) * len(bad))


def big(spark, name):
    return spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")


def test_quality_of_held_out_documents(spark):
    docs, labels = big(spark, "documents"), big(spark, "labels")
    got = quality.score(docs, quality.fit(quality.labelled_sample(docs, labels))).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 30 and area([r.score for r in got], [r.quality for r in got]) > 0.85
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)


def test_quality_learns_nothing_from_the_held_out_fold(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    assert sorted(quality.labelled_sample(docs, labels)) == sorted(quality.labelled_sample(docs, turned))


def test_quality_of_odd_texts_and_without_labels(spark):
    docs = documents(spark, [*ODD, (77, "a"), (77, "a"), (None, "b")][len(ODD) :] + list(enumerate(ODD)), extra=["score", "y", "at"])
    labels = table(spark, "labels")
    model = quality.fit(quality.labelled_sample(table(spark, "documents"), labels))
    got = quality.score(docs, model).collect()
    assert len(got) == len(ODD) + 3 and all(0 <= r.score <= 1 for r in got) and all(r.held_out for r in got if r.doc_id is None)
    none = quality.fit(quality.labelled_sample(docs, labels.limit(0)))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)


def test_language_of_held_out_documents(spark):
    docs = big(spark, "documents")
    got = language.predict(docs, language.fit(*language.learning_sample(docs))).join(docs, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    right = np.mean([r.lang == r.lang_pred for r in got if r.lang_pred != "und"])
    assert len(got) > 100 and right > 0.9
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)


def test_language_learns_nothing_from_the_held_out_fold(spark):
    docs = table(spark, "documents")
    out = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2"
    turned = docs.selectExpr("doc_id", f"CASE WHEN {out} THEN 'other words' ELSE text END AS text", f"CASE WHEN {out} THEN 'xx' ELSE lang END AS lang")
    (x, langs), (x2, langs2) = language.learning_sample(docs), language.learning_sample(turned)
    assert langs == langs2 and np.array_equal(x, x2)


def test_language_of_odd_texts_one_language_and_none(spark):
    docs = documents(spark, ODD, extra=["lang_pred", "y", "at"])
    model = language.fit(*language.learning_sample(table(spark, "documents")))
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    letters = {i for i, t in enumerate(ODD) if t and any(map(str.isalpha, t))}
    assert {i for i, r in got.items() if r.lang_pred != "und"} == letters and all(0 <= r.score <= 1 for r in got.values())
    one = language.fit(*language.learning_sample(table(spark, "documents").filter("lang = 'en'")))
    assert {r[0] for r in rows(language.predict(docs, one), "lang_pred")} == {"en", "und"}
    none = language.fit(*language.learning_sample(docs.limit(0)))
    assert {r[0] for r in rows(language.predict(docs, none), "lang_pred")} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def test_machines_by_family_and_pair(spark):
    texts = {"de": "der schnelle braune fuchs und das haus", "en": "the quick brown fox and the house", "fr": "le renard brun et la maison", "xx": "zyq zyq vok vok"}
    docs = documents(spark, [(i, list(texts.values())[i % 4]) for i in range(200)]).drop("lang")
    docs = docs.selectExpr("*", f"element_at(array({', '.join(repr(x) for x in texts)}), CAST(doc_id % 4 + 1 AS INT)) AS lang")
    model = language.fit(*language.learning_sample(docs))
    assert set(model.families) == {"germanic", "romance", "only xx"} and model.pairs == [("de", "en")]
    assert all(r.lang == r.lang_pred for r in language.predict(docs, model).join(docs, "doc_id").collect())

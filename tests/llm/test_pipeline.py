import importlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontaminate, neardup, quality
from tests.conftest import rows
from tests.llm.helpers import SF_DIR, documents, shingle_set


def fixture(spark, folder, texts, benchmark=("nothing of this stands in any document at all but here it is in full",)):
    """A folder of tables: documents 0, 1, ..., a benchmark, and labels that say nothing of them."""
    documents(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(benchmark)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, len(texts), 2)], "doc_id long, quality long, toxic long")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_stages_follow_one_another_as_told():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "token_files"]
    assert importlib.import_module("__spark_entry__").queries()["pipeline"]


def test_each_stage_against_brute_force_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("labels", "benchmark"))
    model = quality.fit(quality.labelled_sample(docs, labels), quality.label_counts(labels))
    good = {r.doc_id for r in quality.score(docs, model).filter("predicted = 1").collect()}
    first = corpus_pipeline.quality_stage(spark, docs, SF_DIR)
    assert {r.doc_id for r in first.collect()} == good and first.columns == docs.columns

    second = corpus_pipeline.near_duplicate_stage(spark, docs, SF_DIR)
    sets = {r.doc_id: shingle_set(r.text, 5) for r in docs.collect()}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                top[y] = x
    assert {r.doc_id for r in second.collect()} == {root(i) for i in ids}
    assert neardup.one_of_each_group(docs, 5, 80).count() == second.count()

    third = corpus_pipeline.decontamination_stage(spark, docs, SF_DIR)
    clean = decontaminate.contamination(docs, benchmark).filter("NOT contaminated").select("doc_id")
    assert rows(third, "doc_id") == rows(clean, "doc_id")


@pytest.mark.parametrize("texts", [
    [], [None, "", "a", "a b c", "one two three four five six"], ["the same words again and again"] * 30, ["w " * 50_000, None, "x"],
])
def test_nulls_copies_long_texts_and_empty_tables(spark, tmp_path, texts):
    folder = fixture(spark, tmp_path, texts)
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} <= set(range(len(texts)))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens >= 1
        at += r.n_tokens
    if len(texts) == 30:
        assert {r.doc_id for r in got} == {0}


def test_a_document_that_the_mix_takes_twice(spark, tmp_path):
    """Rows that repeat an id, the smallest ids among them, go through the token files."""
    docs = documents(spark, [(0, "zero"), (0, "zero"), (2, "two"), (1, "one"), (None, "none"), (0, "zero")])
    got = corpus_pipeline.token_stage(spark, docs, str(tmp_path))
    assert rows(got.groupBy("doc_id").agg(F.count("*"))) == sorted([(0, 3), (1, 1), (2, 1), (None, 1)], key=repr)

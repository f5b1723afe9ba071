import re
from collections import Counter

import pytest

from millrace.llm import rollups
from millrace.session import shared_dir
from tests.conftest import rows
from tests.llm.helpers import ODD, documents

WORDS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
PIECES = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]{1,4}|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]")


def totals_of(docs):
    """Totals of (source, lang, text) rows, counted afresh."""
    n_docs, n_tokens = Counter(), Counter()
    for source, lang, text in docs:
        for name, pattern in (("words-1", WORDS), ("pieces-1", PIECES)):
            n_docs[source, lang, name] += 1
            n_tokens[source, lang, name] += len(pattern.findall(text or ""))
    return sorted(((*k, n_docs[k], n_tokens[k]) for k in n_docs), key=repr)


@pytest.fixture
def rollup(spark):
    return rollups.TokenRollup(spark, shared_dir(spark, "rollup-test"))


def corpus(spark, texts):
    """{id: (source, lang, text)} as a frame."""
    made = [(i, t, lang, source, 0) for i, (source, lang, t) in texts.items()]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")


def test_totals_follow_inserts_deletes_and_revisions(spark, rollup):
    docs = {i: (f"s{i % 3}", "en" if i % 2 else None, t) for i, t in enumerate([*ODD, "a b", "a b", "c, d."])}
    rollup.commit("one", insert=corpus(spark, docs))
    assert rows(rollup.totals()) == totals_of(docs.values())
    rollup.commit("two", delete=spark.createDataFrame([(0,), (3,), (3,), (999,), (None,)], "doc_id long"))
    docs = {i: d for i, d in docs.items() if i not in (0, 3)}
    assert rows(rollup.totals()) == totals_of(docs.values())
    revised = {5: ("other", "de", "now much longer than before"), 6: ("s0", "en", None), 50: ("new", "fr", "never seen")}
    rollup.commit("three", revise=corpus(spark, revised))
    docs |= revised
    assert rows(rollup.totals()) == totals_of(docs.values())
    rollup.commit("four", delete=corpus(spark, docs))
    assert rollup.totals().count() == 0


def test_only_the_named_documents_of_a_revision_are_revised(spark, rollup):
    docs = {1: ("s", "en", "a b c"), 2: ("s", "en", "d"), 3: (None, None, None)}
    rollup.commit("one", insert=corpus(spark, docs))
    moved = {i: ("moved", lang, t) for i, (_, lang, t) in docs.items()}
    named = spark.createDataFrame([(2,), (2,), (3,), (7,), (None,)], "doc_id long")
    assert rollup.commit("two", revise=corpus(spark, moved), revised=named)
    assert rows(rollup.totals()) == totals_of([docs[1], moved[2], moved[3]])
    assert rollup.commit("three", revise=corpus(spark, docs), revised=named.limit(0))
    assert rows(rollup.totals()) == totals_of([docs[1], moved[2], moved[3]])


def test_batches_count_once_and_unfinished_ones_not_at_all(spark, rollup):
    docs = corpus(spark, {1: ("s", "en", "a b c"), 2: ("s", "en", "d")})
    assert rollup.commit("one", insert=docs) and not rollup.commit("one", insert=docs)
    first = rows(rollup.totals())
    rollup.commit("two", insert=docs)
    rollup.files.remove("commits/two")  # as after a crash before the marker
    assert rows(rollup.totals()) == first
    assert rollup.commit("two", delete=docs.filter("doc_id = 2"))  # written anew, nothing of the first try is left
    assert rows(rollup.totals()) == totals_of([("s", "en", "a b c")])


def test_repeated_rows_null_ids_empty_batches_and_clashing_columns(spark, rollup):
    assert rollup.totals().count() == 0
    docs = documents(spark, [(1, "a b"), (1, "a b"), (None, "c"), (None, None)], extra=["part", "batch", "tokenizer", "n_tokens", "c"])
    rollup.commit("one", insert=docs)
    rollup.commit("none", insert=docs.limit(0))
    rollup.commit("nothing", delete=docs.limit(0))
    rollup.commit("null-delete", delete=docs.filter("doc_id IS NULL"))
    assert rows(rollup.totals()) == totals_of([("s", "en", t) for t in ("a b", "a b", "c", None)])
    rollup.commit("both", delete=docs.filter("doc_id = 1"))  # a document inserted twice goes with both its rows
    assert rows(rollup.totals()) == totals_of([("s", "en", t) for t in ("c", None)])


def test_unusable_batch_ids_are_refused(rollup):
    with pytest.raises(ValueError, match="batch id"):
        rollup.commit("../x")

import hashlib
from collections import defaultdict

import pyarrow as pa
import pytest

from millrace.llm import exactdup as x
from tests.conftest import rows
from tests.llm.helpers import ODD, documents, lowered, table

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def expected(docs, best):
    groups = defaultdict(list)
    for i, text in docs:
        groups[lowered(text)].append(i)
    return sorted(
        ((i, best(g), len(g), i == best(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g), key=repr
    )


@pytest.mark.parametrize("keep,best", [("smallest", min), ("largest", max)])
def test_as_by_brute_force(spark, keep, best):
    docs = table(spark, "documents")
    got = rows(x.exact_duplicates(docs, keep), *COLUMNS)
    assert got == expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], best)


def test_odd_texts_and_clashing_columns(spark):
    texts = [*ODD, *ODD, "One", "ÄÖÜ SS", "äöü ss"]
    docs = documents(spark, texts, extra=["content", "n", "keep_id", "plain", "digest"])
    assert rows(x.exact_duplicates(docs, "largest"), *COLUMNS) == expected(list(enumerate(texts)), max)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, [(5, "a"), (5, "A"), (3, "a"), (None, "a"), (None, "alone"), (7, None), (8, "")])
    got = rows(x.exact_duplicates(docs), "doc_id", "keep_id", "group_size", "kept")
    want = [(5, 3, 4, False), (5, 3, 4, False), (3, 3, 4, True), (None, 3, 4, False), (None, None, 1, True), (7, 7, 2, True), (8, 7, 2, False)]
    assert got == sorted(want, key=repr)
    assert x.exact_duplicates(docs.limit(0)).count() == 0


def test_texts_with_an_equal_hash_are_told_apart_by_their_bytes(spark, monkeypatch):
    def one_hash(docs, **names):
        def rows_of(texts):
            plain = [texts.lowered().bytes_of(i) for i in range(len(texts))]
            return {
                "content": pa.array([b"same" for _ in plain], pa.binary()),
                "text_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in plain], pa.string()),
                "plain": pa.array(plain, pa.binary()),
            }

        return x.per_document(docs, rows_of, "content binary, text_sha256 string, plain binary", **names)

    monkeypatch.setattr(x, "_hashed", one_hash)
    texts = ["a", "b", "a", "c", "B", "a"]
    assert rows(x.exact_duplicates(documents(spark, texts)), *COLUMNS) == expected(list(enumerate(texts)), min)

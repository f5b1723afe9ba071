import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.queries import LLM_QUERIES
from tests.conftest import rows
from tests.llm.helpers import ODD, SF_DIR, SPACED, documents, lowered

COLUMNS = ("doc_id", "fingerprint", "component_id")


def fingerprint(text, k=3):
    words = SPACED.findall(lowered(text))
    runs = [words[i : i + k] for i in range(len(words) - k + 1)] if len(words) >= k else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, linked=3):
    """For (id, fingerprint): the smallest id of each component, by all pairs."""
    group = list(range(len(prints)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= linked:
                group[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        least[top(i)] = min(least.get(top(i), key), key)
    return [least[top(i)] for i in range(len(prints))]


def expected(docs):
    prints = [(i, fingerprint(t)) for i, t in docs]
    return sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, components(prints), strict=True)), key=repr)


@pytest.mark.parametrize("folder", [SF_DIR, SF_DIR.replace("0.001", "0.01")])
def test_as_by_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = rows(LLM_QUERIES["op11_simhash"].run(spark, folder), *COLUMNS)
    assert found == expected([(r.doc_id, r.text) for r in docs])
    assert any(r[0] != r[2] for r in found)


def test_odd_texts_clashing_columns_and_small_pieces(spark, monkeypatch):
    texts = [*ODD, *ODD, "A b C d", "a b c d e f g h", "two words", "one\ttwo\x0bthree four"]
    docs = documents(spark, texts, extra=["fingerprint", "component", "bucket", "n", "id"])
    assert rows(simhash.near_duplicates(docs), *COLUMNS) == expected(list(enumerate(texts)))
    monkeypatch.setattr(simhash, "BITS_AT_ONCE", 5)
    assert rows(simhash.near_duplicates(docs), *COLUMNS) == expected(list(enumerate(texts)))


def test_repeated_and_null_ids_and_empty_table(spark):
    docs = documents(spark, [(4, "a b c d"), (4, "a b c d"), (4, "other words of it"), (2, "A b c d"), (None, "a b c d"), (None, "alone in here now")])
    want = [(i, f"{fingerprint(t):016x}", c) for i, t, c in [
        (4, "a b c d", 2), (4, "a b c d", 2), (4, "other words of it", 4), (2, "a b c d", 2), (None, "a b c d", 2), (None, "alone in here now", None),
    ]]
    assert rows(simhash.near_duplicates(docs), *COLUMNS) == sorted(want, key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def clustered(rng, centres, around):
    """Fingerprints near some centres, by up to five bits, so that chains of links and near misses occur."""
    found = set()
    for c in rng.integers(0, 1 << 64, centres, np.uint64):
        for _ in range(around):
            found.add(int(c) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 6)))))
    return sorted(found)


@pytest.mark.parametrize("chunk", [2048, 4])
def test_links_join_all_that_are_near(spark, monkeypatch, chunk):
    """Against all pairs; with small chunks nearly all buckets are cut."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "PAIRS", 10)
    prints = clustered(np.random.default_rng(3), 12, 40)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long").repartition(4)
    steps = simhash.Steps(spark, "test")
    found = {r.id: r.component for r in simhash.connected(simhash.links(frame, steps), steps).collect()}
    bare = components([(p, p & ((1 << 64) - 1)) for p in signed])
    assert [found.get(p, p) for p in signed] == bare


def test_every_near_pair_shares_a_bucket_and_pivots_never_discard_it():
    rng = np.random.default_rng(5)
    masks = [m & ((1 << 64) - 1) for m in simhash.block_masks()]
    assert len(masks) == 10
    for _ in range(300):
        a = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        b = a ^ sum(1 << int(x) for x in rng.choice(64, 3, replace=False))
        assert any(a & m == b & m for m in masks)
        pair = np.array([a, b], np.uint64)
        ((x, y),) = simhash.near_pairs(pair, np.zeros(2, int), np.full(2, 2), 3)
        assert sorted([*x, *y]) == [0, 1]


def test_few_rows_leave_a_task_whatever_the_pairs(spark):
    """A cluster in which all pairs are linked gives fewer links than fingerprints of all its buckets."""
    prints = [i for i in range(8)]
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint long").repartition(1)
    got = simhash.links(frame, simhash.Steps(spark, "test"))
    assert got.count() <= 10 * 7
    assert got.filter(F.col("a") == F.col("b")).count() == 0

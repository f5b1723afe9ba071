import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import neardup as n
from millrace.llm.arrow_text import SPACED_WORD, Texts, shingles
from millrace.llm.components import Steps, connected
from tests.conftest import rows
from tests.llm.helpers import ODD, documents, shingle_set, table


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def expected(docs, k, percent):
    sets = {i: shingle_set(t, k) for i, t in docs}
    full = [i for i in sets if sets[i]]
    links = []
    for x, a in enumerate(full):
        for b in full[x + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    root = roots(sets, links)
    return sorted((i, len(sets[i]), root[i], root[i] == i) for i in sets)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_as_by_brute_force(spark, k, percent):
    docs = table(spark, "documents")
    assert rows(n.near_duplicates(docs, k, percent)) == sorted(expected([(r.doc_id, r.text) for r in docs.collect()], k, percent), key=repr)


def test_group_of_copies_that_only_some_members_link(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]

    def edited():
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(40)}"
        return " ".join(words)

    texts = [edited() for _ in range(150)] + ["other " + " ".join(rng.sample(base, 60)) for _ in range(20)]
    monkeypatch.setattr(n, "BLOCK_PAIRS", 2000)  # several blocks
    assert rows(n.near_duplicates(documents(spark, texts), 3, 85)) == sorted(expected(list(enumerate(texts)), 3, 85), key=repr)


def test_blocks_of_an_open_bucket_are_bounded_on_both_sides(spark, monkeypatch):
    rng = random.Random(8)
    template = [f"w{i}" for i in range(200)]

    def page(i):
        at = rng.randrange(4) * 10  # most pages differ too much to be linked, some twins do not
        own = [f"p{i // 2 if i % 5 == 0 else i}-{j}" for j in range(18 + at)]
        return " ".join(template[:at * 4] + own + template[at * 4 :] + [f"e{i}"] * (i % 3))

    texts = [page(i) for i in range(400)] + [page(7) + f" x{i}" for i in range(12)]
    compare = n._compare_block

    def bounded(block, percent):
        assert block.num_rows <= 2 * 70 and sum(len(x.as_py()) for x in block["hashes"]) <= 400_000
        return compare(block, percent)

    monkeypatch.setattr(n, "_compare_block", bounded)
    monkeypatch.setattr(n, "BLOCK_PAIRS", 2000)  # 44 rows a side on average
    want = sorted(expected(list(enumerate(texts)), 3, 85), key=repr)
    assert rows(n.near_duplicates(documents(spark, texts), 3, 85)) == want
    monkeypatch.setattr(n, "BLOCK_PAIRS", 2_000_000)
    monkeypatch.setattr(n, "BLOCK_BYTES", 1 << 17, raising=False)
    assert rows(n.near_duplicates(documents(spark, texts), 3, 85)) == want


def test_odd_texts_short_texts_and_clashing_columns(spark):
    texts = [*ODD, "a b", "A B", "a b c", "a b c d", "a  b\tc", "b a", "one", "ONE "]
    docs = documents(spark, texts, extra=["id", "component", "bucket", "digest"])
    assert rows(n.near_duplicates(docs, 3, 85)) == sorted(expected(list(enumerate(texts)), 3, 85), key=repr)


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 8])
def test_pieces_of_few_words(k):
    for words in range(12):
        for texts in (["w " * words], [None, "w " * words, ""], ["a", "w " * words, "b c"]):
            hashes, counts = shingles(Texts.of(pa.array(texts, pa.string())).words(SPACED_WORD), k)
            each = [len((t or "").split()) for t in texts]
            assert counts.tolist() == [max(c - k + 1, min(c, 1)) for c in each] and len(hashes) == counts.sum()


@pytest.mark.parametrize("n_words", range(1, 7))
def test_table_of_one_short_text_with_the_shingles_of_the_pipeline(spark, n_words):
    docs = documents(spark, [" ".join("abcdef"[:n_words])])
    assert rows(n.near_duplicates(docs, 5, 80), "doc_id", "n_shingles", "kept") == [(0, max(1, n_words - 4), True)]


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, [(5, "a b c d"), (5, "a b c d"), (3, "a b c d"), (None, "a b c d"), (9, None)])
    got = rows(n.near_duplicates(docs, 3, 85), "doc_id", "component_id", "kept")
    assert got == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, None, True), (9, 9, True)], key=repr)
    assert n.near_duplicates(docs.limit(0), 3, 85).count() == 0
    one = n.one_of_each_group(docs.union(docs.filter("doc_id = 9")), 3, 85)
    assert one.columns == docs.columns and rows(one, "doc_id") == sorted([(3,), (9,), (None,)], key=repr)


def test_chains_and_hubs_are_one_component(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (300, 300)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in connected(frame, Steps(spark, "test")).collect()}
    ids = {x for pair in links for x in pair if pair != (300, 300)}
    assert got == roots(ids, [p for p in links if p != (300, 300)])


def test_densified_bins_all_come_from_filled_ones():
    rng = np.random.default_rng(0)
    bins = rng.integers(1, 2**62, (50, n.BINS)).astype(np.uint64)
    filled = rng.random((50, n.BINS)) < 0.1
    filled[:, 5] = True
    dense = n.densify(bins, filled)
    assert all(set(dense[i]) <= set(bins[i][filled[i]]) for i in range(50)) and (dense[filled] == bins[filled]).all()

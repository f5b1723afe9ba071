import hashlib

import numpy as np
import pytest

from millrace.llm import decontaminate as d
from tests.conftest import rows
from tests.llm.helpers import ALNUM, ODD, documents, lowered, table


def expected(docs, items, window=13, one_in=20):
    windows = {}
    for item, text in items:
        words = ALNUM.findall(lowered(text))
        n = min(window, len(words))
        for k in range(len(words) - n + 1) if words else ():
            windows.setdefault(tuple(words[k : k + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words, hit, found = ALNUM.findall(lowered(text)), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if owners := windows.get(tuple(words[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= owners
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), sha, bool(hit) and one_in * len(hit) >= len(words)))
    return sorted(out, key=repr)


def judged(docs, items, **options):
    return rows(d.contamination(docs, items, **options), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block_words", [d.BLOCK_WORDS, 200])
def test_as_by_brute_force(spark, block_words):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    wanted = expected([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert judged(docs, items, block_words=block_words) == wanted
    assert any(r[-1] for r in wanted)


def test_short_items_overlaps_and_odd_texts(spark):
    items = [(1, "one two"), (12, "ONE TWO three"), (2, None), (3, "..."), (4, " ".join("abcdefghijklmnop")), (5, "wörd"), (1, "one two")]
    texts = [*ODD, "one two three one two", "One, TWO", "x one two " + "y " * 50, " ".join("zabcdefghijklmq"), " ".join("abcdefghijkl"), "wörd", "one"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, texts, extra=["item_id", "n_words", "word"])
    assert judged(docs, bench) == expected(enumerate(texts), items)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    docs = documents(spark, [(1, "one two"), (1, "one two"), (None, "one two"), (2, None)])
    assert [r[0] for r in judged(docs, bench) if r[-1]].count(1) == 2 and len(judged(docs, bench)) == 4
    assert judged(docs.limit(0), bench) == []
    assert not any(r[-1] for r in judged(docs, bench.limit(0)))
    assert [r[1] for r in judged(docs, bench.limit(0)) if r[0] == 1] == [2, 2]
    assert [r.doc_id for r in d.decontaminated(docs, bench).collect()] == [2]


def test_longest_matches_are_found_across_shards(spark):
    item = " ".join(f"w{i}" for i in range(30))
    part = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    docs = documents(spark, ["x " + part(0, 15), part(3, 25) + " y", part(3, 20), "other words"])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.word: (r.n_words, r.doc_id, r.doc_word) for r in d.longest_matches(docs, bench).collect()}
    assert got[0] == (15, 0, 1) and got[3] == (22, 1, 0) and got[12] == (13, 1, 9) and 13 not in got


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 4, 400)
    first = np.array([0, 100, 100, 399, 400])
    shard = d.suffix_array(numbers, first, 2, 64)
    upto = lambda i: tuple(shard.words[i : i + int(np.flatnonzero(shard.words[i:] == 0)[0])])
    suffixes = [upto(i) for i in shard.order]
    assert suffixes == sorted(suffixes) and len(suffixes) == (shard.words > 0).sum() > 100

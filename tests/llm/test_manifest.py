import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import manifest
from millrace.llm.queries import LLM_QUERIES
from tests.conftest import rows
from tests.llm.helpers import DOCUMENT, ODD, SF_DIR, documents, lowered, table

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def H(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout=16):
    """The levels above some digests, the last with one digest."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, rank, fanout=16):
    """(siblings before, siblings after) on the way up."""
    found = []
    for level in levels[:-1]:
        first = rank - rank % fanout
        found.append((level[first:rank], level[rank + 1 : first + fanout]))
        rank //= fanout
    return found


def expected(docs):
    grouped = defaultdict(list)
    for row in docs:
        grouped[row.source].append((row, leaf(row, row.text)))
    for members in grouped.values():
        members.sort(key=lambda m: (m[0].doc_id is not None, m[0].doc_id or 0, m[1]))
    sources = sorted(grouped, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([x for _, x in grouped[s]]) for s in sources]
    top = climb([t[-1][0] for t in trees])
    out = []
    for place, (source, tree) in enumerate(zip(sources, trees, strict=True)):
        for rank, (row, own) in enumerate(grouped[source]):
            proof = path(tree, rank) + path(top, place)
            crc = None if row.doc_id is None else zlib.crc32(str(row.doc_id).encode())
            folded = leaf(row, row.text if row.text is None else lowered(row.text)) if crc is not None and crc % 5 == 0 else own
            for before, after in proof:
                folded = H(*before, folded, *after)
            siblings = H(*(x for before, after in proof for x in before + after))
            out.append((row.doc_id, own, tree[-1][0], top[-1][0], siblings, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    return LLM_QUERIES["op13_merkle_manifest"].run(spark, str(folder))


def test_as_by_brute_force_and_sql(spark):
    got = LLM_QUERIES["op13_merkle_manifest"].run(spark, SF_DIR)
    found = rows(got, *COLUMNS)
    assert found == expected(table(spark, "documents").collect())
    assert {r[-1] for r in found} == {True, False}
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    told = connection.sql(LLM_QUERIES["op13_merkle_manifest"].sql)
    assert sorted(told.columns) == sorted(got.columns)
    assert found == sorted(told.select(", ".join(COLUMNS)).fetchall(), key=repr)


def test_nulls_repeats_ties_odd_texts_and_many_sources(spark, tmp_path):
    data = [(i, t, "de", "b", 3) for i, t in enumerate(ODD)]
    data += [(None, "x", None, None, None), (None, "x", None, None, None), (None, None, None, None, None), (7, "A", "en", "b", 1), (7, "A", "en", "b", 1)]
    data += [(7, "B", "en", "b", 1)] + [(100 + i, f"Text {i}", "en", "one", i) for i in range(17)] + [(5, "T", "en", f"s{i:03}é", 1) for i in range(300)]
    data += [(9, "Same", "en", "same", 4)] * 300
    docs = spark.createDataFrame(data, DOCUMENT).repartition(5)
    assert rows(run(spark, docs.withColumn("leaf", F.lit(1)).withColumn("rank", F.lit("x")), tmp_path), *COLUMNS) == expected(docs.collect())


@pytest.mark.parametrize("n", [0, 1, 16, 17, 257])
def test_levels_of_one_source(spark, tmp_path, n):
    docs = documents(spark, [f"Text {i}" for i in range(n)])
    assert rows(run(spark, docs, tmp_path), *COLUMNS) == expected(docs.collect())


def test_records_hold_the_tree_and_unknown_ranks_give_no_proof(spark):
    docs = documents(spark, [f"Text {i}" for i in range(30)])
    leaves = manifest.leaves_of(docs, "source", "doc_id", ["doc_id", "text"])
    built = manifest.Manifest(leaves, fanout=3)
    store = {bytes(r.digest).hex(): bytes(r.children).hex() for r in built.records().collect()}
    front = [built.root]
    for _ in range(4):
        assert all(H(store[d]) == d for d in front)
        front = [store[d][i : i + 64] for d in front for i in range(0, len(store[d]), 64)]
    assert front == [bytes(r.leaf).hex() for r in sorted(leaves.collect(), key=lambda r: r.key)]
    asked = spark.createDataFrame([("s", 4), ("s", 30), ("t", 0)], "grp string, rank long")
    (proof,) = built.proofs(asked).collect()
    assert (proof.rank, [s.digit for s in proof.path], bytes(proof.digest).hex()) == (4, [1, 1, 0, 0], front[4])

import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import queries
from millrace.llm import tokenfiles as t
from millrace.llm.arrow_text import Texts
from tests.conftest import rows
from tests.llm.helpers import ODD, documents, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
MORE = ["a,b .c\n\nd", "it's  two", "x  y", "é, è.", "×, ÷.", "end \n", " lead", "a\nb\n c", "don't,can't", "…, —.", "<|endoftext|> x", "1,2.3, 4"]


def plain(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]


def expected(docs, end=2):
    docs = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out, at = [], 0
    for (i, _), ids in zip(docs, plain([x for _, x in docs]), strict=True):
        ids = [*ids, end]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


def written(spark, docs, folder, **options):
    return t.write_token_files(docs, str(folder), PATH, end_id=2, **options)


def test_pieces_give_the_ids_of_the_whole():
    texts = [x for x in [*ODD, *MORE] if x is not None]
    ids, counts = t.Encoder(PATH).encode(Texts.of(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == plain(texts)


def test_round_trip_of_the_table(spark, tmp_path):
    docs = table(spark, "documents")
    got = t.read_all(spark, str(tmp_path), written(spark, docs, tmp_path))
    assert rows(got) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_texts_repeated_and_null_ids(spark, tmp_path):
    pairs = [*enumerate([*ODD, *MORE]), (3, "again"), (3, "again"), (None, "no id"), (-7, "below")]
    docs = documents(spark, pairs, extra=["ids", "start"])
    got = t.read_all(spark, str(tmp_path), written(spark, docs, tmp_path, width=4))
    assert rows(got) == expected(pairs)


def test_look_up_by_key(spark, tmp_path):
    docs = documents(spark, [(2 * i, f"text number {i}") for i in range(300)])
    manifest = written(spark, docs, tmp_path)
    asked = spark.createDataFrame([(i,) for i in range(-3, 620)] + [(None,)], "doc_id long")
    got = {r.doc_id: r.ids for r in t.look_up(asked, str(tmp_path), manifest).collect()}
    assert set(got) == set(range(0, 600, 2))
    assert got[84] == [*plain(["text number 42"])[0], 2]


def test_empty_table_and_ids_that_do_not_fit(spark, tmp_path):
    empty = documents(spark, ["x"]).limit(0)
    assert t.read_all(spark, str(tmp_path), written(spark, empty, tmp_path)).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        written(spark, documents(spark, ["some words"]), tmp_path / "narrow", width=1)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 5000])
def test_index_is_minimal_and_perfect(n):
    hashed = t.key_hashes(np.arange(n), np.ones(n, bool))
    seeds, slots = t.build_index(hashed)
    assert sorted(slots.tolist()) == list(range(n)) and len(seeds) == max(1, n // t.KEYS_PER_BUCKET)


@pytest.mark.parametrize("ids", [[0, 0, 2], [None, 1], [2, 2, 2, 4, 4], [0, None, None, 0, 1, -1, 1], list(range(40)) * 3])
def test_repeated_and_null_ids_through_write_read_and_look_up(spark, tmp_path, ids):
    pairs = [(i, f"text {n}") for n, i in enumerate(ids)]
    manifest = written(spark, documents(spark, pairs), tmp_path)
    assert rows(t.read_all(spark, str(tmp_path), manifest)) == expected(pairs)
    known = sorted({i for i in ids if i is not None})
    asked = spark.createDataFrame([(i,) for i in [*known, 99, None]], "doc_id long")
    first = {i: min(x for j, x in pairs if j == i) for i in known}
    got = {r.doc_id: r.ids for r in t.look_up(asked, str(tmp_path), manifest).collect()}
    assert got == {i: [*plain([x])[0], 2] for i, x in first.items()}


def test_hashes_tell_keys_and_occurrences_apart():
    keys, turns = (x.ravel() for x in np.meshgrid(np.arange(-300, 300), np.arange(300)))
    for known in (np.ones(len(keys), bool), np.arange(len(keys)) % 2 == 0):
        assert len(np.unique(t.hash_of(keys, known, turns))) == len(keys)


def test_another_salt_where_two_hashes_are_the_same(monkeypatch, spark, tmp_path):
    true = t.hash_of
    monkeypatch.setattr(t, "hash_of", lambda k, known, o, salt=0: true(k, known, o, salt) if salt > 1 else np.zeros(len(k), np.uint64))
    salt, hashed = t.salted(np.arange(9), np.ones(9, bool))
    assert salt == 2 and len(set(hashed.tolist())) == 9


def test_one_key_is_found_in_a_few_bytes_whatever_the_size(tmp_path):
    read = []
    for n in (100, 100_000):
        keys, counts = np.arange(n) * 3, np.full(n, 2)
        name = f"{n}.ids"
        with pa.OSFile(str(tmp_path / name), "wb") as file:
            file.write(np.repeat(keys % 50_000, 2).astype("<u2").tobytes())
            t._write_index(file, keys, np.ones(n, bool), counts, 2)
        shard = t.Shard.open(str(tmp_path), name)
        for key in (0, 3 * (n // 2), 3 * (n - 1)):
            before = shard.bytes_read
            (rank,) = shard.find(t.hash_of(np.array([key]), np.ones(1, bool), np.zeros(1, np.int64), shard.salt)).tolist()
            (start,), (stop,) = shard.spans(np.array([rank]))
            assert rank * 3 == key and shard.ids(start, stop).tolist() == [key % 50_000] * 2
            read.append(shard.bytes_read - before)
        assert shard.find(t.hash_of(np.array([1, 2]), np.ones(2, bool), np.zeros(2, np.int64), shard.salt)).tolist() == [-1, -1]
    assert set(read) == {8 + 4 + 4 + 16 + 4}


END = "<|endoftext|>"
SPECIAL = [
    f"a {END} b", END, f"{END}{END}", f"a{END}b, c.{END}, d", f"a  {END}  b\n{END}\nc", f"é{END}é {END}", "<|endof", "text|>", f"x {END[:-1]} y",
    f"\n{END}\n", f"it{END}'s", "a <|end of|> b", "one  two <b>x</b> <b> y", "abc ab bc a b c cab", " ab ", "ab", " x <|end", " of|> x",
]


def unchanged(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("more", [
    [], [{"content": "ab"}, {"content": "abc"}, {"content": "<b>", "special": True}], [{"content": "<|end of|>"}, {"content": "  "}],
    [{"content": "<b>", "lstrip": True, "rstrip": True}], [{"content": "ab", "single_word": True}], [{"content": "bc", "normalized": True}, {"content": "ab"}],
])
def test_added_tokens_as_in_the_plain_call(tmp_path, more):
    made = json.load(open(PATH))
    plain_token = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}
    made["added_tokens"] += [plain_token | {"id": 50257 + i} | m for i, m in enumerate(more)]
    path = str(tmp_path / "tokenizer.json")
    json.dump(made, open(path, "w"))
    texts = [x for x in [*ODD, *MORE, *SPECIAL] if x is not None]
    encoder = t.Encoder(path, special=True)
    for some in (texts, texts[::-1], [" and ".join(SPECIAL)], SPECIAL):
        ids, counts = encoder.encode(Texts.of(pa.array(some)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == unchanged(path, some)


def test_queries_encode_special_tokens_as_the_plain_call(spark, tmp_path):
    texts = [*SPECIAL, *MORE]
    docs = documents(spark, texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    lengths = [len(ids) + 1 for ids in unchanged(PATH, texts)]
    sums = [zlib.crc32(np.array([*ids, 2], "<u4").tobytes()) for ids in unchanged(PATH, texts)]
    want = sorted(zip(range(len(texts)), (np.cumsum(lengths) - lengths).tolist(), lengths, sums, strict=True), key=repr)
    assert rows(queries.op6_token_files(spark, str(tmp_path))) == want
    assert rows(corpus_pipeline.token_stage(spark, docs, str(tmp_path))) == want

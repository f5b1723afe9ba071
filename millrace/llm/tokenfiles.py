"""Token ids in binary shard files, with constant-time access by document key.

Documents are sorted by id over range partitions; every task writes one file: the raw ids of its documents one after the
other, then the tables of its index. A minimal perfect hash (hash and displace) sends each key to a slot of its own; the slot
holds a 32-bit fingerprint of the key, which tells foreign keys apart, and the document's rank, whose start is in a table of
offsets. Finding a document takes four reads of a few bytes, whatever the size of the file; for many documents of a file whole
tables are read instead, once.

File: ids (uint16, or uint32 for vocabularies over 65,536), then little-endian arrays ``seeds`` int64, ``fingerprints``
uint32, ``ranks`` uint32, ``starts`` uint64 (one more than documents), ``keys`` int64 and ``known`` uint8 (0: null id), then
a trailer of six int64: documents, buckets, bytes per id, start of the arrays, salt of the hashes, magic number.

A task writes under a name of its own attempt and renames at its end, so a repeated task replaces the file by an equal one.
Text is cut before the tokenizer only where its pre-tokenizer cuts too, and around its added tokens; every different piece is
encoded once per task.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ID, TEXT, Texts, byte_class, id_and_text, mix, pieces, ranges
from millrace.llm.components import Steps

MAGIC = 0x32534B4F54524D
TRAILER = 6 * 8
KEYS_PER_BUCKET = 4
MAX_CACHED = 1_000_000
JOINED_BYTES = 1 << 14

_GRAPHIC = byte_class(lambda b: 0x21 <= b <= 0x7E)
_LETTER = byte_class(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
# A two-byte character that starts with 0xC3 is a letter of Latin-1, but for the signs of multiplication and division.
_LATIN, _SIGNS = 0xC3, (0x97, 0xB7)


def cuts(texts: Texts) -> np.ndarray:
    """Places where a byte-level pre-tokenizer always cuts: before a single space or line feed between graphic characters,
    behind such a line feed, before a comma or full stop that follows a letter, and at the start of a document."""
    data, n = texts.data, len(texts.data)
    one, two, after = (np.full(n, 0x20, np.uint8) for _ in range(3))
    one[1:], two[2:], after[:-1] = data[:-1], data[:-2], data[1:]
    latin = (two == _LATIN) & (one >= 0x80)
    feed = data == 0x0A
    single = ((data == 0x20) | feed) & (_GRAPHIC[one] | latin) & (_GRAPHIC[after] | (after == _LATIN))
    letter = _LETTER[one] | (latin & (one != _SIGNS[0]) & (one != _SIGNS[1]))
    cut = single | (((data == 0x2C) | (data == 0x2E)) & letter)
    cut[1:] |= (single & feed)[:-1]
    cut[texts.offsets[:-1][texts.offsets[:-1] < n]] = True
    return np.flatnonzero(cut)


_ENDS = frozenset(np.flatnonzero(_GRAPHIC).tolist())
_STARTS = _ENDS | {_LATIN}


def _stands_alone(piece: bytes) -> bool:
    """Whether the piece starts and ends so that ``cuts`` finds it again between others of the kind."""
    n = len(piece)
    return n > 1 and piece[0] == 0x20 and piece[1] in _STARTS and (piece[-1] in _ENDS or (n > 2 and piece[-2] == _LATIN))


class Encoder:
    """Ids of whole documents, made from the ids of their different pieces.

    With ``special`` they are those of the tokenizer as its file has it: the text of a special token gives the token's id.
    Without, that text is encoded like any other.
    """

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        # Pieces are the same as the whole only for a byte-level pre-tokenizer without a normalizer.
        self.whole = self.tokenizer.normalizer is not None or type(self.tokenizer.pre_tokenizer).__name__ != "ByteLevel"
        # In a byte-level vocabulary each character of a token stands for one byte.
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.widths[i] = len(token)
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.content and (special or not t.special)]
        contents = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, contents))) if added else None
        # Whether the added tokens are found by their text alone, in one pass.
        self.literal = not any(t.single_word or t.lstrip or t.rstrip for t in added) and len({t.normalized for t in added}) < 2
        self.joins = not self.whole and self.literal and not any(b" " in c for c in contents)
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.ids, self.lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

    def _encode(self, parts: list[bytes]) -> None:
        """Pieces that would be cut from one another anyway are encoded together; the bytes of the ids tell them apart."""
        joined, single = [], []
        for part in parts:
            (joined if self.joins and _stands_alone(part) else single).append(part)
        groups, size = [[]], 0
        for part in joined:
            groups[-1].append(part)
            size += len(part)
            if size > JOINED_BYTES:
                groups.append([])
                size = 0
        together = [p.decode() for p in single] + [b"".join(g).decode() for g in groups]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(together, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for x in found for i in x), np.uint32, int(counts.sum()))
        lengths = counts[: len(single)]
        if joined:
            ends = np.cumsum(self.widths[ids[lengths.sum() :]])
            upto = np.searchsorted(ends, np.cumsum([len(p) for p in joined]), "left") + 1
            lengths = np.concatenate([lengths, np.diff(upto, prepend=0)])
        self.ids.append(ids)
        self.lengths.append(lengths)
        self.rows.update(zip([*single, *joined], range(len(self.rows), len(self.rows) + len(parts)), strict=True))

    def _around_added(self, texts: Texts, starts: np.ndarray) -> np.ndarray:
        """The places to cut, with those around added tokens and without those inside; a document stays whole if it holds a
        token that takes in more than its own text."""
        data = memoryview(texts.data)
        if not self.added.search(data):
            return starts
        found = [m.span() for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True) for m in self.added.finditer(data, a, b)]
        if not found:
            return starts
        begin, end = np.array(found).T
        if not self.literal:
            doc = np.unique(np.searchsorted(texts.offsets, begin, "right") - 1)
            begin, end = texts.offsets[doc], texts.offsets[doc + 1]
        before = np.searchsorted(begin, starts, "left") - 1
        inside = (before >= 0) & (starts < end[np.maximum(before, 0)])
        return np.unique(np.concatenate([starts[~inside], begin, end[end < len(data)]]))

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each document has."""
        if not len(texts.data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        starts = np.unique(texts.offsets[:-1][np.diff(texts.offsets) > 0]) if self.whole else cuts(texts)
        if self.added and not self.whole:
            starts = self._around_added(texts, starts)
        ends = np.append(starts, len(texts.data))
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(texts.data))])
        coded = parts.dictionary_encode()
        different = coded.dictionary.to_pylist()
        if len(self.rows) > MAX_CACHED:
            self._clear()
        if unknown := [p for p in different if p not in self.rows]:
            self._encode(unknown)
            self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]
        ids, lengths = self.ids[0], self.lengths[0]
        row = np.fromiter((self.rows[p] for p in different), np.int64, len(different))[coded.indices.to_numpy()]
        counts, begins = lengths[row], (np.cumsum(lengths) - lengths)[row]
        upto = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, texts.offsets)]
        return ids[ranges(begins, counts)], np.diff(upto)


def key_hashes(keys: np.ndarray, known: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hashes of sorted keys; equal keys differ by how many of them come before."""
    same = np.concatenate([[False], (keys[1:] == keys[:-1]) & (known[1:] == known[:-1])]) if len(keys) else np.zeros(0, bool)
    place = np.arange(len(keys))
    first = np.maximum.accumulate(np.where(same, 0, place)) if len(keys) else place
    return hash_of(keys, known, place - first, salt)


def hash_of(keys: np.ndarray, known: np.ndarray, occurrence: np.ndarray, salt: int = 0) -> np.ndarray:
    """Key and occurrence are scrambled one after the other, so that they do not stand for each other."""
    turn = occurrence.astype(np.uint64) * np.uint64(2) + (~known.astype(bool)).astype(np.uint64)
    own = mix(keys.astype(np.int64).view(np.uint64) ^ np.uint64(0xD1B54A32D192ED03))
    shift = np.uint64((1 + salt * 0xD6E8FEB86659FD93) & ((1 << 64) - 1))
    return mix(own * np.uint64(0x9E3779B97F4A7C15) + mix(turn + shift))


def salted(keys: np.ndarray, known: np.ndarray) -> tuple[int, np.ndarray]:
    """The first salt with which no two keys have the same hash, and the hashes."""
    salt = 0
    while True:
        hashed = key_hashes(keys, known, salt)
        if len(np.unique(hashed)) == len(hashed):
            return salt, hashed
        salt += 1


def _slot(hashed: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (mix(hashed + seed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


def _bucket(hashed: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((hashed >> np.uint64(20)) % np.uint64(n_buckets)).astype(np.int64)


def build_index(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and displace: seeds of the buckets, and the slot of each key. A bucket of one key names its slot as -1 - slot."""
    n = len(hashed)
    n_buckets = max(1, n // KEYS_PER_BUCKET)
    bucket = _bucket(hashed, n_buckets)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=n_buckets)
    begin = np.cumsum(sizes) - sizes
    seeds, slots, free = np.zeros(n_buckets, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for b in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())].tolist():
        members = order[begin[b] : begin[b] + sizes[b]]
        for tried in range(0, 1 << 24, 64):
            seed = np.arange(tried, tried + 64)
            places = np.sort(_slot(hashed[members][None, :], seed[:, None], n), axis=1)
            good = free[places].all(1) & (places[:, 1:] != places[:, :-1]).all(1)
            if good.any():
                seeds[b] = seed[good.argmax()]
                slots[members] = _slot(hashed[members], seeds[b : b + 1], n)
                free[slots[members]] = False
                break
        else:
            raise ValueError("two keys have the same hash")
    single = np.flatnonzero(sizes == 1)
    alone = order[begin[single]]
    slots[alone] = np.flatnonzero(free)
    seeds[single] = -1 - slots[alone]
    return seeds, slots


def fingerprint(hashed: np.ndarray) -> np.ndarray:
    return (mix(hashed ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype("<u4")


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def _located(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, so that every task means the same place."""
    return folder if "://" in folder or folder.startswith("file:") else spark._jsc.hadoopConfiguration().get("fs.defaultFS").rstrip("/") + folder


MANIFEST = "shard int, file string, n_docs long, n_tokens long, first_id long, last_id long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None, width: int = 2, id_column: str = ID, text_column: str = TEXT, special: bool = False) -> DataFrame:
    """Write the shard files and return their manifest, one row per file in ascending order of ids.

    A null text counts as empty; a document's ids are those of its whole text and ``end_id``, if given. Rows that repeat an
    id all have their place, in the order of their texts; a null id is a key too and comes first. ``width`` is the bytes of an
    id; an id that does not fit fails the job. An empty table gives no file. The manifest has as many rows as the job has
    partitions, and its order is that of the ids. With ``special`` the ids are those of the plain call of the tokenizer, where
    the text of a special token gives its id; without, such text is encoded like any other.
    """
    spark, steps = docs.sparkSession, Steps(docs.sparkSession, "token-manifest")
    folder = _located(spark, folder)
    kept = id_and_text(docs, id_column, text_column).withColumn(ID, F.col(ID).cast("long"))
    ordered = kept.repartitionByRange(ID).sortWithinPartitions(ID, TEXT)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = file = None
        keys, known, counts = [], [], []
        for batch in batches:
            for part, texts in pieces(batch):
                if file is None:
                    store, base = _open(folder)
                    store.create_dir(base, recursive=True)
                    shard = TaskContext.get().partitionId()
                    own = f"{base}/.{shard}-{uuid.uuid4().hex}"
                    file, encoder = store.open_output_stream(own), Encoder(tokenizer, special)
                ids, n = encoder.encode(texts)
                if end_id is not None:
                    ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
                if len(ids) and int(ids.max()) >= 1 << (8 * width):
                    raise ValueError("an id does not fit the width of the file")
                file.write(ids.astype(f"<u{width}").tobytes())
                column = part.column(ID)
                known.append(np.asarray(column.is_valid()))
                keys.append(column.fill_null(0).to_numpy())
                counts.append(n)
        if file is None:
            return
        keys, known, counts = (np.concatenate(x) for x in (keys, known, counts))
        _write_index(file, keys, known, counts, width)
        file.close()
        name = f"shard-{shard:06d}.ids"
        store.move(own, f"{base}/{name}")
        row = {"shard": shard, "file": name, "n_docs": len(keys), "n_tokens": int(counts.sum()), "first_id": int(keys[0]), "last_id": int(keys[-1])}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int32()), ("file", pa.string()), *((c, pa.int64()) for c in list(row)[2:])]))

    return steps.keep(ordered.mapInArrow(write, MANIFEST))


def _write_index(file, keys: np.ndarray, known: np.ndarray, counts: np.ndarray, width: int) -> None:
    at = file.tell()
    salt, hashed = salted(keys, known)
    seeds, slots = build_index(hashed)
    prints, ranks = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u4")
    prints[slots], ranks[slots] = fingerprint(hashed), np.arange(len(keys))
    starts = np.concatenate([[0], np.cumsum(counts)])
    for table in (seeds.astype("<i8"), prints, ranks, starts.astype("<u8"), keys.astype("<i8"), known.astype("u1")):
        file.write(table.tobytes())
    file.write(np.array([len(keys), len(seeds), width, at, salt, MAGIC], "<i8").tobytes())


@dataclass
class Shard:
    """An open shard file. For a few keys only their entries are read, for many of them each table once."""

    file: pyarrow.NativeFile
    n: int
    n_buckets: int
    width: int
    at: int
    salt: int
    tables: dict[str, np.ndarray] = field(default_factory=dict)
    bytes_read: int = 0

    @classmethod
    def open(cls, folder: str, name: str) -> Shard:
        store, base = _open(folder)
        file = store.open_input_file(f"{base}/{name}")
        n, n_buckets, width, at, salt, magic = np.frombuffer(file.read_at(TRAILER, file.size() - TRAILER), "<i8").tolist()
        if magic != MAGIC:
            raise ValueError(f"{name} is not a whole shard file")
        return cls(file, n, n_buckets, width, at, salt)

    def _read(self, at: int, size: int, kind: str) -> np.ndarray:
        self.bytes_read += size
        return np.frombuffer(self.file.read_at(size, at), kind)

    def _entries(self, name: str, where: np.ndarray | None = None, width: int = 1) -> np.ndarray:
        """A whole table, or ``width`` entries from each place in ``where``, a row each."""
        at = self.at
        for table, kind, length in (("seeds", "<i8", self.n_buckets), ("prints", "<u4", self.n), ("ranks", "<u4", self.n), ("starts", "<u8", self.n + 1), ("keys", "<i8", self.n), ("known", "u1", self.n)):
            size = np.dtype(kind).itemsize
            if table == name:
                break
            at += length * size
        if where is not None and name not in self.tables and len(where) * FEW < length:
            each = [self._read(at + w * size, width * size, kind) for w in where.tolist()]
            return np.stack(each) if each else np.zeros((0, width), kind)
        if name not in self.tables:
            self.tables[name] = self._read(at, length * size, kind)
        whole = self.tables[name]
        return whole if where is None else whole[where[:, None] + np.arange(width)]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        return self._entries("keys"), self._entries("known").astype(bool)

    def find(self, hashed: np.ndarray) -> np.ndarray:
        """Ranks of the documents with these key hashes, -1 where the fingerprint is another one."""
        seed = self._entries("seeds", _bucket(hashed, self.n_buckets))[:, 0]
        slot = np.where(seed < 0, -1 - seed, _slot(hashed, np.maximum(seed, 0), self.n))
        ranks = np.full(len(hashed), -1, np.int64)
        right = np.flatnonzero(self._entries("prints", slot)[:, 0] == fingerprint(hashed))
        ranks[right] = self._entries("ranks", slot[right])[:, 0]
        return ranks

    def spans(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(self._entries("starts", ranks, 2).astype(np.int64).reshape(-1, 2).T)

    def ids(self, start: int, stop: int) -> np.ndarray:
        return self._read(start * self.width, (stop - start) * self.width, f"<u{self.width}").astype("<u4")


FEW = 16  # a table is read whole if more than one of so many of its entries are wanted


def read_all(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Every document, looked up by its key: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The manifest (a row per file) is read by the driver to add up the files' lengths; a task reads one file.
    """
    folder, files = _located(spark, folder), manifest.orderBy("shard").collect()
    before = np.concatenate([[0], np.cumsum([f.n_tokens for f in files])]).tolist()
    names = [f.file for f in files]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                shard = Shard.open(folder, names[i])
                keys, known = shard.keys()
                ranks = shard.find(key_hashes(keys, known, shard.salt))
                if (ranks < 0).any():
                    raise ValueError(f"{names[i]}: a key is not in its index")
                start, stop = shard.spans(ranks)
                for some in range(0, len(keys), 4096):
                    here = slice(some, some + 4096)
                    crc = [zlib.crc32(shard.ids(a, b).tobytes()) for a, b in zip(start[here].tolist(), stop[here].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[here], pa.int64(), mask=~known[here]), pa.array(start[here] + before[i], pa.int64()),
                            pa.array(stop[here] - start[here], pa.int64()), pa.array(crc, pa.int64()),
                        ],
                        [ID, "start", "n_tokens", "ids_crc32"],
                    )

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(read, f"{ID} long, start long, n_tokens long, ids_crc32 long")


def look_up(keys: DataFrame, folder: str, manifest: DataFrame, id_column: str = ID) -> DataFrame:
    """doc_id and ids of the asked keys that are in the files; a repeated id gives its first document, a null key nothing.

    The keys are dealt to the files by the range of ids in the manifest; each task opens a file once and reads the documents.
    """
    spark = keys.sparkSession
    folder, files = _located(spark, folder), manifest.orderBy("shard").collect()
    last, names = np.array([f.last_id for f in files], np.int64), [f.file for f in files]

    def place(batches):
        for batch in batches:
            asked = batch.column(0).to_numpy()
            at = np.searchsorted(last, asked)
            some = pa.array(at < len(last))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int32())], [ID, "at"]).filter(some)

    def read(batches):
        at, shard = -1, None
        for batch in batches:
            asked, where = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in np.unique(where).tolist():
                if i != at:
                    at, shard = i, Shard.open(folder, names[i])
                mine = asked[where == i]
                ranks = shard.find(hash_of(mine, np.ones(len(mine), bool), np.zeros(len(mine), np.int64), shard.salt))
                mine, ranks = mine[ranks >= 0], ranks[ranks >= 0]
                spans = zip(*(x.tolist() for x in shard.spans(ranks)), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(mine, pa.int64()), pa.array([shard.ids(a, b) for a, b in spans], pa.list_(pa.int64()))], [ID, "ids"])

    asked = keys.select(F.col(id_column).cast("long").alias(ID)).filter(F.col(ID).isNotNull())
    return asked.mapInArrow(place, f"{ID} long, at int").repartition("at").sortWithinPartitions("at").mapInArrow(read, f"{ID} long, ids array<long>")

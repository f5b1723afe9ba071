"""Text columns as bytes: finding, hashing and counting words of whole Arrow batches with numpy.

A text column of an Arrow batch is one buffer of UTF-8 bytes and one of offsets. The word patterns used here separate words
at ASCII bytes only, and no byte of a longer UTF-8 sequence is ASCII, so words can be found on bytes without decoding.
Everything is exact for any text; batches are cut into pieces of bounded size, but never inside a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 8 << 20  # documents are handled together up to this many bytes; a longer document is handled alone

ID, TEXT = "doc_id", "text"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(is_member: Callable[[int], bool]) -> np.ndarray:
    return np.array([is_member(b) for b in range(256)])


# Bytes that belong to a word, after A-Z were lower-cased.
ALNUM_WORD = byte_class(lambda b: not (b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F))
SPACED_WORD = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))


class Texts:
    """Some documents: ``data`` (bytes), ``offsets`` (one more than documents) and ``valid`` (False for null)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, valid: np.ndarray):
        self.data, self.offsets, self.valid = data, offsets, valid

    def __len__(self) -> int:
        return len(self.valid)

    @classmethod
    def of(cls, array: pa.Array) -> Texts:
        array = array.cast(pa.large_binary())
        _, offsets, data = array.buffers()
        offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        valid = np.asarray(array.is_valid().to_numpy(zero_copy_only=False), bool)
        return cls(data[offsets[0] : offsets[-1]], offsets - offsets[0], valid)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def one(self, i: int) -> Texts:
        """The document alone."""
        offsets = self.offsets[i : i + 2]
        return Texts(self.data[offsets[0] : offsets[1]], offsets - offsets[0], self.valid[i : i + 1])

    def lowered(self) -> Texts:
        """A-Z to a-z, nothing else."""
        return Texts(_LOWER[self.data], self.offsets, self.valid)

    def words(self, word_bytes: np.ndarray) -> Words:
        n = len(self.data)
        inside = word_bytes[self.data]
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[self.offsets[:-1][self.offsets[:-1] < n]] = False
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        last = self.offsets[1:] - 1
        after[last[(last >= 0)]] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return Words(self, starts, ends, np.searchsorted(starts, self.offsets))


class Words:
    """Words of some documents: ``starts`` and ``ends`` in bytes; document i has words ``first[i]`` to ``first[i+1]``."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
        self.texts, self.starts, self.ends, self.first = texts, starts, ends, first

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, eight bytes at a time; a bijection for words of up to eight bytes."""
        padded = np.concatenate([self.texts.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        length = self.ends - self.starts
        out = mix(length.astype(np.uint64) * _ODD[0] ^ (eight[self.starts] & _MASK[np.minimum(length, 8)]))
        more, at = np.flatnonzero(length > 8), 8
        while len(more):
            left = length[more] - at
            out[more] = mix(out[more] * _ODD[1] ^ (eight[self.starts[more] + at] & _MASK[np.minimum(left, 8)]))
            more, at = more[left > 8], at + 8
        return out


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, so that every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[2]
    x = (x ^ (x >> np.uint64(27))) * _ODD[3]
    return x ^ (x >> np.uint64(31))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each document, and how many each has; shorter documents give one run."""
    hashed, counts = words.hashes(), words.counts()
    n = max(0, len(hashed) - k + 1)
    runs = np.full(n, k, np.uint64)
    for j in range(k):
        runs = mix(runs * _ODD[1] + hashed[j : n + j])
    per_doc = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out = np.empty(per_doc.sum(), np.uint64)
    to = np.cumsum(per_doc) - per_doc
    long = np.flatnonzero(counts >= k)
    source = np.repeat(words.first[long] - to[long], per_doc[long]) + ranges(to[long], per_doc[long])
    out[ranges(to[long], per_doc[long])] = runs[source]
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        value = np.full(1, counts[i], np.uint64)
        for j in range(words.first[i], words.first[i + 1]):
            value = mix(value * _ODD[1] + hashed[j : j + 1])
        out[to[i]] = value[0]
    return out, per_doc


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and length, in a row."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(before - starts, lengths)


def pieces(batch: pa.RecordBatch, text: str = TEXT) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """A batch in slices of whole documents, each of at most PIECE_BYTES of text or one document."""
    texts = Texts.of(batch.column(text))
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(texts.offsets, texts.offsets[at] + PIECE_BYTES, "right")) - 1
        upto = max(at + 1, min(upto, len(texts)))
        offsets = texts.offsets[at : upto + 1]
        data = texts.data[offsets[0] : offsets[-1]]
        yield batch.slice(at, upto - at), Texts(data, offsets - offsets[0], texts.valid[at:upto])
        at = upto


def id_and_text(docs: DataFrame, id_column: str = ID, text_column: str = TEXT) -> DataFrame:
    return docs.select(F.col(id_column).alias(ID), F.col(text_column).cast("string").alias(TEXT))


def per_document(docs: DataFrame, rows: Callable[[Texts], dict[str, object]], schema: str, **names: str) -> DataFrame:
    """One row per document: its id and the columns that ``rows`` computes for the documents of a piece."""
    kept = id_and_text(docs, **names)
    id_type = kept.schema[ID].dataType.simpleString()
    columns = [part.split()[0] for part in schema.split(", ")]

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for part, texts in pieces(batch):
                found = rows(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(ID), *(x if isinstance(x := found[c], pa.Array) else pa.array(x) for c in columns)], [ID, *columns]
                )

    return kept.mapInArrow(batches, f"{ID} {id_type}, {schema}")


def filter_documents(docs: DataFrame, keep: Callable[[Texts], np.ndarray], text_column: str = TEXT) -> DataFrame:
    """The rows whose text passes; all columns stay as they are."""
    at = docs.columns.index(text_column)

    def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            for part, texts in pieces(batch, at):
                yield part.filter(pa.array(keep(texts)))

    return docs.mapInArrow(batches, docs.schema)

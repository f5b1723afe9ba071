"""Near-duplicate documents by SimHash: 64-bit fingerprints that differ in few bits, found through pivot distance tables.

1. A task turns each text into its fingerprint: a bit is set if it is set in over half of the hashes of the word shingles.
   Equal fingerprints are one from here on.
2. The bits are cut into ``LINKED + 2`` blocks. Fingerprints that differ in at most ``LINKED`` bits agree in two blocks at
   least, so each pair to be found shares one of the buckets "these two blocks have these bits". Nothing is missed.
3. In a bucket the Hamming distances of all members to ``PIVOTS`` reference fingerprints are computed once. By the triangle
   inequality a pair whose distances to any pivot differ by more than ``LINKED`` cannot be linked. Members are sorted by the
   first coordinate, so only pairs in its window are looked at; the other coordinates discard most of these, and the few that
   survive are verified on the fingerprints. A bucket of more than ``CHUNK`` members is dealt into chunks by the first
   coordinate, then by hash, and every two chunks whose coordinates are near enough are a task's work of their own.
4. A task gives the links it found as stars, fewer than it has members, and links give components.

Pairs of a bucket are looked at in a task only; rows between tasks grow with fingerprints and not with pairs. The work on
one bucket of m different fingerprints grows with m * m times the share of pairs in the window of the first pivot.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ID, SPACED_WORD, Texts, mix, per_document, ranges
from millrace.llm.components import Steps, connected

LINKED = 3
SEED = 42
PIVOTS = mix(np.arange(1, 17, dtype=np.uint64))
CHUNK = 2048
PAIRS = 1 << 20  # links a task holds before it makes stars of them
BITS_AT_ONCE = 1 << 16  # shingles whose bits a task holds


def _shingle_hashes(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each run of ``k`` words joined by spaces, repeats included, and how many each document has."""
    words = texts.words(SPACED_WORD)
    lengths, counts = words.ends - words.starts, words.counts()
    starts = np.cumsum(lengths + 1) - lengths - 1
    spaced = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    spaced[ranges(starts, lengths)] = texts.data[ranges(words.starts, lengths)]
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.repeat(words.first[:-1], n) + ranges(np.zeros(len(n), np.int64), n)
    last = first + np.repeat(np.minimum(counts, k), n) - 1
    data, h = spaced.tobytes(), xxhash.xxh64_intdigest
    each = zip(starts[first].tolist(), (starts[last] + lengths[last]).tolist(), strict=True)
    return np.fromiter((h(data[s:e], SEED) for s, e in each), np.uint64, len(first)), n


def fingerprint_array(texts: Texts, k: int) -> np.ndarray:
    hashes, counts = _shingle_hashes(texts.lowered(), k)
    owner = np.repeat(np.arange(len(counts)), counts)
    totals = np.zeros((len(counts), 64), np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        some, of = hashes[at : at + BITS_AT_ONCE], owner[at : at + BITS_AT_ONCE]
        bits = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        runs = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        totals[of[runs]] += np.add.reduceat(bits, runs, axis=0, dtype=np.int64)
    return np.packbits(2 * totals > counts[:, None], axis=1, bitorder="little").reshape(-1, 8).view("<u8").ravel()


def fingerprints(docs: DataFrame, k: int = 3, **names: str) -> DataFrame:
    """doc_id and fingerprint (as a long) of each document; zero for a text that is null or has no words."""

    def rows(texts: Texts) -> dict[str, object]:
        return {"fingerprint": pa.array(fingerprint_array(texts, k).view(np.int64))}

    return per_document(docs, rows, "fingerprint long", **names)


def block_masks(linked: int = LINKED) -> list[int]:
    """The bits of each two of ``linked + 2`` blocks, as signed 64-bit numbers."""
    n = linked + 2
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [int(np.uint64(a | b).astype(np.int64)) for a, b in combinations(blocks, 2)]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the links (a, b) lead to."""
    least = np.arange(n)
    while len(a):
        x, y = least[a], least[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (further := least[least]).tobytes() != least.tobytes():
            least = further
    return least


def near_pairs(prints: np.ndarray, block: np.ndarray, side: np.ndarray, linked: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of the linked pairs in each block, of which one member is of side 0 and the other of side 1, or both of side 2."""
    table = np.bitwise_count(prints[:, None] ^ PIVOTS).astype(np.int8)
    order = np.lexsort((table[:, 0], block))
    prints, block, side, table = prints[order], block[order], side[order], table[order]
    left, shift = np.arange(len(prints)), 0
    while len(left):
        shift += 1
        left = left[left + shift < len(prints)]
        right = left + shift
        near = (block[left] == block[right]) & (table[right, 0] - table[left, 0] <= linked)
        left, right = left[near], right[near]
        wanted = (side[left] != side[right]) | (side[left] == 2)
        a, b = left[wanted], right[wanted]
        for pivot in range(1, len(PIVOTS)):
            if not len(a):
                break
            kept = np.abs(table[a, pivot] - table[b, pivot]) <= linked
            a, b = a[kept], b[kept]
        same = np.bitwise_count(prints[a] ^ prints[b]) <= linked
        if same.any():
            yield order[a[same]], order[b[same]]


def _compare(linked: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for side, name in enumerate(("one", "two")):
                lists = batch.column(name)
                counts = np.diff(lists.offsets.to_numpy())
                block = np.repeat(np.arange(len(lists)), counts)
                sides = np.full(len(block), side, np.int8)
                parts.append((lists.flatten().to_numpy().view(np.uint64), block, sides))
            prints, block, side = (np.concatenate(p) for p in zip(*parts, strict=True))
            side[~np.isin(block, parts[1][1])] = 2
            values, at = np.unique(prints, return_inverse=True)
            a, b = (np.zeros(0, np.int64) for _ in range(2))
            for x, y in near_pairs(prints, block, side, linked):
                a, b = np.concatenate([a, at[x]]), np.concatenate([b, at[y]])
                if len(a) > PAIRS:
                    b = forest(len(values), a, b)
                    a = np.arange(len(values))
            root = forest(len(values), a, b)
            joined = np.flatnonzero(root != np.arange(len(values)))
            found = [pa.array(values[i].view(np.int64)) for i in (root[joined], joined)]
            yield pa.RecordBatch.from_arrays(found, ["a", "b"])

    return blocks


def links(prints: DataFrame, steps: Steps, linked: int = LINKED) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``prints`` (distinct ``fingerprint``) that differ in at most ``linked`` bits.

    Not every pair is among them, but every pair is joined by some.
    """
    each = [F.xxhash64(F.lit(i), F.col("fingerprint").bitwiseAND(F.lit(m))) for i, m in enumerate(block_masks(linked))]
    placed = prints.select(F.explode(F.array(*each)).alias("bucket"), "fingerprint")
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = steps.keep(placed.join(shared, "bucket"))
    none = F.array().cast("array<long>")
    small = rows.filter(F.col("n") <= CHUNK).groupBy("bucket").agg(F.collect_list("fingerprint").alias("one")).select("one", none.alias("two"))

    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.lit(int(PIVOTS[0].astype(np.int64))))).cast("long")
    large = rows.filter(F.col("n") > CHUNK).select("bucket", "fingerprint", near.alias("near"))
    kinds = large.groupBy("bucket", "near").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("n_chunks"))
    number = F.pmod(F.xxhash64("fingerprint"), "n_chunks")
    dealt = large.join(kinds, ["bucket", "near"]).withColumn("chunk", F.shiftleft("near", 32) + number)
    chunks = steps.keep(dealt.groupBy("bucket", "chunk").agg(F.collect_list("fingerprint").alias("members")))
    one, two = (chunks.select("bucket", F.col("chunk").alias(f"chunk_{i}")) for i in (1, 2))
    far = F.shiftright("chunk_2", 32) - F.shiftright("chunk_1", 32)
    pairs = one.join(two, "bucket").filter((F.col("chunk_1") <= F.col("chunk_2")) & (far <= linked))
    pairs = pairs.join(chunks.select("bucket", F.col("chunk").alias("chunk_1"), F.col("members").alias("one")), ["bucket", "chunk_1"])
    pairs = pairs.join(chunks.select("bucket", F.col("chunk").alias("chunk_2"), F.col("members").alias("two")), ["bucket", "chunk_2"])
    pairs = pairs.select("one", F.when(F.col("chunk_1") < F.col("chunk_2"), F.col("two")).otherwise(none).alias("two"))
    return small.unionAll(pairs).mapInArrow(_compare(linked), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 3, linked: int = LINKED, id_column: str = ID, text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id, the smallest id that links lead to.

    Words are runs without white space, A-Z lower-cased; shingles are ``k`` words joined by spaces, each as often as it occurs,
    or the whole text if it has fewer words. A text that is null or has no words has the fingerprint zero, which is linked like
    any other. Documents are linked if their fingerprints differ in at most ``linked`` bits. Ids are whole numbers; rows that
    repeat an id are judged by their own texts. A null id is nobody's component_id: a component of null ids only has a null one.
    """
    steps = Steps(docs.sparkSession, "simhash")
    signed = fingerprints(docs, k, id_column=id_column, text_column=text_column)
    signed = steps.keep(signed.withColumn(ID, F.col(ID).cast("long")))
    prints = steps.keep(signed.groupBy("fingerprint").agg(F.min(ID).alias("id")))
    joined = connected(steps.keep(links(prints, steps, linked)), steps).withColumnRenamed("id", "fingerprint")
    whole = prints.join(joined, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    whole = steps.keep(whole)
    named = whole.groupBy("component").agg(F.min("id").alias("component_id"))
    told = signed.join(whole.select("fingerprint", "component").join(named, "component"), "fingerprint")
    return told.select(ID, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")

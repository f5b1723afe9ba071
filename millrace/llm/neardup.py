"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

1. A task turns each text into its set of word shingles (64-bit hashes), a 128-bit digest of the set, and a signature: the
   hash space is cut into ``BINS`` bins and the smallest hash of each is kept; an empty bin takes the value of another one,
   which a hash of (bin, attempt) picks, the same for every document. ``ROWS`` neighbouring bins form a band.
2. Documents with the same set are one class from here on, represented by the smallest id.
3. In each bucket (equal bands) one member is the centre, and every other member is a candidate with the centre only: a
   bucket of m members has m - 1 candidates. The centre follows from a few different orders of the ids, so that a large group
   has several centres over its buckets, but not one for each bucket.
4. Candidates are compared on their full sets; links give components.
5. Members of a bucket that are still in different components, and neither of them its centre, have not been compared. These
   rest pairs are compared too, those of a document outside the bucket's largest component against all members, on full sets,
   chunk by chunk, so that neither the pairs nor the sets of a group grow with the bucket; only found links leave a task. A pair
   is compared in its first common bucket only.

So no link between documents that share a bucket is lost. At the similarity 0.85 a pair shares none of 25 bands of 5 with
probability 5e-7, at 0.8 with 5e-5. Bands, centres and comparisons are the same at every size, and nothing is capped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ID, SPACED_WORD, Texts, id_and_text, mix, per_document, shingles
from millrace.llm.components import Steps, connected

BINS, BANDS, ROWS = 128, 25, 5
# Bits that are flipped in an id before the smallest is taken: the orders in which centres are chosen.
CENTRES = [0x2545F4914F6CDD1D >> (7 * i) for i in range(6)]
# Of the documents that one task compares with one another: pairs, and bytes of their sets.
BLOCK_PAIRS = 2_000_000
BLOCK_BYTES = 1 << 25


def _sets(texts: Texts, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    hashes, counts = shingles(texts.lowered().words(SPACED_WORD), k)
    ends = np.cumsum(counts)
    return [np.unique(hashes[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]


def densify(bins: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Give each empty bin the value of a filled one of its row: the first that the hash of (bin, attempt) hits."""
    out, (row, column) = bins.copy(), np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        donor = (mix(column.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) >> np.uint64(32)).astype(np.int64) % BINS
        found = filled[row, donor]
        out[row[found], column[found]] = bins[row[found], donor[found]]
        row, column = row[~found], column[~found]
    return out


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Bucket keys (one per band) of sets that are not empty."""
    if not sets:
        return np.zeros((0, BANDS), np.int64)
    flat = np.concatenate(sets)
    cell = np.repeat(np.arange(len(sets)) * BINS, [len(s) for s in sets]) + (flat >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    bins, filled = np.zeros(len(sets) * BINS, np.uint64), np.zeros(len(sets) * BINS, bool)
    bins[cell[first]], filled[cell[first]] = flat[first], True
    dense = densify(bins.reshape(-1, BINS), filled.reshape(-1, BINS))[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), dense.shape[:2])
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + dense[:, :, r])
    return key.view(np.int64)


def signatures(docs: DataFrame, k: int, **names: str) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null without words) and its bucket keys."""

    def rows(texts: Texts) -> dict[str, object]:
        sets = _sets(texts, k)
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        for i, key in zip(full, bands([sets[i] for i in full]), strict=True):
            keys[i] = key
        return {
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            "buckets": pa.array(keys, pa.list_(pa.int64())),
        }

    return per_document(docs, rows, "n_shingles long, digest binary, buckets array<long>", **names)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("of_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c) for c in ("of_a", "of_b"))
            right = [linked(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64), percent) for i in range(len(batch))]
            yield batch.select(["a", "b"]).filter(pa.array(right, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "of_a", "of_b").mapInArrow(compare, "a long, b long")


def _rest(members: DataFrame, parts: DataFrame, sets: DataFrame, keys: DataFrame, percent: int, steps: Steps) -> DataFrame:
    """Links (a, b) between components among the pairs of a bucket that the stars have not compared.

    A bucket is dealt into chunks by the hash of the id, a large one first by who asks and by the size of the sets, and each two
    chunks that can hold a link are a group of their own. The chunks of a bucket are so many that rows and bytes stay in bounds on
    the average of the hash; a longer document is a chunk's excess.
    """
    placed = members.filter("id <> centre").join(parts, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("part"))
    sizes = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    open_buckets = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "part")).alias("main")).filter("parts > 1")
    rows = placed.join(open_buckets, "bucket").join(sets.select("id", "size"), "id")
    rows = steps.keep(rows.select("bucket", "id", "part", (F.col("part") != F.col("main.part")).alias("asks"), "size"))
    needed = F.ceil(F.greatest(F.count(F.lit(1)) / math.isqrt(BLOCK_PAIRS), 8 * F.sum("size") / (BLOCK_BYTES // 2)))
    large = rows.groupBy("bucket").agg((needed > 1).alias("large"))
    kind = F.when(F.col("large"), 2 * F.floor(F.log(1.25, F.col("size"))) + F.col("asks").cast("long")).otherwise(F.lit(0))
    rows = rows.join(large, "bucket").withColumn("kind", kind)
    kinds = rows.groupBy("bucket", "kind").agg(
        needed.alias("n_chunks"), F.max("asks").alias("asks"), F.min("size").alias("least"), F.max("size").alias("most")
    )
    chunk = F.shiftleft("kind", 32) + F.col("number")
    chunks = kinds.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1))).withColumn("chunk", chunk)
    one, two = (chunks.select("bucket", *(F.col(c).alias(f"{c}_{i}") for c in ("chunk", "asks", "least", "most"))) for i in (1, 2))
    fits = "chunk_1 <= chunk_2 AND (asks_1 OR asks_2) AND 100 * most_1 >= {0} * least_2 AND 100 * most_2 >= {0} * least_1"
    blocks = one.join(two, "bucket").filter(fits.format(percent))
    either = F.explode(F.array_distinct(F.array("chunk_1", "chunk_2")))
    dealt = rows.join(kinds.select("bucket", "kind", "n_chunks"), ["bucket", "kind"]).withColumn("number", F.pmod(F.xxhash64("id"), "n_chunks"))
    dealt = dealt.select("bucket", chunk.alias("chunk"), "id", "part", "asks")
    dealt = dealt.join(blocks.select("bucket", "chunk_1", "chunk_2", either.alias("chunk")), ["bucket", "chunk"])
    dealt = dealt.join(sets.select("id", "hashes"), "id").join(keys, "id")
    return dealt.groupBy("bucket", "chunk_1", "chunk_2").applyInArrow(lambda t: _compare_block(t, percent), "a long, b long").distinct()


def _compare_block(block: pa.Table, percent: int) -> pa.Table:
    """Each asking document against all the others of its chunk, or of the other chunk of the block, by the hashes in common."""
    bucket, within = block["bucket"][0].as_py(), block["chunk_1"][0] == block["chunk_2"][0]
    ids, parts, asks, chunks = (block[c].to_numpy() for c in ("id", "part", "asks", "chunk"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in block["hashes"].combine_chunks()]
    keys = np.stack(block["buckets"].to_numpy(zero_copy_only=False)) if len(ids) else np.zeros((0, BANDS), np.int64)
    earlier = int(np.flatnonzero(keys[0] == bucket)[0])
    lengths = np.array([len(s) for s in sets])
    flat, ends = np.concatenate(sets), np.cumsum(lengths)
    starts, found = ends - lengths, set()
    for q in np.flatnonzero(asks).tolist():
        fits = (parts != parts[q]) & (100 * np.minimum(lengths, lengths[q]) >= percent * np.maximum(lengths, lengths[q]))
        fits &= ~(asks & (ids <= ids[q])) & (within | (chunks != chunks[q]))
        fits[fits] = ~(keys[fits, :earlier] == keys[q, :earlier]).any(1)
        at = np.flatnonzero(fits)
        for some in (at[i : i + 4096] for i in range(0, len(at), 4096)):
            picked = np.concatenate([flat[starts[t] : ends[t]] for t in some.tolist()])
            where = np.minimum(np.searchsorted(sets[q], picked), lengths[q] - 1)
            both = np.add.reduceat((sets[q][where] == picked).astype(np.int64), np.cumsum(lengths[some]) - lengths[some])
            for t in some[100 * both >= percent * (lengths[q] + lengths[some] - both)]:
                found.add((int(parts[q]), int(parts[t])))
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_column: str = ID, text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id it is linked with) and kept (it is that id).

    Words are runs without white space, A-Z lower-cased; a document of fewer than ``k`` words has one shingle, all of it.
    Two documents are linked if 100 times the common shingles are at least ``percent`` times those of either. A document
    without words is linked with nothing. Ids are whole numbers; rows that repeat an id repeat the document and get the same
    result. A document with a null id takes no part: its component_id is null, and it is kept.
    """
    steps = Steps(docs.sparkSession, "neardup")
    names = {"id_column": id_column, "text_column": text_column}
    signed = steps.keep(signatures(docs, k, **names).withColumn(ID, F.col(ID).cast("long")))
    classes = signed.filter(F.col("digest").isNotNull() & F.col(ID).isNotNull()).groupBy("digest").agg(
        F.min(ID).alias("id"), F.first("buckets").alias("buckets")
    )
    classes = steps.keep(classes)
    exploded = classes.select(F.explode("buckets").alias("bucket"), "id")
    mask = F.element_at(F.array(*[F.lit(c) for c in CENTRES]), (F.pmod("bucket", F.lit(len(CENTRES))) + 1).cast("int"))
    buckets = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("id").bitwiseXOR(mask)).alias("first"))
    centres = buckets.filter("n > 1").select("bucket", F.col("first").bitwiseXOR(mask).alias("centre"))
    members = steps.keep(exploded.join(centres, "bucket"))
    texts = id_and_text(docs, **names).withColumn(ID, F.col(ID).cast("long"))
    wanted = members.select(F.col("id").alias(ID)).distinct()
    chosen = texts.join(wanted, ID, "left_semi").dropDuplicates([ID])

    def hashed(texts: Texts) -> dict[str, object]:
        found = _sets(texts, k)
        return {"size": pa.array([len(s) for s in found], pa.int64()), "hashes": pa.array([s.tobytes() for s in found], pa.binary())}

    sets = steps.keep(per_document(chosen, hashed, "size long, hashes binary").withColumnRenamed(ID, "id"))
    pairs = members.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    links = steps.keep(_confirmed(pairs, sets, percent))
    parts = steps.keep(connected(links, steps))
    more = steps.keep(_rest(members, parts, sets, classes.select("id", "buckets"), percent, steps))
    joined = connected(more, steps).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    grouped = classes.select("digest", "id").join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = grouped.join(joined, "component", "left").select("digest", F.coalesce("whole", "component").alias("found"))
    answered = signed.select(ID, "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col(ID).isNotNull(), F.coalesce("found", ID))
    return answered.select(ID, "n_shingles", component.alias("component_id"), F.col(ID).eqNullSafe(component).alias("kept"))


def one_of_each_group(docs: DataFrame, k: int = 5, percent: int = 80, id_column: str = ID, text_column: str = "text") -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, with all its columns.

    Of rows that repeat an id one stays. Documents with a null id take no part and stay.
    """
    judged = near_duplicates(docs, k, percent, id_column, text_column)
    kept = judged.filter(F.col("kept") & F.col(ID).isNotNull()).select(F.col(ID).alias(id_column)).distinct()
    unnamed = docs.filter(F.col(id_column).isNull())
    return docs.join(kept, id_column, "left_semi").dropDuplicates([id_column]).select(*docs.columns).unionAll(unnamed)

"""Benchmark decontamination with suffix arrays of the training text.

Every task cuts its documents into shards, writes the suffix array of each shard (on words), and looks every suffix of the
benchmark up in it by binary search. That gives, for each place in the benchmark, its longest verbatim match in the shard and
where it stands; the matches that cover a whole window mark the document words they cover.

A match can only consist of words of the benchmark. A shard's suffix array therefore holds the suffixes that start in a run
of such words that is long enough for a window; all others would be passed over by every search. Documents never leave
their task and no document is split, so nothing is shuffled but the longest matches, one row per benchmark place and shard.

The benchmark is sent to the tasks in blocks of at most ``BLOCK_WORDS`` words each. With several blocks a shard is searched
for one block after the other, so a task holds one block at a time.

Words are compared by 64-bit hashes during the search, and the bytes of a found match are compared before it counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ALNUM_WORD, ID, Texts, Words, id_and_text, pieces, ranges

WINDOW = 13
BLOCK_WORDS = 2_000_000


@dataclass
class Block:
    """Benchmark items as numbered words. Item i has words ``first[i]`` to ``first[i+1]`` of ``words``."""

    item_ids: list[str]
    vocabulary: np.ndarray  # sorted hashes; a word's number is its place plus 1
    words: np.ndarray
    first: np.ndarray
    need: np.ndarray  # per item: words of a window
    text: list[bytes]  # the words themselves, joined by spaces, to confirm matches
    starts: np.ndarray  # of each word in its item's text


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, item: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The benchmark in blocks of bounded size, read one row after the other.

    Items without words and items with a null id, which nothing could name, are left out; repeated rows are read once. All of the
    benchmark passes through the driver, so it has to be small beside the corpus.
    """
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("string").alias("t")).distinct().toLocalIterator():
        lowered = Texts.of(pa.array([row["t"]], pa.string())).lowered()
        words = lowered.words(ALNUM_WORD)
        if row["i"] is None or not len(words.starts):
            continue
        ids.append(row["i"])
        texts.append(b" ".join(lowered.data[s:e].tobytes() for s, e in zip(words.starts, words.ends, strict=True)))
        size += len(words.starts)
        if size >= block_words:
            yield _block(ids, texts, window)
            ids, texts, size = [], [], 0
    if ids:
        yield _block(ids, texts, window)


def _block(ids: list[str], texts: list[bytes], window: int) -> Block:
    words = Texts.of(pa.array(texts, pa.large_binary())).words(ALNUM_WORD)
    vocabulary, numbers = np.unique(words.hashes(), return_inverse=True)
    base = words.texts.offsets[np.searchsorted(words.first, np.arange(len(words.starts)), "right") - 1]
    return Block(ids, vocabulary, numbers + 1, words.first, np.minimum(words.counts(), window), texts, words.starts - base)


@dataclass
class Shard:
    """A suffix array: ``order`` lists the places of ``words`` (0 ends a run) in the order of the suffixes there."""

    words: np.ndarray
    order: np.ndarray
    place: np.ndarray  # the document word each entry of ``words`` stands for, -1 for an end


def suffix_array(numbers: np.ndarray, first: np.ndarray, shortest: int, depth: int) -> Shard:
    """Sort the suffixes that start in runs of at least ``shortest`` known words, by their first ``depth`` words.

    Prefix doubling: suffixes ranked by 1, 2, 4, ... words, until the ranks differ or ``depth`` words are compared.
    """
    known = numbers > 0
    edge = np.zeros(len(numbers) + 1, bool)
    edge[first] = True
    begins = np.flatnonzero(known & (edge[:-1] | ~np.concatenate([[False], known[:-1]])))
    stops = np.flatnonzero(known & (edge[1:] | ~np.concatenate([known[1:], [False]]))) + 1
    long = stops - begins >= shortest
    begins, lengths = begins[long], (stops - begins)[long]
    total = int((lengths + 1).sum())
    place = np.full(total, -1, np.int64)
    to = np.cumsum(lengths + 1) - (lengths + 1)
    filled = ranges(to, lengths)
    place[filled] = ranges(begins, lengths)
    words = np.zeros(total, np.int64)
    words[filled] = numbers[place[filled]]
    rank, done = words.copy(), 1
    order = filled[np.argsort(rank[filled], kind="stable")]
    while done < depth and len(order):
        after = np.zeros(total, np.int64)
        after[: total - done] = rank[done:]
        after[rank == 0] = 0
        key = rank * (int(rank.max()) + 1) + after
        order = filled[np.argsort(key[filled], kind="stable")]
        fresh = np.ones(len(order), bool)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.zeros(total, np.int64)
        rank[order] = np.cumsum(fresh)
        done *= 2
        if fresh.all():
            break
    return Shard(words, order, place)


@dataclass
class Matches:
    longest: np.ndarray  # per benchmark word: length of the longest match starting there
    where: np.ndarray  # an entry of the suffix array with that match
    low: np.ndarray  # the entries that begin with the whole window starting there: low to high
    high: np.ndarray


def search(shard: Shard, block: Block) -> Matches:
    """Binary search of every benchmark suffix, one word deeper per round, all suffixes at once."""
    n = len(block.words)
    item = np.repeat(np.arange(len(block.item_ids)), np.diff(block.first))
    end = block.first[item + 1]
    low, high = np.zeros(n, np.int64), np.full(n, len(shard.order), np.int64)
    longest, where = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    padded = np.concatenate([shard.words, [0]])
    alive, depth = np.arange(n), 0
    while len(alive):
        alive = alive[alive + depth < end[alive]]
        wanted = block.words[alive + depth]
        left = _bound(shard.order, padded, depth, wanted, low[alive], high[alive], strict=False)
        right = _bound(shard.order, padded, depth, wanted, left, high[alive], strict=True)
        found = left < right
        alive, left, right = alive[found], left[found], right[found]
        depth += 1
        low[alive], high[alive], longest[alive] = left, right, depth
        where[alive] = shard.order[left]
        whole = depth == block.need[item[alive]]
        window_low[alive[whole]], window_high[alive[whole]] = left[whole], right[whole]
    return Matches(longest, where, window_low, window_high)


def _bound(order, words, depth, wanted, low, high, strict) -> np.ndarray:
    """First entry in low..high whose word at ``depth`` is not less than (strict: greater than) the wanted one."""
    low, high = low.copy(), high.copy()
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) // 2
        word = words[np.minimum(order[middle] + depth, len(words) - 1)]
        below = word <= wanted[active] if strict else word < wanted[active]
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
        active = active[low[active] < high[active]]
    return low


def _windows(words: Words, shard: Shard, block: Block, found: Matches) -> tuple[np.ndarray, np.ndarray]:
    """Confirmed occurrences of windows: the first document word of each, and the benchmark word it starts at."""
    many = found.high - found.low
    query = np.repeat(np.arange(len(many)), many)
    at = shard.place[shard.order[ranges(found.low, many)]]
    item = np.searchsorted(block.first, query, "right") - 1
    data, right = words.texts.data, np.zeros(len(query), bool)
    wanted: dict[int, bytes] = {}
    for k, (q, w, i) in enumerate(zip(query.tolist(), at.tolist(), item.tolist(), strict=True)):
        need = int(block.need[i])
        if q not in wanted:
            here = block.text[i][block.starts[q] :]
            wanted[q] = b" ".join(here.split(b" ", need)[:need])
        span = words.starts[w : w + need], words.ends[w : w + need]
        right[k] = wanted[q] == b" ".join(data[s:e].tobytes() for s, e in zip(*span, strict=True))
    return at[right], query[right]


def _searched(texts: Texts, block: Block) -> tuple[Words, Shard, Matches]:
    words = texts.lowered().words(ALNUM_WORD)
    hashed = words.hashes()
    at = np.minimum(np.searchsorted(block.vocabulary, hashed), len(block.vocabulary) - 1)
    numbers = np.where(block.vocabulary[at] == hashed, at + 1, 0)
    shard = suffix_array(numbers, words.first, int(block.need.min()), int(np.diff(block.first).max()))
    return words, shard, search(shard, block)


def _hits(texts: Texts, all_blocks: list) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Per document: its words, its words inside a window of the benchmark, and the items with such windows."""
    n_words = texts.words(ALNUM_WORD).counts() if not all_blocks else None
    covered, items = None, [set() for _ in range(len(texts))]
    for block in _one_by_one(all_blocks):
        words, shard, found = _searched(texts, block)
        if covered is None:
            n_words, covered = words.counts(), np.zeros(len(words.starts) + 1, np.int64)
        at, query = _windows(words, shard, block, found)
        item = np.searchsorted(block.first, query, "right") - 1
        np.add.at(covered, at, 1)
        np.add.at(covered, at + block.need[item], -1)
        doc = np.searchsorted(words.first, at, "right") - 1
        for d, i in np.unique(np.stack([doc, item], 1), axis=0).tolist() if len(doc) else []:
            items[d].add(block.item_ids[i])
    if covered is None:
        return n_words, np.zeros(len(texts), np.int64), items
    hit = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return n_words, hit[words.first[1:]] - hit[words.first[:-1]], items


def _sent(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> list:
    context = docs.sparkSession.sparkContext
    return [context.broadcast(block) for block in blocks(benchmark, window, block_words)]


def _one_by_one(sent: list) -> Iterator[Block]:
    """The blocks in a task; with several, each is read from the task's disk when its turn comes and then let go."""
    for one in sent:
        yield one.value
        if len(sent) > 1:
            del one._value


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: words, words inside a benchmark window, the items found, and whether it is contaminated.

    A window is ``window`` consecutive words of an item, or the whole of a shorter item. A document is contaminated if it
    has such words and they are at least one in ``one_in`` of its words. A null or empty text has no words and is clean; repeated
    rows and ids are judged one by one; an empty benchmark leaves every document clean. Columns: doc_id, n_words, n_hit,
    n_items, items (sorted as strings), items_sha256, contaminated.
    """
    kept, sent = id_and_text(docs), _sent(docs, benchmark, window, block_words)
    schema = f"{ID} {kept.schema[ID].dataType.simpleString()}, n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean"

    def batches(incoming):
        for batch in incoming:
            for part, texts in pieces(batch):
                n_words, n_hit, items = _hits(texts, sent)
                named = [sorted(x) for x in items]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(ID), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                        pa.array([len(x) for x in named], pa.int64()), pa.array(named, pa.list_(pa.string())),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in named], pa.string()),
                        pa.array((n_hit > 0) & (one_in * n_hit >= n_words)),
                    ],
                    [ID, "n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"],
                )

    return kept.mapInArrow(batches, schema)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The longest verbatim match of every benchmark suffix anywhere in the documents, and one place where it stands.

    Columns: item_id (string), word (its place in the item, from 0), n_words of the match, doc_id and doc_word of the place
    with the smallest id. Suffixes without a match of a whole window have no row. Each task sends one row per suffix and
    shard; they are reduced before and after the shuffle. Null and empty texts match nothing; rows that repeat an id are one place.
    """
    kept, sent = id_and_text(docs), _sent(docs, benchmark, window, block_words)
    id_type = kept.schema[ID].dataType.simpleString()

    def batches(incoming):
        for batch in incoming:
            for part, texts in pieces(batch):
                for block in _one_by_one(sent):
                    words, shard, found = _searched(texts, block)
                    item = np.repeat(np.arange(len(block.item_ids)), np.diff(block.first))
                    query = np.flatnonzero(found.longest >= block.need[item])
                    at = shard.place[found.where[query]]
                    doc = np.searchsorted(words.first, at, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block.item_ids[i] for i in item[query]], pa.string()),
                            pa.array(query - block.first[item[query]], pa.int64()), pa.array(found.longest[query], pa.int64()),
                            part.column(ID).take(pa.array(doc, pa.int64())), pa.array(at - words.first[doc], pa.int64()),
                        ],
                        ["item_id", "word", "n_words", ID, "doc_word"],
                    )

    found = kept.mapInArrow(batches, f"item_id string, word long, n_words long, {ID} {id_type}, doc_word long")
    best = found.groupBy("item_id", "word").agg(F.min(F.struct((-F.col("n_words")).alias("n"), ID, "doc_word")).alias("best"))
    return best.select("item_id", "word", (-F.col("best.n")).alias("n_words"), f"best.{ID}", "best.doc_word")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = 20, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns; null and empty texts stay, repeated rows each as judged."""
    sent, at = _sent(docs, benchmark, window, BLOCK_WORDS), docs.columns.index(text)

    def batches(incoming):
        for batch in incoming:
            for part, texts in pieces(batch, at):
                n_words, n_hit, _ = _hits(texts, sent)
                yield part.filter(pa.array(~((n_hit > 0) & (one_in * n_hit >= n_words))))

    return docs.mapInArrow(batches, docs.schema)

"""Quality by compression: how much better the dictionary of good texts packs a document than that of bad ones.

Two zstandard dictionaries are trained, on texts labelled good and bad. A text is compressed in chunks of ``CHUNK_BYTES``, each
on its own, so that the dictionaries count to its end. The difference of the two sizes, divided by the larger, and the plain
ratio without a dictionary are calibrated to a probability by a logistic curve, fitted on labelled texts that were not in the
dictionaries.

Fitting takes at most ``MAX_LABELLED`` whole texts of each label, chosen by a hash of their ids. The curve's constant is shifted
by how much more often a label is in all labels than in the sample, so the bound does not make labels equally likely.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ID, TEXT, Texts, filter_documents, id_and_text, per_document

MAX_LABELLED = 1500
CHUNK_BYTES = 2048
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def scores(self, sizes: np.ndarray) -> np.ndarray:
        """Probability of the good label, from the rows of ``packed_sizes``; a text without bytes gets that of the average."""
        return _probability((_features(sizes) - self.centre) / self.scale, self.weights)


def _compressors(good: bytes, bad: bytes) -> list:
    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    made = [zstandard.ZstdCompressor(**options)]
    for raw in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(raw)
        dictionary.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(dict_data=dictionary, **options))
    return made


def packed_sizes(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """Per text: bytes, and packed bytes without a dictionary, with the good and with the bad one."""
    packers = [c.compress for c in _compressors(good, bad)]
    out = np.zeros((len(texts), 4))
    for i, text in enumerate(texts):
        out[i, 0] = len(text)
        for at in range(0, len(text), CHUNK_BYTES):
            chunk = text[at : at + CHUNK_BYTES]
            for j, pack in enumerate(packers):
                out[i, j + 1] += len(pack(chunk))
    return out


def _features(sizes: np.ndarray) -> np.ndarray:
    n, plain, good, bad = sizes.T
    gain = (bad - good) / np.maximum(np.maximum(bad, good), 1)
    ratio = plain / np.maximum(n, 1)
    return np.stack([gain, np.minimum(gain, 0.1), np.minimum(ratio, 0.35), np.log1p(n) * gain], 1)


def _probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[1:] + weights[0], -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton steps for a few features; the ridge keeps separable labels finite."""
    x = np.hstack([np.ones((len(x), 1)), x])
    weights, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ weights)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def held_out(id_column: Column, folds: int, fold: int) -> Column:
    """Whether the id falls into the fold that learning must not see; a null id does."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == fold, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = MAX_LABELLED, folds: int = 5, fold: int = 0) -> list:
    """(text, label, calibrates): a bounded sample of labelled texts of each label, in the order of a hash of their ids.

    Only ids and labels are sorted; the texts of the chosen ids are fetched by a join with them.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(ID).isNotNull() & ~held_out(F.col(ID), folds, fold))
    known = known.select(ID, F.col(label).cast("int").alias("y"), F.xxhash64(ID, F.lit(17)).alias("at")).distinct()
    chosen = [known.filter(F.col("y") == y).orderBy("at", ID).limit(limit) for y in (0, 1)]
    few = F.broadcast(chosen[0].unionAll(chosen[1]))  # at most twice the limit of narrow rows
    found = id_and_text(docs).filter(F.length(TEXT) > 0).select(ID, F.col(TEXT).cast("binary").alias(TEXT)).join(few, ID).orderBy("at", ID)
    return [(bytes(r[TEXT]), r["y"], r["at"] % 3 == 0) for r in found.collect()]


def label_counts(labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0) -> tuple[int, int]:
    """How many documents that learning may see are labelled 0 and 1."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(ID).isNotNull() & ~held_out(F.col(ID), folds, fold))
    found = {r["y"]: r["count"] for r in known.select(ID, F.col(label).cast("int").alias("y")).distinct().groupBy("y").count().collect()}
    return found.get(0, 0), found.get(1, 0)


def fit(sample: list, counts: tuple[int, int] | None = None) -> Model:
    """Dictionaries from two thirds of the sample, the curve from the others. Labels of one kind only give its share as score.

    ``counts`` are the documents of each label that the sample stands for; without them it stands for itself.
    """
    learn = {y: [t for t, label, late in sample if label == y and not late] for y in (0, 1)}
    judge = [(t, y) for t, y, late in sample if late]
    good, bad = (_dictionary(learn[y]) for y in (1, 0))
    y = np.array([label for _, label in judge], float)
    if not len(y) or y.min() == y.max() or not good or not bad:
        share = np.clip(np.mean([label for _, label, _ in sample]) if sample else 0.5, 0.01, 0.99)
        return Model(good, bad, np.array([np.log(share / (1 - share)), 0, 0, 0, 0]), np.zeros(4), np.ones(4))
    x = _features(packed_sizes([t for t, _ in judge], good, bad))
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    weights = _logistic((x - centre) / scale, y)
    if counts and min(counts):
        held = [sum(label == v for _, label, _ in sample) for v in (0, 1)]
        weights[0] += np.log(counts[1] / held[1]) - np.log(counts[0] / held[0])
    return Model(good, bad, weights, centre, scale)


def _dictionary(texts: list[bytes]) -> bytes:
    chunks = [t[at : at + CHUNK_BYTES] for t in texts for at in range(0, len(t), CHUNK_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chunks).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the texts themselves serve as content
        return b"".join(chunks)[-DICTIONARY_BYTES:]


def _plain(texts: Texts) -> list[bytes]:
    return [texts.bytes_of(i) for i in range(len(texts))]


def score(docs: DataFrame, model: Model, threshold: float = 0.3, folds: int = 5, fold: int = 0, **names: str) -> DataFrame:
    """One row per document: doc_id, held_out (learning could not have seen it), score (0 to 1) and predicted (0 or 1).

    Null and empty texts get the score of a text that both dictionaries pack alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(texts: Texts) -> dict[str, object]:
        found = sent.value
        return {"score": found.scores(packed_sizes(_plain(texts), found.good, found.bad))}

    scored = per_document(docs, rows, "score double", **names)
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select(ID, held_out(F.col(ID), folds, fold).alias("held_out"), "score", predicted)


def accepted(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents that score at least the threshold, with all their columns; null and empty texts are judged as in ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts: Texts) -> np.ndarray:
        return sent.value.scores(packed_sizes(_plain(texts), sent.value.good, sent.value.bad)) >= threshold

    return filter_documents(docs, keep)

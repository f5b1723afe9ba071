"""Language by linear support vector machines: first the family, then the languages of that family against one another.

A text's features are its byte trigrams (A-Z lower-cased, runs of anything but letters as one space), hashed into
``FEATURES`` counts and scaled to length one. A machine per family separates it from the other families; inside the family
with the largest margin a machine for every pair of languages gives one vote, and the language with most votes wins, ties by
the sum of margins.

Learning takes at most ``MAX_LABELLED`` documents of each language, chosen by a hash of their ids in one pass over ids and
languages. Tasks make the feature vectors of their whole texts, which come to the driver, where the machines are fitted: its work
and memory grow with the number of languages, not with the corpus. Prediction reads whole texts too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ID, TEXT, Texts, byte_class, id_and_text, per_document, pieces
from millrace.llm.quality import held_out

FEATURES = 1 << 13
MAX_LABELLED = 400

# Families of languages by their codes; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "bn", "mr", "ne", "gu", "pa", "ur"),
}

_LETTERS = byte_class(lambda b: 0x61 <= b <= 0x7A or b >= 0x80)


def family_of(lang: str) -> str:
    return next((family for family, langs in FAMILIES.items() if lang.lower().split("-")[0] in langs), f"only {lang}")


@dataclass
class Model:
    """Weights of the machines, a column each: first one per family, then one per pair of languages of a family."""

    families: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray


def _grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all documents in a row, and the document of each; none reaches over the end of a document."""
    data = texts.lowered().data
    letters = _LETTERS[data]
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # the first byte behind a word stands for all between it and the next
    keep[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(keep)
    doc = np.searchsorted(texts.offsets, at, "right") - 1
    code = np.where(letters[at], data[at], 0x20).astype(np.uint32)
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = (code[:-2] << 16) | (code[1:-1] << 8) | code[2:]
    return ((whole * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)).astype(np.int64)[doc[:-2] == doc[2:]], doc[:-2][doc[:-2] == doc[2:]]


def _has_letter(texts: Texts) -> np.ndarray:
    """Whether a text has any letter of any script; only texts without an ASCII letter are decoded."""
    ascii_letters = np.concatenate([[0], np.cumsum(_LETTERS[:128][np.minimum(texts.lowered().data, 127)] & (texts.data < 0x80))])
    found = ascii_letters[texts.offsets[1:]] > ascii_letters[texts.offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(texts.offsets) > 0)):
        found[i] = any(map(str.isalpha, texts.bytes_of(i).decode("utf-8", "replace")))
    return found


def _vectors(texts: Texts) -> np.ndarray:
    grams, doc = _grams(texts)
    counts = np.bincount(doc * FEATURES + grams, minlength=len(texts) * FEATURES).reshape(-1, FEATURES).astype(np.float32)
    return _scaled(counts)


def _scaled(counts: np.ndarray) -> np.ndarray:
    counts = np.sqrt(counts)
    return counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)


def learning_sample(docs: DataFrame, limit: int = MAX_LABELLED, folds: int = 4, fold: int = 2, lang: str = "lang") -> tuple[np.ndarray, list[str]]:
    """Feature vectors and languages of a bounded sample. The ids are ranked per language without their texts."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(ID).isNotNull() & ~held_out(F.col(ID), folds, fold))
    known = known.select(ID, F.col(lang).alias("y"), F.xxhash64(ID, F.lit(29)).alias("at"))
    # Spark keeps the first rows of a language in each task already, so no language meets in one task.
    rank = F.row_number().over(W.partitionBy("y").orderBy("at", ID))
    few = known.withColumn("rank", rank).filter(F.col("rank") <= limit).select(ID, "y", "at").distinct()
    # At most ``limit`` narrow rows of each language.
    found = id_and_text(docs).filter(F.length(TEXT) > 0).join(F.broadcast(few), ID).select("y", "at", ID, TEXT)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                each = [_vectors(texts.one(i))[0] for i in range(len(texts))]
                cells = [np.flatnonzero(x) for x in each]
                made = [pa.array([c.astype("<u2").tobytes() for c in cells], pa.binary()), pa.array([x[c].tobytes() for x, c in zip(each, cells, strict=True)], pa.binary())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("y", "at", ID)), *made], ["y", "at", ID, "cells", "values"])

    kinds = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in ("y", "at", ID))
    table = found.mapInArrow(vectors, f"{kinds}, cells binary, values binary").orderBy("y", "at", ID).toArrow()
    x = np.zeros((len(table), FEATURES), np.float32)
    for i, (cells, values) in enumerate(zip(table["cells"].to_pylist(), table["values"].to_pylist(), strict=True)):
        x[i, np.frombuffer(cells, "<u2")] = np.frombuffer(values, np.float32)
    return x, table["y"].to_pylist()


def _machine(x: np.ndarray, y: np.ndarray, rounds: int = 30, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by coordinate steps on the dual."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    alpha, w, square = np.zeros(len(x)), np.zeros(x.shape[1]), (x.astype(np.float64) ** 2).sum(1) + 1 / (2 * cost)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            gradient = y[i] * (w @ x[i]) - 1 + alpha[i] / (2 * cost)
            new = max(0.0, alpha[i] - gradient / square[i])
            if new != alpha[i]:
                moved = max(moved, abs(new - alpha[i]))
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        if moved < 1e-3:
            break
    return w[:-1], float(w[-1])


def fit(x: np.ndarray, langs: list[str]) -> Model:
    known = sorted(set(langs))
    families: dict[str, list[str]] = {}
    for lang in known:
        families.setdefault(family_of(lang), []).append(lang)
    y, of = np.array(langs), np.array([family_of(lang) for lang in langs])
    machines = [_machine(x, np.where(of == f, 1.0, -1.0)) if len(families) > 1 else (np.zeros(FEATURES), 0.0) for f in families]
    pairs = [pair for langs in families.values() for pair in combinations(langs, 2)]
    for a, b in pairs:
        some = (y == a) | (y == b)
        machines.append(_machine(x[some], np.where(y[some] == a, 1.0, -1.0)))
    weights = np.stack([w for w, _ in machines], 1).astype(np.float32) if machines else np.zeros((FEATURES, 0), np.float32)
    return Model(families, pairs, weights, np.array([b for _, b in machines]))


def _margins(texts: Texts, model: Model) -> np.ndarray:
    """A row of margins per document, from the counts of its different trigrams."""
    grams, doc = _grams(texts)
    out = np.zeros((len(texts), model.weights.shape[1]), np.float64)
    ends = np.searchsorted(doc, np.arange(len(texts) + 1))
    for some in (range(i, min(i + 256, len(texts))) for i in range(0, len(texts), 256)):
        low, high = ends[some.start], ends[some.stop]
        cells = (doc[low:high] - some.start) * FEATURES + grams[low:high]
        counts = np.bincount(cells, minlength=len(some) * FEATURES).reshape(-1, FEATURES)
        out[some.start : some.stop] = _scaled(counts.astype(np.float32)) @ model.weights + model.bias
    return out


def _decide(margins: np.ndarray, model: Model) -> tuple[list[str | None], np.ndarray]:
    """The language of each row, and a score that grows with the smallest margin it won by."""
    if not model.families:
        return [None] * len(margins), np.zeros(len(margins))
    names = list(model.families)
    best = margins[:, : len(names)].argmax(1)
    sure = margins[np.arange(len(margins)), best] if len(names) > 1 else np.full(len(margins), 5.0)
    langs: list[str | None] = [None] * len(margins)
    for f, family in enumerate(names):
        rows, members = np.flatnonzero(best == f), model.families[family]
        votes = np.zeros((len(rows), len(members)))
        closest = np.full((len(rows), len(members)), 5.0)
        for j, (a, b) in enumerate(model.pairs):
            if a in members:
                margin = margins[rows, len(names) + j]
                for lang, own in ((a, margin), (b, -margin)):
                    k = members.index(lang)
                    votes[:, k] += (own > 0) + 1e-3 * np.tanh(own)
                    closest[:, k] = np.minimum(closest[:, k], own)
        won = votes.argmax(1)
        sure[rows] = np.minimum(sure[rows], closest[np.arange(len(rows)), won])
        for row, k in zip(rows.tolist(), won.tolist(), strict=True):
            langs[row] = members[k]
    return langs, 1 / (1 + np.exp(-2 * np.clip(sure, -15, 15)))


def predict(docs: DataFrame, model: Model, folds: int = 4, fold: int = 2, **names: str) -> DataFrame:
    """One row per document: doc_id, held_out (learning could not have seen it), lang_pred and score (0 to 1).

    A null text, one without any letter, and every text when nothing was learned, is ``und`` with score 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(texts: Texts) -> dict[str, object]:
        langs, scores = _decide(_margins(texts, sent.value), sent.value)
        told = _has_letter(texts) & texts.valid & np.array([x is not None for x in langs], bool)
        named = pc.if_else(pa.array(told), pa.array(langs, pa.string()), pa.scalar("und"))
        return {"lang_pred": named, "score": pa.array(np.where(told, scores, 0.0))}

    predicted = per_document(docs, rows, "lang_pred string, score double", **names)
    return predicted.select(ID, held_out(F.col(ID), folds, fold).alias("held_out"), "lang_pred", "score")

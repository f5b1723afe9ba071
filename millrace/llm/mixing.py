"""Mixing to target weights with soft membership, in DataFrame functions only.

1. A classifier learns the domains from a labelled table and gives every document a probability for each domain.
2. Projected-gradient least squares finds a rate for each document, never negative, such that the expected tokens of each
   domain (the sum over documents of rate, tokens and probability) come as near the targets as rates can bring them. The
   gradient of a document is its probabilities times one miss for each domain, so its rate, a gradient step from 1 projected
   to what is not negative, follows from those few numbers. Plain steps need thousands of rounds where the classifier is
   unsure; here the misses are stepped by their curvature, which converges in a few. A round is one aggregate to as many
   numbers as there are pairs of domains, over a narrow table that is written once.
3. A document is then taken as often as its rate says: the whole part for sure, the rest by a hash of its id.

The objective divides each domain's squared miss by the domain's tokens, which makes all domains move at the same speed, and a
small ``pull`` draws rates to 1, so that of many solutions the one nearest to the corpus as it is results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ID, TEXT, id_and_text
from millrace.llm.components import Steps

FEATURES = 1 << 12
MAX_LABELLED = 2000
PULL = 1e-3
TOLERANCE = 1e-7  # of all tokens: how far the misses may be from their gradient's zero

# The domains that labels tell apart, and the share of the tokens that each is to have.
DOMAINS = ("clean", "toxic", "poor")
TARGETS = {"clean": 0.95, "toxic": 0.04, "poor": 0.01}


def domain_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain: poor if the quality is 0, else toxic or clean. Rows without a quality have none."""
    kind = F.when(F.col("quality") == 0, "poor").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
    return labels.select(ID, kind.alias("domain")).filter("doc_id IS NOT NULL AND domain IS NOT NULL")


def _features(df: DataFrame) -> DataFrame:
    """Adds ``features``, hashed word counts scaled to length one, and ``tokens``."""
    words = RegexTokenizer(inputCol=TEXT, outputCol="_words", pattern=r"\s+", toLowercase=True).transform(df)
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=FEATURES).transform(words)
    scaled = Normalizer(inputCol="_counts", outputCol="features").transform(counts)
    return scaled.withColumn("tokens", F.size("_words").cast("double")).drop("_words", "_counts")


def labelled_sample(docs: DataFrame, domains: DataFrame, names: Sequence[str] = DOMAINS, limit: int = MAX_LABELLED) -> DataFrame:
    """Texts and domain numbers of at most ``limit`` documents of each domain, those with the smallest hashes of their ids."""
    known = domains.select(ID, "domain", F.xxhash64(ID, F.lit(41)).alias("at")).distinct()
    few = None
    for i, name in enumerate(names):
        some = known.filter(F.col("domain") == name).orderBy("at", ID).limit(limit).select(ID, F.lit(float(i)).alias("label"))
        few = some if few is None else few.unionAll(some)
    return id_and_text(docs).filter(F.col(TEXT).isNotNull()).join(F.broadcast(few), ID).select(TEXT, "label")


def posteriors(docs: DataFrame, domains: DataFrame, names: Sequence[str] = DOMAINS, steps: Steps | None = None) -> DataFrame:
    """doc_id, at (hash of the text), tokens, and ``p``: the probabilities of the domains in the order of ``names``.

    A null text counts as empty. With labels of fewer than two domains all documents get the labels' shares.
    """
    steps = steps or Steps(docs.sparkSession, "mixing")
    sample = steps.keep(_features(labelled_sample(docs, domains, names).coalesce(8)).select("features", "label"))
    seen = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    texts = id_and_text(docs).select(ID, F.coalesce(TEXT, F.lit("")).alias(TEXT))
    scored = _features(texts.withColumn("at", F.xxhash64(TEXT)))
    if len(seen) < 2:
        shares = [(seen.get(float(i), 0) / sum(seen.values())) if seen else 1 / len(names) for i in range(len(names))]
        return scored.select(ID, "at", "tokens", F.array(*map(F.lit, shares)).alias("p"))
    classifier = LogisticRegression(maxIter=30, regParam=1e-4, family="multinomial", aggregationDepth=2).fit(sample)
    told = classifier.transform(scored).select(ID, "at", "tokens", vector_to_array("probability").alias("p"))
    # A label that never occurs and is the last has no place in the classifier's output. The sample has as many documents of a
    # frequent domain as of a rare one, so probabilities are weighed by how much more often a label is than it is in the sample.
    labelled = {r["domain"]: r["count"] for r in domains.filter(F.col("domain").isin(list(names))).select(ID, "domain").distinct().groupBy("domain").count().collect()}
    weights = [labelled.get(name, 0) / seen[float(i)] if seen.get(float(i)) else 0.0 for i, name in enumerate(names)]
    weighed = [F.coalesce(F.get("p", F.lit(i)), F.lit(0.0)) * F.lit(float(w)) for i, w in enumerate(weights)]
    told = told.withColumn("w", F.array(*weighed)).withColumn("all", F.aggregate("w", F.lit(0.0), lambda a, b: a + b))
    return told.select(ID, "at", "tokens", F.transform("w", lambda x: x / F.col("all")).alias("p"))


def _rate(multipliers: Sequence[float], pull: float) -> Column:
    """The projected gradient step from 1 for these misses of the domains."""
    slope = sum((F.col(f"p{k}") * F.lit(float(x)) for k, x in enumerate(multipliers)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - slope / F.lit(pull))


def _cost(multipliers: Sequence[float], pull: float) -> Column:
    """What the documents add to the objective: their rates' pull and gradient, summed over tokens."""
    rate = _rate(multipliers, pull)
    slope = sum((F.col(f"p{k}") * F.lit(float(x)) for k, x in enumerate(multipliers)), F.lit(0.0))
    return F.coalesce(F.sum(F.col("tokens") * (-slope * rate - F.lit(pull / 2) * (rate - 1) * (rate - 1))), F.lit(0.0))


HALVINGS = 30


def _misses(table: DataFrame, mass: np.ndarray, wanted: np.ndarray, usable: np.ndarray, pull: float, tolerance: float) -> np.ndarray:
    """The misses of the domains (over their tokens) at which the rates that follow from them give just these misses.

    They are the minimum of a convex function, so steps by its curvature, halved until it falls enough, end at it from anywhere.
    """
    n, whole = len(mass), mass.sum()
    pairs = [(j, k) for j in range(n) for k in range(j, n)]

    def own(x: np.ndarray) -> float:
        return float((mass * x * x / 2 + wanted * x)[usable].sum())

    def look(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        rate, tokens = _rate(x, pull), F.col("tokens")
        got = [F.sum(rate * tokens * F.col(f"p{k}")) for k in range(n)]
        moved = [F.sum(F.when(rate > 0, tokens * F.col(f"p{j}") * F.col(f"p{k}")).otherwise(0.0)) for j, k in pairs]
        row = table.agg(*got, *moved, _cost(x, pull)).first()
        curve = np.zeros((n, n))
        for (j, k), value in zip(pairs, row[n:-1], strict=True):
            curve[j, k] = curve[k, j] = value / pull
        return mass * x + wanted - np.array(row[:n]), curve + np.diag(mass), row[-1] + own(x)

    x = np.zeros(n)
    slope, curve, cost = look(x)
    while np.abs(slope[usable]).max() > tolerance * whole:
        step = np.zeros(n)
        step[usable] = np.linalg.solve(curve[np.ix_(usable, usable)], -slope[usable])
        fall = float(slope @ step)
        ahead = look(x + step)
        if ahead[2] > cost + 1e-4 * fall:
            tried = [0.5**i for i in range(1, HALVINGS)]
            costs = table.agg(*[_cost(x + t * step, pull) for t in tried]).first()
            good = [t for t, c in zip(tried, costs, strict=True) if c + own(x + t * step) <= cost + 1e-4 * t * fall]
            if not good:  # no step falls any more: the numbers' precision is reached
                return x
            step = good[0] * step
            ahead = look(x + step)
        x, (slope, curve, cost) = x + step, ahead
    return x


def fit_rates(members: DataFrame, targets: Sequence[float], steps: Steps, pull: float = PULL, tolerance: float = TOLERANCE) -> DataFrame:
    """``members`` (tokens and p) with a column ``rate``. ``targets`` are the shares of the domains in all tokens.

    The rates are those of the least sum of squared misses (each over its domain's tokens) and, with the weight ``pull``, of
    squared distances from 1. What is still missed at them, no rates that are not negative can bring (see ``reached``), but for
    a small part that the pull costs. A domain without tokens is left out of the fit; without any tokens all rates stay 1.
    """
    n = len(targets)
    columns = [c for c in members.columns if c not in ("tokens", "p")]
    table = steps.keep(members.select(*columns, "tokens", *[F.col("p")[k].alias(f"p{k}") for k in range(n)]))
    have = [F.coalesce(F.sum(F.col("tokens") * F.col(f"p{k}")), F.lit(0.0)) for k in range(n)]
    mass = np.array(table.agg(*have).first(), float)
    usable = mass > 1e-9 * mass.sum()
    share = float(np.array(targets, float)[usable].sum())
    misses = np.zeros(n)
    if mass.sum() > 0 and share > 0:
        wanted = np.where(usable, mass.sum() * np.array(targets, float) / share, 0.0)
        misses = _misses(table, mass, wanted, usable, pull, tolerance)
    return table.select(*columns, "tokens", F.array(*[F.col(f"p{k}") for k in range(n)]).alias("p"), _rate(misses, pull).alias("rate"))


def reached(fitted: DataFrame, n: int) -> list[float]:
    """The shares of the domains in the expected tokens of the mix."""
    parts = [F.sum(F.col("rate") * F.col("tokens") * F.col("p")[k]) for k in range(n)]
    got = [x or 0.0 for x in fitted.agg(*parts).first()]
    return [x / sum(got) if sum(got) else 0.0 for x in got]


def copies_of(rate: Column, key: Column, at: Column) -> Column:
    """How often a document is taken: the whole part of its rate, and once more with the probability of the rest."""
    chance = F.pmod(F.xxhash64(key, at, F.lit(53)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return F.floor(rate + chance).cast("long")


def rates(docs: DataFrame, domains: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """One row per document: doc_id, tokens, p_<domain>, rate and copies (how often the mix takes it).

    Tokens are the words between white space. A null or empty text has none; its rate follows from its posteriors and moves
    nothing. Repeated rows each have their rate. An empty table gives an empty result.
    """
    names, steps = list(targets), Steps(docs.sparkSession, "mixing")
    fitted = fit_rates(posteriors(docs, domains, names, steps), [targets[x] for x in names], steps)
    return fitted.select(
        ID, "at", F.col("tokens").cast("long").alias("tokens"), *[F.col("p")[k].alias(f"p_{x}") for k, x in enumerate(names)],
        "rate", copies_of(F.col("rate"), F.col(ID), F.col("at")).alias("copies"),
    )


def mixed(docs: DataFrame, domains: DataFrame, targets: Mapping[str, float] = TARGETS) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns. Repeated rows are taken as often as they stand."""
    taken = rates(docs, domains, targets).select(F.col(ID).alias("_mixing_id"), F.col("at").alias("_mixing_at"), F.col("copies").alias("_mixing_copies")).distinct()
    at = F.xxhash64(F.coalesce(F.col(TEXT).cast("string"), F.lit("")))
    joined = docs.withColumn("_mixing_key", at).join(taken, F.col(ID).eqNullSafe(F.col("_mixing_id")) & (F.col("_mixing_key") == F.col("_mixing_at")))
    repeated = joined.filter("_mixing_copies > 0").withColumn("_mixing_copy", F.explode(F.sequence(F.lit(1), F.col("_mixing_copies"))))
    return repeated.select(*[F.col(c) for c in docs.columns])

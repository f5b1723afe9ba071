import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing
from millrace.llm.components import Steps
from tests.conftest import rows
from tests.llm.helpers import ODD, documents, table


def members(spark, rows_):
    return spark.createDataFrame([(i, float(t), p) for i, (t, p) in enumerate(rows_)], "doc_id long, tokens double, p array<double>")


def shares(fitted, n):
    got = fitted.agg(F.sum(F.col("rate") * F.col("tokens")), *[F.sum(F.col("rate") * F.col("tokens") * F.col("p")[k]) for k in range(n)]).first()
    return [x / got[0] for x in got[1:]]


def test_rates_reach_the_targets_and_are_never_negative(spark):
    rows_ = [(10 + i % 7, [0.9, 0.05, 0.05]) for i in range(50)] + [(20, [0.1, 0.8, 0.1])] * 20 + [(5, [0.2, 0.2, 0.6])] * 30
    for targets in ([0.5, 0.3, 0.2], [0.8, 0.1, 0.1]):
        fitted = mixing.fit_rates(members(spark, rows_), targets, Steps(spark, "test"))
        assert fitted.filter("rate < 0").count() == 0
        assert shares(fitted, 3) == pytest.approx(targets, abs=0.01)


def test_an_unsure_classifier_gets_the_best_rates_there_are(spark):
    """Against a projected gradient in numpy that runs on until nothing moves; the poor share cannot be brought to its target."""
    rng = np.random.default_rng(2)
    p = 0.5 * rng.dirichlet([8, 0.5, 0.5], 400) + 0.5 * np.array([0.8, 0.08, 0.12])
    tokens, targets = rng.integers(1, 200, 400).astype(float), np.array([0.95, 0.04, 0.01])
    rows_ = [(t, q.tolist()) for t, q in zip(tokens, p, strict=True)]
    fitted = mixing.fit_rates(members(spark, rows_), targets.tolist(), Steps(spark, "test"))
    got = np.array([r.rate for r in fitted.orderBy("doc_id").collect()])
    mass, whole = tokens @ p, tokens.sum()
    best = np.ones(400)
    for _ in range(200_000):
        miss = ((best * tokens) @ p - whole * targets) / mass
        new = np.maximum(0, best - (p @ miss + mixing.PULL * (best - 1)) / (1 + mixing.PULL))
        if np.abs(new - best).max() < 1e-12:
            break
        best = new
    assert got == pytest.approx(best, abs=1e-3) and (got >= 0).all() and (got == 0).any()
    assert mixing.reached(fitted, 3)[2] > 0.05
    assert shares(fitted, 3) == pytest.approx(mixing.reached(fitted, 3))


def test_the_mix_of_the_documents_reaches_its_targets(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    steps, names = Steps(spark, "test"), list(mixing.TARGETS)
    fitted = mixing.fit_rates(mixing.posteriors(docs, mixing.domain_of(labels), names, steps), [mixing.TARGETS[x] for x in names], steps)
    assert mixing.reached(fitted, 3) == pytest.approx(list(mixing.TARGETS.values()), abs=0.005)


@pytest.mark.parametrize("limit", [10, 2000])
def test_the_bound_on_labels_does_not_make_the_domains_equally_frequent(spark, monkeypatch, limit):
    """Texts that tell nothing get the labels' shares, whether or not the sample holds all of a frequent domain."""
    docs = documents(spark, ["same old words"] * 110)
    domains = spark.createDataFrame([(i, "poor" if i < 10 else "clean") for i in range(100)], "doc_id long, domain string")
    monkeypatch.setattr(mixing.labelled_sample, "__defaults__", (mixing.DOMAINS, limit))
    for r in mixing.posteriors(docs, domains).collect():
        assert r.p == pytest.approx([0.9, 0.0, 0.1], abs=0.02)


def test_rates_without_tokens_without_a_domain_and_without_rows(spark):
    none = mixing.fit_rates(members(spark, [(0, [0.5, 0.5])] * 3), [0.5, 0.5], Steps(spark, "test"))
    assert {r.rate for r in none.collect()} == {1.0}
    one = mixing.fit_rates(members(spark, [(4, [1.0, 0.0])] * 3), [0.5, 0.5], Steps(spark, "test"))
    assert [r.rate for r in one.collect()] == pytest.approx([1.0] * 3, abs=0.01)
    assert mixing.fit_rates(members(spark, [(4, [1.0, 0.0])]).limit(0), [0.5, 0.5], Steps(spark, "test")).count() == 0


def test_copies_are_the_rate_on_average(spark):
    ids = spark.range(20_000)
    for rate in (0.0, 0.3, 1.0, 2.25):
        got = [r.n for r in ids.select(mixing.copies_of(F.lit(rate), F.col("id"), F.lit(0)).alias("n")).collect()]
        assert set(got) <= {int(rate), int(rate) + 1} and sum(got) / len(got) == pytest.approx(rate, abs=0.02)


def test_posteriors_tell_labelled_domains_apart_and_the_mix_follows_the_copies(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    domains = mixing.domain_of(labels)
    found = mixing.rates(docs, domains)
    rated = found.withColumn("most", F.greatest("p_clean", "p_toxic", "p_poor")).collect()
    assert len(rated) == docs.count() and all(abs(r.p_clean + r.p_toxic + r.p_poor - 1) < 1e-6 for r in rated)
    told = {r.doc_id: r.domain for r in domains.collect()}
    right = [r[f"p_{told[r.doc_id]}"] == r.most for r in rated if r.doc_id in told]
    assert sum(right) / len(right) > 0.85
    mix = mixing.mixed(docs, domains)
    assert mix.columns == docs.columns
    assert rows(mix.groupBy("doc_id").count()) == sorted([(r.doc_id, r.copies) for r in rated if r.copies], key=repr)


def test_odd_texts_repeated_rows_null_ids_clashing_columns_and_no_labels(spark):
    docs = documents(spark, [*enumerate(ODD), (500, "a b"), (500, "a b"), (None, "c")], extra=["tokens", "p", "rate", "features", "label"])
    labels = table(spark, "labels")
    for domains in (mixing.domain_of(labels), mixing.domain_of(labels.limit(0))):
        got = mixing.rates(docs, domains).collect()
        assert len(got) == len(ODD) + 3 and all(r.rate >= 0 for r in got) and len({r.rate for r in got if r.doc_id == 500}) == 1
        assert mixing.rates(docs.limit(0), domains).count() == 0
        assert mixing.mixed(docs, domains).columns == docs.columns

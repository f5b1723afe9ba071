"""URL filters: hand-written host and path rules, and gradient-boosted trees where no rule decides. DataFrame functions only.

The trees learn from labelled URLs; without any given, from those that the rules decide. Their features are lexical: lengths, depth, share of
digits, entropy of the characters, parameters, and statistics of the host's suffixes among the labelled URLs (how many there
are and which share is blocked, smoothed). Fitting takes at most ``MAX_LABELLED`` URLs, chosen by a hash, so
the statistics table has at most three suffixes for each of them and is sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import Steps

MAX_LABELLED = 5000
TREES, DEPTH = 10, 3

# (verdict, host and path)
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

FEATURES = ["n_url", "n_host", "n_path", "depth", "labels", "digits", "entropy", "params", "dashes", "seen_1", "share_1", "seen_2", "share_2", "seen_3", "share_3"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and for texts without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits: a struct of its length, text and verdict, or null. Of equally long ones the last by text."""
    fitting = []
    for verdict, rule in rules:
        own, _, start = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(f"/{start}"))
        fitting.append(F.when(fits, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    found = "array<struct<length:int,rule:string,verdict:string>>"  # also without any rules
    return F.array_max(F.array_compact(F.array(*fitting).cast(found)))


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for an empty text."""
    n = F.greatest(F.length(text), F.lit(1))
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0)))


def with_lexical(df: DataFrame, url: str) -> DataFrame:
    """Add host, path, the host's last one, two and three labels, and the lexical features."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host, path = parts(F.col(url).cast("string"))
    split = df.withColumns({"host": host, "path": path, "_url": text})
    labels = F.split("host", r"\.")
    query = F.regexp_extract("_url", r"\?([^#]*)", 1)
    return split.withColumns({
        **{f"suffix_{k}": F.concat_ws(".", F.slice(labels, -F.least(F.size(labels), F.lit(k)), k)) for k in (1, 2, 3)},
        "n_url": F.length("_url").cast("double"),
        "n_host": F.length("host").cast("double"),
        "n_path": F.length("path").cast("double"),
        "depth": F.regexp_count("path", F.lit("/[^/]")).cast("double"),
        "labels": F.size(labels).cast("double"),
        "digits": F.regexp_count("_url", F.lit("[0-9]")) / F.greatest(F.length("_url"), F.lit(1)),
        "entropy": _entropy(F.col("_url")),
        "params": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(F.lit(0)).cast("double"),
        "dashes": F.regexp_count("host", F.lit("[-_]")).cast("double"),
    }).drop("_url")


def _statistics(labelled: DataFrame, k: int) -> DataFrame:
    """Per suffix of k labels: the logarithm of its labelled URLs and the smoothed share of blocked ones."""
    counted = labelled.groupBy(f"suffix_{k}").agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("bad"))
    return counted.select(f"suffix_{k}", F.log1p("n").alias(f"seen_{k}"), ((F.col("bad") + 1) / (F.col("n") + 2)).alias(f"share_{k}"))


def _with_statistics(df: DataFrame, labelled: DataFrame) -> DataFrame:
    for k in (1, 2, 3):
        df = df.join(F.broadcast(_statistics(labelled, k)), f"suffix_{k}", "left")
    return df.fillna({f"seen_{k}": 0.0 for k in (1, 2, 3)} | {f"share_{k}": 0.5 for k in (1, 2, 3)})


def labelled_sample(df: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """At most ``limit`` labelled URLs, those with the smallest hashes, so that both labels keep their shares. Needs columns
    url and blocked (0 or 1); a URL with both labels counts with each."""
    known = df.filter(F.col("blocked").isin(0, 1) & F.col("url").isNotNull()).select("url", F.col("blocked").cast("double").alias("blocked"))
    return known.distinct().orderBy(F.xxhash64("url"), "url", "blocked").limit(limit)


def fit(sample: DataFrame) -> tuple[DataFrame, GBTClassificationModel | None, float]:
    """The labelled URLs with their suffixes, the trees, and the share of blocked ones. No trees unless there are both labels."""
    # Written once, so that the many passes of the fit do not search the whole table again.
    small = Steps(sample.sparkSession, "urls").keep(with_lexical(sample.coalesce(1), "url"))
    n, bad = small.agg(F.count(F.lit(1)), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    if bad in (0, n):
        return small, None, bad / max(n, 1)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(_with_statistics(small, small))
    trees = GBTClassifier(featuresCol="features", labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=5, minInstancesPerNode=5)
    return small, trees.fit(assembled.select("features", "blocked")), bad / n


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None, key: str = "page_id", url: str = "url", limit: int = MAX_LABELLED) -> DataFrame:
    """One row per page: its key, host, path, rule (or null), verdict (allow or block) and score (probability of block).

    ``labelled`` holds URLs and ``blocked`` (0 or 1); without it the URLs that the rules decide are used. A rule's verdict
    stands; without one the page is blocked if its score is above one half. A null URL has no host and path. Rows are
    judged one by one, repeated ones too. Without labelled URLs of both kinds the score is the share of blocked ones.
    """
    narrow = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("url"))
    host, path = parts(F.col("url"))
    ruled = narrow.withColumn("found", rule_of(host, path, rules))
    if labelled is None:
        labelled = ruled.filter("found is not null").select("url", (F.col("found.verdict") == "block").cast("int").alias("blocked"))
    suffixes, trees, share = fit(labelled_sample(labelled, limit))
    features = _with_statistics(with_lexical(ruled, "url"), suffixes)
    if trees is None:
        scored = features.withColumn("score", F.lit(float(share)))
    else:
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)
        scored = trees.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    verdict = F.coalesce("found.verdict", F.when(F.col("score") > 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select(F.col("_key").alias(key), "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), "score")

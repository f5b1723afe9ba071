"""Merkle manifest of a dataset: a content-addressed tree of digests, proofs of membership, and their verification.

Every row is a leaf. The leaves of a group (say, of a source) stand in order, and each run of ``fanout`` nodes is hashed into
a node of the next level until one is left; the groups' roots, in the order of the groups, are hashed into one root likewise.

* **Ranks** come from one exchange by ranges of (group, order): a slice knows how many rows of its groups stand in earlier
  slices from a table of counts, so a group of any size is spread over slices, and no window runs over a whole group.
* **Store**: each level is a table of records, digest and children. A record is one run, so a group in Spark is never larger
  than ``fanout`` rows. Equal subtrees have equal digests and are one record.
* **Descent**: requests start at the root and follow the digits of their rank in base ``fanout``. Requests with the same
  leading digits travel as one row; at each level that row looks its digest up in the store, goes on with the child of each
  requested digit, and takes the other children along. So a level has at most as many rows as it has nodes, and only the
  last join, which nothing has to be shuffled after, has one row for each request. A proof is these segments, reversed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.components import Steps

SIZE = 32  # bytes of a digest
PATH = "array<struct<digit:int,others:binary>>"


def field(value: Column) -> Column:
    """A value as hashed: its length in UTF-8 bytes, a colon and its text, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(field(v) for v in values)), 256))


def leaves_of(docs: DataFrame, group: str, key: str, columns: list[str], **more: Column) -> DataFrame:
    """A leaf for each row: ``grp``, ``key``, the digest of ``columns`` (in this order, nulls too), and more columns to carry along."""
    digest = leaf_digest(*(F.col(c) for c in columns)).alias("leaf")
    return docs.select(F.col(group).alias("grp"), F.col(key).alias("key"), digest, *(c.alias(name) for name, c in more.items()))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf and the segments of its proof give."""

    def up(below: Column, segment: Column) -> Column:
        before = F.substring(segment["others"], F.lit(1), segment["digit"] * SIZE)
        after = F.substring(segment["others"], segment["digit"] * SIZE + 1, F.octet_length(segment["others"]))
        return F.sha2(F.concat(hex_text(before), below, hex_text(after)), 256)

    return F.aggregate(path, hex_text(leaf), up)


def siblings_digest(path: Column) -> Column:
    """The digest (hex) of all siblings of a proof, in the order of its segments."""
    return F.sha2(F.array_join(F.transform(path, lambda segment: hex_text(segment["others"])), ""), 256)


def _ranked(rows: DataFrame, order: list[str], steps: Steps) -> DataFrame:
    """``rank`` of each row in its ``grp`` (from 0) and ``n``, the rows of the group. Nulls come first."""
    by = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    dealt = steps.keep(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("slice", F.shiftright("at", 33))
    counts = dealt.groupBy("grp", "slice").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    group = W.partitionBy("grp")
    earlier = F.sum("here").over(group.orderBy("slice").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select(
        F.col("grp").alias("of"), F.col("slice").alias("in"), (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(group).alias("n"),
    )
    joined = dealt.join(counts, F.col("grp").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("in")))
    return steps.keep(joined.withColumn("rank", F.col("at") + F.col("shift")).drop("at", "slice", "of", "in", "shift"))


@dataclass
class Tree:
    """``levels[i]`` holds the records (grp, rank, digest, children) made of the nodes of level i; ``roots`` has (grp, depth, digest)."""

    levels: list[DataFrame]
    roots: DataFrame
    fanout: int

    @classmethod
    def of(cls, leaves: DataFrame, steps: Steps, fanout: int) -> Tree:
        """The trees of ``leaves`` (grp, rank, n, digest), one of each group."""
        nodes, levels = leaves.select("grp", "rank", "n", "digest"), []
        roots = [nodes.filter("n = 1").select("grp", F.lit(0).alias("depth"), "digest")]
        most = nodes.agg(F.max("n")).first()[0] or 0
        while most > 1:
            run = F.sort_array(F.collect_list(F.struct("rank", "digest")))
            parent = F.floor(F.col("rank") / fanout).alias("rank")
            runs = nodes.filter("n > 1").groupBy("grp", parent, F.ceil(F.col("n") / fanout).alias("n")).agg(run.alias("run"))
            text = F.array_join(F.transform("run", lambda node: hex_text(node["digest"])), "")
            made = runs.select("grp", "rank", "n", F.unhex(F.sha2(text, 256)).alias("digest"), F.unhex(text).alias("children"))
            levels.append(steps.keep(made))
            nodes, most = levels[-1], -(-most // fanout)
            roots.append(nodes.filter("n = 1").select("grp", F.lit(len(levels)).alias("depth"), "digest"))
        whole = roots[0]
        for some in roots[1:]:
            whole = whole.unionAll(some)
        return cls(levels, steps.keep(whole), fanout)

    def descend(self, starts: DataFrame, requests: DataFrame, steps: Steps) -> DataFrame:
        """The requests (grp, rank and more) with ``root`` of their group, the ``digest`` found there and the ``path`` to it.

        ``starts`` (grp, depth, digest, path) are the roots to begin at and the segments above them.
        """
        starts = starts.select("grp", "depth", "digest", "path", F.col("digest").alias("root"))
        wanted = {0: requests}
        for level in range(1, len(self.levels)):
            below = wanted[level - 1].select("grp", F.floor(F.col("rank") / self.fanout).alias("rank")).distinct()
            wanted[level] = steps.keep(below)
        front = starts.filter(F.col("depth") == len(self.levels)).withColumn("rank", F.lit(0).cast("long")).drop("depth")
        for level in reversed(range(len(self.levels))):
            front = self._open(front, self.levels[level], wanted[level])
            if level:
                front = steps.keep(front)
                begin = starts.filter(F.col("depth") == level).withColumn("rank", F.lit(0).cast("long"))
                front = front.unionByName(begin.drop("depth"))
        if not self.levels:
            return _meet(front.drop("rank"), requests, F.lit(True))
        alone = _meet(starts.filter("depth = 0").drop("depth"), requests, F.lit(True))
        return front.unionByName(alone)

    def _open(self, front: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
        """One level down: each node's record, and of its children those that are wanted."""
        opened = front.join(records.select("digest", "children").dropDuplicates(["digest"]), "digest").drop("digest")
        opened = opened.withColumnRenamed("rank", "parent")
        found = _meet(opened, wanted, F.col("parent") == F.floor(F.col("rank") / self.fanout)).drop("parent")
        digit = F.pmod(F.col("rank"), F.lit(self.fanout)).cast("int")
        at = digit * SIZE
        others = F.concat(
            F.substring("children", F.lit(1), at), F.substring(F.col("children"), at + SIZE + 1, F.octet_length("children"))
        )
        segment = F.struct(digit.alias("digit"), others.alias("others"))
        return found.select(
            *(c for c in found.columns if c not in ("path", "children")),
            F.substring(F.col("children"), at + 1, F.lit(SIZE)).alias("digest"), F.concat("path", F.array(segment)).cast(PATH).alias("path"),
        )


def _meet(nodes: DataFrame, requests: DataFrame, on: Column) -> DataFrame:
    """Requests with what is known of their group (and, by ``on``, of their place)."""
    nodes = nodes.withColumnRenamed("grp", "of")
    return requests.join(nodes, F.col("grp").eqNullSafe(F.col("of")) & on).drop("of")


class Manifest:
    """The tree over a table of leaves, as ``leaves_of`` gives it.

    Null groups and null keys come first; leaves of equal keys stand by their digest, so repeated rows have a place each
    and the root does not depend on how the rows lie. ``root`` is None for an empty table.
    """

    def __init__(self, leaves: DataFrame, fanout: int = 16):
        self.steps = Steps(leaves.sparkSession, "manifest")
        self.leaves = _ranked(self.steps.keep(leaves), ["key", "leaf"], self.steps)
        self.trees = Tree.of(self.leaves.withColumnRenamed("leaf", "digest"), self.steps, fanout)
        groups = self.trees.roots.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "depth", "digest")
        self.groups = _ranked(groups, ["name"], self.steps)
        self.top = Tree.of(self.groups, self.steps, fanout)
        self.root = (found := self.top.roots.first()) and bytes(found["digest"]).hex()

    def records(self) -> DataFrame:
        """The store: every digest of an inner node and its children (their digests in a row)."""
        levels = [level.select("digest", "children") for level in (*self.trees.levels, *self.top.levels)]
        none = self.groups.sparkSession.createDataFrame([], "digest binary, children binary")
        for level in levels:
            none = none.unionAll(level)
        return none.dropDuplicates(["digest"])

    def proofs(self, requests: DataFrame) -> DataFrame:
        """For requests (grp, rank and more): ``root`` of their group, ``digest`` found at the rank, ``path`` from it to the top.

        A path is a list of segments, the lowest first: the digit of the node in its run and the other digests of the run. A rank
        that the group does not have gives no row.
        """
        start = self.top.roots.withColumn("path", F.array().cast(PATH))
        above = self.top.descend(start, self.groups.select("grp", "rank", "name", "depth"), self.steps)
        starts = self.steps.keep(above.select(F.col("name").alias("grp"), "depth", "digest", "path"))
        return self.trees.descend(starts, requests, self.steps).withColumn("path", F.reverse("path"))

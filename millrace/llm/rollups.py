"""Token counts that follow a changing corpus: additive totals kept up by signed batches.

A batch holds documents to insert, delete or revise. Each becomes signed counts: an insert adds its counts; a delete takes away
what the ledger holds for the document; a revision does both. A batch writes two tables under its own id: its entries in the
ledger (per document and tokenizer) and its delta of the totals (per source, language and tokenizer). A marker, written
last, commits both; a batch without it does not count and is written anew, and a batch with it is skipped, so a batch
can be sent any number of times. Totals are the sum of the committed deltas, a few rows per batch.

The ledger is dealt by a hash of the document's id, so that a batch reads only as much of it as its own documents can be in.
Documents are counted where they are read; only ids and counts are shuffled, and totals are summed before they are.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sinks.storage import Folder

PARTS = 16  # of the ledger
SPREAD = 8  # files of a part at most
KEYS = ["source", "lang", "tokenizer"]



def words_1(text: Column) -> Column:
    """Runs of letters and digits: ASCII ones, and everything beyond ASCII."""
    return F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))


def pieces_1(text: Column) -> Column:
    """Pieces of up to four characters of such runs, and every other character that is not white space."""
    return F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{1,4}|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"))


VERSIONS = {"words-1": words_1, "pieces-1": pieces_1}


_SCHEMA = {
    "ledger": "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long, batch string, part int",
    "delta": "source string, lang string, tokenizer string, n_docs long, n_tokens long, batch string",
}


class TokenRollup:
    """Totals and ledger below a folder."""

    def __init__(self, spark: SparkSession, folder: str, counters: Mapping = VERSIONS):
        self.spark, self.folder, self.counters = spark, folder.rstrip("/"), dict(counters)
        self.files = Folder(spark, self.folder)

    def committed(self) -> list[str]:
        return sorted(self.files.children("commits"))

    def _read(self, kind: str) -> DataFrame | None:
        """The committed batches of a table; batches are partitions, so others are not opened."""
        done = self.committed()
        return self.spark.read.schema(_SCHEMA[kind]).parquet(f"{self.folder}/{kind}").filter(F.col("batch").isin(done)) if done else None

    def counted(self, docs: DataFrame) -> DataFrame:
        """doc_id, source, lang, tokenizer, n_tokens: a row per document and tokenizer version."""
        text = F.col("text").cast("string")
        each = [F.struct(F.lit(name).alias("tokenizer"), F.coalesce(count(text), F.lit(0)).cast("long").alias("n_tokens")) for name, count in self.counters.items()]
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.explode(F.array(*each)).alias("c")).select("doc_id", "source", "lang", "c.*")

    def commit(
        self, batch: str, insert: DataFrame | None = None, delete: DataFrame | None = None, revise: DataFrame | None = None,
        revised: DataFrame | None = None,
    ) -> bool:
        """Apply a batch once; False if it was committed before. With ``revised`` (doc_id) only those of ``revise`` are revised.

        ``insert`` and ``revise`` have the columns of documents, ``delete`` only needs doc_id. Deleting or revising a document
        that the ledger does not know takes nothing away. Inserting the same document twice counts it twice; null ids can
        be inserted, but not named by a delete or a revision. Null sources and languages are keys of their own.
        """
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch id has letters, digits, - and _ only")
        if self.files.exists(f"commits/{batch}"):
            return False
        signed = [self.counted(df) for df in (insert, revise) if df is not None]
        if revise is not None and revised is not None:
            # Documents are picked after they are counted, so that no text is shuffled.
            few = revised.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
            signed[-1], revise = signed[-1].join(few, "doc_id", "left_semi"), few
        signed = [rows.withColumn("n_docs", F.lit(1).cast("long")) for rows in signed]
        gone = [df.select(F.col("doc_id").cast("long").alias("doc_id")) for df in (delete, revise) if df is not None]
        ledger = self._read("ledger")
        if gone and ledger is not None:
            signed.append(self._taken_away(ledger, gone))
        if not signed:
            signed = [self.spark.createDataFrame([], _SCHEMA["ledger"]).drop("part", "batch")]
        rows = signed[0]
        for more in signed[1:]:
            rows = rows.unionByName(more)
        part = F.pmod(F.hash("doc_id"), F.lit(PARTS)).alias("part")
        entries = rows.select("doc_id", *KEYS, "n_docs", "n_tokens", part)
        ledger_path, delta_path = (f"{self.folder}/{kind}/batch={batch}" for kind in ("ledger", "delta"))
        entries.repartition("part", F.pmod(F.xxhash64("doc_id", "tokenizer"), F.lit(SPREAD))).write.mode("overwrite").partitionBy("part").parquet(ledger_path)
        written = self.spark.read.schema(entries.schema).parquet(ledger_path)
        delta = written.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        delta.write.mode("overwrite").parquet(delta_path)
        self.files.touch(f"commits/{batch}")
        return True

    def _taken_away(self, ledger: DataFrame, gone: list[DataFrame]) -> DataFrame:
        """Negative entries that cancel what the ledger holds for the named documents."""
        ids = gone[0].unionAll(gone[1]) if len(gone) > 1 else gone[0]
        ids = ids.filter("doc_id IS NOT NULL").distinct().withColumn("part", F.pmod(F.hash("doc_id"), F.lit(PARTS)))
        held = ledger.join(ids, ["part", "doc_id"], "left_semi").groupBy("doc_id", *KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return held.filter("n_docs <> 0 OR n_tokens <> 0").withColumns({c: -F.col(c) for c in ("n_docs", "n_tokens")})

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over the committed batches; keys without documents have no row."""
        deltas = self._read("delta")
        if deltas is None:
            return self.spark.createDataFrame([], _SCHEMA["delta"]).drop("batch")
        summed = deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.filter("n_docs <> 0 OR n_tokens <> 0")

"""Exact duplicates by a 128-bit hash of the normalised text, with the bytes compared inside each group.

The groups are counted on hashes alone, with map-side partials, so a group of any size is one row before it is joined. Texts
are read again only to compare: every document of a group of two or more is joined with the text of the row that stays, in a
join that adaptive execution splits where a group is large. Rows whose bytes differ from it in spite of an equal hash are
grouped again, by hash and text; usually there are none.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow_text import ID, Texts, per_document
from millrace.llm.components import Steps


def _hashed(docs: DataFrame, **names: str) -> DataFrame:
    """doc_id, content hash (16 bytes), SHA-256 in hex, and the text with A-Z lower-cased as bytes."""

    def rows(texts: Texts) -> dict[str, object]:
        lowered = texts.lowered()
        plain = [lowered.bytes_of(i) for i in range(len(texts))]
        return {
            "content": pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in plain], pa.binary()),
            "text_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in plain], pa.string()),
            "plain": pa.array(plain, pa.binary()),
        }

    return per_document(docs, rows, "content binary, text_sha256 string, plain binary", **names)


def exact_duplicates(docs: DataFrame, keep: str = "smallest", id_column: str = ID, text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256 of the normalised text.

    Texts are equal if they are the same after A-Z were lower-cased; null counts as empty. Of equal texts the document with the
    ``keep`` ("smallest" or "largest") id stays. Rows that repeat an id are each counted and share the result. Null ids never
    stay while another id of their group can; a group of null ids only has a null keep_id, and its rows stay.
    """
    steps = Steps(docs.sparkSession, "exactdup")
    best = {"smallest": F.min, "largest": F.max}[keep]
    hashed = _hashed(docs, id_column=id_column, text_column=text_column)
    narrow = hashed.select(ID, "content", "text_sha256")
    groups = narrow.groupBy("content").agg(best(ID).alias("keep_id"), F.count(F.lit(1)).alias("n"))
    told = steps.keep(narrow.join(groups, "content"))
    shared = told.filter("n > 1").select(F.col("content").alias("group"), F.col(ID).alias("member"), "keep_id").distinct()
    member = (F.col(ID).eqNullSafe(F.col("member"))) & (F.col("content") == F.col("group"))
    texts = hashed.select(ID, "content", "plain")
    copies = steps.keep(texts.join(shared, member).select(ID, "content", "keep_id", "plain").withColumn("digest", F.sha2("plain", 256)))
    staying = copies.filter(F.col(ID).eqNullSafe(F.col("keep_id"))).select("content", F.col("plain").alias("stays"))
    compared = copies.join(staying.dropDuplicates(["content"]), "content").withColumn("same", F.col("plain") == F.col("stays"))
    other = steps.keep(compared.filter(~F.col("same")).select(ID, "content", "plain", "digest"))
    again = other.groupBy("content", "plain").agg(best(ID).alias("own_keep"), F.count(F.lit(1)).alias("own_n"), F.first("digest").alias("digest"))
    split = again.select("content", F.col("digest").alias("text_sha256"), "own_keep", "own_n")
    fewer = other.groupBy("content").agg(F.count(F.lit(1)).alias("less"))
    joined = told.join(split, ["content", "text_sha256"], "left").join(fewer, "content", "left")
    size = F.coalesce("own_n", F.col("n") - F.coalesce("less", F.lit(0)))
    kept_id = F.when(F.col("own_n").isNotNull(), F.col("own_keep")).otherwise(F.col("keep_id"))
    return joined.select(ID, kept_id.alias("keep_id"), size.alias("group_size"), F.col(ID).eqNullSafe(kept_id).alias("kept"), "text_sha256")

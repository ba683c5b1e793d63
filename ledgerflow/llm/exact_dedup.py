"""Exact dedup by skew-safe combining (DataFrame functions only).

Texts are equal when identical after every run of ASCII white space becomes one space.

1. *Local*: rows are grouped by (digest, salt, whole normalised text). The salt is a hash
   of the document id, so one text that fills a third of the corpus is spread over
   ``salts`` groups; Spark's partial aggregate collapses copies inside each task before
   anything is shuffled.
2. *Global*: the salt winners - at most ``salts`` rows per distinct text - are grouped by
   (digest, whole text). Both groupings compare the full text, never the digest alone.
3. *Labels*: each group names the salts that it was found under, so members find their
   group by an equi-join on (content key, salt) in which no key is hotter than 1/salts of
   the largest group. The content key is SHA-256 plus XXH64 plus the length.

Defined results: a NULL text counts as empty; empty texts are equal to each other; a NULL
document id never wins over a non-NULL one (a group of NULL ids has keep_id NULL and is
kept); rows that repeat the winner's id and text are the same document and are all marked
kept, :func:`deduplicate` returns one of them; an empty table gives an empty result; extra
columns, whatever their names, are ignored by :func:`assign` and kept by
:func:`deduplicate`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def normalised(text: Column) -> Column:
    """NULL as empty; each run of space, tab, LF, VT, FF, CR as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _keyed(docs: DataFrame, text: str, key: str, salts: int) -> DataFrame:
    norm = docs.select(docs[key].alias("_id"), normalised(docs[text]).alias("_norm"))
    return norm.select(
        "_id",
        "_norm",
        F.sha2("_norm", 256).alias("_sha"),
        F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"),
    )


def _content_key() -> list[Column]:
    return [F.col("_sha"), F.xxhash64("_norm").alias("_xx"), F.length("_norm").alias("_len")]


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per distinct text: content key, keep_id, group_size and the salts seen."""
    local = _keyed(docs, text, key, salts).groupBy("_sha", "_salt", "_norm").agg(
        F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    return local.groupBy("_sha", "_norm").agg(
        F.min("_id").alias("keep_id"),
        F.sum("_n").alias("group_size"),
        F.collect_set("_salt").alias("_salts"),  # at most ``salts`` small integers
    ).select(*_content_key(), "keep_id", "group_size", "_salts")


def assign(docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per input row: the id, keep_id, group_size, kept, text_sha256."""
    labels = groups(docs, text, key, salts).withColumn("_salt", F.explode("_salts")).drop("_salts")
    members = _keyed(docs, text, key, salts).select("_id", "_salt", *_content_key())
    return members.join(labels, ["_sha", "_xx", "_len", "_salt"]).select(
        F.col("_id").alias(key),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    Ids delivered more than once with one text are looked up first (a narrow aggregate);
    only when there are some do the kept rows pass one more aggregate on (id, text)."""
    decided = assign(docs, text, key, salts)
    kept = decided.where("kept").select(
        F.col(key).alias("_keep_id"), F.col("text_sha256").alias("_keep_sha")).distinct()
    sha = F.sha2(normalised(docs[text]), 256)
    out = docs.join(kept, docs[key].eqNullSafe(kept["_keep_id"]) & (sha == kept["_keep_sha"]), "left_semi")
    repeats = docs.groupBy(docs[key].alias("_id")).count().where("count > 1")
    if repeats.isEmpty():
        return out
    return out.withColumn("_dedup_sha", F.sha2(normalised(out[text]), 256)).dropDuplicates(
        [key, "_dedup_sha"]).drop("_dedup_sha")

"""A corpus pipeline of five stages, each of which calls one operator of folioforge.llm.

Every stage takes documents with any further columns, whatever their names, and all but the last
return the same columns. Null and empty texts pass through, repeated rows of them too. Rows with a
null doc_id count as near copies like others, and the second stage keeps one of them only where a
group has no other; the third leaves them whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import common, jaccard, pack, secrets, substrings, toxicity

#: Documents that score so much are rejected.
REJECT = toxicity.THRESHOLD


def _shield(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with columns other than doc_id and text under names that clash with nothing, and the way back; n_chars follows the text."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    hidden = {c: f"_carried{i}" for i, c in enumerate(others)}

    def back(rows: DataFrame) -> DataFrame:
        def column(c: str):
            if c == "n_chars":
                size = F.length("text").cast(docs.schema[c].dataType)
                return F.when(F.col("text").isNull(), F.col(hidden[c])).otherwise(size).alias(c)
            return F.col(hidden.get(c, c)).alias(c)

        return rows.select(*map(column, docs.columns))

    common.tune(docs.sparkSession)
    return docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(h) for c, h in hidden.items())), back


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on all labelled rows of its input, rejects go."""
    rows, back = _shield(docs)
    scored = toxicity.toxicity(rows, common.read(spark, sf_dir, "labels"), keep=rows.columns, held_out=None)
    return back(scored.where(F.col("score") < REJECT))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that with the smallest doc_id; rows without words all stay."""
    rows, back = _shield(docs)
    return back(jaccard.representatives(rows))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; documents of which no word is left go."""
    rows, back = _shield(docs)
    clean = substrings.dedupe(rows, keep=rows.columns)
    return back(clean.where((F.col("removed_chars") == 0) | F.col("text").rlike(r"\S")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    rows, back = _shield(docs)
    return back(secrets.redact(secrets.scan(rows, keep=[c for c in rows.columns if c != "text"])))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of sequences."""
    rows, _ = _shield(docs)
    return pack.pack(rows)


STAGES = [("toxicity", drop_toxic), ("n-gram Jaccard join", drop_near_copies), ("substring dedup", drop_repeats), ("secret scans", mask_secrets), ("packing", pack_tokens)]
#: Trained scores and content-defined cuts have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over sf_dir's documents; every stage's result is written and read again."""
    docs = common.read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.materialise(docs, f"stage{i}")
    return docs

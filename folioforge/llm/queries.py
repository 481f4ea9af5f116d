"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, bpe, common, decontam, jaccard, neardup, negatives, pack, quality, secrets, substrings, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = common.read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vecs, vecs.where("vec_id % 20 = 0"), k=20)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = toxicity.toxicity(docs, common.read(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(common.crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(common.read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(common.read(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(common.read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(common.read(spark, sf_dir, "pages").select("page_id", "url"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedupe(common.read(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = quality.quality(docs, common.read(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(common.crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near(common.read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(common.read(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = common.read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return negatives.mine(negatives.shifted(vecs), F.col("vec_id") % 100 == 0)


def op12_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark")
    return decontam.digest(decontam.scan(docs.select("doc_id", "text"), items))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned(common.read(spark, sf_dir, "documents").select("doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_ann, op2_toxicity, op3_jaccard, op4_secrets, op5_bpe, op6_urls, op7_substrings, op8_quality, op9_neardup, op10_pack, op11_negatives, op12_decontam, op13_align, pipeline)}
ORACLES: dict[str, str] = {"op4_secrets": secrets.oracle(), "op11_negatives": negatives.oracle(), "op12_decontam": decontam.oracle()}

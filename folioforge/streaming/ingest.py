"""File streams of documents through the same per-document functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioforge.functions import text
from folioforge.operators import blocks as B


def read_documents(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of JSON lines (doc_id, text)."""
    return spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", files_per_trigger).json(folder)


def labelled_lines(docs: DataFrame) -> DataFrame:
    """Every line of a document with its label: stateless, as a label needs its own document alone."""
    lines = docs.select("doc_id", F.posexplode(F.filter(F.split(text.normalize_lines("text"), "\n"), lambda x: x != "")).alias("pos", "line"))
    none = F.lit(None).cast("double")
    return lines.select("doc_id", "pos", F.col("line").alias("text"), B.label(F.col("line"), F.col("pos"), none, none).alias("label"))


def write(rows: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Parquet sink, exactly once by its checkpoint."""
    out = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(availableNow=True) if once else out).start()

"""Dead letters: inputs that failed, with the cause, kept until a later run takes them.

A letter is (stage, key, cause, run, settled): one row for each failure, one with settled true for each input that
came through later. The table is only added to; what is open is the last word on each input of a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LETTERS = "stage string, key string, cause string, run long, settled boolean"


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LETTERS).parquet(path)


def record(results: DataFrame, path: str, stage: str, key: str, run: int, error: str = "error") -> DataFrame:
    """Adds the failures among results (rows with an error) to the letters, and what came through of those that are open; returns the rest of results, without the error.

    run: a number that grows from run to run."""
    spark = results.sparkSession
    own = results.select(F.lit(stage).alias("stage"), F.col(key).cast("string").alias("key"), F.col(error).alias("cause"), F.lit(run).cast("long").alias("run"), F.col(error).isNull().alias("settled"))
    failed, passed = own.where("not settled"), own.where("settled")
    try:
        before = pending(read(spark, path), stage)
        passed = passed.join(before.select("key"), "key", "left_semi").select(*failed.columns)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        passed = passed.limit(0)  # nothing was open
    failed.unionByName(passed).write.mode("append").parquet(path)
    return results.where(F.col(error).isNull()).drop(error)


def pending(letters: DataFrame, stage: str) -> DataFrame:
    """(key, cause, run, tries): what is open of a stage: its last failure, and how many there were since it last came through."""
    own = letters.where(F.col("stage") == stage)
    settled = F.max(F.when(F.col("settled"), F.col("run"))).over(Window.partitionBy("key"))
    since = own.withColumn("_s", settled).where("not settled and (_s is null or run > _s)")
    return since.groupBy("key").agg(F.max_by("cause", "run").alias("cause"), F.max("run").alias("run"), F.count(F.lit(1)).alias("tries"))


def retry(inputs: DataFrame, letters: DataFrame, stage: str, key: str) -> DataFrame:
    """Those inputs that are open, and no others."""
    return inputs.join(pending(letters, stage).select(F.col("key").alias("_key")), F.col(key).cast("string") == F.col("_key"), "left_semi")

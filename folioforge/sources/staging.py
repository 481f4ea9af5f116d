"""Tables between the steps of one job: written once, read by all that need them."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share. Where it is unset, a local session, whose executor is the driver, gets one of ours; any other fails."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _own[app] = tempfile.mkdtemp(prefix="folioforge-staged-")
    return _own[app]


def staged(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read back: what stands on it doesn't compute it again, nor after a lost executor."""
    path = f"{folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt over twice as many partitions as there are cores. Before a step that takes long for few bytes, as scans and exchanges are cut by bytes."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 2,000 rows and 4 MB, unless the caller has set them: rows that hold whole records are wide, and a batch lies in a worker's memory several times."""
    for name, default, ours in (("maxRecordsPerBatch", "10000", "2000"), ("maxBytesPerBatch", "", str(4 << 20))):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.sparkContext.getConf().get(key) is None and (name == "maxBytesPerBatch" or spark.conf.get(key) == default):
            spark.conf.set(key, ours)


@atexit.register
def _clear() -> None:
    for spark, path in _written:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is over: the folder belongs to its cluster
            return

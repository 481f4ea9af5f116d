"""Helpers that the operators of this subpackage share: shared storage, grouped streaming, hashing."""

from __future__ import annotations

import atexit
import ctypes
import gc
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []
#: Bytes of an Arrow batch, and of what one reducing task should read, about.
BATCH_BYTES, TASK_BYTES = 4 << 20, 64 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it is unset, executors in the
    driver's own process (as in tests) get a folder of ours; others could not see it, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        import tempfile

        _own[app] = tempfile.mkdtemp(prefix="folioforge-")
    return _own[app]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there and lost executors cost no rerun."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of materialise() that nothing reads any more."""
    paths = {getattr(df, "_path", None) for df in tables}
    for own in [x for x in _written if x[1] in paths]:
        _delete(*own)
        _written.remove(own)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    for own in _written:
        try:
            _delete(*own)
        except Exception:  # the session has ended; its cluster owns the folder
            return


atexit.register(_clean)


def tune(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes as well as rows, unless the caller has: texts are long, and a batch lies in memory several times."""
    for name, default, ours in (("maxRecordsPerBatch", "10000", "2000"), ("maxBytesPerBatch", "", str(BATCH_BYTES))):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.sparkContext.getConf().get(key) is None and (name == "maxBytesPerBatch" or spark.conf.get(key) == default):
            spark.conf.set(key, ours)


def trim() -> None:
    """Gives freed memory back to the system: an idle Python worker stays for a minute beside the JVM's own needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def size_hint(df: DataFrame) -> int:
    """Bytes of df by Spark's own statistics, 0 where it knows none; runs no job."""
    found = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return found if found < 1 << 60 else 0


def parts(df: DataFrame, times: float = 1.0) -> int:
    """Partitions for an exchange of `times` df's bytes: they grow with the input, from the session's own number on."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(times * size_hint(df)) // TASK_BYTES)


def shards(df: DataFrame, target_bytes: int, least: int = 64) -> int:
    """A number of key ranges that grows with the input, so that each stays near target_bytes."""
    return int(min(max(least, size_hint(df) // target_bytes), 1 << 20))


class WordHashes(dict):
    """word (bytes) -> 64-bit digest as int; forgets everything at `most` words, so memory is bounded."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = h
        return h


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, over a uint64 array."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def windows64(h: np.ndarray, k: int) -> np.ndarray:
    """One 64-bit hash for each k consecutive entries of h, order-sensitive."""
    n = len(h) - k + 1
    out = h[:n].copy()
    for j in range(1, k):
        out = mix64(out) ^ h[j : j + n]
    return mix64(out)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start..start+length-1 of every span, one after another."""
    if len(starts) == 0 or lengths.sum() == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.ones(ends[-1], np.int64)
    keep = lengths > 0
    s, e = starts[keep], ends[keep]
    out[0] = s[0]
    if len(s) > 1:
        out[e[:-1]] = s[1:] - (s[:-1] + lengths[keep][:-1] - 1)
    return np.cumsum(out)


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows with equal keys, from batches sorted by them. Holds one group and one batch."""
    rest: list[pd.DataFrame] = []
    last = None
    for b in batches:
        if not len(b):
            continue
        cols = [b[k].to_numpy() for k in keys]
        new = np.zeros(len(b), bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        cuts = np.flatnonzero(new)
        if last is not None and first != last:
            yield pd.concat(rest) if len(rest) > 1 else rest[0]
            rest = []
        start = 0
        for c in cuts:
            rest.append(b.iloc[start:c])
            yield pd.concat(rest) if len(rest) > 1 else rest[0]
            rest, start = [], c
        rest.append(b.iloc[start:])
        last = tuple(c[-1] for c in cols)
    if rest:
        yield pd.concat(rest) if len(rest) > 1 else rest[0]


def by_group(df: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, order: list[str] | None = None, parts_: int | None = None) -> DataFrame:
    """work() on every group of bounded size: one exchange by the keys, one sort, then a stream of groups."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for g in groups(batches, keys):
            out = work(g)
            if len(out):
                held.append(out)
                rows += len(out)
            if rows >= 20_000:
                yield pd.concat(held)
                held, rows = [], 0
        if held:
            yield pd.concat(held)

    n = parts_ or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *(order or [])).mapInPandas(run, schema)


def _pieces(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.RecordBatch]]:
    for b in batches:
        if b.num_rows:
            k = b.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), b.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                yield k[start], b.slice(start, end - start)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[pa.RecordBatch]]]:
    """(value, slices of batches) for every run of one key in batches sorted by it; a run is streamed, never gathered."""
    for value, run in groupby(_pieces(batches, key), key=lambda p: p[0]):
        yield value, (b for _, b in run)


def with_hubs(rows: DataFrame, table: DataFrame, key: str, many: int) -> DataFrame:
    """rows joined with table (one row a key; `n` says how many of rows have it) without a hot key in one task.

    Keys that over `many` rows have are joined by broadcast; with `many` no less than a ten-thousandth
    of the rows they are at most ten thousand."""
    hubs, others = table.where(F.col("n") > many), table.where(F.col("n") <= many).drop("n")
    names = [c for c in hubs.columns if c not in (key, "n")]
    marked = rows.join(F.broadcast(hubs.select(key, F.struct(*names).alias("_hub"))), key, "left")
    hot = marked.where("_hub is not null").select(*rows.columns, *(F.col(f"_hub.{c}").alias(c) for c in names))
    return hot.unionByName(marked.where("_hub is null").select(*rows.columns).join(others, key).select(*rows.columns, *names))


def least_hub(n: int) -> int:
    """So many rows make a key a hub: at most ten thousand keys of n rows have more."""
    return max(64, n // 10_000)


def _star(e: DataFrame, n: int, forward: str) -> DataFrame:
    """(a, b, m) for the n rows (a, b) of e with the condition `forward`: m is the least of a and of all its b in e."""
    low = e.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n"))
    return with_hubs(e.where(forward).select("a", "b"), low, "a", least_hub(n))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b) of any orderable type; component is the smallest node reachable.

    Alternates large-star and small-star steps; every step is a few shuffles whose rows never exceed
    twice the edges, and every round is written to the shared folder, the one before deleted. No node's
    links are gathered in one row or task, and nothing but counts reaches the driver.
    """
    e = materialise(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    n = e.count()
    while n:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        starred = _star(both, 2 * n, "b > a")
        large = materialise(starred.where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).distinct(), "cc")
        discard(e)
        starred = _star(large, large.count(), "true")
        links = starred.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(starred.select("a", F.col("m").alias("b")))
        e = materialise(links.where("a <> b").distinct(), "cc")
        discard(large)
        n = e.count()
        # a star forest: nobody is both a child and a parent, and every child has one parent
        if n == e.select("a").distinct().count() and e.join(e.select(F.col("a").alias("x")), F.col("b") == F.col("x"), "left_semi").isEmpty():
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def crc_mod(doc_id: Column | str, m: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(m))

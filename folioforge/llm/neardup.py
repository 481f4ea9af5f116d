"""Embedding near-duplicates by Euclidean p-stable hashing, with exact cosine checks.

Normalised vectors are projected on Gaussian directions, shifted, and quantised; `width` quantised
numbers are a bucket of one of several tables. The width grows with the logarithm of the number of
vectors, so a bucket holds some thousands of unrelated ones whatever the corpus, which matrix products
compare at once; the number of tables follows from the width and the wanted recall: at cosine 0.9 a
pair shares a bucket of some table with a probability of RECALL, nearer pairs with a higher one.

Equal vectors are one class from the start. Buckets larger than a cell are dealt in blocks that meet
in cells. A pair is counted in the first table it meets in, so nothing is counted twice and no list
of pairs is made: cells return counts by class and a forest of links. Single precision decides only
where its error bound allows; pairs nearer to the threshold are checked in double precision.

Vectors that are null, zero or hold null or non-finite components link with nothing. Vectors of
different lengths never link. Each row is a vector: rows that share a vec_id count one another as
others if their vectors link, and each gets its own row. Rows with a null vec_id link with nothing,
have a null component_id and are kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

LEAST, RECALL, STEP = 0.9, 0.95, 2.5
#: Unrelated vectors that a bucket holds on average, at most.
BUCKET = 8192
#: Bytes of a block's vectors in double precision.
_BLOCK = 16 << 20


def collide(distance: float, step: float) -> float:
    """The probability that one quantised projection of two vectors agrees (the p-stable formula)."""
    t = step / distance
    return erf(t / sqrt(2)) - 2 / (sqrt(2 * pi) * t) * (1 - exp(-t * t / 2))


def shape(n: int, least: float = LEAST, recall: float = RECALL, step: float = STEP, bucket: int = BUCKET) -> tuple[int, int]:
    """(tables, width) for n vectors: buckets of at most `bucket` orthogonal vectors, and as many tables as `recall` at `least` takes."""
    width = max(1, ceil(log(max(n, 1) / bucket) / -log(collide(sqrt(2), step)))) if n > bucket else 1
    return ceil(log(1 - recall) / log(1 - collide(sqrt(2 - 2 * least), step) ** width)), width


def keys(x: np.ndarray, tables: int, width: int, step: float = STEP, seed: int = 11) -> np.ndarray:
    """Bucket of every normalised vector in every table, as 64-bit numbers."""
    rng = np.random.default_rng([seed, x.shape[1]])
    a = rng.normal(size=(x.shape[1], tables * width))
    b = rng.uniform(0, step, tables * width)
    q = np.floor((x @ a + b) / step).astype(np.int64).view(np.uint64).reshape(len(x), tables, width)
    h = np.full((len(x), tables), np.uint64(x.shape[1]))
    for j in range(width):
        h = common.mix64(h ^ q[:, :, j])
    return h.view(np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows brought to length 1, in double precision, without overflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def hashed(classes: DataFrame, tables: int, width: int, step: float) -> DataFrame:
    """classes with `keys`, the bucket of every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            size = np.diff(v.offsets.to_numpy())
            for n in np.unique(size):
                own = b.filter(pa.array(size == n))
                k = keys(unit(own.column("v").flatten().to_numpy().reshape(-1, n)), tables, width, step)
                ends = pa.array(np.arange(own.num_rows + 1) * tables, pa.int32())
                yield pa.RecordBatch.from_arrays([*own.columns, pa.ListArray.from_arrays(ends, pa.array(k.reshape(-1)))], [*b.schema.names, "keys"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{schema}, keys array<long>")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable number of every number under n, by the links (a, b)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def pairs(x: np.ndarray, weight: np.ndarray, earlier: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For rows of x: the weight of the rows each is linked with, by pairs of a left and a right row that
    share no earlier bucket, and the smallest row it is reached from by them. With left = right each pair counts once."""
    n, dim = x.shape
    single = x.astype(np.float32)
    margin = (dim + 8) * 1.2e-7  # over twice the error of a product of two unit vectors in single precision
    same = left is right
    count = np.zeros(n)
    ends_a: list[np.ndarray] = []
    ends_b: list[np.ndarray] = []
    rows = max(16, (4 << 20) // max(len(right), 1))
    other = single[right].T.copy()
    for s in range(0, len(left), rows):
        own = left[s : s + rows]
        product = single[own] @ other
        mask = product >= least - margin
        if same:
            mask &= right[None, :] > own[:, None]
        if not mask.any():
            continue
        i, j = np.nonzero(mask & (product < least + margin))
        for at in range(0, len(i), 100_000):
            p, q = i[at : at + 100_000], j[at : at + 100_000]
            mask[p, q] = (x[own[p]] * x[right[q]]).sum(axis=1) >= least
        for t in range(earlier.shape[1]):
            mask &= earlier[own, t][:, None] != earlier[right, t][None, :]
        found = int(np.count_nonzero(mask))
        if not found:
            continue
        if found < mask.size // 50:
            i, j = np.nonzero(mask)
            np.add.at(count, own[i], weight[right[j]])
            np.add.at(count, right[j], weight[own[i]])
            ends_a.append(own[i])
            ends_b.append(right[j])
            continue
        dense = mask.astype(np.float64)
        np.add.at(count, own, dense @ weight[right])
        np.add.at(count, right, weight[own] @ dense)
        # one link a row and a column, then those that still join two trees
        i, j = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        a, b = np.concatenate([own[i], own[mask.argmax(axis=0)[j]]]), np.concatenate([right[mask.argmax(axis=1)[i]], right[j]])
        low = forest(a, b, n)
        i, j = np.nonzero(mask & (low[own][:, None] != low[right][None, :]))
        ends_a += [a, own[i]]
        ends_b += [b, right[j]]
    none = np.zeros(0, np.int64)
    return count, forest(np.concatenate([none, *ends_a]), np.concatenate([none, *ends_b]), n)


def _links(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells: the rows of block `lo` against those of block `hi` of a bucket, or all pairs of one block."""
        for _, cell in common.runs(batches, "cell"):
            part = pa.Table.from_batches(list(cell)).combine_chunks()
            t, lo, hi = (part.column(c)[0].as_py() for c in ("t", "lo", "hi"))
            block = part.column("block").to_numpy()
            dim = len(part.column("v")[0])

            def matrix(name: str, width: int) -> np.ndarray:
                return part.column(name).combine_chunks().flatten().to_numpy().reshape(part.num_rows, width)

            left = np.flatnonzero(block == lo)
            right = left if lo == hi else np.flatnonzero(block == hi)
            if not len(left) or not len(right):
                continue
            count, low = pairs(unit(matrix("v", dim)), part.column("m").to_numpy().astype(np.float64), matrix("earlier", t), left, right, least)
            own = np.flatnonzero(count)
            cls = part.column("cls").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(cls[own]), pa.array(np.rint(count[own]).astype(np.int64)), pa.array(cls[low[own]])], ["cls", "links", "to"])

    return run


def near(vecs: DataFrame, least: float = LEAST, recall: float = RECALL, step: float = STEP, bucket: int = BUCKET, block: int = _BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of vecs."""
    # one zero: equal vectors must have equal hashes
    own = vectors.marked(vecs).withColumn("v", F.when(F.col("ok"), F.transform("v", lambda x: x + F.lit(0))))
    valid = own.where("ok").select("vec_id", "v", F.struct(F.xxhash64("v").alias("a"), F.xxhash64("v", F.lit(1)).alias("b")).alias("h"))
    # equal vectors meet here, combined before they travel
    table = common.materialise(valid.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("rep"), F.min("h").alias("h")).withColumn("cls", F.monotonically_increasing_id()), "classes")
    tables, width = shape(table.count(), least, recall, step, bucket)
    codes = common.materialise(hashed(table.select("cls", "v"), tables, width, step).select("cls", "keys"), "keys")
    # blocks of a bucket: most buckets are one
    rows = F.greatest(F.lit(1), F.floor(F.lit(block) / (8 * F.max("dim"))))
    placed = codes.join(table.select("cls", F.size("v").alias("dim")), "cls").select("dim", F.posexplode("keys").alias("t", "key"))
    sizes = placed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size"), F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts"))
    large = common.materialise(sizes.where("parts > 1").select("t", "key", "parts"), "large")
    if large.count() <= 100_000:  # a few MB
        large_ = F.broadcast(large)
    else:
        large_ = large
    cells = codes.join(table.select("cls", "m", "v"), "cls").select("cls", "m", "v", "keys", F.posexplode("keys").alias("t", "key"))
    cells = cells.join(large_, ["t", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cells = cells.withColumn("block", F.pmod(F.xxhash64("cls", "t"), F.col("parts")).cast("int"))
    cells = cells.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    cells = cells.select("cls", "m", "v", "t", "block", F.slice("keys", F.lit(1), F.col("t")).alias("earlier"), "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    cells = cells.withColumn("cell", F.xxhash64("t", "key", "lo", "hi")).drop("key").repartition(common.parts(table, tables), "cell").sortWithinPartitions("cell")
    found = common.materialise(cells.mapInArrow(_links(least), "cls long, links long, to long"), "found")
    comp = common.components(found.select(F.col("cls").alias("a"), F.col("to").alias("b")))
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    each = table.select("cls", "m", "rep", "h").join(counts, "cls", "left").join(comp.withColumnRenamed("node", "cls"), "cls", "left")
    each = common.materialise(each.select("h", "m", "rep", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component")), "each")
    common.discard(table, codes, large, found)
    low = common.materialise(each.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n")), "least")
    each = common.with_hubs(each, low, "component", common.least_hub(each.count())).select("h", F.col("m").alias("n"), "n_links", "component_id")
    named = common.with_hubs(valid.select("vec_id", "h"), common.materialise(each, "named"), "h", common.least_hub(vecs.count()))
    out = named.select("vec_id", "n_links", "component_id").unionByName(own.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))

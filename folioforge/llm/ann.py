"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample. Every vector goes to the posting list of its nearest
centroid and, as a boundary vector, to further lists whose centroids are almost as near. A query finds near centroids by a best-first walk over an
in-memory graph and reads the lists whose distance is within a ratio of the nearest one's, more of
them where these hold too few vectors for an answer; how many are enough is learnt from some queries that are compared with all rows. Lists are balanced when read: a list of any size is dealt in blocks of bounded size, and queries meet the
blocks in cells. Candidates are scored exactly, by inner product in double precision.

Nearness is the inner product; vectors are indexed with one more component that brings all to one
length, so that the nearest by distance is the largest by product.

Vectors that are null, zero or hold null or non-finite components take no part. Vectors of a length
other than the commonest of the sample are compared with their like only, in a list of their own.
Ties go to the smaller vec_id; repeated vec_ids are one candidate with their best score, and of a
query's several vectors the smallest asks. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

#: Rows that the centroids are fitted on, at most; every row is indexed.
SAMPLE = 32_768
#: Centroids at most: 4 MB at 64 components, the size of what is sent to every worker, besides the graph's 1.6 MB.
MOST_LISTS = 16_384
LIST, COPIES, EDGE, RATIO, CELL = 64, 3, 1.1, 1.11, 2048
_LINKS, _BEAM = 24, 48
#: How many queries are compared with all rows to learn how far lists must be read, and the share of their neighbours that must be met.
ASKED, WANTED = 256, 0.97


@dataclass
class Index:
    centroids: np.ndarray  # single precision: they only choose lists
    links: np.ndarray  # neighbours of each centroid in the graph
    longest: float  # squared length that all vectors are brought to
    dim: int
    typical: float = 0.0  # squared distance of a query to its nearest centroid that one in ten exceeds

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with the component that makes product a matter of distance; a query gets zero there, and the length of the vectors."""
        size = (x * x).sum(axis=1)
        if query:  # a query's length has no say in the order of products
            return np.concatenate([x * np.sqrt(self.longest / size)[:, None], np.zeros((len(x), 1))], axis=1)
        return np.concatenate([x, np.sqrt(np.maximum(0.0, self.longest - size))[:, None]], axis=1)

    def walk(self, y: np.ndarray, ratio: float, width: int = _BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Ids and squared distances, nearest first, of centroids found for each row of y by a best-first walk over the graph from the `width` nearest ones.

        All rows walk side by side, four nodes a step. A row is done when it has visited the neighbours of
        every node in its beam that lies within `ratio` of the nearest one's distance, or of the typical
        one where that is larger; where the whole beam does, it is doubled. Places without a node have id -1 and an infinite distance."""
        y = y.astype(np.float32)
        c, n = self.centroids, len(self.centroids)
        width = min(width, n)
        own, norm = (y * y).sum(axis=1), (c * c).sum(axis=1)
        # from the nearest centroids of all, by one product: clusters that no link joins are met too
        d = np.maximum(own[:, None] - 2 * y @ c.T + norm, 0)
        ids = np.argpartition(d, width - 1, axis=1)[:, :width]
        d = np.take_along_axis(d, ids, 1)
        seen = np.zeros(d.shape, bool)
        limit, base = np.float32(ratio**2), np.float32(max(self.typical, 1e-12))

        def nearest(ids: np.ndarray, d: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The beam: each node once, a visited one before its copy."""
            order = np.lexsort((~seen, ids), axis=1)
            ids, d, seen = (np.take_along_axis(x, order, 1) for x in (ids, d, seen))
            d = d.copy()
            d[:, 1:][ids[:, 1:] == ids[:, :-1]] = np.inf
            order = np.argsort(d, axis=1, kind="stable")[:, :width]
            return tuple(np.take_along_axis(x, order, 1) for x in (ids, d, seen))

        ids, d, seen = nearest(ids, d, seen)
        live = np.arange(len(y))
        while len(live):
            i, x, s = ids[live], d[live], seen[live]
            ahead = ~s & (x <= limit * np.maximum(x[:, :1], base))
            some = ahead.any(axis=1)
            live, i, x, s, ahead = live[some], i[some], x[some], s[some], ahead[some]
            if not len(live):
                break
            at = np.argsort(~ahead, axis=1, kind="stable")[:, :4]  # the nearest not visited
            go = np.take_along_axis(ahead, at, 1)
            np.put_along_axis(s, at, np.take_along_axis(s, at, 1) | go, 1)
            new = self.links[np.take_along_axis(i, at, 1)]
            new = np.where(go[:, :, None], new, new[:, :1, :]).reshape(len(live), -1)
            to = np.maximum(own[live][:, None] - 2 * np.matmul(c[new], y[live][:, :, None])[:, :, 0] + norm[new], 0)
            ids[live], d[live], seen[live] = nearest(np.concatenate([i, new], axis=1), np.concatenate([x, to], axis=1), np.concatenate([s, np.zeros(new.shape, bool)], axis=1))
        more = np.flatnonzero(d[:, -1] <= limit * np.maximum(d[:, 0], base)) if width < n else np.zeros(0, np.int64)
        if len(more):
            wide_ids, wide_d = self.walk(y[more], ratio, 2 * width)
            out_ids, out_d = np.full((len(y), wide_ids.shape[1]), -1, np.int64), np.full((len(y), wide_ids.shape[1]), np.inf, np.float32)
            out_ids[:, :width], out_d[:, :width] = ids, d
            out_ids[more], out_d[more] = wide_ids, wide_d
            ids, d = out_ids, out_d
        return np.where(np.isfinite(d), ids, -1), d

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every row's posting lists: the nearest centroid's, and those of boundary centroids.

        By one matrix product: for 51,282 vectors and 801 centroids that took 1 CPU second and a walk of
        the graph 10, which missed the nearest centroid of 13 % of the vectors."""
        y = self.lifted(x).astype(np.float32)
        dense = np.maximum((y * y).sum(axis=1)[:, None] - 2 * y @ self.centroids.T + (self.centroids**2).sum(axis=1), 0)
        ids = np.argpartition(dense, min(4 * COPIES, dense.shape[1]) - 1, axis=1)[:, : 4 * COPIES]
        ids = np.take_along_axis(ids, np.argsort(np.take_along_axis(dense, ids, 1), axis=1, kind="stable"), 1)
        d = np.take_along_axis(dense, ids, 1)
        rows = np.arange(len(ids))
        taken = ids[:, :1]
        for j in range(1, ids.shape[1]):
            fits = (d[:, j] <= EDGE**2 * np.maximum(d[:, 0], 1e-12)) & ((taken >= 0).sum(axis=1) < COPIES)
            if fits.any():
                taken = np.concatenate([taken, np.where(fits, ids[:, j], -1)[:, None]], axis=1)
        return np.repeat(rows, (taken >= 0).sum(axis=1)), taken[taken >= 0]

    def probes(self, x: np.ndarray, ratio: float, sizes: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists each query reads: those whose centroid lies within `ratio` of the nearest one's
        distance, or of the typical one (a query next to a centroid has neighbours elsewhere too), and the next ones until the lists hold `floor` ids."""
        y = self.lifted(x, query=True)
        ids, d = self.walk(y, ratio)
        near = (ids >= 0) & (d <= ratio**2 * np.maximum(d[:, :1], max(self.typical, 1e-12)))
        held = (np.where(near, sizes[ids], 0)).sum(axis=1)
        out = [(np.repeat(np.arange(len(x)), near.sum(axis=1)), ids[near])]
        for s in range(0, len(x), 256):
            few = s + np.flatnonzero(held[s : s + 256] < floor)
            if not len(few):
                continue
            taken = np.zeros((len(few), len(sizes)), bool)
            row, at = np.nonzero(near[few])
            taken[row, ids[few][row, at]] = True
            order, _ = self.nearest(y[few], sizes, floor)
            before = held[few][:, None] + np.cumsum(np.where(np.take_along_axis(taken, order, 1), 0, sizes[order]), axis=1)
            fresh = ~np.take_along_axis(taken, order, 1)
            fresh &= before - sizes[order] < floor
            row, at = np.nonzero(fresh)
            out.append((few[row], order[row, at]))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def nearest(self, y: np.ndarray, sizes: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Lists of all centroids, nearest first, and their squared distances, as many for each row as hold `floor` ids besides any that hold as many."""
        y, c = y.astype(np.float32), self.centroids
        d = np.maximum((y * y).sum(axis=1)[:, None] - 2 * y @ c.T + (c * c).sum(axis=1), 0)
        n = d.shape[1]
        m = min(n, 16 + int(4 * floor / max(1.0, sizes.mean())))
        while True:
            ids = np.argpartition(d, m - 1, axis=1)[:, :m] if m < n else np.broadcast_to(np.arange(n), d.shape)
            if m == n or sizes[ids].sum(axis=1).min() >= 2 * floor:
                break
            m = min(n, 2 * m)
        own = np.take_along_axis(d, ids, 1)
        order = np.argsort(own, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(own, order, 1)


    def enough(self, x: np.ndarray, near: list[np.ndarray], ratio: float, sizes: np.ndarray, floor: int) -> int:
        """The least floor, `floor` or more, with which probes() meets the share WANTED of the vectors near[i], over all rows x[i]."""
        y, c = self.lifted(x, query=True).astype(np.float32), self.centroids
        d = np.maximum((y * y).sum(axis=1)[:, None] - 2 * y @ c.T + (c * c).sum(axis=1), 0)
        order = np.argsort(d, axis=1, kind="stable")
        before = np.zeros(d.shape, np.int64)
        np.put_along_axis(before, order, np.cumsum(sizes[order], axis=1) - sizes[order], 1)
        before[d <= ratio**2 * np.maximum(d.min(axis=1, keepdims=True), max(self.typical, 1e-12))] = 0
        needs = [np.zeros(1, np.int64)]
        for i, v in enumerate(near):
            if len(v):
                row, own = self.lists(v)
                needs.append(np.minimum.reduceat(before[i][own], np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))))
        return max(floor, int(np.quantile(np.concatenate(needs[1:] or needs), WANTED, method="higher")) + 1)


def fit(vecs: DataFrame, n: int, seed: int = 17) -> Index | None:
    """Centroids by k-means on a sample of at most SAMPLE rows, chosen by a hash of their id over all rows."""
    rows = vecs.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    if not len(rows):
        return None
    size = rows.map(len)
    dim = int(size.mode().iloc[0])
    x = vectors.stack(rows[size == dim])
    longest = vecs.where(F.size("v") == dim).agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, b: a + b.cast("double") * b))).first()[0]
    return trained(x, float(longest), n, seed)


def trained(x: np.ndarray, longest: float, n: int, seed: int = 17) -> Index:
    """The index of n vectors, of which x is a sample, of at most the squared length `longest`."""
    dim = x.shape[1]
    index = Index(np.zeros((0, dim + 1)), np.zeros((0, 0), np.int64), longest, dim)
    y = index.lifted(x).astype(np.float32)
    rng = np.random.default_rng(seed)
    k = int(max(1, min(MOST_LISTS, n // LIST, len(y) // 2)))
    c = y[rng.choice(len(y), k, replace=False)]
    for _ in range(6):
        own = np.concatenate([((c * c).sum(axis=1) - 2 * y[s : s + 2048] @ c.T).argmin(axis=1) for s in range(0, len(y), 2048)])
        order = np.argsort(own, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], np.diff(own[order]) != 0]))
        total = np.add.reduceat(y[order], edge, axis=0)
        count = np.diff(np.concatenate([edge, [len(y)]]))
        c = y[rng.integers(0, len(y), k)]  # a centroid without vectors moves to one
        c[own[order][edge]] = total / count[:, None]
    near = min(_LINKS, max(k - 1, 0))
    links = np.zeros((k, near + 1), np.int64)
    for s in range(0, k, 1024):
        d = (c[s : s + 1024] ** 2).sum(axis=1)[:, None] - 2 * c[s : s + 1024] @ c.T + (c * c).sum(axis=1)
        d[np.arange(len(d)), np.arange(s, s + len(d))] = -np.inf
        links[s : s + 1024, :near] = np.argsort(d, axis=1, kind="stable")[:, 1 : near + 1] if near else 0
    links[:, near] = (np.arange(k) + 1) % k  # a ring, so that every centroid can be reached
    asked = index.lifted(x[:4096], query=True).astype(np.float32)
    d = np.maximum((asked * asked).sum(axis=1)[:, None] - 2 * asked @ c.T + (c * c).sum(axis=1), 0).min(axis=1)
    return Index(c, links, index.longest, dim, float(np.quantile(d, 0.9)))


def _placed(vecs: DataFrame, index: Index, probe: tuple[float, np.ndarray, int] | None) -> DataFrame:
    """(list, vec_id, v): a row for every posting list of a vector or, with `probe` = (ratio, sizes of lists, floor), that a query reads.
    Other lengths than the index's have list -length."""
    shared = vecs.sparkSession.sparkContext.broadcast((index, probe))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix, ask = shared.value
        for whole in batches:
            for s in range(0, len(whole), 512):
                b = whole.iloc[s : s + 512]
                like = b["v"].map(len).to_numpy() == ix.dim
                if like.any():
                    own = b[like]
                    x = vectors.stack(own["v"])
                    at, lists = ix.probes(x, *ask) if ask else ix.lists(x)
                    yield pd.DataFrame({"list": lists, "vec_id": own["vec_id"].to_numpy()[at], "v": own["v"].to_numpy()[at]})
                if not like.all():
                    own = b[~like]
                    yield pd.DataFrame({"list": -own["v"].map(len).to_numpy(), "vec_id": own["vec_id"].to_numpy(), "v": own["v"].to_numpy()})

    return vecs.select("vec_id", "v").mapInPandas(run, f"list long, vec_id long, v {vecs.schema['v'].dataType.simpleString()}")


def _floor(own: DataFrame, asking: DataFrame, index: Index, ratio: float, sizes: np.ndarray, k: int) -> int:
    """How many ids a query's lists must hold: enough for at most ASKED of the queries, chosen by a hash, whose nearest of all rows are found one by one."""
    least = COPIES * (k + 1)
    some = asking.where(F.size("v") == index.dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(ASKED).toPandas()
    if not len(some):
        return least
    ids, q = some["vec_id"].to_numpy(), vectors.stack(some["v"])
    shared = own.sparkSession.sparkContext.broadcast((ids, q))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        held = pd.DataFrame({"query": np.zeros(0, np.int64), "score": np.zeros(0), "vec_id": np.zeros(0, np.int64), "v": np.zeros(0, object)})
        for b in batches:
            x, c = vectors.stack(b["v"]), b["vec_id"].to_numpy()
            score = q @ x.T
            score[ids[:, None] == c[None, :]] = -np.inf
            at = np.argpartition(-score, min(k, len(c)) - 1, axis=1)[:, :k]
            row = np.repeat(np.arange(len(ids)), at.shape[1])
            new = pd.DataFrame({"query": row, "score": score[row, at.ravel()], "vec_id": c[at.ravel()], "v": b["v"].to_numpy()[at.ravel()]})
            held = pd.concat([held, new[new["score"] > -np.inf]]).sort_values(["query", "score", "vec_id"], ascending=[True, False, True], kind="stable")
            held = held[held.groupby("query").cumcount() < k]
        yield held

    like = own.where(F.size("v") == index.dim).select("vec_id", "v")
    found = like.mapInPandas(run, f"query long, score double, vec_id long, v {own.schema['v'].dataType.simpleString()}")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    near = found.withColumn("nth", nth).where(F.col("nth") <= k).select("query", "v").toPandas()
    by = {i: vectors.stack(g) for i, g in near.groupby("query")["v"]}
    return index.enough(q, [by.get(i, np.zeros((0, index.dim))) for i in range(len(q))], ratio, sizes, least)


def best(query: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest scores of every query, each candidate once, ties to the smaller id."""
    order = np.lexsort((-score, found, query))
    query, found, score = query[order], found[order], score[order]
    fresh = np.concatenate([[True], (query[1:] != query[:-1]) | (found[1:] != found[:-1])])
    query, found, score = query[fresh], found[fresh], score[fresh]
    order = np.lexsort((found, -score, query))
    query, found, score = query[order], found[order], score[order]
    first = np.concatenate([[True], query[1:] != query[:-1]])
    nth = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    return query[nth < k], found[nth < k], score[nth < k]


def _cell(g: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One block of queries against one block of a list: the k nearest of each query, ties to the smaller id."""
    is_query = g["query"].to_numpy()
    ids = g["vec_id"].to_numpy()
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not is_query.any() or is_query.all():
        return none
    v = vectors.stack(g["v"])
    q, c, qid, cid = v[is_query], v[~is_query], ids[is_query], ids[~is_query]
    rough = q @ c.T
    rough[qid[:, None] == cid[None, :]] = -np.inf
    # an id with several vectors counts once for the line, with its best product
    order = np.argsort(cid, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(cid[order]) != 0]))
    each = rough if len(first) == len(cid) else np.maximum.reduceat(rough[:, order], first, axis=1)
    m = min(k, len(first))
    line = np.partition(each, len(first) - m, axis=1)[:, len(first) - m]
    # a matrix product rounds by place; what it puts near the line is scored again, row by row
    i, j = np.nonzero((rough >= (line - 1e-9 * (1 + np.abs(line)))[:, None]) & (rough > -np.inf))
    return best(qid[i], cid[j], (q[i] * c[j]).sum(axis=1), k) if len(i) else none


def _nearest(k: int, most: int = 200_000):
    """Cells one after another; what they find is merged by query as it grows, so a task returns k rows a query it saw, not a cell."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return best(*(np.concatenate(x) for x in zip(*held, strict=True)), k)

        for g in common.groups(batches, ["list", "cb", "qb"]):
            held.append(_cell(g, k))
            rows += len(held[-1][0])
            if rows > most:
                held = [merged()]
                rows = len(held[0][0])
                if rows > most // 2:
                    yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), held[0], strict=True)))
                    held, rows = [], 0
        if rows:
            yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), merged(), strict=True)))

    return run


def search(vecs: DataFrame, queries: DataFrame, k: int = 20, ratio: float = RATIO, cell: int = CELL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of vecs found for each row of queries, but for its own id."""
    own = common.materialise(vectors.valid(vecs).dropDuplicates(["vec_id", "v"]), "vecs")
    out = "query_id long, vec_id long, score double"
    index = fit(own, own.count())
    if index is None:
        return vecs.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = common.materialise(_placed(own, index, None), "lists")
    # one row per list: bounded by MOST_LISTS; ids once each, as repeated ones are one candidate
    held = np.zeros(len(index.centroids), np.int64)
    for r in lists.where("list >= 0").groupBy("list").agg(F.countDistinct("vec_id").alias("n")).collect():
        held[r["list"]] = r["n"]
    # of repeated query ids the smallest vector asks; a candidate may stand in COPIES lists, the query itself in as many
    # little data and much work: dealt to all cores, by a key other than the grouping's, whose exchange would else serve for both and be coalesced
    asking = vectors.valid(queries).groupBy("vec_id").agg(F.min("v").alias("v")).repartition(2 * vecs.sparkSession.sparkContext.defaultParallelism, F.xxhash64("vec_id"))
    floor = _floor(own, asking, index, ratio, held, k)
    common.discard(own)
    asked = common.materialise(_placed(asking, index, (ratio, held, floor)), "asked")
    # one row per list and per length of odd vectors: bounded by MOST_LISTS and those lengths
    sizes = lists.groupBy("list").agg(F.count(F.lit(1)).alias("c")).join(asked.groupBy("list").agg(F.count(F.lit(1)).alias("q")), "list")
    sizes = sizes.select("list", vectors.blocks(F.col("c"), cell).alias("cs"), vectors.blocks(F.col("q"), cell // 4).alias("qs"))

    def dealt(rows: DataFrame, query: bool) -> DataFrame:
        mine, others = ("qs", "cs") if query else ("cs", "qs")
        # vectors of one id may lie in several blocks: the best of them leads in its own
        block = F.pmod(F.xxhash64("vec_id", "v"), F.col(mine)).cast("int")
        rows = rows.join(sizes, "list").select("list", "vec_id", "v", block.alias("own"), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias("other"))
        cb, qb = ("other", "own") if query else ("own", "other")
        return rows.select("list", F.col(cb).alias("cb"), F.col(qb).alias("qb"), F.lit(query).alias("query"), "vec_id", "v")

    cells = dealt(lists, False).unionByName(dealt(asked, True))
    parts = common.parts(lists, 3.0)
    found = cells.repartition(parts, "list", "cb", "qb").sortWithinPartitions("list", "cb", "qb").mapInPandas(_nearest(k), out)
    top = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return top.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

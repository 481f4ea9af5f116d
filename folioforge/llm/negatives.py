"""Hard-negative mining by a dual-tree search: a tree over anchors, a tree over candidates, and intervals of
inner products for pairs of their nodes.

A node is a ball: a centre and a radius that holds all its vectors. The inner products of two balls lie in
an interval, so a pair of nodes whose interval no anchor of the one can use is pruned with all its rows at
once; pairs of leaves that are left are scored exactly, with vectors as whole numbers floor(scale * x).

The upper levels of both trees are fitted on a sample of at most SAMPLE rows and have at most MOST_NODES
leaves (cells of candidates, groups of anchors); every row is placed in them, and radii are over all rows.
Cells are dealt in blocks of about CELL rows and groups in chunks of about GROUP, so any number of equal
vectors spreads. A chunk meets the blocks of those cells that its group can't rule out, first of the
likeliest cells, whose scores bound what the others may have. Within a task both sides grow trees of their
own down to ASKING anchors and LEAF candidates.

Rows whose id, label or vector is null, or which have a null or non-finite component, take no part. Vectors
meet vectors of their length only. Equal rows count once; rows of one id with different vectors are rows
each, and no row is a partner of its own id. Ties go to the smaller id. Scores are exact up to 2 to the 46th.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, vectors

SAMPLE, MOST_NODES = 16_384, 256
CELL, GROUP, LEAF, ASKING, STEP = 8192, 4096, 64, 16, 4
_KEYS = ["grp", "chunk", "cell", "block"]
#: Vectors of another length than the tree's share a place of their own.
_ODD = -1


def _direction(x: np.ndarray) -> np.ndarray:
    """From one far row towards another: the rows spread along it."""
    a = x[((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    b = x[((x - a) ** 2).sum(axis=1).argmax()]
    return b - a


@dataclass
class Upper:
    """The upper levels: a node i has the children 2i+1 and 2i+2; the last level's are the places."""

    directions: np.ndarray
    cuts: np.ndarray
    centres: np.ndarray
    dim: int

    @classmethod
    def fit(cls, x: np.ndarray, places: int) -> Upper:
        depth, dim = max(0, int(places).bit_length() - 1), x.shape[1]
        directions, cuts, centres = np.zeros((2**depth - 1, dim)), np.zeros(2**depth - 1), np.zeros((2**depth, dim))
        own = {0: np.arange(len(x))}
        for i in range(2**depth - 1):
            rows = own.pop(i)
            if len(rows):
                directions[i] = _direction(x[rows])
            along = np.einsum("ij,j->i", x[rows], directions[i])
            cuts[i] = np.median(along) if len(rows) else 0.0
            own[2 * i + 1], own[2 * i + 2] = rows[along <= cuts[i]], rows[along > cuts[i]]
        for i, rows in own.items():
            if len(rows):
                centres[i - (2**depth - 1)] = x[rows].mean(axis=0)
        return cls(directions, cuts, centres, dim)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of every row, and its distance from that place's centre."""
        at = np.zeros(len(x), np.int64)
        while len(at) and at[0] < len(self.cuts):
            at = 2 * at + 1 + ((x * self.directions[at]).sum(axis=1) > self.cuts[at])
        at -= len(self.cuts)
        return at, np.sqrt(((x - self.centres[at]) ** 2).sum(axis=1))


def interval(a: np.ndarray, ra: np.ndarray, b: np.ndarray, rb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of vectors in the balls (a, ra) and (b, rb), row by row; a little wider, as sums are rounded."""
    mid = (a * b).sum(axis=-1)
    na, nb = np.sqrt((a * a).sum(axis=-1)), np.sqrt((b * b).sum(axis=-1))
    wide = (na * rb + nb * ra + ra * rb) * (1 + 1e-9) + 1e-9 * (1 + na * nb)
    return mid - wide, mid + wide


class Tree:
    """A tree in a task: rows in an order in which every node is a range; levels of equal depth, halved at medians."""

    def __init__(self, x: np.ndarray, leaf: int):
        depth = max(0, int(np.ceil(np.log2(max(1, len(x) / leaf)))))
        self.order = np.arange(len(x))
        edges = np.array([0, len(x)])
        self.edges = [edges]
        for _ in range(depth):
            middle = (edges[:-1] + edges[1:]) // 2
            for start, mid, end in zip(edges[:-1], middle, edges[1:], strict=True):
                if end - start > 1:
                    own = self.order[start:end]
                    self.order[start:end] = own[np.argpartition(x[own] @ _direction(x[own]), mid - start)]
            edges = np.sort(np.concatenate([edges, middle]), kind="stable")
            self.edges.append(edges)
        self.centres, self.radii = [], []
        y = x[self.order]
        for edges in self.edges:
            size = np.diff(edges)
            centre = np.add.reduceat(np.concatenate([y, np.zeros((1, y.shape[1]))]), edges[:-1], axis=0) / np.maximum(size, 1)[:, None]
            far = np.sqrt(((y - np.repeat(centre, size, axis=0)) ** 2).sum(axis=1))
            radius = np.maximum.reduceat(np.concatenate([far, [0.0]]), edges[:-1])
            self.centres.append(centre)
            self.radii.append(np.where(size > 0, radius, 0.0))


class Best:
    """For each of some rows the k best (score, id) so far, at least `least` each."""

    def __init__(self, rows: int, k: int, least: np.ndarray):
        self.scores, self.ids = np.full((rows, k), -np.inf), np.full((rows, k), np.iinfo(np.int64).max)
        self.least, self.k = least.copy(), k

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores: len(rows) x len(ids), minus infinity where there is none."""
        k = self.k
        floor = self.least[rows]
        if scores.shape[1] > k:
            floor = np.maximum(floor, np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k])
        r, c = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
        if not len(r):
            return
        touched = np.unique(r)
        whose = np.concatenate([np.repeat(touched, k), r])
        s = np.concatenate([self.scores[rows[touched]].ravel(), scores[r, c]])
        i = np.concatenate([self.ids[rows[touched]].ravel(), ids[c]])
        order = np.lexsort((i, -s, whose))
        whose, s, i = whose[order], s[order], i[order]
        start = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
        take = start[:, None] + np.arange(k)  # every touched row has k entries at least
        at = rows[touched]
        self.scores[at], self.ids[at] = s[take], i[take]
        self.least[at] = np.maximum(self.least[at], self.scores[at][:, -1])


def _pairs(a: Tree, c: Tree, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Leaf of anchors, and the leaves of candidates (largest first) that level after level could not be ruled out, with their largest products.

    low, high: of every anchor in the tree's order, what it can use."""
    x, y = np.zeros(1, np.int64), np.zeros(1, np.int64)
    depth = max(len(a.edges), len(c.edges))
    for level in range(depth):
        la, lc = min(level, len(a.edges) - 1), min(level, len(c.edges) - 1)
        if level:
            if level < len(a.edges):
                x, y = np.concatenate([2 * x, 2 * x + 1]), np.concatenate([y, y])
            if level < len(c.edges):
                x, y = np.concatenate([x, x]), np.concatenate([2 * y, 2 * y + 1])
        full = (np.diff(a.edges[la])[x] > 0) & (np.diff(c.edges[lc])[y] > 0)
        x, y = x[full], y[full]
        least = np.minimum.reduceat(np.concatenate([low, [np.inf]]), a.edges[la][:-1])
        most = np.maximum.reduceat(np.concatenate([high, [-np.inf]]), a.edges[la][:-1])
        bottom, top = interval(a.centres[la][x], a.radii[la][x], c.centres[lc][y], c.radii[lc][y])
        ok = (top >= least[x]) & (bottom <= most[x])
        x, y, top = x[ok], y[ok], top[ok]
    for leaf in np.unique(x):
        own = np.flatnonzero(x == leaf)
        own = own[np.argsort(-top[own], kind="stable")]
        yield int(leaf), y[own], top[own]


@dataclass
class Task:
    """What is looked for: the best rows of an anchor's label, or for each of its positives the best of other labels in a range below it."""

    k: int
    negative: bool
    low: int = 80  # hundredths of a positive's score
    high: int = 100

    def search(self, anchors: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        """(akey, anchor_id, slot, score, id) of the anchors and candidates of one length."""
        x, q = vectors.stack(anchors["v"]), vectors.stack(found["v"])
        a, c = Tree(x, ASKING), Tree(q, LEAF)
        x, q = x[a.order], q[c.order]
        anchors, found = anchors.iloc[a.order], found.iloc[c.order]
        ids, labels = found["vec_id"].to_numpy(np.int64), found["label"].to_numpy(np.int64)
        own, own_label = anchors["vec_id"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64)
        least = vectors.stack(anchors["least"])  # by slot: no worse score is wanted
        if self.negative:
            top = vectors.stack(anchors["positives"])  # negative where there are fewer
            use = top >= 0  # under a negative score the range is empty
            least = np.where(use, np.maximum(least, self.low * top / 100), np.inf)
            high = np.where(use, self.high * top / 100, -np.inf)
        else:
            high = np.full_like(least, np.inf)
        slots = [Best(len(x), self.k, least[:, j]) for j in range(least.shape[1])]
        edge_a, edge_c = a.edges[-1], c.edges[-1]
        norm, centres, radii = np.sqrt((x * x).sum(axis=1)), c.centres[-1], c.radii[-1]
        for leaf, leaves, top_of in _pairs(a, c, least.min(axis=1), high.max(axis=1)):
            whole = np.arange(edge_a[leaf], edge_a[leaf + 1])
            mid, wide = x[whole] @ centres[leaves].T, norm[whole][:, None] * radii[leaves] * (1 + 1e-9)
            wide += 1e-9 * (1 + np.abs(mid))  # sums are rounded
            for at in range(0, len(leaves), STEP):
                now = np.min([s.least[whole] for s in slots], axis=0)
                if top_of[at] < now.min():
                    break  # nor can those after it, which have no larger products
                step = slice(at, at + STEP)
                # of the pairs of leaves that are left, the anchors and the leaves that can use each other
                able = (mid[:, step] + wide[:, step] >= now[:, None]) & (mid[:, step] - wide[:, step] <= high[whole].max(axis=1)[:, None])
                if not able.any():
                    continue
                rows, some = whole[able.any(axis=1)], leaves[step][able.any(axis=0)]
                those = common.ragged(edge_c[some], np.diff(edge_c)[some])
                score = x[rows] @ q[those].T
                same = own_label[rows][:, None] == labels[those]
                score[same if self.negative else ~same | (own[rows][:, None] == ids[those])] = -np.inf
                for j, best in enumerate(slots):
                    if not self.negative:
                        best.add(rows, score, ids[those])
                    else:
                        p = top[rows, j][:, None]
                        inside = (100 * score <= self.high * p) & (100 * score >= self.low * p)
                        best.add(rows, np.where(inside, score, -np.inf), ids[those])
        out = []
        for j, best in enumerate(slots):
            r, n = np.nonzero(best.scores > -np.inf)
            out.append(pd.DataFrame({"akey": anchors["akey"].to_numpy()[r], "anchor_id": own[r], "slot": j, "score": best.scores[r, n].astype(np.int64), "id": best.ids[r, n]}))
        return pd.concat(out)


_FOUND = "akey long, anchor_id long, slot int, score long, id long"


def _searched(task: Task, scale: float):
    def work(g: pd.DataFrame) -> pd.DataFrame:
        g = g.assign(v=[np.floor(scale * np.asarray(v, np.float64)) for v in g["v"]])
        size = g["v"].map(len).to_numpy()
        asks = g["asks"].to_numpy(bool)
        empty = pd.DataFrame({"akey": [], "anchor_id": [], "slot": [], "score": [], "id": []})
        found = [task.search(g[asks & (size == n)], g[~asks & (size == n)]) for n in np.unique(size[asks]) if (~asks & (size == n)).any()]
        return pd.concat(found) if found else empty

    return work


@dataclass
class Places:
    """Counts and radii of the upper trees' places, over all rows; at most MOST_NODES, and one for odd lengths."""

    tree: Upper
    counts: dict[int, int]
    radii: dict[int, float]

    def parts(self, size: int) -> dict[int, int]:
        return {i: -(-n // size) for i, n in self.counts.items()}

    @classmethod
    def of(cls, tree: Upper, table: DataFrame, place: str, far: str) -> Places:
        rows = table.where(f"{place} is not null").groupBy(place).agg(F.count(F.lit(1)).alias("n"), F.max(far).alias("far")).collect()
        return cls(tree, {r[place]: r["n"] for r in rows}, {r[place]: r["far"] for r in rows})


def _intervals(groups: Places, cells: Places) -> dict[tuple[int, int], tuple[float, float]]:
    """What inner products each group of anchors may have with each cell."""
    out = {(_ODD, _ODD): (-np.inf, np.inf)} if _ODD in groups.counts and _ODD in cells.counts else {}
    some, these = (sorted(i for i in p.counts if i != _ODD) for p in (groups, cells))
    for i in some:
        b = cells.tree.centres[these]
        bottom, top = interval(groups.tree.centres[i][None, :], np.float64(groups.radii[i]), b, np.array([cells.radii[j] for j in these]))
        out |= {(i, j): (float(x), float(y)) for j, x, y in zip(these, bottom, top, strict=True)}
    return out


def _units(table: DataFrame, asking: DataFrame, pairs: list[tuple[int, int]], groups: Places, cells: Places) -> DataFrame:
    """Anchors and candidates of the pairs (group, cell), every chunk with every block of its pair."""
    spark = table.sparkSession
    chunks, blocks = groups.parts(GROUP), cells.parts(CELL)
    # at most MOST_NODES squared pairs
    sent = F.broadcast(spark.createDataFrame([(i, j, chunks[i], blocks[j]) for i, j in pairs], "grp int, cell int, chunks int, blocks int"))
    number = F.xxhash64("vec_id", "label", "v")

    def dealt(n: Column) -> Column:
        return F.pmod(number, n).cast("int")

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    none = F.lit(None).cast("array<double>")
    candidates = table.drop("grp").join(sent, "cell").withColumn("block", dealt(F.col("blocks"))).withColumn("chunk", all_of("chunks"))
    anchors = asking.drop("cell").join(sent, "grp").withColumn("chunk", dealt(F.col("chunks"))).withColumn("block", all_of("blocks"))
    columns = [*_KEYS, "vec_id", "label", "v"]
    return candidates.select(*columns, F.lit(False).alias("asks"), F.lit(0).cast("long").alias("akey"), none.alias("least"), none.alias("positives")).unionByName(
        anchors.select(*columns, F.lit(True).alias("asks"), number.alias("akey"), "least", "positives")
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("akey", "anchor_id", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _hunt(table: DataFrame, asking: DataFrame, groups: Places, cells: Places, task: Task, scale: float, slots: int) -> DataFrame:
    """The best k of every anchor and slot: first in its group's likeliest cells, then in those that these bounds don't rule out."""
    between = _intervals(groups, cells)
    likely = {i: max((p for p in between if p[0] == i), key=lambda p: between[p][1], default=None) for i in groups.counts}
    first = sorted(p for p in likely.values() if p is not None)

    def run(asking: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
        units = _units(table, asking, pairs, groups, cells)
        return common.by_group(units, _KEYS, _searched(task, scale), _FOUND, parts_=common.parts(table, 2.0))

    seeds = common.materialise(run(asking, first), "seeds")
    if len(first) == len(between):
        return _top(seeds, task.k)
    # no score under the worst of a full list is wanted
    full = _top(seeds, task.k).groupBy("akey", "anchor_id", "slot").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("n")).where(F.col("n") == task.k)
    full = full.groupBy("akey", "anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "worst"))).alias("worst"))
    asking = asking.withColumn("akey", F.xxhash64("vec_id", "label", "v"))
    bound = asking.join(full.withColumnRenamed("anchor_id", "vec_id"), ["akey", "vec_id"], "left")
    least = F.transform("least", lambda x, j: F.greatest(x, F.coalesce(F.try_element_at("worst", j.cast("int")).cast("double"), F.lit(float("-inf")))))
    bound = common.materialise(bound.withColumn("least", least).drop("worst", "akey"), "bound")
    # what a group can use: from the least of its bounds to the largest of its positives
    if task.negative:
        usable = F.filter(F.zip_with("least", "positives", lambda x, p: F.when(p >= 0, F.greatest(x, task.low * p / 100))), lambda x: x.isNotNull())
        low, high = F.array_min(usable), F.array_max(F.filter("positives", lambda p: p >= 0)) * task.high / 100
    else:
        low, high = F.array_min("least"), F.lit(float("inf"))
    limits = {r["grp"]: (r["low"], r["high"]) for r in bound.groupBy("grp").agg(F.min(low).alias("low"), F.max(high).alias("high")).collect()}
    done = set(first)

    def wanted(p: tuple[int, int]) -> bool:
        low, high = limits.get(p[0], (None, None))
        return p not in done and low is not None and between[p][1] >= low and between[p][0] <= high

    rest = [p for p in between if wanted(p)]
    return _top(seeds.unionByName(run(bound, rest)) if rest else seeds, task.k)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from rows (vec_id, label, embedding).

    anchor: which rows ask. A negative's score lies between low and high hundredths of its positive's."""
    x = F.col("embedding").cast("array<double>")
    whole = x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"), F.coalesce(anchor, F.lit(False)).alias("asks"))
    # rows by a hash, a bounded number
    sample = rows.select("v").orderBy(F.xxhash64("vec_id", F.lit(11)), "v").limit(SAMPLE).toPandas()["v"]
    lengths = sample.map(len)
    dim = int(lengths.mode().iloc[0]) if len(sample) else 0
    points = np.floor(scale * vectors.stack(sample[lengths == dim])) if len(sample) else np.zeros((0, 0))
    n = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    trees = [Upper.fit(points, min(MOST_NODES, max(1, k // size))) for k, size in ((n[0], CELL), (n[1], GROUP))]
    shared = rows.sparkSession.sparkContext.broadcast(trees)  # two times MOST_NODES nodes, 0.5 MB at 64 components

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, groups = shared.value
        for b in batches:
            fits = b["v"].map(len).to_numpy() == cells.dim
            out = b.drop(columns="asks").assign(cell=_ODD, far=0.0, grp=pd.array(np.where(b["asks"], _ODD, None), "Int32"), grp_far=0.0)
            if fits.any():
                q = np.floor(scale * vectors.stack(b["v"][fits]))
                out.loc[fits, "cell"], out.loc[fits, "far"] = cells.place(q)
                grp, far = groups.place(q)
                asks = b["asks"].to_numpy(bool)[fits]
                out.loc[b.index[fits][asks], "grp"] = grp[asks]
                out.loc[b.index[fits][asks], "grp_far"] = far[asks]
            yield out

    kind = rows.schema["v"].dataType.simpleString()
    table = common.materialise(rows.distinct().mapInPandas(place, f"vec_id long, label long, v {kind}, cell int, far double, grp int, grp_far double"), "placed")
    cells, groups = Places.of(trees[0], table, "cell", "far"), Places.of(trees[1], table, "grp", "grp_far")
    some = table.where("grp is not null").drop("cell", "far", "grp_far")
    table = table.select("vec_id", "label", "v", "cell", "grp")
    never = F.lit(float("-inf"))

    asking = some.withColumns({"cell": F.lit(None).cast("int"), "least": F.array(never), "positives": F.lit(None).cast("array<double>")})
    near = common.materialise(_hunt(table, asking, groups, cells, Task(positives, False), scale, 1), "positives")
    listed = near.groupBy("akey", "anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("p"))
    scores = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda r: F.coalesce(F.get("p", r - 1)["score"].cast("double"), F.lit(float("nan"))))
    asking = some.withColumn("akey", F.xxhash64("vec_id", "label", "v")).join(listed.withColumnRenamed("anchor_id", "vec_id"), ["akey", "vec_id"])
    # of positives without score the range is empty: as under a negative one
    asking = asking.select("vec_id", "label", "v", "grp", F.lit(None).cast("int").alias("cell"), F.array_repeat(never, positives).alias("least"), F.transform(scores, lambda s: F.when(F.isnan(s), F.lit(-1.0)).otherwise(s)).alias("positives"))
    asking = common.materialise(asking, "asking")
    far = _hunt(table, asking, groups, cells, Task(negatives, True, low, high), scale, positives)
    near = near.select("akey", "anchor_id", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.join(near, ["akey", "anchor_id", "slot"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def shifted(rows: DataFrame) -> DataFrame:
    """rows whose labels are wrong on purpose where vec_id is divisible by 7."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def oracle() -> str:
    """mine() of shifted embeddings, anchors' ids divisible by 100, as SQL."""
    return """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""

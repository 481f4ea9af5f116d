"""Set-similarity join on word shingles with token-combination prefixes.

Shingles are ordered by document frequency. A set's prefix is extended until any set similar
enough must share a signature with it: a single shingle of the rare class, or two shingles of one
class of the frequent ones. Frequent shingles are dealt to as many classes as the size of the set
asks for, so that pairs stay as few as single shingles would be. Candidates are verified exactly.

Frequencies come from one exchange of shingles by range; equal sets meet there only as classes, and
what many sets of a batch share is counted before it is sent. Sets are compared with the centres of
their lists, then only across components not yet joined, so a group of near copies costs pairs in
proportion to its size and no link between components is lost.

Texts: null, empty or blank texts have no shingles and link with nothing; fewer words than a shingle
make one. Repeated rows and equal texts are one class. Rows with a null doc_id link as any other
and get the component's smallest doc_id, null if it has none. Texts of any length are read whole. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .neardup import forest

WORDS, PERCENT = 5, 75
#: A shingle that so many different sets hold is frequent.
FREQUENT = 64
#: Shingles are 56-bit hashes: seven bytes of each travel.
_BITS = 56
#: Words that a worker gathers before it sends what they make.
_FLUSH = 600_000
#: Postings that a reducing worker holds, about.
_POSTINGS = 1_000_000
#: Shingles of a block of sets that are compared with another block's, about.
_BLOCK = 400_000
_WORD = r"[^\x20\x09-\x0D]"


def shingles(text: str, words: common.WordHashes, width: int = WORDS) -> np.ndarray:
    """The set of a text, sorted: 56-bit hashes of its runs of `width` words, A-Z in lower case."""
    h = np.array(list(map(words.__getitem__, text.encode().lower().split())), np.uint64)
    if not len(h):
        return h
    k = min(width, len(h))
    return np.unique((common.windows64(h, k) ^ np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - _BITS))


def _planes(x: np.ndarray) -> bytes:
    """Sorted 56-bit numbers byte by byte: the high bytes of neighbours agree, so they compress."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].T.tobytes()


def _unplanes(b) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8)
    n = len(raw) // 7
    out = np.zeros((n, 8), np.uint8)
    out[:, :7] = raw.reshape(7, n).T
    return out.reshape(-1).view("<u8").astype(np.uint64)


_SENT = "rng int, kind int, digest long, n int, tokens binary, owners binary, sets binary, docs array<long>"
_TOLD = "digest long, n int, token long, df int, docs array<long>"
_COUNT, _KNOWN, _POSTING, _CLASS = 0, 1, 2, 3
_TOLD_ARROW = pa.schema([("digest", pa.int64()), ("n", pa.int32()), ("token", pa.int64()), ("df", pa.int32()), ("docs", pa.list_(pa.int64()))])


def digest_of(s: np.ndarray) -> int:
    """Name of a set; the empty one's is 0."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else 0


def _send(ranges: int):
    """Batches of texts -> a row for each different set of the batch with its documents and, by range of shingles, postings of the sets."""

    bounds = np.array([(i << _BITS) // ranges for i in range(ranges + 1)], np.uint64)
    names = ["rng", "kind", "digest", "n", "tokens", "owners", "sets", "docs"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]

    def flush(held: dict[int, tuple[np.ndarray, list]], turn: int) -> Iterator[pa.RecordBatch]:
        rows = [(d % ranges, _CLASS, d, len(s), None, None, None, docs) for d, (s, docs) in held.items()]
        digests = [d for d, (s, _) in held.items() if len(s)]
        own = [held[d][0] for d in digests]
        if own:
            sizes = [len(s) for s in own]
            table = np.stack([np.array(digests, np.int64), np.array(sizes, np.int64)], axis=1)
            t = np.concatenate(own)
            owner = np.repeat(np.arange(len(own), dtype=np.uint32), sizes)
            order = np.argsort(t, kind="stable")
            t, owner = t[order], owner[order]
            edge = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            times = np.diff(np.concatenate([edge, [len(t)]]))
            hot = np.repeat(times >= FREQUENT, times)

            def payload(r: int, kind: int, tokens: np.ndarray, owners: np.ndarray) -> None:
                used, back = np.unique(owners, return_inverse=True)
                width = "<u2" if len(used) < 65536 else "<u4"
                rows.append((r, kind, 0, 0, _planes(tokens), back.astype(width).tobytes(), table[used].tobytes(), None))

            cold_t, cold_o = t[~hot], owner[~hot]
            at = np.searchsorted(cold_t, bounds)
            for r in np.flatnonzero(np.diff(at)):
                payload(int(r), _POSTING, cold_t[at[r] : at[r + 1]], cold_o[at[r] : at[r + 1]])
            if hot.any():  # known to be frequent here already: others need the counts alone
                which = edge[times >= FREQUENT]
                place = np.searchsorted(bounds, t[which], side="right") - 1
                for r in np.unique(place):
                    rows.append((int(r), _COUNT, 0, 0, _planes(t[which[place == r]]), None, None, None))
                for s in range(0, int(hot.sum()), _POSTINGS):
                    payload(turn % ranges, _KNOWN, t[hot][s : s + _POSTINGS], owner[hot][s : s + _POSTINGS])
        for s in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*rows[s : s + 2000], strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = common.WordHashes()
        held: dict[int, tuple[np.ndarray, list]] = {}
        size = turn = 0
        for b in batches:
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                s = shingles(text.as_py(), words)
                digest = digest_of(s)
                if digest in held:
                    held[digest][1].append(d)
                    size += 1
                else:
                    held[digest] = (s, [d])
                    size += 1 + len(s)
                if size >= _FLUSH:
                    yield from flush(held, turn + digest % 997)
                    held, size, turn = {}, 0, turn + 1
        if held:
            yield from flush(held, turn + next(iter(held)) % 997)
        del words, held
        common.trim()

    return run


def _shared(t: np.ndarray, d: np.ndarray, n: np.ndarray, df: np.ndarray) -> Iterator[pa.RecordBatch]:
    for s in range(0, len(t), 100_000):
        cut = slice(s, s + 100_000)
        columns = [pa.array(d[cut]), pa.array(n[cut].astype(np.int32)), pa.array(t[cut].astype(np.int64)), pa.array(df[cut].astype(np.int32)), pa.nulls(len(t[cut]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, schema=_TOLD_ARROW)


def _reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of shingles -> for every set, those of its shingles that other sets hold too, with their frequency.

    A range is streamed. Postings are held until there are many; then those of shingles that turn out
    to be frequent go out at once, as all later ones of them do, so at most FREQUENT of a shingle stay."""

    def unpack(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tok = _unplanes(b.column("tokens")[i].as_buffer())
        raw = b.column("owners")[i].as_buffer()
        table = np.frombuffer(b.column("sets")[i].as_buffer(), np.int64).reshape(-1, 2)
        own = np.frombuffer(raw, "<u2" if raw.size == 2 * len(tok) else "<u4")
        return tok, table[own, 0], table[own, 1]

    for _, part in common.runs(batches, "rng"):
        hot = np.zeros(0, np.uint64)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            """What is held, a set of many batches once, with the frequencies so far."""
            t, d, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((d, t))
            t, d, n = t[order], d[order], n[order]
            fresh = np.concatenate([[True], (t[1:] != t[:-1]) | (d[1:] != d[:-1])])
            t, d, n = t[fresh], d[fresh], n[fresh]
            edge = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            times = np.diff(np.concatenate([edge, [len(t)]]))
            return t, d, n, np.repeat(np.minimum(times, FREQUENT), times)

        for b in part:
            kind = b.column("kind").to_numpy()
            if (kind == _CLASS).any():
                own = b.filter(pa.array(kind == _CLASS))
                nothing = pa.nulls(own.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([own.column("digest"), own.column("n"), nothing, pa.nulls(own.num_rows, pa.int32()), own.column("docs")], schema=_TOLD_ARROW)
            counts = [_unplanes(b.column("tokens")[int(i)].as_buffer()) for i in np.flatnonzero(kind == _COUNT)]
            if counts:
                hot = np.unique(np.concatenate([hot, *counts]))
            for i in np.flatnonzero((kind == _KNOWN) | (kind == _POSTING)):
                t, d, n = unpack(b, int(i))
                known = np.isin(t, hot) if kind[i] == _POSTING else np.ones(len(t), bool)
                if known.any():
                    yield from _shared(t[known], d[known], n[known], np.full(known.sum(), FREQUENT))
                    t, d, n = t[~known], d[~known], n[~known]
                if len(t):
                    held.append((t, d, n))
                    size += len(t)
                if size > _POSTINGS:
                    t, d, n, df = counted()
                    out = df >= FREQUENT
                    yield from _shared(t[out], d[out], n[out], df[out])
                    hot = np.unique(np.concatenate([hot, t[out]]))
                    held = [(t[~out], d[~out], n[~out])]
                    # at least half a block between two rounds, whatever stays
                    size = min(len(held[0][0]), _POSTINGS // 2)
        if held:
            t, d, n, df = counted()
            keep = df > 1
            yield from _shared(t[keep], d[keep], n[keep], df[keep])
    common.trim()


def _levels(n: int) -> list[tuple[int, int]]:
    """(level, classes of frequent shingles) under which a set of n signs: its own size level, and a neighbour's if a similar set can lie there."""
    out = []
    for level in range(-1, 20):
        low, high = (0, 16) if level < 0 else (16 << 2 * level, 64 << 2 * level)
        if n * 100 >= low * PERCENT and n * PERCENT < high * 100:
            out.append((level, 0 if level < 0 else low // 4))
    return out


def signatures(n: int, tokens: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Signatures of a set of n shingles, of which only `tokens` (ordered by df, then value) are held by others.

    At most `miss` of its shingles lack from a similar set. A prefix in which the classes can hold no
    more than `miss` unmatched without sharing a signature is long enough: every rare shingle counts
    one, every frequent one counts unless it is the first of its class."""
    miss = n * (100 - PERCENT) // 100
    alone = n - len(tokens)
    if alone > miss:
        return np.zeros(0, np.int64)
    need = miss + 1 - alone
    rare = tokens[df < FREQUENT]
    out = [common.mix64(rare[:need])]
    if need > len(rare):
        need -= len(rare)
        often = tokens[df >= FREQUENT]
        for level, classes in _levels(n):
            if not classes:  # small sets: single shingles of every class
                out.append(common.mix64(often[:need]))
                continue
            of = common.mix64(often) % np.uint64(classes)
            first = np.zeros(len(often), bool)
            first[np.unique(of, return_index=True)[1]] = True
            length = int(np.searchsorted(np.cumsum(~first), need)) + 1
            head, of = often[:length], of[:length]
            order = np.argsort(of, kind="stable")
            head, of = head[order], of[order]
            edge = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
            for s, e in zip(edge, [*edge[1:], len(of)], strict=True):
                if e - s > 1:
                    a, b = np.triu_indices(e - s, 1)
                    out.append(common.mix64(common.mix64(head[s:e][a] + np.uint64(level + 1)) ^ head[s:e][b]))
    return np.unique(np.concatenate(out)).view(np.int64)


_SIGNED = pa.schema([("digest", pa.int64()), ("n", pa.int32()), ("alone", pa.int32()), ("tokens", pa.list_(pa.int64())), ("signs", pa.list_(pa.int64()))])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets' shared shingles, sorted by set -> the sets that can have a similar one at all, with their signatures."""
    rows: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        def lists(k: int) -> pa.Array:
            ends = np.cumsum([0, *(len(r[k]) for r in rows)])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([r[k] for r in rows]), pa.int64()))

        return pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in rows], _SIGNED.types[k]) for k in range(3)), lists(3), lists(4)], schema=_SIGNED)

    for digest, part in common.runs(batches, "digest"):
        tokens, df, n = np.zeros(0, np.uint64), np.zeros(0, np.int32), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for b in part:
            n = b.column("n")[0].as_py()
            held.append((b.column("token").to_numpy().view(np.uint64), b.column("df").to_numpy()))
            waiting += b.num_rows
            if waiting > n + _POSTINGS:  # copies of one set in many batches
                tokens, at = np.unique(np.concatenate([tokens, *(t for t, _ in held)]), return_index=True)
                df = np.concatenate([df, *(f for _, f in held)])[at]
                held, waiting = [], 0
        if held:
            tokens, at = np.unique(np.concatenate([tokens, *(t for t, _ in held)]), return_index=True)
            df = np.concatenate([df, *(f for _, f in held)])[at]
        if n - len(tokens) > n * (100 - PERCENT) // 100:
            continue
        order = np.lexsort((tokens, df))
        tokens, df = tokens[order], df[order]
        signs = signatures(n, tokens, df)
        if len(signs):
            rows.append((int(digest), n, n - len(tokens), tokens.view(np.int64), signs))
            size += len(tokens) + len(signs)
        if size > 500_000 or len(rows) >= 2000:
            yield out()
            rows, size = [], 0
    if rows:
        yield out()
    common.trim()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those (a, b) whose Jaccard similarity is large enough. Shingles no other set holds can't be common, so shared ones suffice."""
    one = sets.select(F.col("digest").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("digest").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT
    rows = pairs.join(one, "a").join(two, "b").where(near)
    return rows.where(both * 100 >= PERCENT * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends lie in different components so far."""
    for side in ("a", "b"):
        pairs = pairs.join(comp.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    return pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _held(tokens: np.ndarray, ends: np.ndarray, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which of the sorted shingles `own` each row holds, as a matrix of 0 and 1."""
    out = np.zeros((len(rows), len(own)), np.float32)
    for k, i in enumerate(rows):
        t = tokens[ends[i] : ends[i + 1]]
        at = np.searchsorted(own, t)
        ok = at < len(own)
        at = at[ok]
        out[k, at[own[at] == t[ok]]] = 1
    return out


def _cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells, two blocks of one family each: links between sets of different components, as a forest."""
    for _, run in common.runs(batches, "cell"):
        g = pa.Table.from_batches(list(run)).combine_chunks()
        lo, hi = g.column("lo")[0].as_py(), g.column("hi")[0].as_py()
        block, size, comp, ids = (g.column(c).to_numpy() for c in ("block", "n", "component", "digest"))
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        if not len(left) or not len(right):
            continue
        lists = g.column("tokens").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        # sorted by value in every row, as searches need
        tokens = lists.flatten().to_numpy().copy()
        for a, b in zip(ends, ends[1:], strict=False):
            tokens[a:b].sort()
        shared = np.intersect1d(tokens[common.ragged(ends[left], np.diff(ends)[left])], tokens[common.ragged(ends[right], np.diff(ends)[right])])
        both = np.zeros((len(left), len(right)), np.float32)
        for s in range(0, len(shared), 8192):  # long texts share many: a block of shingles at a time
            both += _held(tokens, ends, left, shared[s : s + 8192]) @ _held(tokens, ends, right, shared[s : s + 8192]).T
        near = (100 * both >= PERCENT * (size[left][:, None] + size[right][None, :] - both)) & (comp[left][:, None] != comp[right][None, :])
        i, j = np.nonzero(near)
        if len(i):
            low = forest(left[i], right[j], g.num_rows)
            own = np.flatnonzero(low != np.arange(g.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[low[own]])], ["a", "b"])
    common.trim()


def _joined(sets: DataFrame) -> DataFrame:
    """Components (node, component) of the sets by similarity, from the lists of their signatures.

    First every set is compared with the centre of each of its lists: the one with the fewest
    shingles of its own, which is likest to all others. That joins groups of near copies by as many
    pairs as they have members. Lists that still hold several components stay open: in short ones all
    pairs across components are verified; the sets of long ones are put together to families, and a
    family's pairs are verified in cells of bounded size, which return links alone."""
    lists = sets.select("digest", "alone", F.explode("signs").alias("sign"))
    centre = lists.groupBy("sign").agg(F.min(F.struct("alone", "digest")).alias("c"), F.count(F.lit(1)).alias("size")).where("size > 1").select("sign", F.col("c.digest").alias("centre"), "size")
    lists = common.materialise(lists.join(centre, "sign").select("sign", "digest", "centre", "size"), "lists")
    star = lists.where("digest <> centre").groupBy(F.col("digest").alias("a"), F.col("centre").alias("b")).agg(F.count(F.lit(1)).alias("k"))
    star = common.materialise(star, "star")
    best = common.materialise(star.groupBy("a").agg(F.max_by("b", F.struct("k", "b")).alias("b")), "best")
    links = common.materialise(_verified(best, sets), "links")
    comp = common.components(links)
    more = common.materialise(_verified(_across(star.select("a", "b").join(best, ["a", "b"], "left_anti"), comp), sets), "links")
    if not more.isEmpty():
        links = common.materialise(links.unionByName(more), "links")
        comp = common.components(links)
    # centres have met all others of their lists
    rest = lists.where("digest <> centre").join(comp.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    mixed = rest.groupBy("sign").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rest = common.materialise(rest.join(mixed.select("sign"), "sign", "left_semi"), "rest")
    short = rest.where(F.col("size") <= FREQUENT)
    other = short.select("sign", F.col("digest").alias("b"), F.col("component").alias("cb"))
    pairs = short.select("sign", F.col("digest").alias("a"), F.col("component").alias("ca")).join(other, "sign").where("ca < cb").select("a", "b").distinct()
    found = _verified(pairs, sets)
    long = rest.where(F.col("size") > FREQUENT)
    family = common.components(long.select(F.col("digest").alias("a"), F.col("centre").alias("b")).distinct()).withColumnRenamed("node", "digest").withColumnRenamed("component", "family")
    members = long.select("digest", "component").distinct().join(family, "digest").join(sets.select("digest", F.size("tokens").alias("held")), "digest")
    members = common.materialise(members.select("family", "digest", "component", "held"), "members")
    # a block holds a bounded number of sets and, single long sets aside, of shingles
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(256.0)), F.ceil(F.sum("held") / F.lit(float(_BLOCK)))).cast("int")
    sizes = members.groupBy("family").agg(parts.alias("parts"), F.count(F.lit(1)).alias("n"))
    members = common.with_hubs(members, sizes, "family", common.least_hub(members.count())).withColumn("block", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
    members = members.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o"))
    cells = members.join(sets.select("digest", "n", "tokens"), "digest").select("family", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi"), "block", "digest", "component", "n", "tokens")
    cells = cells.withColumn("cell", F.xxhash64("family", "lo", "hi")).drop("family").repartition(common.parts(sets), "cell").sortWithinPartitions("cell")
    found = common.materialise(found.unionByName(cells.mapInArrow(_cell, "a long, b long")), "links")
    if not found.isEmpty():
        comp = common.components(links.unionByName(found))
    common.discard(lists, star, best, rest, found, links)
    return comp


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets: (digest, n, docs), a row for every batch of texts that holds one, and (digest, component_id, kept).

    component_id is the smallest doc_id of the class's component, null if it has none; of every
    component one class is kept, the smallest by that id and digest. Sets without shingles are in the first alone."""
    ranges, parts = common.shards(docs, 4 << 20), common.parts(docs, 2.0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sent = rows.mapInArrow(_send(ranges), _SENT).repartition(parts, "rng").sortWithinPartitions("rng", "kind")
    told = common.materialise(sent.mapInArrow(_reply, _TOLD), "told")
    held = common.materialise(told.where("docs is not null").select("digest", "n", "docs"), "held")
    shared = told.where("docs is null").select("digest", "n", "token", "df").repartition(parts, "digest").sortWithinPartitions("digest")
    sets = common.materialise(shared.mapInArrow(_sign, "digest long, n int, alone int, tokens array<long>, signs array<long>"), "sets")
    common.discard(told)
    comp = common.materialise(_joined(sets), "components")
    common.discard(sets)
    own = held.where("n > 0").groupBy("digest").agg(F.min(F.array_min("docs")).alias("low"))
    own = own.join(comp.withColumnRenamed("node", "digest"), "digest", "left").select("digest", F.struct(F.col("low").isNull().alias("nameless"), "low", "digest").alias("key"), F.coalesce("component", "digest").alias("component"))
    own = common.materialise(own, "classes")
    common.discard(comp)
    least = common.materialise(own.groupBy("component").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")), "least")
    named = common.with_hubs(own, least, "component", common.least_hub(own.count()))
    return held, named.select("digest", F.col("first.low").alias("component_id"), (F.col("first.digest") == F.col("digest")).alias("kept"), F.col("key.low").alias("low"))


def similar(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of docs."""
    held, named = classes(docs)
    rows = held.join(named.select("digest", "component_id"), "digest", "left").select(F.explode("docs").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id")
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """docs with one row of every component of near copies, and all rows without words.

    The row that stays has the component's smallest doc_id (a null one only if all are null); of several
    such rows, the class with the smallest digest, then the smallest text, then the least hash of the other columns."""
    _, named = classes(docs)

    @F.pandas_udf("long")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = common.WordHashes()
        for texts in batches:
            yield pd.Series([digest_of(shingles(t, words)) for t in texts], dtype="int64")

    worded = F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    # what hashes don't take has no say
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    rows = docs.where(worded).select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").cast("long").alias("_id"), digest(F.col("text")).alias("_digest"), F.struct("text", F.xxhash64(*hashed).alias("h")).alias("_order"))
    rows = rows.withColumn("_nameless", F.col("_id").isNull()).withColumn("_id", F.coalesce("_id", "_digest"))
    keys = ["_nameless", "_id", "_digest"]
    one = rows.groupBy(*keys).agg(F.min_by("_row", "_order").alias("_row"))
    kept = named.where("kept").select(F.col("low").isNull().alias("_nameless"), F.coalesce("low", "digest").alias("_id"), F.col("digest").alias("_digest"))
    stay = one.join(kept, keys, "left_semi").select("_row.*")
    return stay.unionByName(docs.where(~worded))

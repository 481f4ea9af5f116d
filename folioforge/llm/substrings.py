"""Substring dedup by content-defined chunking.

A text is a sequence of units: its words, and the single code points of pieces in scripts without
blanks or of endless strings. A gear rolling hash runs over the units; a cut lies where it is smallest
among REACH units on either side, so cuts depend on a few units around them alone, return soon after
an insertion, and chunks have a least size of REACH + 1 units and about twice that on average. Chunks
don't overlap and together are the whole text. A chunk is a repeat if its digest stands earlier: in a
document of a smaller doc_id, or earlier in the same text. With every chunk travel short hashes of the
units around it, by which a repeat is extended beyond its ends as far as the first place agrees.

Repeated chunks that follow one another form a passage, which is cut out if it has `least` units or
more, or is a whole text, however short.

Texts: null, empty or blank texts have no chunks and stay as they are. Rows with the same doc_id and
the same text are one document and lose nothing to each other; of different texts of one doc_id the one
with the smaller hash counts as earlier. Rows with a null doc_id are kept whole and are nobody's first.
White space takes no part in chunks. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Units of a passage at least; passages of over 50 words are longer.
LEAST = 30
#: Units that the gear hash rolls over, and on either side of a cut that have larger hashes.
WINDOW, REACH = 3, 3
#: Units around a chunk by which it may be extended, and chunk sizes where no unit's hash is smallest (one word over and over).
BEFORE, AFTER, MOST = 12, 10, 16
#: Pieces of more characters are read code point by code point.
_LONG = 64
_FLUSH = 500_000
#: Chunks that a reducing worker holds, about.
_HELD = 500_000
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Scripts that are written without blanks.
_DENSE = re.compile("[฀-໿က-႟ក-៿⺀-鿿가-힯豈-﫿\U00020000-\U0003ffff]")
_NO_BLANKS = re.compile(_DENSE.pattern + "|[^\\x20\\x09-\\x0D]{%d}" % (_LONG + 1))


def units(text: str, words: common.WordHashes) -> np.ndarray:
    """Hashes of a text's units."""
    if not _NO_BLANKS.search(text):
        return np.array(list(map(words.__getitem__, text.encode("utf-8", "surrogatepass").split())), np.uint64)
    out = []
    for piece in _WORD.findall(text):
        parts = piece if len(piece) > _LONG or _DENSE.search(piece) else (piece,)
        out += [words[p.encode("utf-8", "surrogatepass")] for p in parts]
    return np.array(out, np.uint64)


def places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code-point positions of starts and ends of the same units."""
    start, end = [], []
    dense = _NO_BLANKS.search(text)
    for m in _WORD.finditer(text):
        a, b = m.span()
        if dense and (b - a > _LONG or _DENSE.search(m.group())):
            start.extend(range(a, b))
            end.extend(range(a + 1, b + 1))
        else:
            start.append(a)
            end.append(b)
    return np.array(start, np.int64), np.array(end, np.int64)


def gear(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The rolling hash g = (g << 16) + gear(unit) after every unit, of which `window` units are left in 16 * window bits; mixed, so that all of them decide."""
    own = common.mix64(h) & np.uint64(0xFFFF)
    g = np.zeros(len(h), np.uint64)
    for j in range(window):
        g[j:] += own[: len(h) - j] << np.uint64(16 * j)
    return common.mix64(g)


def cuts(h: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Places between units, 0 and the end among them: after every unit whose gear hash is smallest within `reach` units on either side, the first of equal ones."""
    n = len(h)
    g = gear(h)
    ok = np.ones(n, bool)
    ok[: min(n, WINDOW - 1 + reach)] = False
    ok[max(0, n - reach) :] = False
    for j in range(1, reach + 1):
        ok[j:] &= g[j:] < g[:-j]
        ok[:-j] &= g[:-j] <= g[j:]
    found = np.unique(np.concatenate([[0], np.flatnonzero(ok) + 1, [n]]))
    gap = (np.diff(found) - 1) // MOST
    if gap.any():
        found = np.unique(np.concatenate([found, common.ragged(np.ones(len(gap), np.int64), gap) * MOST + np.repeat(found[:-1], gap)]))
    return found


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            base = np.ones(size, np.uint64)
            base[1:] = _MULTIPLIER
            self.up = np.cumprod(base)
            base[1:] = pow(_MULTIPLIER, -1, 1 << 64)
            self.down = np.cumprod(base)
        return self.up, self.down


def chunks(h: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digest, first unit, end unit) of every chunk of a text given by its units' hashes."""
    n = len(h)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    found = cuts(h)
    start, end = found[:-1], found[1:]
    up, down = powers.to(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[:n])])
    digest = common.mix64((total[end] - total[start]) * down[start] ^ common.mix64((end - start).astype(np.uint64)))
    return digest, start, end


def around(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Short hashes of the BEFORE units before each chunk, nearest first, and of the AFTER behind it; 0 beyond the text."""
    short = np.concatenate([np.zeros(BEFORE, np.uint16), (h >> np.uint64(40)).astype(np.uint16) | np.uint16(1), np.zeros(AFTER, np.uint16)])
    before = start[:, None] + BEFORE - 1 - np.arange(BEFORE)
    after = end[:, None] + BEFORE + np.arange(AFTER)
    return short[np.concatenate([before, after], axis=1)]


def extent(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By how many units before and behind them pairs of equal chunks agree further."""
    same = (one == two) & (one != 0)
    return np.cumprod(same[:, :BEFORE], axis=1).sum(axis=1), np.cumprod(same[:, BEFORE:], axis=1).sum(axis=1)


def union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans merged where they touch."""
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    at = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
    return s[at], e[np.concatenate([at[1:] - 1, [len(s) - 1]]).astype(int)]


#: What is known of a chunk: its digest, its place (document, print of the text, first unit), its size, the text's size, what is around.
_CHUNK = np.dtype([("digest", "<u8"), ("doc", "<i8"), ("print", "<i8"), ("start", "<u4"), ("size", "<u4"), ("units", "<u4"), ("around", "<u2", BEFORE + AFTER)])
_FIELDS = ["digest", "doc", "print", "start", "size", "units", "around"]
#: A repeat: its place, with its extension.
_REPEAT = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("units", pa.int32()), ("before", pa.int32()), ("after", pa.int32())])
_REPEATS = "doc_id long, print long, start int, size int, units int, before int, after int"


def _packed(x: np.ndarray) -> list[bytes]:
    """Field by field, bytes of one significance side by side, which compress well."""
    out = []
    for f in _FIELDS:
        col = np.ascontiguousarray(x[f])
        out.append(col.view(np.uint8).reshape(-1, col.dtype.itemsize).T.tobytes())
    return out


def _unpacked(raw: list) -> np.ndarray:
    n = len(raw[0]) // 8
    x = np.zeros(n, _CHUNK)
    for f, b in zip(_FIELDS, raw, strict=True):
        base = _CHUNK[f].base
        x[f] = np.frombuffer(b, np.uint8).reshape(base.itemsize, -1).T.copy().reshape(-1).view(base).reshape(x[f].shape)
    return x


def split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first chunk of every digest by document, print and place, and the others with their extension by it."""
    x = x[np.lexsort((x["start"], x["print"], x["doc"], x["digest"]))]
    new = np.concatenate([[True], x["digest"][1:] != x["digest"][:-1]])
    # the same place again is the same row again
    place = np.zeros(len(x), bool)
    first = x[np.flatnonzero(new)][np.cumsum(new) - 1]
    for f in ("doc", "print", "start"):
        place |= x[f] != first[f]
    later = x[place]
    before, after = extent(later["around"], first["around"][place])
    # a text's own first place ends before the repeat begins
    own = (later["doc"] == first["doc"][place]) & (later["print"] == first["print"][place])
    gap = later["start"].astype(np.int64) - (first["start"][place].astype(np.int64) + first["size"][place])
    ends = np.maximum(gap, 0)
    after = np.where(own, np.minimum(after, ends), after)
    before = np.where(own, np.minimum(before, ends - after), before)
    return x[new], _found(later, before, after)


_FOUND = np.dtype([("doc_id", "<i8"), ("print", "<i8"), ("start", "<i4"), ("size", "<i4"), ("units", "<i4"), ("before", "<i4"), ("after", "<i4")])


def _found(x: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), _FOUND)
    for to, of in (("doc_id", x["doc"]), ("print", x["print"]), ("start", x["start"]), ("size", x["size"]), ("units", x["units"]), ("before", before), ("after", after)):
        out[to] = of
    return out


def _send(ranges: int):
    """Batches -> by range of digests, the first chunk of every digest of the batch; what repeats within the batch is known already."""
    names = ["rng", *_FIELDS, "found"]
    types = [pa.int32(), *[pa.binary()] * (len(_FIELDS) + 1)]
    bounds = (np.arange(1, ranges) * (2.0**64 / ranges)).astype(np.uint64)

    def flush(held: list[np.ndarray], turn: int) -> Iterator[pa.RecordBatch]:
        first, found = split(np.concatenate(held))
        cut = np.concatenate([[0], np.searchsorted(first["digest"], bounds), [len(first)]])
        rows = [(int(r), *_packed(first[cut[r] : cut[r + 1]]), None) for r in np.flatnonzero(np.diff(cut))]
        rows += [((turn + i) % ranges, *[None] * len(_FIELDS), found[s : s + 20_000].tobytes()) for i, s in enumerate(range(0, len(found), 20_000))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, powers = common.WordHashes(), Powers()
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        size = turn = 0
        for b in batches:
            for doc, text, mark in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("print").to_pylist(), strict=True):
                if (doc, mark) in seen:  # the same row again
                    continue
                h = units(text.as_py(), words)
                digest, s, e = chunks(h, powers)
                if not len(digest):
                    continue
                seen.add((doc, mark))
                own = np.zeros(len(digest), _CHUNK)
                for f, x in (("digest", digest), ("doc", doc), ("print", mark), ("start", s), ("size", e - s), ("units", len(h)), ("around", around(h, s, e))):
                    own[f] = x
                held.append(own)
                size += len(h)
                if size >= _FLUSH:
                    yield from flush(held, turn + doc % 997)
                    held, size, turn = [], 0, turn + 1
                    seen.clear()
        if held:
            yield from flush(held, turn + int(held[0]["doc"][0] % 997))
        del words, powers, held
        common.trim()

    return run


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of digests -> chunks that aren't the first of their digest. A range is streamed: of every digest the first chunk so far is held."""

    def out(found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(found), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(found[f][s : s + 100_000])) for f in _REPEAT.names], schema=_REPEAT)

    for _, part in common.runs(batches, "rng"):
        held: list[np.ndarray] = []
        size, most = 0, _HELD
        for b in part:
            for i in range(b.num_rows):
                if b.column("found")[i].is_valid:
                    yield from out(np.frombuffer(b.column("found")[i].as_buffer(), _FOUND))
                    continue
                held.append(_unpacked([b.column(f)[i].as_buffer().to_pybytes() for f in _FIELDS]))
                size += len(held[-1])
                if size > most:
                    first, found = split(np.concatenate(held))
                    yield from out(found)
                    held, size = [first], len(first)
                    most = max(_HELD, 2 * size)  # what stays are different digests
        if held:
            yield from out(split(np.concatenate(held))[1])
    common.trim()


def passages(start: np.ndarray, size: np.ndarray, units: int, before: np.ndarray, after: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of units to cut from one text, by its repeated chunks: chunks that touch are one passage, with the extension of its ends."""
    order = np.lexsort((-before - after, start))
    start, size, before, after = start[order], size[order], before[order], after[order]
    once = np.concatenate([[True], start[1:] != start[:-1]])  # a repeat of several places: the one that agrees furthest
    start, size, before, after = start[once], size[once], before[once], after[once]
    end = start + size
    new = np.concatenate([[True], start[1:] != end[:-1]])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:] - 1, [len(start) - 1]]).astype(int)
    s, e = union(np.maximum(start[at] - before[at], 0), np.minimum(end[last] + after[last], units))
    keep = (e - s >= least) | (e - s == units)
    return s[keep], e[keep]


def _merge(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Repeats by document, one text after another -> the spans of units to cut from each."""
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "print", "starts", "ends"])

        for doc, part in common.runs(batches, "doc_id"):
            for mark, own in common.runs(part, "print"):
                x = [np.concatenate(c) for c in zip(*([b.column(f).to_numpy().astype(np.int64) for f in ("start", "size", "units", "before", "after")] for b in own), strict=True)]
                s, e = passages(x[0], x[1], int(x[2][0]), x[3], x[4], least)
                if len(s):
                    rows.append((int(doc), int(mark), s.tolist(), e.tolist()))
                if len(rows) >= 1000:
                    yield out()
                    rows.clear()
        if rows:
            yield out()

    return run


def repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, print, starts, ends): spans of units to cut from every text that has any; print is the text's hash."""
    ranges, parts = common.shards(docs, 4 << 20), common.parts(docs, 2.0)
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("print"))
    fields = ", ".join(f"{f} binary" for f in [*_FIELDS, "found"])
    sent = rows.mapInArrow(_send(ranges), f"rng int, {fields}").repartition(parts, "rng").sortWithinPartitions("rng")
    found = sent.mapInArrow(_first, _REPEATS).repartition(parts, "doc_id", "print").sortWithinPartitions("doc_id", "print")
    return found.mapInArrow(_merge(least), "doc_id long, print long, starts array<int>, ends array<int>")


def _cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    """Texts without their spans of units; nulls where there are none."""
    rows = []
    for text, s, e in zip(texts, starts, ends, strict=True):
        if text is None:
            rows.append((None, 0, 0))
            continue
        a, b = places(text)
        spans = list(zip(a[np.asarray(s)].tolist(), b[np.asarray(e) - 1].tolist(), strict=True))
        left = [0, *(y for _, y in spans)]
        right = [*(x for x, _ in spans), len(text)]
        rows.append(("".join(text[x:y] for x, y in zip(left, right, strict=True)), sum(y - x for x, y in spans), len(spans)))
    return pd.DataFrame(rows, columns=["text", "removed_chars", "n_spans"])


def dedupe(docs: DataFrame, least: int = LEAST, keep: list[str] | None = None) -> DataFrame:
    """doc_id (or the columns in `keep`), text without repeats, removed_chars and n_spans; one row per row of docs."""
    names = [c for c in (keep or ["doc_id"]) if c != "text"]
    spans = repeats(docs, least).select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), F.col("starts").alias("_starts"), F.col("ends").alias("_ends"))
    rows = docs.select(*(F.col(f"`{c}`") for c in names), "text", F.col("doc_id").cast("long").alias("_key"), F.xxhash64("text").alias("_own"))
    # a null id meets nothing, but rows are dealt by their texts' hashes too, so such rows don't gather in one task
    rows = rows.join(spans, (F.col("_key") == F.col("_id")) & (F.col("_own") == F.col("_print")), "left")
    hit = F.col("_starts").isNotNull()
    cut = F.pandas_udf(_cut, "text string, removed_chars long, n_spans int")
    rows = rows.withColumn("_cut", cut(F.when(hit, F.col("text")), F.col("_starts"), F.col("_ends")))

    def either(found: Column, other: Column, name: str) -> Column:
        return F.when(hit, found).otherwise(other).alias(name)

    return rows.select(*(F.col(f"`{c}`") for c in names), either(F.col("_cut.text"), F.col("text"), "text"), either(F.col("_cut.removed_chars"), F.lit(0).cast("long"), "removed_chars"), either(F.col("_cut.n_spans"), F.lit(0), "n_spans"))

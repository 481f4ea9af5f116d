"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts.

A text's words are what is left between ASCII characters other than letters and digits, A-Z in lower
case. A benchmark item gives every window of `width` consecutive words, or all its words where it has
fewer. The automaton is over words, not letters: its symbols are numbers of the benchmark's words, all
others count as one. Each document is read once; a word inside any occurrence of a window is hit, and hit
words are mapped back to positions in the original text.

The automaton holds blocks of BLOCK_BYTES of benchmark text at most; a larger benchmark is dealt over
several, which read the documents one after another, with the same result. Long items are dealt in
overlapping pieces, long documents read in overlapping pieces of the words.

Null and empty texts, of either table, have no words: nothing is hit, and nothing occurs. Rows of an item
id are its windows together; an item without id hits words, but is not listed. Repeated documents, and
those without doc_id, are read each. An empty table gives an empty result, an empty benchmark no hits.
Extra columns are ignored but for those in `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 10
#: Benchmark text in one automaton, at most: about 150 bytes of memory for each byte of it.
BLOCK_BYTES = 2 << 20
#: Words of a piece of an item, and bytes of a document that are split into words at once.
_PIECE, _CHUNK = 4096, 1 << 20
#: Every byte as what it is for words: a lower-case letter, a digit, a part of a longer character, or a blank.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SPANS = "array<struct<start: int, end: int>>"


def words(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return text.translate(_NORMAL).split()


def windows(items: DataFrame, width: int) -> DataFrame:
    """(item string, words array<binary>): pieces of items, which together have the items' windows and no others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, pieces = [], []
            for i, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
                w = words(text)
                for at in range(0, max(1, len(w) - width + 1), _PIECE):
                    if w:
                        ids.append(i)
                        pieces.append(w[at : at + _PIECE + width - 1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(pieces, pa.list_(pa.binary()))], ["item", "words"])

    return items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null").mapInArrow(run, "item string, words array<binary>")


class Automaton:
    """Finds windows in sequences of words."""

    def __init__(self, pieces: list[tuple[str | None, list[bytes]]], width: int):
        import ahocorasick

        self.number: dict[bytes, int] = {}
        self.width = width
        whose: dict[tuple[int, ...], set[str]] = {}
        for item, piece in pieces:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in piece]
            for at in range(max(1, len(ids) - width + 1)):
                own = whose.setdefault(tuple(ids[at : at + width]), set())
                if item is not None:
                    own.add(item)
        self.found = None
        if whose:
            self.found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for window, own in whose.items():
                self.found.add_word(window, (len(window), tuple(own)))
            self.found.make_automaton()

    def matches(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """How many words a text has, the merged runs of hit words (first, one after the last), and the items that occur."""
        normal = text.translate(_NORMAL)
        n, runs, items, before = 0, [], set(), ()
        start = 0
        while start < len(normal):
            end = len(normal) if len(normal) - start <= _CHUNK else normal.find(b" ", start + _CHUNK)
            end = len(normal) if end < 0 else end
            own = normal[start:end].split()
            start = end
            if self.found is not None and own:
                ids = (*before, *map(self.number.get, own, repeat(0)))
                shift = n - len(before)
                for last, (size, whose) in self.found.iter(ids):
                    first, last = shift + last + 1 - size, shift + last + 1
                    items.update(whose)
                    while runs and runs[-1][1] >= first:  # ends ascend, starts may not
                        first = min(first, runs[-1][0])
                        last = max(last, runs.pop()[1])
                    runs.append((first, last))
                before = ids[max(0, len(ids) - self.width + 1) :]
            n += len(own)
        return n, runs, items


def places(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as code points of the original text, from the first word's start to the last one's end."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.frombuffer(text.translate(_NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in runs]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(pieces: DataFrame, size: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Pieces in blocks of about `size` bytes; at least one block, which may be empty."""
    total = pieces.agg(F.sum(F.aggregate("words", F.lit(0), lambda s, w: s + F.octet_length(w) + 1))).first()[0] or 0
    n = -(-total // size) or 1
    block = F.pmod(F.xxhash64("item", "words"), F.lit(n))
    for i in range(n):
        yield [(r["item"], [bytes(w) for w in r["words"]]) for r in pieces.where(block == i).collect()]


def scan(docs: DataFrame, items: DataFrame, width: int = WIDTH, keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs' doc_id (or the columns in `keep`) with n_words, n_hit, items (sorted strings) and spans (code points of the original, end exclusive)."""
    names = keep or ["doc_id"]
    carried = {f"_k{i}": c for i, c in enumerate(names)}
    rows = docs.select(*(F.col(f"`{c}`").alias(k) for k, c in carried.items()), F.col("text").cast("binary").alias("text"))
    rows = rows.withColumns({"runs": F.lit(None).cast(_SPANS), "items": F.lit(None).cast("array<string>"), "n_words": F.lit(0).cast("long")})
    pieces = windows(items, width)
    blocks = _blocks(pieces, block_bytes)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        rows = _read(rows, block, width, following is None)
        if following is not None:  # one automaton at a time in a worker
            rows = common.materialise(rows, "scan")
        block = following
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return rows.select(*(F.col(k).alias(c) for k, c in carried.items()), "n_words", n_hit.alias("n_hit"), "items", "spans")


def _read(rows: DataFrame, block: list[tuple[str | None, list[bytes]]], width: int, last: bool) -> DataFrame:
    """rows with the runs and items of one automaton added to theirs; after the last one spans take the text's place."""
    shared = rows.sparkSession.sparkContext.broadcast(block)  # a block's size at most
    kept = [f for f in rows.schema.fields if f.name.startswith("_k")]
    pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Automaton(shared.value, width)
        for b in batches:
            n_words, runs, items, spans = [], [], [], []
            before = zip(b.column("text"), b.column("runs"), b.column("items"), strict=True)
            for text, old_runs, old_items in before:
                text = text.as_py() or b""
                n, own, whose = found.matches(text)
                if old_items.is_valid:  # of the blocks before
                    own = merged(own + [(r["start"], r["end"]) for r in old_runs.as_py()])
                    whose |= set(old_items.as_py())
                n_words.append(n)
                runs.append([{"start": x, "end": y} for x, y in own])
                items.append(sorted(whose))
                if last:
                    spans.append([{"start": x, "end": y} for x, y in places(text, own)] if own else [])
            columns = [b.column(f.name) for f in kept] + [pa.array(runs, pair), pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64())]
            columns.append(pa.array(spans, pair) if last else b.column("text"))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + ["runs", "items", "n_words", "spans" if last else "text"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + f", runs {_SPANS}, items array<string>, n_words long, " + (f"spans {_SPANS}" if last else "text binary")
    return rows.mapInArrow(run, schema)


def digest(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of scan()."""
    listed = F.array_join("items", ",").cast("binary")
    return scanned.select(F.col("doc_id").cast("long").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def oracle() -> str:
    """digest(scan(documents, benchmark)) as SQL."""
    upper = "".join(map(chr, range(65, 91)))
    cut = rf"regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH item AS (SELECT item_id, {cut} AS ws FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, len(ws[i:i + {WIDTH - 1}]) AS size, array_to_string(ws[i:i + {WIDTH - 1}], ' ') AS win
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {WIDTH - 1}, 1) + 1)) AS i FROM item WHERE len(ws) > 0)),
doc AS (SELECT doc_id, coalesce({cut}, []) AS ws FROM documents),
pos AS (SELECT doc_id, i, list(w) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WIDTH - 1} FOLLOWING) AS ws
        FROM (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM doc WHERE len(ws) > 0)),
hit AS (SELECT doc_id, i, size, item_id FROM (SELECT doc_id, i, size, array_to_string(ws[1:size], ' ') AS win FROM pos, (SELECT DISTINCT size FROM win) WHERE size <= len(ws)) JOIN win USING (size, win)),
n AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hit) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN own USING (doc_id)"""

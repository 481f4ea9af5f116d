"""Alignment of two tokenizers' tokens over the same text, by arrays of byte owners.

Every byte of a text belongs to one token of A and one of B. Arrays of these owners (np.repeat of token
numbers over bytes) give all the rest: consecutive distinct pairs of owners are the overlapping tokens
(links), bytes where both owners change are cuts between groups. How many links of the whole corpus hold a
pair of ids together says which A ids a B id usually stands for.

A is a byte-level BPE (read by tiktoken from the same vocabulary) of a blank and the text, B a
sentencepiece model, which adds the blank itself. Strings of special tokens are plain text.

Counting takes two passes. The first tokenises documents in blocks of about BLOCK_BYTES of text, and writes
each document's links as numbers of its block's distinct pairs, and those pairs with their counts. The
pairs are summed over the corpus and sent back to the blocks that hold them, where the second pass adds up
each document's links. A block holds a few per cent as many pairs as links, so no exchange carries the
links but one, of two bytes or so each.

Texts that are null or empty, or whose bytes B doesn't give back (its mark for a blank stands in the text,
say), have no tokens: zeros and an empty digest. Texts of any length are aligned whole, as a block of their
own if need be. Repeated rows, and those without doc_id, count and are returned each. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, pack

A_NAME, B_NAME = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20
#: Texts that are tokenised and compared at once.
_SLICE_BYTES = 2 << 20


class Side:
    """The tokens of one tokenizer: their bytes and lengths."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.size = np.array([len(t) for t in table], np.int64)
        # an id after another of its group, or first in its group after the other side's mark
        digits = [str(i) for i in range(len(table))]
        self.written = ["," + d for d in digits] + [";" + d for d in digits] + ["|" + d for d in digits]


class Tokenizers:
    def __init__(self, a_name: str = A_NAME, b_name: str = B_NAME):
        import public_tokenizers
        import sentencepiece

        self.of_a = pack.encoding(a_name)
        self.of_b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b_name))
        known = set(self.of_a.token_byte_values())
        ids = {self.of_a.encode_single_token(t): t for t in known}
        self.a = Side([ids.get(i, b"") for i in range(self.of_a.n_vocab)])
        self.b = Side([self._bytes(i) for i in range(self.of_b.get_piece_size())])

    def _bytes(self, i: int) -> bytes:
        piece = self.of_b.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self.of_b.is_byte(i) else None
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B for every text; none where it is empty or the bytes differ from its own."""
        a, b = [], []
        none = np.zeros(0, np.int64)
        for text, ids in zip(texts, self.of_b.encode(texts, num_threads=1), strict=True):
            whole = (" " + text).encode()
            same = bool(text) and b"".join(map(self.b.table.__getitem__, ids)) == whole
            own = self.of_a.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64) if same else none
            same = same and int(self.a.size[own].sum()) == len(whole)
            a.append(own if same else none)
            b.append(np.array(ids, np.int64) if same else none)
        return a, b


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(a_name: str, b_name: str) -> Tokenizers:
    """One pair for each worker process."""
    if (a_name, b_name) not in _loaded:
        _loaded[a_name, b_name] = Tokenizers(a_name, b_name)
    return _loaded[a_name, b_name]


@dataclass
class Aligned:
    """What owner arrays say about texts that stand one after another."""

    link_a: np.ndarray  # numbers of linked tokens
    link_b: np.ndarray
    group_a: np.ndarray  # group of each token
    group_b: np.ndarray
    groups: int


def align(size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """Links and groups from the sizes in bytes of both sides' tokens, over the same bytes."""
    kind = np.int32 if size_a.sum() < 1 << 31 else np.int64
    own_a = np.repeat(np.arange(len(size_a), dtype=kind), size_a)
    own_b = np.repeat(np.arange(len(size_b), dtype=kind), size_b)
    if not len(own_a):
        none = np.zeros(0, np.int64)
        return Aligned(none, none, none, none, 0)
    new_a, new_b = np.ones(len(own_a), bool), np.ones(len(own_b), bool)
    np.not_equal(own_a[1:], own_a[:-1], out=new_a[1:])
    np.not_equal(own_b[1:], own_b[:-1], out=new_b[1:])
    at = np.flatnonzero(new_a | new_b)
    group = np.cumsum(new_a & new_b, dtype=kind) - 1
    return Aligned(own_a[at], own_b[at], group[new_a], group[new_b], int(group[-1]) + 1)


def written(t: Tokenizers, ids_a: np.ndarray, ids_b: np.ndarray, got: Aligned) -> list[str]:
    """Every token of both sides as text with the mark before it, group by group, A's before B's."""
    first_a, first_b = np.ones(len(ids_a), bool), np.ones(len(ids_b), bool)
    np.not_equal(got.group_a[1:], got.group_a[:-1], out=first_a[1:])
    np.not_equal(got.group_b[1:], got.group_b[:-1], out=first_b[1:])
    # a token stands after all tokens of its own side before it, and the other side's of the groups before
    count_a, count_b = np.bincount(got.group_a, minlength=got.groups), np.bincount(got.group_b, minlength=got.groups)
    before_b, upto_a = np.cumsum(count_b) - count_b, np.cumsum(count_a)
    na, nb = len(t.a.table), len(t.b.table)
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[np.arange(len(ids_a)) + before_b[got.group_a]] = ids_a + na * first_a
    code[np.arange(len(ids_b)) + upto_a[got.group_b]] = 3 * na + ids_b + 2 * nb * first_b
    return list(map((t.a.written + t.b.written).__getitem__, code.tolist()))


def _block(t: Tokenizers, texts: list[str]) -> tuple[list[tuple], list[np.ndarray], list[np.ndarray]]:
    """Of every text (n_a, n_b, n_groups, digest), and the A and B ids of its links."""
    rows, link_a, link_b = [], [], []
    ids_a, ids_b = t.encode(texts)
    flat_a, flat_b = np.concatenate(ids_a), np.concatenate(ids_b)
    got = align(t.a.size[flat_a], t.b.size[flat_b])
    marks = written(t, flat_a, flat_b, got) if got.groups else []
    ends_a, ends_b = np.cumsum([len(x) for x in ids_a]), np.cumsum([len(x) for x in ids_b])
    # a text's links begin with its first token of A
    cuts = np.searchsorted(got.link_a, ends_a) if len(got.link_a) else np.zeros(len(texts), np.int64)
    of_a, of_b = flat_a[got.link_a], flat_b[got.link_b]
    at_a = at_b = at = 0
    for end_a, end_b, cut in zip(ends_a.tolist(), ends_b.tolist(), cuts.tolist(), strict=True):
        if end_a == at_a:
            rows.append((0, 0, 0, ""))
        else:
            groups = int(got.group_a[end_a - 1] - got.group_a[at_a]) + 1
            text = "".join(marks[at_a + at_b : end_a + end_b])[1:]
            rows.append((end_a - at_a, end_b - at_b, groups, hashlib.sha256(text.encode()).hexdigest()))
        link_a.append(of_a[at:cut])
        link_b.append(of_b[at:cut])
        at_a, at_b, at = end_a, end_b, cut
    return rows, link_a, link_b


def _slices(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


_FIRST = "block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, a array<int>, b array<int>, n array<int>"


def tokenised(docs: DataFrame, a_name: str = A_NAME, b_name: str = B_NAME, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Two kinds of rows. A document: its counts, its digest, and its links as little-endian 32-bit numbers of its
    block's pairs. A block (n_a is null): its distinct pairs of ids (a, b), and how many links hold each."""

    def block_rows(t: Tokenizers, ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        name = uuid.uuid4().hex  # a task that runs again names its blocks anew, and all its rows with them
        rows, pairs = [], []
        for start, end in _slices(texts, _SLICE_BYTES):
            own, link_a, link_b = _block(t, texts[start:end])
            rows += own
            pairs += [a << 32 | b for a, b in zip(link_a, link_b, strict=True)]
        distinct, times = np.unique(np.concatenate(pairs), return_counts=True)
        links = [np.searchsorted(distinct, p).astype("<u4").tobytes() for p in pairs]
        n = len(rows)
        n_a, n_b, groups, digests = zip(*rows, strict=True)
        counts = [pa.array(x, pa.int64()) for x in (ids, n_a, n_b, groups, [len(p) for p in pairs])]
        nothing = pa.nulls(n, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([name] * n), *counts, pa.array(digests), pa.array(links, pa.binary()), nothing, nothing, nothing], names=_NAMES)
        if len(distinct):
            lists = [pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (distinct >> 32, distinct & 0xFFFFFFFF, times)]
            yield pa.RecordBatch.from_arrays([pa.array([name]), *[pa.nulls(1, pa.int64())] * 5, pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), *lists], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a_name, b_name)
        ids, texts, size = [], [], 0
        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                if size and size + len(text) > block_bytes:
                    yield from block_rows(t, ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(text)
                size += len(text)
        if ids:
            yield from block_rows(t, ids, texts)
        del ids, texts
        common.trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, _FIRST)


_NAMES = [c.split()[0] for c in _FIRST.split(", ")]


def pair_counts(first: DataFrame) -> DataFrame:
    """(a, b, count, best): how many links of the corpus hold the pair, and whether no other pair of b is held by more."""
    pairs = first.where("n_a is null").select(F.explode(F.arrays_zip("a", "b", "n")).alias("p"))
    counted = pairs.select("p.a", "p.b", "p.n").groupBy("a", "b").agg(F.sum("n").alias("count"))
    # a b has as many rows here as A has ids, at most
    return counted.select("a", "b", "count", (F.col("count") == F.max("count").over(Window.partitionBy("b"))).alias("best"))


def summed(first: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    held = first.where("n_a is null").select(F.col("block").alias("own"), F.posexplode(F.arrays_zip("a", "b")).alias("at", "p"))
    held = held.select("own", "at", "p.a", "p.b").join(counts, ["a", "b"]).select("own", "at", "count", "best")
    documents = first.where("n_a is not null").drop("a", "b", "n")

    def add(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        at = pairs.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], best[at] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy()
        n_best, total = [], []
        for links in docs.column("links"):
            own = np.frombuffer(links.as_buffer(), "<u4")
            n_best.append(int(best[own].sum()))
            total.append(int(count[own].sum()))
        kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64())).append_column("groups_sha256", docs.column("groups_sha256"))

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return documents.groupBy("block").cogroup(held.groupBy("own")).applyInArrow(add, schema)


def aligned(docs: DataFrame, a_name: str = A_NAME, b_name: str = B_NAME, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: its tokens, groups and links under two tokenizers, and how common its links' pairs are."""
    first = common.materialise(tokenised(docs, a_name, b_name, block_bytes), "aligned")
    return summed(first, pair_counts(first))

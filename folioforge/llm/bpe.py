"""Exact BPE by dynamic programming over prefixes, and its inverse.

Every prefix of a pre-token has exactly one last token in its encoding. Suffix matches of the
vocabulary at each position (an Aho-Corasick automaton, longest first) propose that token; it is the
right one when the pair (last token of the shorter prefix, proposed token) survives merging
unchanged. Back-pointers then give the ids. The time is linear in the length, whatever the text.

Texts: null counts as empty; a text of any length is encoded whole; lone words of any length are
one pre-token. Special tokens of the tokenizer file are found first, as its library does by default.
Rows with a null doc_id are kept with it. Extra columns are ignored. Repeated rows are encoded each.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4
BYTE_BPE = "byte_bpe_50k.json"
#: Any white space but a blank and a newline.
_ODD = re.compile(r"[^\S \n]")


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others are numbered from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return letters


class Codec:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, path: str, most_cached: int = 200_000):
        import ahocorasick
        import regex

        spec = json.load(open(path, encoding="utf-8"))
        letters, model = byte_letters(), spec["model"]
        raw = {t: bytes(letters[c] for c in t) for t in model["vocab"]}
        self.bytes_of: dict[int, bytes] = {i: raw[t] for t, i in model["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(public_tokenizers.PATTERN)
        # rank of the merge that makes a token, and its two halves; single bytes have none
        ids = model["vocab"]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            if (t := ids.get(a + b)) is not None:
                self.merge[ids[a], ids[b]] = (r, t)
                if t not in self.halves:
                    self.halves[t], self.rank[t] = (ids[a], ids[b]), r
        self.single = {raw[t][0]: i for t, i in ids.items() if len(raw[t]) == 1}
        self.automaton = ahocorasick.Automaton()
        for t, i in ids.items():
            if len(raw[t]) == 1 or i in self.halves:
                self.automaton.add_word(raw[t].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        self.pairs: dict[int, bool] = {}
        self.of_word: dict[str, bytes] = {}
        self.of_part: dict[str, bytes] = {}
        self.most = most_cached
        self.table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two; answers are kept."""
        if len(self.pairs) > 500_000:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self._compatible(left, right)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        # Undoes the merges of both from the latest to the earliest: at each moment the tokens that touch
        # across the border must not have been mergeable before the merge that was undone.
        # `until`: the pair (a, b) touches until the merge of this rank takes one of them away
        until, by_left = float("inf"), False
        while True:
            made = self.merge.get((a, b))
            # on equal ranks the leftmost merge goes first
            if made is not None and (made[0] < until or made[0] == until and not by_left):
                return False
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:  # the left token was made later: before that, its right half touched b (of equals, the left is made first)
                a, until, by_left = self.halves[a][1], ra, True
            else:
                b, until, by_left = self.halves[b][0], rb, False

    def word_ids(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        n = len(word)
        if n == 1:
            return [self.single[word[0]]]
        last = [-1] * (n + 1)
        length, known, compatible = self.length, self.pairs.get, self.compatible
        for end, token in self.automaton.iter(word.decode("latin-1")):
            end += 1
            if last[end] < 0:
                start = end - length[token]
                if not start:
                    last[end] = token
                else:
                    before = last[start]
                    ok = known(before << 32 | token)
                    if compatible(before, token) if ok is None else ok:
                        last[end] = token
        out, at = [], n
        while at:
            token = last[at]
            out.append(token)
            at -= length[token]
        out.reverse()
        return out

    def pack(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if _NATIVE else np.asarray(ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        found = self.of_word.get(word)
        if found is None:
            found = self.pack(self.word_ids(word.encode()))
            if len(word) < 200:
                if len(self.of_word) >= self.most:
                    self.of_word.clear()
                self.of_word[word] = found
        return found

    def _part(self, part: str) -> bytes:
        """Ids of a piece between blanks, as bytes; a piece that begins with a newline has no blank before it."""
        out = b"".join(map(self._word, self.words.findall(part if part.startswith("\n") else " " + part)))
        if len(part) < 200:
            if len(self.of_part) >= self.most:
                self.of_part.clear()
            self.of_part[part] = out
        return out

    def _plain(self, text: str) -> bytes:
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[-1:] in (" ", "\n") or _ODD.search(text):
            return b"".join(map(self._word, self.words.findall(text)))
        # single blanks and newlines between words: pre-tokens never reach over them
        first, *rest = text.replace("\n", " \n").split(" ")
        get, part = self.of_part.get, self._part
        return b"".join([*map(self._word, self.words.findall(first)), *(get(p) or part(p) for p in rest)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.split_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(self.pack([self.special[p]]) if p in self.special else self._plain(p) for p in self.split_special.split(text) if p)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(name: str) -> Codec:
    """One codec for each worker process and file."""
    if name not in _codecs:
        _codecs[name] = Codec(public_tokenizers.path(name))
    return _codecs[name]


def encode(docs: DataFrame, name: str = BYTE_BPE) -> DataFrame:
    """(doc_id, n_tokens, ids binary): little-endian unsigned 32-bit ids of every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(name)
        for b in batches:
            ids = [c.encode(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [len(x) // 4 for x in ids], "ids": ids})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, name: str = BYTE_BPE) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(name)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [c.decode(x) for x in b["ids"]]})

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInPandas(run, "doc_id long, text string")


def round_trip(docs: DataFrame, name: str = BYTE_BPE) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes in one pass, moving digests only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(name)
        for b in batches:
            rows = []
            for t in b["text"]:
                ids = c.encode(t)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(ids).encode()).hexdigest()))
            n, i, d = zip(*rows, strict=True) if rows else ((), (), ())
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": list(n), "ids_sha256": list(i), "decoded_sha256": list(d)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

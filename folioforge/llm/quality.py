"""Quality: hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates.

A text becomes the frequencies of its tokens and token pairs, hashed into 2^20 buckets; a score is
a sparse dot product. Tokens are words (lower-case, or as they are if all capitals) and runs of
punctuation.

Texts: null and empty texts have no n-grams and score by the bias alone. Texts of any length are
read whole. Labels as in toxicity: nulls are skipped, repeated labels count once. With no labels of
both kinds the score is the share of label 1. An empty table gives an empty result. Extra columns are
ignored; repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, toxicity

#: Labelled documents that the model is fitted on, at most, of each label.
SAMPLE = {0: 2000, 1: 3000}
BITS = 20
THRESHOLD = 0.3
_TOKEN = re.compile(r"\w+|[^\w\s]+")
#: The n-gram that every pair of equal tokens counts as, besides its own.
_SAME = np.uint64(0x5A3E5A3E5A3E5A3E)


class Tokens(dict):
    """A white-space-free piece -> hashes of its tokens; bounded as WordHashes."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most, self.hashes = most, common.WordHashes(most)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        out = []
        for t in _TOKEN.findall(piece):
            shout = len(t) > 1 and t.isupper()
            out.append(self.hashes[(t if shout else t.lower()).encode()])
            if shout:
                out.append(self.hashes[b"<capitals>"])
        self[piece] = tuple(out)
        return self[piece]


def features(texts: list[str], tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts, and how many each text has."""
    own = [list(chain.from_iterable(map(tokens.__getitem__, t.split()))) for t in texts]
    n = np.array([len(x) for x in own], np.int64)
    h = np.fromiter(chain.from_iterable(own), np.uint64, int(n.sum()))
    pairs = common.mix64(common.mix64(h[:-1]) ^ h[1:]) if len(h) > 1 else np.zeros(0, np.uint64)
    ends = np.cumsum(n)
    inside = np.ones(len(pairs), bool)
    inside[ends[(ends > 0) & (ends < len(h))] - 1] = False
    owner = np.repeat(np.arange(len(texts)), n)
    same = inside & (h[:-1] == h[1:]) if len(h) > 1 else inside
    grams = np.concatenate([common.mix64(h), pairs[inside], np.full(same.sum(), _SAME)])
    whose = np.concatenate([owner, owner[:-1][inside], owner[:-1][same]]) if len(h) > 1 else owner
    order = np.argsort(whose, kind="stable")
    return (grams[order] >> np.uint64(64 - BITS)).astype(np.int64), np.bincount(whose, minlength=len(texts))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    scale: float

    def logits(self, texts: list[str], tokens: Tokens) -> np.ndarray:
        f, n = features(texts, tokens)
        w = np.concatenate([[0.0], np.cumsum(self.weights[f].astype(np.float64))])
        ends = np.cumsum(n)
        return self.bias + self.scale * (w[ends] - w[ends - n]) / np.maximum(n, 1)


def fit(rows: list[tuple[str, int]], epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3, scale: float = 30.0, seed: int = 5) -> Model:
    share = float(np.mean([y for _, y in rows])) if rows else 0.0
    prior = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    if share in (0.0, 1.0):
        return Model(np.zeros(1 << BITS, np.float32), prior, scale)
    tokens = Tokens()
    examples = []
    for text, y in rows:
        f, _ = features([text], tokens)
        i, c = np.unique(f, return_counts=True)
        examples.append((i, scale * c / max(len(f), 1), y))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb, nb, b = 0.0, 1.0, prior
    rng = np.random.default_rng(seed)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            i, x, y = examples[k]
            w = weights(z[i], n[i])
            p = 1 / (1 + np.exp(-np.clip(w @ x + b, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
            nb += (p - y) ** 2
            b -= 0.1 * (p - y) / np.sqrt(nb)
    out = weights(z, n).astype(np.float32)
    del examples, tokens, z, n
    common.trim()
    return Model(out, float(b), scale)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """docs' doc_id (or the columns in `keep`) with score, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^20 floats: 4 MB, whatever the corpus

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, tokens = shared.value, Tokens()
        for b in batches:
            texts = b["_text"].tolist()
            logits = np.concatenate([np.zeros(0), *(m.logits(texts[k : k + 500], tokens) for k in range(0, len(texts), 500))])
            yield b.drop(columns="_text").assign(score=1 / (1 + np.exp(-np.clip(logits, -500, 500))))
        del tokens
        common.trim()

    names = keep or ["doc_id"]
    rows = docs.select(*names, F.coalesce("text", F.lit("")).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema) + ", score double"
    return rows.mapInPandas(run, schema)


def quality(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, held_out: tuple[int, int] | None = (5, 0)) -> DataFrame:
    """Fits on the labelled rows that aren't held out and scores every row of docs."""
    return score(docs, fit(toxicity.sample(docs, labels, "quality", SAMPLE, held_out)), keep)

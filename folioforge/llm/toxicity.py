"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is its whole form and its character n-grams, hashed into a table of embeddings; a document is
the mean of its words' means. Misspelt and unseen words share n-grams with known ones. At scoring
time the softmax's weights are folded into the table, so a word costs one number.

Texts: null and empty texts have no words and score by the bias alone. Texts of any length are read
whole; a piece without blanks that is longer than a word counts as overlapping windows, each a word,
so text in scripts without blanks, or glued together, has all its n-grams. Labels that are null, and
rows with a null doc_id, are not learnt from; of repeated labels of a document the largest counts. With
no labels of both kinds the score is the share of label 1, or 0. An empty table gives an empty result.
Extra columns are ignored; repeated rows are scored each.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Labelled documents that the model is fitted on, at most, of each label, and the bytes of their texts.
SAMPLE, SAMPLE_BYTES = {1: 1500, 0: 3000}, 32 << 20
#: A labelled text of more bytes isn't learnt from, so none takes the others' place; every text is scored whole.
LONGEST = 1 << 20
BUCKETS, DIM, GRAMS = 1 << 17, 8, (3, 4, 5)
THRESHOLD = 0.3
#: Most n-grams say nothing: so many times their median weight is noise, and taken off.
QUIET = 4.0
_EDGE = string.punctuation + "«»„“”‘’…–—¿¡"
_STEP = np.uint64(0x100000001B3)


#: Characters of a piece that is read as one word, and of the windows of a longer one; they overlap by what the longest n-gram needs.
_PIECE, _WINDOW = 62, 32


def split_words(text: str) -> list[str]:
    """White-space-free pieces of a text, long ones as windows."""
    pieces = text.split()
    if max(map(len, pieces), default=0) <= _PIECE:
        return pieces
    step = _WINDOW - max(GRAMS) + 1
    return [w for p in pieces for w in ([p] if len(p) <= _PIECE else [p[i : i + _WINDOW] for i in range(0, len(p) - max(GRAMS) + 1, step)])]


def subwords(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of white-space-free pieces, one piece after another, and how many each has.

    A piece's features are its lower-case form without edge punctuation, between marks, and the
    character n-grams of that; a piece of punctuation alone has none. All are hashed at once."""
    forms = [p.lower().strip(_EDGE) for p in pieces]
    marked = [f"<{f}>" if f else "" for f in forms]
    size = np.array([len(m) for m in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), size)
    end = np.cumsum(size)[owner] if len(owner) else owner
    held = np.flatnonzero(size)
    whole = np.fromiter((crc32(marked[i].encode()) for i in held), np.uint64, len(held))
    buckets, owners = [common.mix64(whole)], [held]
    h = codes * _STEP
    for n in range(2, max(GRAMS) + 1):
        if len(h) < 2:
            break
        h = (h[:-1] ^ codes[n - 1 :]) * _STEP
        if n in GRAMS:
            at = np.arange(len(h))
            ok = (at + n <= end[: len(h)]) & (size[owner[: len(h)]] > n)
            buckets.append(common.mix64(h[ok] + np.uint64(n)))
            owners.append(owner[: len(h)][ok])
    whose = np.concatenate(owners)
    order = np.argsort(whose, kind="stable")
    return (np.concatenate(buckets)[order] & np.uint64(BUCKETS - 1)).astype(np.int64), np.bincount(whose, minlength=len(pieces))


def sample(docs: DataFrame, labels: DataFrame, label: str, sizes: dict[int, int], seen: tuple[int, int] | None) -> list[tuple[str, int]]:
    """Texts and labels to learn from: at most `sizes` of each label and SAMPLE_BYTES of text in all, none of over LONGEST, by a hash of doc_id over all labelled rows.

    `seen` = (m, r): rows whose crc32(doc_id as text) mod m is r are held out."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y is not null")
    if seen:
        own = own.where(common.crc_mod("doc_id", seen[0]) != seen[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("doc_id", F.lit(7)))
    texts = texts.where(F.octet_length("text") <= LONGEST)
    # ids of the chosen rows: a top-k by hash, bounded by `sizes`; twice as many, as some may have no text here
    chosen = [own.where(F.col("y") == y).orderBy("h", "doc_id").limit(2 * n) for y, n in sizes.items()]
    ids = chosen[0].unionByName(chosen[1])
    rows = texts.join(F.broadcast(ids), "doc_id").withColumn("t", F.xxhash64("text"))
    rows = rows.groupBy("doc_id").agg(F.first("y").alias("y"), F.first("h").alias("h"), F.min("text").alias("text"))
    # running numbers over the few chosen rows; each label gets a share of the bytes, and a text that ends beyond it isn't learnt from
    own = Window.partitionBy("y").orderBy("h", "doc_id")
    rows = rows.withColumn("n", F.row_number().over(own)).withColumn("bytes", F.sum(F.octet_length("text")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    total = sum(sizes.values())
    fits = F.lit(False)
    for y, n in sizes.items():
        fits |= (F.col("y") == y) & (F.col("n") <= n) & (F.col("bytes") <= SAMPLE_BYTES * n // total)
    return [(r["text"], r["y"]) for r in rows.where(fits).orderBy(F.desc("y"), "h", "doc_id").select("text", "y").collect()]


def weight(times: np.ndarray) -> np.ndarray:
    """How much a word counts in a document's mean by how often it stands there: one endlessly repeated word must not decide."""
    return 1 + np.log(times)


@dataclass
class Model:
    weights: np.ndarray  # BUCKETS: what each bucket adds to the logit of label 1
    bias: float

    def words(self, pieces: list[str]) -> list[float]:
        """What each piece adds on average; not a number where it has no features."""
        flat, size = subwords(pieces)
        whose = np.repeat(np.arange(len(pieces)), size)
        with np.errstate(invalid="ignore", divide="ignore"):
            return (np.bincount(whose, self.weights[flat], len(pieces)) / size).tolist()


def fit(rows: list[tuple[str, int]], epochs: int = 4, rate: float = 0.5, scale: float = 50.0, least: int = 10, seed: int = 3, prevalence: float | None = None) -> Model:
    """Adagrad on the embeddings and the softmax together, in mini-batches of documents.

    Buckets that fewer than `least` of the documents hold stay zero: they would learn single documents by heart;
    those that few hold are shrunk at the end."""
    share = float(np.mean([y for _, y in rows])) if rows else 0.0
    if not rows or share in (0.0, 1.0):
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    rng = np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    documents = []
    for text, _ in rows:
        c = Counter(split_words(text))
        ids = np.fromiter((vocabulary.setdefault(p, len(vocabulary)) for p in c), np.int32, len(c))
        documents.append((ids, np.fromiter(c.values(), np.float32, len(c))))
    pieces = list(vocabulary)
    del vocabulary
    parts = []
    for i in range(0, len(pieces), 20_000):
        f, n = subwords(pieces[i : i + 20_000])
        parts.append((f.astype(np.int32), n))
    del pieces
    flat = np.concatenate([np.zeros(0, np.int32), *(p[0] for p in parts)])
    size = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])
    del parts
    start = np.cumsum(size) - size
    documents = [(w[size[w] > 0], weight(t[size[w] > 0])) for w, t in documents]
    y = np.array([y for _, y in rows])
    held = np.zeros(BUCKETS, np.int64)
    for w, _ in documents:
        held[np.unique(flat[common.ragged(start[w], size[w])])] += 1
    use = held >= least
    table = rng.normal(0, 0.01, (BUCKETS, DIM)).astype(np.float32)
    table[~use] = 0
    soft = rng.normal(0, 1.0, (DIM, 2)).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    g_table, g_soft, g_bias = np.full(BUCKETS, 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    filled = [i for i, (w, _) in enumerate(documents) if len(w)]
    for _ in range(epochs):
        order = rng.permutation(filled)
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            words = np.concatenate([documents[i][0] for i in batch])
            counts = [documents[i][1] for i in batch]
            share_of = np.concatenate([c / c.sum() for c in counts])
            owner = np.repeat(np.arange(len(batch)), [len(c) for c in counts])
            # one entry per word of the batch: a word's mean once, however many documents hold it
            distinct, back = np.unique(words, return_inverse=True)
            entries = flat[common.ragged(start[distinct], size[distinct])]
            edges = np.cumsum(size[distinct]) - size[distinct]
            means = np.add.reduceat(table[entries], edges, axis=0) / size[distinct][:, None]
            doc = np.zeros((len(batch), DIM), np.float32)
            np.add.at(doc, owner, means[back] * (scale * share_of)[:, None])
            logit = doc @ soft + bias
            logit -= logit.max(axis=1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(axis=1, keepdims=True)
            delta = p
            delta[np.arange(len(batch)), y[batch]] -= 1
            delta /= len(batch)
            d_doc = delta @ soft.T
            d_soft, d_bias = doc.T @ delta, delta.sum(axis=0)
            d_mean = np.zeros((len(distinct), DIM), np.float32)
            np.add.at(d_mean, back, d_doc[owner] * (scale * share_of)[:, None])
            d_entry = np.repeat(d_mean / size[distinct][:, None], size[distinct], axis=0)
            kept = use[entries]
            touched, where = np.unique(entries[kept], return_inverse=True)
            d_entry = d_entry[kept]
            d_table = np.stack([np.bincount(where, d_entry[:, k], len(touched)) for k in range(DIM)], axis=1).astype(np.float32)
            g_table[touched] += (d_table**2).mean(axis=1)
            table[touched] -= rate * d_table / np.sqrt(g_table[touched])[:, None]
            g_soft += d_soft**2
            soft -= rate * d_soft / np.sqrt(g_soft)
            g_bias += d_bias**2
            bias -= 0.1 * rate * d_bias / np.sqrt(g_bias)
    shrunk = held / (held + 5.0 * least)
    folded = shrunk * scale * (table @ (soft[:, 1] - soft[:, 0]))
    noise = QUIET * np.median(np.abs(folded[use])) if use.any() else 0.0
    folded = np.sign(folded) * np.maximum(np.abs(folded) - noise, 0)
    # sums over the words of the sample, then a logistic curve through them, as the sample isn't as mixed as the labels
    word = np.zeros(len(size))
    for i in range(0, len(size), 20_000):
        n = size[i : i + 20_000]
        own = np.repeat(np.arange(len(n)), n)
        word[i : i + 20_000] = np.bincount(own, folded[flat[start[i] : start[i] + n.sum()]], len(n)) / np.maximum(n, 1)
    z = np.array([(word[w] * t).sum() / t.sum() if len(w) else 0.0 for w, t in documents])
    known = share if prevalence is None else min(max(prevalence, 1e-4), 1 - 1e-4)
    slope, offset = curve(z, y, np.where(y == 1, known / share, (1 - known) / (1 - share)))
    del documents, flat, start, size, table
    common.trim()
    return Model((slope * folded).astype(np.float32), offset)


def curve(z: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the weighted logistic regression of y on z, by Newton's method."""
    unit = max(float(z.std()), 1e-9)
    x = np.stack([z / unit, np.ones(len(z))], axis=1)
    share = float((w * y).sum() / w.sum())
    theta = np.array([1.0, np.log(share / (1 - share))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        g = x.T @ (w * (p - y)) + ridge * len(z) * np.array([theta[0], 0.0])
        h = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * len(z) * np.eye(2)
        step = np.linalg.solve(h, g)
        theta -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(theta[0] / unit), float(theta[1])


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """docs' doc_id (and the columns in `keep`, else doc_id alone) with score, the probability of label 1."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS floats: 0.5 MB, whatever the corpus

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        known: dict[str, float] = {}
        for b in batches:
            logits = []
            for at in range(0, len(b), 250):
                texts = [Counter(split_words(t)) for t in b["_text"].iloc[at : at + 250]]
                if len(known) > 300_000:
                    known.clear()
                new = list({p for c in texts for p in c if p not in known})
                fresh = dict(zip(new, m.words(new), strict=True)) if new else {}
                known.update(fresh)
                for c in texts:
                    total, n = 0.0, 0.0
                    for piece, times in c.items():
                        v = known[piece]
                        if v == v:
                            k = 1.0 if times == 1 else 1.0 + log(times)
                            total += k * v
                            n += k
                    logits.append(m.bias + (total / n if n else 0.0))
                for p in [p for p in new if len(p) > 200]:
                    del known[p]
            yield b.drop(columns="_text").assign(score=1 / (1 + np.exp(-np.clip(np.array(logits, float), -500, 500))))
        known.clear()
        common.trim()

    names = keep or ["doc_id"]
    rows = docs.select(*names, F.coalesce("text", F.lit("")).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema) + ", score double"
    return rows.mapInPandas(run, schema)


def prevalence(labels: DataFrame, label: str, seen: tuple[int, int] | None) -> float | None:
    """Share of label 1 among all labelled rows to learn from."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if seen:
        own = own.where(common.crc_mod(F.col("doc_id").cast("long"), seen[0]) != seen[1])
    return own.agg(F.avg(F.col(label).cast("double"))).first()[0]


def toxicity(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, held_out: tuple[int, int] | None = (4, 2)) -> DataFrame:
    """Fits on the labelled rows that aren't held out and scores every row of docs."""
    model = fit(sample(docs, labels, "toxic", SAMPLE, held_out), prevalence=prevalence(labels, "toxic", held_out))
    return score(docs, model, keep)

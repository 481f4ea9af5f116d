"""Packing of token ids into sequences as a cutting-stock problem.

Every document is cut into full pieces and one rest. The histogram of piece lengths (at most
`width` numbers, whatever the corpus) is the demand of a linear program over patterns; a knapsack
dynamic program prices new patterns; the rounded patterns are dealt to the pieces by their rank
within their length. A sequence whose fill is a power of two needs no padding, so it costs its fill;
any other costs `width`.

Ids are those of the tokenizers library for the vocabulary file, computed by tiktoken from the same
vocabulary as ranks: a sixth of the time, and tests hold the two equal.

Texts: null counts as empty; an empty text is the end id alone. Texts of any length are cut, never
dropped. Rows are packed one by one, so repeated rows and null doc_ids are packed too. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import logging
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

log = logging.getLogger(__name__)
END_ID = 0
WIDTH = 1024
SPECIAL = {"<|endoftext|>": 50256}
_encodings: dict[str, object] = {}


def encoding(name: str):
    """tiktoken's reading of a byte-level vocabulary: the same ids as the tokenizers file of that name."""
    if name not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(name.replace(".json", ".tiktoken")), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _encodings[name]


def pieces(docs: DataFrame, name: str, width: int = WIDTH, buckets: int = 64) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and a bucket that spreads equal lengths."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, special = encoding(name), set(SPECIAL)
        for b in batches:
            doc, start, length, crc, total = [], [], [], [], []
            for d, text in zip(b["doc_id"], b["text"], strict=True):
                ids = enc.encode_to_numpy(text, allowed_special=special).astype("<u4").tobytes() + END_ID.to_bytes(4, "little")
                n = len(ids) // 4
                for s in range(0, n, width):
                    piece = ids[4 * s : 4 * (s + width)]
                    doc.append(d)
                    start.append(s)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            yield pd.DataFrame({"doc_id": pd.array(doc, dtype=b["doc_id"].dtype), "start": start, "length": length, "ids_crc32": crc, "doc_tokens": total})
        common.trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cut = rows.mapInPandas(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    return cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))


def cost(fill: np.ndarray, width: int) -> np.ndarray:
    """Padded size of a sequence by its fill."""
    return np.where((fill & (fill - 1)) == 0, fill, width)


def price(values: np.ndarray, width: int) -> tuple[float, Counter]:
    """The pattern with most value over cost: an unbounded knapsack, filled exactly to every size."""
    best, take = np.full(width + 1, -np.inf), np.zeros(width + 1, np.int64)
    best[0] = 0.0
    for c in range(1, width + 1):
        options = best[c - 1 :: -1][:c] + values[1 : c + 1]
        take[c] = k = int(options.argmax()) + 1
        best[c] = options[k - 1]
    gain = best[1:] - cost(np.arange(1, width + 1), width)
    c = int(gain.argmax()) + 1
    top, found = float(gain[c - 1]), Counter()
    while c:
        found[int(take[c])] += 1
        c -= int(take[c])
    return top, found


def first_basis(lengths: np.ndarray, demand: np.ndarray, width: int) -> tuple[list[Counter], np.ndarray]:
    """A feasible basis, one column per length: first-fit decreasing in fractions.

    Each step uses its pattern until one of its lengths has run out, and that length gets the
    column; later patterns lack it, so the matrix is triangular in the order of the steps."""
    left = {int(n): float(demand[n]) for n in lengths}
    columns: dict[int, Counter] = {}
    uses: dict[int, float] = {}
    order = sorted(left, reverse=True)
    while order:
        room, pattern = width, Counter()
        for n in order:
            if n <= room:
                pattern[n] = min(room // n, max(1, int(left[n])))
                room -= n * pattern[n]
                if not room:
                    break
        times = min(left[n] / k for n, k in pattern.items())
        out = next(n for n, k in pattern.items() if left[n] / k <= times)
        columns[out], uses[out] = pattern, times
        for n, k in pattern.items():
            left[n] = max(0.0, left[n] - k * times)
        order.remove(out)
    return [columns[int(n)] for n in lengths], np.array([uses[int(n)] for n in lengths])


def inverse_of(columns: list[Counter], lengths: np.ndarray) -> np.ndarray:
    """The inverse of first_basis()'s matrix (a row a length, a column a pattern), by substitution.

    A pattern's own length is one that later steps' patterns lack; so, taken in the order of the steps, a length
    is in its own column and in columns before it, and each row of the inverse follows from rows after it.
    Plain array arithmetic: a driver whose session runs must not depend on a threaded linear algebra library."""
    at = {int(n): i for i, n in enumerate(lengths)}
    users: dict[int, list[tuple[int, int]]] = {i: [] for i in at.values()}
    for j, pattern in enumerate(columns):
        for n, k in pattern.items():
            if at[n] != j:
                users[at[n]].append((j, k))
    out = np.zeros((len(lengths), len(lengths)))
    done = np.zeros(len(lengths), bool)
    ready = [i for i in users if not users[i]]
    waiting = {i: len(u) for i, u in users.items()}
    while ready:  # row i: (unit i - sum of k x row j over other patterns j that hold length i) / own count
        i = ready.pop()
        row = np.zeros(len(lengths))
        row[i] = 1.0
        for j, k in users[i]:
            row -= k * out[j]
        out[i] = row / columns[i][int(lengths[i])]
        done[i] = True
        for n in columns[i]:
            if at[n] != i:
                waiting[at[n]] -= 1
                if not waiting[at[n]]:
                    ready.append(at[n])
    if not done.all():
        raise ValueError("the basis isn't triangular")
    return out


@dataclass
class Report:
    """How plan() ended: the linear program's padding and that of the rounded patterns, as shares of all tokens but full pieces', and why column generation stopped."""

    rounds: int = 0
    stopped: str = "nothing to pack"
    relaxed: float = 0.0
    padding: float = 0.0


def plan(demand: np.ndarray, width: int = WIDTH, gap: float = 5e-4, most_rounds: int = 800, report: Report | None = None) -> list[tuple[Counter, int]]:
    """Patterns and how often to use each, covering demand[length] pieces of every length exactly.

    Column generation: a revised simplex over the lengths in demand, until the padding of the
    linear program is under `gap` of all tokens, no pattern improves it, or `most_rounds` patterns
    have been tried, which `report` tells; whichever it is, the patterns cover the demand. Then rounding
    down, and the rest (bounded by the patterns, not by the corpus) by best fit."""
    report = Report() if report is None else report
    lengths = np.flatnonzero(demand[: width + 1])
    lengths = lengths[lengths > 0]
    out: list[tuple[Counter, int]] = []
    left = demand.astype(np.int64).copy()
    if demand[width:].any():  # full pieces are sequences already
        out.append((Counter({width: 1}), int(demand[width])))
        left[width] = 0
        lengths = lengths[lengths < width]
    m, tokens = len(lengths), float((lengths * demand[lengths]).sum())
    if m:
        at = {int(n): i for i, n in enumerate(lengths)}
        columns, x = first_basis(lengths, demand, width)
        costs = np.array([cost(np.array([sum(n * k for n, k in c.items())]), width)[0] for c in columns], float)
        inverse = inverse_of(columns, lengths)
        values = np.full(width + 1, -np.inf)
        report.stopped = "rounds"
        for report.rounds in range(most_rounds):
            y = np.einsum("i,ij->j", costs, inverse)
            if float((costs * x).sum()) - tokens <= gap * tokens:
                report.stopped = "gap"
                break
            values[lengths] = y
            gain, pattern = price(values, width)
            if gain < 1e-7:
                report.stopped = "optimum"
                break
            d = sum(k * inverse[:, at[n]] for n, k in pattern.items())
            ok = d > 1e-9
            if not ok.any():
                report.stopped = "optimum"
                break
            ratio = np.where(ok, x / np.where(ok, d, 1.0), np.inf)
            r = int(ratio.argmin())
            step = ratio[r]
            x = np.maximum(x - step * d, 0)
            x[r] = step
            row = inverse[r] / d[r]
            inverse -= np.outer(d, row)
            inverse[r] = row
            columns[r] = pattern
            costs[r] = cost(np.array([sum(n * k for n, k in pattern.items())]), width)[0]
        report.relaxed = (float((costs * x).sum()) - tokens) / tokens
        whole = np.floor(x + 1e-6)
        uses = Counter()
        for extra in (False, True):  # rounded down, then up where the fraction is large and pieces are left
            for j in np.argsort(whole - x):
                pattern = columns[j]
                times = min([int(x[j] - whole[j] > 0.5) if extra else int(whole[j]), *(int(left[n]) // k for n, k in pattern.items())])
                if times > 0:
                    uses[int(j)] += times
                    for n, k in pattern.items():
                        left[n] -= k * times
        out += [(columns[j], t) for j, t in uses.items()]
    while left.any():  # best fit: the longest piece first, then the longest that still fits
        room, pattern = width, Counter()
        while room and (fits := np.flatnonzero(left[: room + 1])).size:
            n = int(fits[-1])
            k = int(min(left[n], room // n))
            pattern[n] += k
            left[n] -= k
            room -= n * k
        times = 1
        if pattern:
            more = min(int(left[n]) // k for n, k in pattern.items())
            for n, k in pattern.items():
                left[n] -= k * more
            times += more
        out.append((pattern, times))
    if m:
        used = sum(t * int(cost(np.array([sum(n * k for n, k in p.items())]), width)[0]) for p, t in out)
        report.padding = (used - int((np.arange(len(demand)) * demand).sum())) / tokens
    log.info("packing: %s", report)
    return out


def slots(patterns: list[tuple[Counter, int]], width: int) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, pieces a sequence, first sequence, offset), ordered by rank."""
    used, found, sequence = Counter(), {}, 0
    for pattern, times in patterns:
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            found.setdefault(n, []).append((used[n], k, sequence, offset))
            used[n] += k * times
            offset += n * k
        sequence += times
    return {n: np.array(v, np.int64) for n, v in found.items()}


def pack(docs: DataFrame, name: str = "byte_bpe_50k.json", width: int = WIDTH, gap: float = 5e-4) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece."""
    buckets = min(4096, common.shards(docs, 4 << 20))
    cut = common.materialise(pieces(docs, name, width, buckets), "pieces")
    # at most width x buckets numbers, 34 MB, which also travel to the workers
    counts = np.zeros((width + 1, buckets), np.int64)
    for r in cut.groupBy("length", "bucket").count().toLocalIterator():
        counts[r["length"], r["bucket"]] = r["count"]
    before = np.cumsum(counts, axis=1) - counts
    where = slots(plan(counts.sum(axis=1), width, gap), width)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = b["length"].to_numpy()
            rank = b["rank"].to_numpy() + before[n, b["bucket"].to_numpy()]
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for length in np.unique(n):
                own, rows = where[int(length)], np.flatnonzero(n == length)
                hit = own[np.searchsorted(own[:, 0], rank[rows], side="right") - 1]
                nth = rank[rows] - hit[:, 0]
                sequence[rows] = hit[:, 2] + nth // hit[:, 1]
                offset[rows] = hit[:, 3] + nth % hit[:, 1] * length
            yield b.drop(columns=["rank", "bucket"]).assign(sequence_id=sequence, offset=offset)

    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(own).cast("long") - 1)
    return ranked.mapInPandas(deal, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

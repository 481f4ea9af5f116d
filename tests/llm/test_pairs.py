"""Hard negatives, decontamination and alignment, against SQL, brute force and odd rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from folioforge.llm import align, bpe, decontam, negatives

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(rows):
    return sorted(tuple(r) for r in rows)


# hard negatives


def brute_negatives(rows):
    own = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            own[i, (label + 1) % 10 if i % 7 == 0 else label, tuple(v)] = np.floor(256 * np.array(v, np.float64))
    out = []
    for (i, label, v), q in own.items():
        if i % 100:
            continue
        scored = sorted((-int(q @ p), j, other) for (j, other, w), p in own.items() if j != i and len(w) == len(v))
        for top, j, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 80 * -top <= 100 * -s[0] <= 100 * -top][:5]
            out += [(i, j, n + 1, k, -top, -s) for n, (s, k, _) in enumerate(fits)]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors_of():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, int(rng.integers(0, 3)), (centres[i % 6] + 0.3 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(900)]
    rows += [(1000 + i, i % 3, centres[0].astype(np.float32).tolist()) for i in range(400)]  # a hot vector, of tied scores
    rows += [(1400, 1, None), (1500, None, [1.0] * 8), (None, 1, [1.0] * 8), (1600, 1, [1.0, None] * 4), (1700, 1, [float("nan")] * 8), (1800, 1, [float("inf")] * 8)]
    rows += [(1900, 1, [0.0] * 8), (2000, 2, [1.0, 2.0]), (2001, 2, [1.0, 2.5]), (2002, 1, [1.0, 1.9]), (2100, 1, [])]
    return rows + rows[:5] + [(5, 1, centres[1].astype(np.float32).tolist())]


@pytest.mark.parametrize("cell,group", [(8192, 4096), (60, 3)])
def test_negatives(spark, monkeypatch, vectors_of, cell, group):
    monkeypatch.setattr(negatives, "CELL", cell)
    monkeypatch.setattr(negatives, "GROUP", group)
    df = spark.createDataFrame([(*r, "x", 1) for r in vectors_of], "vec_id long, label int, embedding array<float>, score string, cell int")
    found = negatives.mine(negatives.shifted(df), F.col("vec_id") % 100 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert plain(found.collect()) == brute_negatives(vectors_of)


def test_negatives_empty(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.mine(df, F.col("vec_id") % 100 == 0).collect() == []
    one = spark.createDataFrame([(0, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert negatives.mine(one, F.col("vec_id") % 100 == 0).collect() == []


def test_negatives_prune(monkeypatch):
    """Whole groups of anchors meet a small share of tight clusters' rows; all results are those of the full product."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16)) * 100
    q = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 16)))
    frame = pd.DataFrame({"vec_id": np.arange(4000), "label": np.arange(4000) % 2, "v": list(q), "akey": np.arange(4000)})
    anchors = frame.iloc[::20].assign(least=[np.array([-np.inf])] * 200)
    scored = []
    add = negatives.Best.add
    monkeypatch.setattr(negatives.Best, "add", lambda self, rows, scores, ids: (scored.append(scores.size), add(self, rows, scores, ids))[1])
    got = negatives.Task(5, False).search(anchors, frame)
    assert sum(scored) < 0.5 * 200 * 4000
    for a, own in got.groupby("anchor_id"):
        rows = frame[(frame.label == a % 2) & (frame.vec_id != a)]
        s = np.stack(rows["v"]) @ q[a]
        best = sorted(zip(-s, rows["vec_id"], strict=True))[:5]
        assert list(zip(-own["score"], own["id"], strict=True)) == best
    assert len(got) == 1000


def test_interval_holds():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.normal(size=(30, 5)) * 9, rng.normal(size=(30, 5)) + rng.normal(size=5) * 9
        ca, cb = a.mean(axis=0), b.mean(axis=0)
        low, high = negatives.interval(ca, np.sqrt(((a - ca) ** 2).sum(axis=1)).max(), cb, np.sqrt(((b - cb) ** 2).sum(axis=1)).max())
        assert low <= (a @ b.T).min() and high >= (a @ b.T).max()


# decontamination


def brute_words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute_scan(docs, items, width=10):
    win = {}
    for i, t in items:
        w = brute_words(t)
        for at in range(max(1, len(w) - width + 1)):
            if w:
                win.setdefault(tuple(w[at : at + width]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, own = brute_words(t), set(), set()
        for size in {len(x) for x in win}:
            for at in range(len(w) - size + 1):
                if (whose := win.get(tuple(w[at : at + size]))) is not None:
                    hit.update(range(at, at + size))
                    own |= whose
        own = sorted(str(x) for x in own if x is not None)
        out.append((d, len(w), len(hit), len(own), hashlib.sha256(",".join(own).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def contaminated():
    r = random.Random(3)

    def prose(n):
        return " ".join(r.choice("alpha beta Gamma délta été 日本 x1 2nd É".split()) + str(r.randint(0, 9)) for _ in range(n))

    items = [(i, prose(r.choice([3, 9, 10, 11, 30]))) for i in range(30)] + [(30, ""), (31, None), (None, prose(12)), (32, "one"), (33, "one"), (5, prose(14)), (34, "?!")]
    items += [(35, prose(5000))]
    docs = [(i, prose(40)) for i in range(20)]
    for i, t in items:
        if t and i is not None and i < 30:
            docs.append((100 + i, prose(20) + ". \n" + t.upper().replace("É", "é").replace(" ", ",, ") + "! " + prose(5)))
            docs.append((200 + i, t))
            docs.append((300 + i, " ".join(t.split()[1:11]) + " zz"))
    docs += [(400, items[32][1]), (401, None), (402, ""), (403, "..."), (404, items[-1][1] + " " + prose(3)), (405, prose(3) + " one!"), (405, prose(3) + " one!"), (None, items[4][1]), (406, "word " * 3_000 + items[6][1])]
    return docs, items


@pytest.mark.parametrize("block", [1 << 21, 700])
def test_scan(spark, contaminated, block):
    docs, items = contaminated
    d = spark.createDataFrame([(*x, "a", 1) for x in docs], "doc_id long, text string, words string, n_words int")
    b = spark.createDataFrame([(*x, "a") for x in items], "item_id long, text string, words string")
    got = decontam.digest(decontam.scan(d, b, block_bytes=block)).collect()
    assert sorted((tuple(x) for x in got), key=repr) == brute_scan(docs, items)


def test_scan_in_chunks(monkeypatch, contaminated):
    """A long text is split into words chunk by chunk; windows reach over the borders."""
    docs, items = contaminated
    found = decontam.Automaton([(str(i), decontam.words(t.encode())) for i, t in items if i is not None and t], 10)
    text = " ".join(t for _, t in docs[:60] if t).encode()
    whole = found.matches(text)
    for size in (1, 7, 50, 1000):
        monkeypatch.setattr(decontam, "_CHUNK", size)
        assert found.matches(text) == whole


def test_scan_places(spark, contaminated):
    docs, items = contaminated
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for row in decontam.scan(d, b, keep=["doc_id", "text"]).collect():
        held = [w for s in row["spans"] for w in brute_words(row["text"][s["start"] : s["end"]])]
        assert len(held) == row["n_hit"] and all(s["start"] < s["end"] for s in row["spans"])


def test_scan_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    d = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in decontam.digest(decontam.scan(d, none)).orderBy("doc_id").collect()] == [(3, 0, False), (0, 0, False)]
    assert decontam.scan(d.where("false"), none).collect() == []


def test_scan_sql(spark, contaminated):
    docs, items = contaminated
    con = duckdb.connect()
    docs = list({d: (d, t) for d, t in docs if d is not None}.values())  # the SQL takes doc_id for a key
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame([i for i in items if i[0] is not None], columns=["item_id", "text"]))
    assert sorted(con.sql(decontam.oracle()).fetchall(), key=repr) == brute_scan(docs, [i for i in items if i[0] is not None])


# alignment


def brute_align(docs):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(align.A_NAME))
    tok.encode_special_tokens = True
    letters = bpe.byte_letters()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.B_NAME))
    per, total = [], Counter()
    for d, t in docs:
        links, groups = [], []
        a = [(i, bytes(letters[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + t, add_special_tokens=False).ids] if t else []
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()) for i in sp.encode(t or "")]
        whole = (" " + (t or "")).encode()
        if not t or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            per.append((d, 0, 0, [], ""))
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, x in side:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        for start, end in zip([0, *ends], ends, strict=False):
            ga, gb = ([x for x in s if start <= x[1] < end] for s in spans)
            groups.append(",".join(str(x[0]) for x in ga) + "|" + ",".join(str(x[0]) for x in gb))
            links += [(x[0], y[0]) for x in ga for y in gb if x[1] < y[2] and y[1] < x[2]]
        total.update(links)
        per.append((d, len(a), len(b), links, ";".join(groups)))
    best = Counter()
    for (_, y), n in total.items():
        best[y] = max(best[y], n)
    return [
        (d, a, b, g.count(";") + 1 if g else 0, len(x), sum(total[p] == best[p[1]] for p in x), sum(total[p] for p in x), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for d, a, b, x, g in per
    ]


@pytest.mark.parametrize("block", [8 << 20, 40])
def test_align(spark, block):
    r = random.Random(8)
    docs = [(i, "".join(r.choice(["the ", "ab", "é", "日本", " ", "\n", "😀", "'s", "1984", ".", "\t", "Straße ", "international "]) for _ in range(r.randint(1, 40)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "a▁b"), (63, "<|endoftext|> <s></s> <0x41> <unk>"), (64, " "), (65, "\x00\x7f"), (66, "x" * 5000), (67, "word " * 3000), (67, "word " * 3000), (None, "no id"), (68, "ﬁ①Å é")]
    df = spark.createDataFrame([(*d, "a", 3) for d in docs], "doc_id long, text string, block string, count int")
    got = align.aligned(df.repartition(3), block_bytes=block).collect()
    assert sorted((tuple(x) for x in got), key=repr) == sorted(brute_align(docs), key=repr)
    assert align.aligned(df.where("false")).collect() == []


# bounds of the learnt and planned operators


def test_one_long_text_takes_no_other_texts_place(spark):
    from folioforge.llm import quality, toxicity

    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["vile", "nasty", "awful"] if i % 2 else ["calm", "kind", "fine"]) for _ in range(30))) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(80)] + [(i, 1, 1) for i in range(80, 84)] + [(i, 0, 0) for i in range(84, 88)], "doc_id long, toxic int, quality int")
    short = spark.createDataFrame(rows, "doc_id long, text string")
    long = spark.range(80, 88).select(F.col("id").alias("doc_id"), F.repeat(F.lit("noise "), 7_000_000).alias("text"))
    for label, sizes in (("toxic", toxicity.SAMPLE), ("quality", quality.SAMPLE)):
        alone = toxicity.sample(short, labels, label, sizes, None)
        assert len(alone) == 80 and toxicity.sample(short.unionByName(long), labels, label, sizes, None) == alone


def test_substitution_inverts_the_first_basis():
    from folioforge.llm import pack

    r = np.random.default_rng(0)
    for n in (1, 5, 60, 300):
        lengths = np.sort(r.choice(np.arange(1, 1024), n, replace=False))
        demand = np.zeros(1025, np.int64)
        demand[lengths] = r.integers(1, 50, n)
        columns, _ = pack.first_basis(lengths, demand, 1024)
        matrix = np.array([[c[int(k)] for c in columns] for k in lengths], float)
        assert np.abs(np.einsum("ij,jk->ik", pack.inverse_of(columns, lengths), matrix) - np.eye(n)).max() < 1e-6

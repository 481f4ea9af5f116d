"""Grouped recovery and the fuzzy join against the plain rule, one entry after another."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.functions import vocab
from folioforge.operators import grouped as G
from folioforge.operators import matching as M
from folioforge.operators import reports as R

# the rule as loops over plain values


def tokens(x: str) -> set[str]:
    return {t for t in re.findall(r"[A-Za-z0-9+#/.]+", G._identity(x)) if len(t) > 1}


def share(a: set[str], b: set[str]) -> float:
    return len(a & b) / min(len(a), len(b)) if a and b else 0.0


def score(kind: str, left: dict, right: dict) -> tuple[bool, float]:
    """(matched, score) of two entries, dicts of raw_text, primary_name, secondary_name, date_range, technologies."""
    order = ("secondary_name", "primary_name") if kind in M.ORGANISATION_FIRST else ("primary_name", "secondary_name")
    total, reasons = 0.0, set()
    for field, label, exact, near in zip(order, ("name", "organization"), (4.0, 3.0), (2.5, 2.0)):
        if kind == "projects" and label == "organization":
            continue
        a, b = G._identity(left[field]), G._identity(right[field])
        if a and a == b:
            total += exact
            reasons.add(label)
        elif share(tokens(a), tokens(b)) >= 0.6:
            total += near
            reasons.add(label)
    a, b = G._dates(left["date_range"]), G._dates(right["date_range"])
    if a and b:
        near = 1.0 if a == b else share(tokens(a), tokens(b))
        total += 2.0 if near == 1.0 else 1.0 if near > 0 else 0.0
    if share(tokens(left["raw_text"]), tokens(right["raw_text"])) >= 0.5:
        total += 1.5
        reasons.add("token")
    if kind == "projects" and share(set(left["technologies"]), set(right["technologies"])) >= 0.5:
        total += 1.0
    least, prefixes = M.ACCEPT[kind]
    return total >= least and bool(reasons & set(prefixes)), total


def united(have: list, more: list) -> list:
    """have, and of more what differs from all before it in lower case and blanks; empty values are left out."""
    first = {G._flat(x).lower(): x for x in reversed(more)}
    fresh = [k for k in dict.fromkeys(G._flat(x).lower() for x in more) if k and k not in {G._flat(x).lower() for x in have}]
    return have + [first[k] for k in fresh]


def merged(target: dict, source: dict) -> tuple[dict, list[str]]:
    """target with its empty values filled from source and lists of both united, and the keys that gained, in source's order."""

    def either(old: object, new: object) -> object:
        if G.is_empty(old) or G.is_empty(new):
            return new if G.is_empty(old) and not G.is_empty(new) else old
        return united(old, new) if isinstance(old, list) and isinstance(new, list) else old

    out = {k: either(v, source.get(k)) for k, v in target.items()}
    return out, [k for k in source if k in target and out[k] != target[k]]


def recover_field(field: str, candidates: list[str], parser: list, optimizer: list, skip: set[str] = frozenset()) -> tuple[list[dict], list[str], dict[str, list[str]]]:
    """(entries, schema keys, audit) of one document's field."""
    keys = G.field_keys(field, next((list(e) for e in [*optimizer, *parser] if isinstance(e, dict) and e), None))
    final = [({k: G.default(k) for k in keys} | e) if isinstance(e, dict) else {"value": e} for e in optimizer]
    known = [G.comparable(field, e) for e in final]
    audit: dict[str, list[str]] = {"recovered_items": [], "recovered_fields": [], "notes": []}

    def settle(entry: dict, probe: dict, name: str) -> None:
        hits = [(s, -i) for i, e in enumerate(known) for ok, s in [score(field, e, probe)] if ok]
        if hits:
            at = -max(hits)[1]
            final[at], gained = merged(final[at], entry)
            for key in gained:
                audit["recovered_fields"].append(f"{field}.{key}")
                audit["notes"].append(f"Filled missing {key} from {name}")
            return
        final.append(entry)
        known.append(G.comparable(field, entry))
        audit["recovered_items"].append(f"{field}:appended_from_{name}")
        audit["notes"].append(f"Recovered missing {field.rstrip('s')} from {name} evidence")

    for e in parser:
        if isinstance(e, dict):
            settle(G.to_schema(field, e, keys), G.comparable(field, e), "parser")
    for c in candidates:
        entry = G.from_candidate(field, c, keys)
        title = G._flat(G._value(entry, G._TITLES)).lower()
        if not (title and title in skip):
            settle(entry, G.comparable(field, entry), "source")
    return final, keys, audit


WORDS = "senior backend engineer acme cairo data python 2020 2022 of science lab c++ x".split()
STRUCT = "struct<raw_text:string,primary_name:string,secondary_name:string,date_range:string,technologies:array<string>>"


def pick(r, n, least=0):
    return " ".join(r.choice(WORDS) for _ in range(r.randint(least, n)))


def compared(r):
    return {"raw_text": pick(r, 8), "primary_name": pick(r, 3), "secondary_name": pick(r, 2), "date_range": r.choice(["", "2020 - 2022", "2020", "May 2022"]), "technologies": [r.choice(WORDS) for _ in range(r.randint(0, 3))]}


@pytest.mark.parametrize("kind", list(M.ACCEPT))
def test_join_finds_all_matches(spark, kind):
    r = random.Random(17)
    left, right = ([(i, i % 3, compared(r)) for i in range(n)] for n in (90, 70))
    frames = [spark.createDataFrame([(i, g, tuple(e.values())) for i, g, e in rows], f"id int, grp int, entry {STRUCT}") for rows in (left, right)]
    classes = [M.classed(f, kind, ["grp"]) for f in frames]
    want = {(i, j): score(kind, a, b)[1] for i, g, a in left for j, h, b in right if g == h and score(kind, a, b)[0]}
    mine, others = (c.select(F.col("cls").alias(n), F.col("id").alias(f"id_{n}")) for c, n in zip(classes, "lr", strict=True))
    got = {(x["id_l"], x["id_r"]): x["score"] for x in M.matches(*classes, kind, ["grp"]).join(mine, "l").join(others, "r").collect()}
    assert got == want and want
    one = classes[0]
    alone = {(x["id_l"], x["id_r"]): x["score"] for x in M.matches(one, one, kind, ["grp"]).join(mine, "l").join(mine.select(F.col("l").alias("r"), F.col("id_l").alias("id_r")), "r").collect()}
    assert alone == {(i, j): score(kind, a, b)[1] for i, g, a in left for j, h, b in left if g == h and score(kind, a, b)[0]}


def entry_of(r, field):
    keys = r.choice([list(vocab.DEFAULT_KEYS[field]), [*vocab.DEFAULT_KEYS[field], "link"], ["note"], [vocab.ENTRY_KEYS[field]["primary"][0]]])
    return {k: r.choice([[], [r.choice(WORDS) for _ in range(r.randint(1, 3))], ["Go", "go ", "", 3]]) if k in vocab.LIST_KEYS else r.choice(["", None, pick(r, 3), pick(r, 3, 1), "2020 - 2022", 7, "Bachelor of data | Cairo University | GPA: 3.4"]) for k in keys}


def payload(r, field, n):
    return {field: [r.choice([entry_of(r, field), entry_of(r, field), entry_of(r, field), "plain"]) for _ in range(n)], **({"certifications": [pick(r, 2), "Acme"]} if r.random() < 0.4 else {})}


@pytest.mark.parametrize("field", list(vocab.ENTRY_KEYS))
def test_recovery_is_that_of_the_loop(spark, field):
    r = random.Random(len(field))
    rows = [(d, field, [r.choice([" | ".join([pick(r, 3, 1), pick(r, 2), "2020"]), pick(r, 4), "Master of Science, Cairo University GPA: 3.1"]) for _ in range(r.randint(0, 6))], payload(r, field, r.randint(0, 5)), payload(r, field, r.randint(0, 4))) for d in range(12)]
    rows.append((12, field, [" | ".join([pick(r, 2, 1), pick(r, 2)]) for _ in range(60)], payload(r, field, 30), payload(r, field, 5)))  # a record that holds most entries
    rows.append((13, field, [], {}, {}))
    df = spark.createDataFrame([(d, f, c, json.dumps(p), json.dumps(o)) for d, f, c, p, o in rows], "doc_id long, field string, candidates array<string>, parser string, optimizer string")
    got = {x["doc_id"]: x for x in G.recover(df).collect()}
    assert len(got) == len(rows)
    for d, f, c, p, o in rows:
        titles = {t for side in (p, o) if isinstance(side.get("certifications"), list) for x in side["certifications"] if (t := G._flat(x).lower())}
        entries, keys, audit = recover_field(f, c, p.get(f) or [], o.get(f) or [], titles if f == "trainings_courses" else frozenset())
        x = got[d]
        assert [list(e.items()) for e in json.loads(x["entries"])] == [list(e.items()) for e in entries], d
        assert (x["schema_keys"], x["recovered_items"], x["recovered_fields"], x["notes"]) == (keys, *audit.values()), d


def test_gaps_are_those_of_the_loop(spark):
    r = random.Random(9)
    rows = [(d, f, [" | ".join([pick(r, 3, 1), pick(r, 2)]) for _ in range(4)], payload(r, f, 4), payload(r, f, 4)) for d, f in enumerate(list(vocab.ENTRY_KEYS) * 3)]
    df = spark.createDataFrame([(d, f, c, json.dumps(p), json.dumps(o)) for d, f, c, p, o in rows], "doc_id long, field string, candidates array<string>, parser string, final string")
    want = []
    for d, f, c, p, o in rows:
        keys = G.field_keys(f, next((list(e) for e in [*o[f], *p[f]] if isinstance(e, dict) and e), None))
        titles = {t for side in (p, o) for x in side.get("certifications", []) if (t := G._flat(x).lower())}
        known = [G.comparable(f, e) for e in o[f] if isinstance(e, dict)]
        for i, text in enumerate(c):
            e = G.from_candidate(f, text, keys)
            skipped = f == "trainings_courses" and G._flat(G._value(e, G._TITLES)).lower() in titles - {""}
            if not skipped and not any(score(f, k, G.comparable(f, e))[0] for k in known):
                want.append((d, f, "phase2_input", i))
        want += [(d, f, "parser", i) for i, e in enumerate(p[f]) if isinstance(e, dict) and not any(score(f, k, G.comparable(f, e))[0] for k in known)]
    assert sorted((x["doc_id"], x["field"], x["source"], x["ord"]) for x in R.missing_groups(df).collect()) == sorted(want)


def test_keys_of_the_join_are_narrow(spark):
    """What travels for a sign is a digest and a number, however long names and the signs themselves are."""
    r = random.Random(5)
    words = [f"{w}{'x' * 30}{i}" for w in WORDS for i in range(20)]
    rows = [(i, i // 5, {f: " ".join(r.choice(words) for _ in range(n)) for f, n in (("raw_text", 12), ("primary_name", 4), ("secondary_name", 3))} | {"date_range": "", "technologies": []}) for i in range(600)]
    own = M.classed(spark.createDataFrame([(i, d, "experience", tuple(e.values())) for i, d, e in rows], f"id int, doc_id int, field string, entry {STRUCT}"), None, ["doc_id", "field"])
    store = spark.sparkContext._jsc.sc().statusStore()

    def shuffled() -> int:
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = shuffled()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large for it
    try:
        assert M.matches(own, own, None, ["doc_id", "field"]).where("l = r").count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled() - before < 8000 * len(rows)


def shuffled(spark) -> int:
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


@pytest.mark.parametrize("least", [0, 40])
@pytest.mark.parametrize("kind", list(M.ACCEPT))
def test_join_by_signs_finds_all_matches(spark, monkeypatch, kind, least):
    """Groups over SMALL go by signs, alone or beside smaller ones, with the same result."""
    monkeypatch.setattr(M, "SMALL", least)
    r = random.Random(23)
    left, right = ([(i, i if i < 4 else 9, compared(r)) for i in range(n)] for n in (50, 40))
    frames = [spark.createDataFrame([(i, g, tuple(e.values())) for i, g, e in rows], f"id int, grp int, entry {STRUCT}") for rows in (left, right)]
    classes = [M.classed(f, kind, ["grp"]) for f in frames]
    mine, others = (c.select(F.col("cls").alias(n), F.col("id").alias(f"id_{n}")) for c, n in zip(classes, "lr", strict=True))
    want = {(i, j): score(kind, a, b)[1] for i, g, a in left for j, h, b in right if g == h and score(kind, a, b)[0]}
    assert {(x["id_l"], x["id_r"]): x["score"] for x in M.matches(*classes, kind, ["grp"]).join(mine, "l").join(others, "r").collect()} == want and want


def test_signs_of_the_join_are_narrow(spark, monkeypatch):
    monkeypatch.setattr(M, "SMALL", 0)
    test_keys_of_the_join_are_narrow(spark)


def test_entries_of_small_groups_travel_once(spark):
    """Records of few entries list no signs: what is shuffled is their forms, once a side."""
    r = random.Random(5)
    words = [f"{w}{i}" for w in WORDS for i in range(20)]
    rows = [(i, i // 5, "experience", (" ".join(r.choice(words) for _ in range(12)), " ".join(r.choice(words) for _ in range(4)), r.choice(words), "", [])) for i in range(600)]
    own = M.classed(spark.createDataFrame(rows, f"id int, doc_id int, field string, entry {STRUCT}"), None, ["doc_id", "field"])
    before = shuffled(spark)
    assert M.matches(own, own, None, ["doc_id", "field"]).where("l = r").count() == len(rows)
    assert shuffled(spark) - before < 600 * len(rows)


def test_entries_of_one_file_are_read_by_many_tasks(spark):
    """Entries take long for few bytes, so a scan or an exchange leaves them in one task."""
    rows = [(i // 5, "projects", "source", i % 5, f"tool {i} | lab") for i in range(400)]
    entries = spark.createDataFrame(rows, "doc_id long, field string, source string, ord long, entry string").coalesce(1)
    found = G.formed(entries).select(F.spark_partition_id().alias("task"), "doc_id", "ord", "entry").collect()
    assert len({x["task"] for x in found}) >= spark.sparkContext.defaultParallelism
    assert sorted((x["doc_id"], x["ord"], x["entry"]) for x in found) == sorted((d, o, e) for d, _, _, o, e in rows)

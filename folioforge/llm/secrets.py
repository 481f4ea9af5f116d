"""Secret scans by a trigram inverted index, in DataFrame operations alone.

From each rule's regular expression a Boolean query over trigrams is derived on the driver: an OR of
ANDs that every match must satisfy. The index holds postings (trigram, document) of the queries'
trigrams; intersecting them gives each rule's candidates, and only these are verified with the
regular expression. Rules without mandatory trigrams (hex) are verified on every document.

Texts: null counts as empty; work grows with a text's length and little faster than its matches.
Rows are indexed by doc_id, those without one by a hash of their text; what rows share a key share
candidates, so repeated rows are each verified by all rules that one of them may match. An empty
table gives an empty result. Extra columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import let


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # for Java and RE2 alike
    group: int  # whose length `least` bounds
    least: int
    base: bool = False


RULES = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    # open-ended runs: the longest run is the match, so its least length can stand in the pattern
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 20),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 27),
]
Query = frozenset[frozenset[str]]  # an OR of ANDs; {{}} holds for every text
ANY: Query = frozenset({frozenset()})


def _and(a: Query, b: Query) -> Query:
    return frozenset(x | y for x in a for y in b) if len(a) * len(b) <= 64 else max(a, b, key=lambda q: min(map(len, q)))


def _of(strings: set[str]) -> Query:
    """What a text must hold that has one of the strings."""
    if any(len(s) < 3 for s in strings):
        return ANY
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _exact(op, arg) -> set[str] | None:
    """All strings that a node matches, in lower case, if few."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= 8:
        return {chr(a).lower() for _, a in arg}
    if op is C.SUBPATTERN:
        return _exact_all(arg[3])
    if op is C.BRANCH:
        parts = [_exact_all(x) for x in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op is C.MAX_REPEAT and arg[1] is not C.MAXREPEAT and arg[1] <= 8 and (one := _exact_all(arg[2])) is not None:
        out: set[str] = set()
        for n in range(arg[0], arg[1] + 1):
            now = {""}
            for _ in range(n):
                now = {a + b for a in now for b in one}
            out |= now
            if len(out) > 32:
                return None
        return out
    return None


def _exact_all(nodes) -> set[str] | None:
    now = {""}
    for op, arg in nodes:
        if (one := _exact(op, arg)) is None or len(now) * len(one) > 32:
            return None
        now = {a + b for a in now for b in one}
    return now


def trigrams(pattern: str) -> Query:
    """The Boolean trigram query of a regular expression, over lower-case text."""

    def walk(nodes) -> Query:
        query, run = ANY, {""}
        for op, arg in nodes:
            one = _exact(op, arg)
            if one is not None and len(run) * len(one) <= 32:
                run = {a + b for a in run for b in one}
                continue
            query, run = _and(query, _of(run)), {""}
            if one is not None:
                run = one
            elif op is C.SUBPATTERN:
                query = _and(query, walk(arg[3]))
            elif op is C.BRANCH:
                query = _and(query, frozenset().union(*map(walk, arg[1])))
            elif op is C.MAX_REPEAT and arg[0] >= 1:
                query = _and(query, walk(arg[2]))
        query = _and(query, _of(run))
        return ANY if frozenset() in query else query

    return walk(_parser.parse(pattern, re.DOTALL))


def key(doc_id: str = "doc_id") -> Column:
    """What a row is indexed by, never null, so that no two different texts without an id must meet in one task."""
    return F.struct(F.col(doc_id).isNull().alias("nameless"), F.coalesce(F.col(doc_id).cast("long"), F.xxhash64("text")).alias("id"))


def postings(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """(trigram, key) for the wanted trigrams: the part of the inverted index that the queries read."""
    found = let(F.lower("text"), lambda low: F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted))))
    return docs.select("key", F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, kinds): the rules whose queries the postings of a key satisfy."""
    queries = {r.kind: q for r in rules if (q := trigrams(r.pattern)) != ANY}
    clauses = [(kind, i, t) for kind, q in queries.items() for i, c in enumerate(sorted(map(sorted, q))) for t in c]
    # one row per mandatory trigram: as many as the rules' texts have, whatever the corpus
    wanted = docs.sparkSession.createDataFrame([(t, k, i, len(sorted(map(sorted, queries[k]))[i])) for k, i, t in clauses], "trigram string, kind string, clause int, needed int")
    hits = postings(docs, sorted({t for _, _, t in clauses})).join(F.broadcast(wanted), "trigram")
    whole = hits.groupBy("key", "kind", "clause").agg(F.collect_set("trigram").alias("found"), F.first("needed").alias("needed")).where(F.size("found") == F.col("needed"))
    return whole.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


#: Matches whose places are summed one after another; a text's matches are dealt in blocks of so many.
_RUN = 256


def _spans(rule: Rule, rank: int) -> Column:
    """Leftmost matches of the rule as an array of (start, rank, end, kind, size): lengths of what lies between them give the places.

    Sums run within blocks and then over the blocks, so no match is summed from the text's begin anew."""
    whole = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gap = F.transform(F.split("text", rule.pattern, -1), F.length)
    # the last piece lies behind the last match
    rows = F.arrays_zip(F.slice(gap, 1, F.greatest(F.size(gap) - 1, F.lit(0))).alias("gap"), F.transform(whole, F.length).alias("l"), F.transform(part, F.length).alias("size"))
    one = "struct<start:int,size:int,l:int>"

    def block(all_rows: Column, at: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            start = a["at"] + x["gap"]
            return F.struct((start + x["l"]).alias("at"), F.concat(a["out"], F.array(F.struct(start.alias("start"), x["size"].alias("size"), x["l"].alias("l")))).alias("out"))

        return F.aggregate(F.slice(all_rows, at + 1, F.lit(_RUN)), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{one}>").alias("out")), step)

    def placed(all_rows: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(all_rows) - 1, F.lit(0)), F.lit(_RUN)), lambda at: block(all_rows, at))

        def shift(a: Column, b: Column) -> Column:
            return F.struct((a["at"] + b["at"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))

        def moved(b: Column, by: Column) -> Column:
            return F.transform(b["out"], lambda x: F.struct((x["start"] + by).alias("start"), F.lit(rank).alias("rank"), (x["start"] + by + x["l"]).alias("end"), F.lit(rule.kind).alias("kind"), x["size"].alias("size")))

        def all_of(b: Column) -> Column:
            before = F.aggregate(b, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), shift)["out"]
            return F.flatten(F.zip_with(b, before, moved))

        return let(blocks, all_of)

    return F.filter(let(rows, placed), lambda s: s["size"] >= rule.least)


def scan(docs: DataFrame, rules: list[Rule] | None = None, keep: list[str] | None = None) -> DataFrame:
    """doc_id (or the columns in `keep`), text and found: every rule's spans, by start and then rule."""
    rules = RULES if rules is None else rules
    names = keep or ["doc_id"]
    own = names if "doc_id" in names else ["doc_id", *names]
    rows = docs.select(*own, F.coalesce("text", F.lit("")).alias("text")).withColumn("key", key())
    open_rules = {r.kind for r in rules if trigrams(r.pattern) == ANY}
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,size:int>>")
    if len(open_rules) < len(rules):
        rows = rows.join(candidates(rows.select("key", "text"), rules), "key", "left")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))

    def found(rule: Rule, rank: int) -> Column:
        test = F.col("text").rlike(rule.pattern) if rule.kind in open_rules else F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        return F.when(test, _spans(rule, rank)).otherwise(none)

    spans = F.array_sort(F.concat(*(found(r, i) for i, r in enumerate(rules))))
    return rows.select(*names, "text", spans.alias("found"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Counts and digests of scan()'s spans."""
    base = [r.kind for r in (RULES if rules is None else rules) if r.base]
    own = F.filter("found", lambda s: s["kind"].isin(base))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("doc_id").cast("long").alias("doc_id"), *map(count, base), F.sha2(joined(own), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redact(found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """scan()'s rows with every span replaced by `mark`; overlapping spans are replaced once."""
    text = F.col("text")
    # spans by start; one that begins before an earlier one ends is part of it
    none = F.array().cast("array<struct<start:int,end:int>>")

    def merge(a: Column, s: Column) -> Column:
        last = F.get(a, F.size(a) - 1)
        now = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        grown = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when(F.size(a) == 0, now).when(s["start"] >= last["end"], F.concat(a, now)).otherwise(F.concat(F.slice(a, 1, F.size(a) - 1), grown))

    def clean(spans: Column) -> Column:
        def piece(at: Column) -> Column:  # a run of spans: the text before each, and marks
            run = F.slice(spans, at + 1, F.lit(_RUN))
            begin = F.when(at == 0, F.lit(0)).otherwise(F.get(spans, at - 1)["end"])
            own = text.substr(begin + 1, F.get(run, F.size(run) - 1)["end"] - begin)
            return F.struct(own.alias("own"), F.transform(run, lambda s: F.struct((s["start"] - begin).alias("start"), (s["end"] - begin).alias("end"))).alias("run"))

        def masked(p: Column) -> Column:
            before = F.concat(F.array(F.lit(0)), F.transform(p["run"], lambda s: s["end"]))
            return F.array_join(F.zip_with(p["run"], F.slice(before, 1, F.size(p["run"])), lambda s, b: F.concat(p["own"].substr(b + 1, s["start"] - b), F.lit(mark))), "")

        cut = F.transform(F.sequence(F.lit(0), F.size(spans) - 1, F.lit(_RUN)), lambda at: let(piece(at), masked))
        rest = text.substr(F.get(spans, F.size(spans) - 1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(cut, ""), rest)

    def merged(found: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(found) - 1, F.lit(_RUN)), lambda at: F.aggregate(F.slice(found, at + 1, F.lit(_RUN)), none, merge))

        def whole(f: Column) -> Column:  # blocks are merged on their own; where one reaches into the next, all are merged again
            apart = F.forall(F.zip_with(f, F.slice(f, F.lit(2), F.size(f)), lambda a, b: F.coalesce(b["start"] >= a["end"], F.lit(True))), lambda x: x)
            return F.when(apart, f).otherwise(F.aggregate("found", none, merge))

        return let(F.flatten(runs), whole)

    return found.withColumn("text", F.when(F.size("found") > 0, let(merged(F.col("found")), clean)).otherwise(text))


def oracle(rules: list[Rule] | None = None, table: str = "documents") -> str:
    """DuckDB SQL of digest(scan(documents)), with every rule on every text."""
    rules = RULES if rules is None else rules
    parts = []
    for rank, r in enumerate(rules):
        p = r.pattern.replace("'", "''")
        measured = f"length(list_extract(regexp_extract_all(t, '{p}', {r.group}), i))" if r.group else "length(list_extract(m, i))"
        parts.append(f"""SELECT k, {rank} AS rank, '{r.kind}' AS kind, list_sum(list_transform(b[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s, length(m[i]) AS l, {measured} AS size
FROM (SELECT k, t, m, b, unnest(range(1, len(m) + 1)) AS i FROM (SELECT k, t, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS b FROM d)) WHERE size >= {r.least}""")
    found = " UNION ALL ".join(parts)
    base = ", ".join(f"'{r.kind}'" for r in rules if r.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in rules if r.base)
    names = ", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in rules if r.base)
    span = "kind || ':' || s::BIGINT || ':' || (s + l)::BIGINT"
    return f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM {table}), f AS ({found}),
g AS (SELECT k, {counts}, string_agg({span}, ',' ORDER BY s, rank) FILTER (kind IN ({base})) AS base, string_agg({span}, ',' ORDER BY s, rank) AS spans FROM f GROUP BY k)
SELECT doc_id, {names}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (k)"""

"""Fuzzy matching of grouped entries: the rule as column expressions, and as a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import arrays, text
from folioforge.sources.staging import staged

#: Least score, and prefixes of reasons of which one is needed, by kind of entry.
ACCEPT = {
    "experience": (5.0, ("organization", "title", "token")),
    "education": (5.0, ("organization", "title", "token")),
    "projects": (4.0, ("name", "token")),
    "trainings_courses": (4.0, ("name", "organization", "token")),
}
#: Kinds that compare the organisation first and the title second.
ORGANISATION_FIRST = ("experience", "education")


def match(kind: str, left: Column, right: Column) -> Column:
    """struct(matched, score, reasons) of two entries, structs of raw_text, primary_name, secondary_name, date_range, technologies."""
    if kind in ORGANISATION_FIRST:
        names = [(left["secondary_name"], right["secondary_name"]), (left["primary_name"], right["primary_name"])]
    elif kind == "projects":
        names = [(left["primary_name"], right["primary_name"])]
    else:
        names = [(left["primary_name"], right["primary_name"]), (left["secondary_name"], right["secondary_name"])]

    def part(when_exact: Column, when_near: Column, name: str, exact: float, near: float) -> Column:
        none = F.struct(F.lit(None).cast("string").alias("r"), F.lit(0.0).alias("s"))
        return F.when(when_exact, F.struct(F.lit(name + "_exact").alias("r"), F.lit(exact).alias("s"))).when(when_near, F.struct(F.lit(name + "_token_overlap").alias("r"), F.lit(near).alias("s"))).otherwise(none)

    def named(label: str, exact: float, near: float):
        return lambda s: part((s["x"] != "") & (s["x"] == s["y"]), arrays.overlap(text.identity_tokens(s["x"]), text.identity_tokens(s["y"])) >= 0.6, label, exact, near)

    none = F.struct(F.lit(None).cast("string").alias("r"), F.lit(0.0).alias("s"))

    def dated(d: Column) -> Column:
        return F.when(d == 1.0, F.struct(F.lit("date_exact").alias("r"), F.lit(2.0).alias("s"))).when(d > 0.0, F.struct(F.lit("date_overlap").alias("r"), F.lit(1.0).alias("s"))).otherwise(none)

    parts = []
    for (a, b), label, exact, near in zip(names, ("name", "organization"), (4.0, 3.0), (2.5, 2.0)):
        parts.append(text.let(F.struct(text.normalize_identity(a).alias("x"), text.normalize_identity(b).alias("y")), named(label, exact, near)))
    parts.append(text.let(arrays.date_overlap(left["date_range"], right["date_range"]), dated))
    same = arrays.overlap(text.identity_tokens(left["raw_text"]), text.identity_tokens(right["raw_text"])) >= 0.5
    parts.append(F.when(same, F.struct(F.lit("token_overlap").alias("r"), F.lit(1.5).alias("s"))).otherwise(none))
    if kind == "projects":
        tech = arrays.overlap(F.coalesce(left["technologies"], F.array().cast("array<string>")), F.coalesce(right["technologies"], F.array().cast("array<string>"))) >= 0.5
        parts.append(F.when(tech, F.struct(F.lit("technology_overlap").alias("r"), F.lit(1.0).alias("s"))).otherwise(none))
    least, prefixes = ACCEPT[kind]

    def told(found: Column) -> Column:
        score = F.aggregate(found, F.lit(0.0), lambda a, p: a + p["s"])
        reasons = F.array_compact(F.transform(found, lambda p: p["r"]))
        accepted = F.exists(reasons, lambda r: r.rlike("^(" + "|".join(prefixes) + ")"))
        return F.struct(((score >= least) & accepted).alias("matched"), score.alias("score"), reasons.alias("reasons"))

    return text.let(F.array(*parts), told)


def best(pairs: DataFrame, by: list[str], matched: str = "m", index: str = "idx") -> DataFrame:
    """Of each candidate's matched entries the one with the highest score, the first of equals."""
    w = Window.partitionBy(*by).orderBy(F.desc(f"{matched}.score"), index)
    return pairs.where(f"{matched}.matched").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


# --- the same rule as a join that lists no pairs but those that may match


#: Names, raw texts and technologies match from these shares of the smaller token set on.
NAME_SHARE, RAW_SHARE = 0.6, 0.5
#: What the rule reads of an entry.
FORM = ("a", "b", "date", "raw", "tech")
#: A group of at most so many entries, both sides together, is compared pair by pair, which makes at most half as many pairs an entry; a larger one goes by signs.
SMALL = 64


def _kind(kind: str | None) -> Column:
    return F.col("field") if kind is None else F.lit(kind)


def classed(entries: DataFrame, kind: str | None, by: list[str]) -> DataFrame:
    """entries (by, id, entry) with what the rule reads of them (a and b, the first and second name; date, raw, tech) and cls, a name of all that.

    Without a kind, a column field of by says it."""
    turned, project = _kind(kind).isin(*ORGANISATION_FIRST), _kind(kind) == "projects"
    names = (F.col("entry.primary_name"), F.col("entry.secondary_name"))
    tech = F.filter(F.coalesce(F.col("entry.technologies"), F.array().cast("array<string>")), lambda x: x.isNotNull())
    form = {
        "a": text.normalize_identity(F.when(turned, names[1]).otherwise(names[0])), "b": text.normalize_identity(F.when(project, "").when(turned, names[0]).otherwise(names[1])), "date": text.normalize_date_range(F.col("entry.date_range")),
        "raw": F.array_sort(F.array_distinct(text.identity_tokens(F.col("entry.raw_text")))), "tech": F.when(project, F.array_sort(F.array_distinct(tech))).otherwise(F.array().cast("array<string>")),
    }
    rows = entries.select("*", *(c.alias(n) for n, c in form.items()))
    whole = F.to_json(F.struct(*(F.col(c).cast("string").alias(f"by{i}") for i, c in enumerate(by)), *FORM))
    return rows.withColumn("cls", F.substring(F.unhex(F.sha2(whole, 256)), 1, 16))


def packed(rows: DataFrame, column: str, kind: str | None, by: list[str]) -> DataFrame:
    """rows whose entries in a column are struct(cls, *FORM) of classed()."""
    return classed(rows.withColumnRenamed(column, "entry"), kind, by).withColumn(column, F.struct("cls", *FORM)).select(*rows.columns)


def _read(entry: Column) -> Column:
    """A classed entry (cls, *FORM) as _score() takes it: with the tokens of its names and dates."""
    tokens = {f"{c}_tokens": F.array_distinct(text.identity_tokens(entry[c])) for c in ("a", "b", "date")}
    return F.struct(entry["cls"].alias("cls"), *(entry[c].alias(c) for c in FORM), *(t.alias(n) for n, t in tokens.items()))


def _score(x: Column, y: Column, kind: str | None) -> Column:
    """The score of two entries of _read() if they match by match()'s rule, else null."""

    def share(c: str) -> Column:
        small = F.least(F.size(x[c]), F.size(y[c]))
        return F.when(small > 0, F.size(F.array_intersect(x[c], y[c])) / small).otherwise(0.0)

    def named(c: str, exact: float, near: float) -> Column:
        return F.when((x[c] != "") & (x[c] == y[c]), exact).when(share(f"{c}_tokens") >= NAME_SHARE, near).otherwise(0.0)

    first, second = named("a", 4.0, 2.5), named("b", 3.0, 2.0)
    near = share("date_tokens")
    date = F.when((x["date"] == "") | (y["date"] == ""), 0.0).when((x["date"] == y["date"]) | (near == 1.0), 2.0).when(near > 0.0, 1.0).otherwise(0.0)
    raw = F.when(share("raw") >= RAW_SHARE, 1.5).otherwise(0.0)
    tech = F.when(share("tech") >= RAW_SHARE, 1.0).otherwise(0.0)  # only projects have any
    score = first + second + date + raw + tech
    parts = {"name": first, "organization": second, "token": raw}
    accepted = F.lit(False)
    for k, (least, prefixes) in ACCEPT.items():
        if kind in (None, k):
            told = F.greatest(*(parts[n] for n in prefixes if n in parts)) > 0.0
            accepted = F.when(_kind(kind) == k, (score >= least) & told).otherwise(accepted)
    return F.when(accepted, score)


def _within(left: DataFrame, right: DataFrame, kind: str | None, by: list[str]) -> DataFrame:
    """matches() of small groups: every left class of a group with every right one."""

    def side(rows: DataFrame, n: int) -> DataFrame:
        return rows.select(*by, F.struct("cls", *FORM).alias("x"), F.lit(n).alias("side"))

    rows = side(left, 0) if left is right else side(left, 0).unionByName(side(right, 1))
    sides = [F.transform(F.collect_set(F.when(F.col("side") == n, F.col("x"))), _read).alias(c) for n, c in ((0, "x"), (1, "y"))]
    # read once a class: what is exploded isn't computed again for every pair
    groups = rows.groupBy(*by).agg(*(sides[:1] if left is right else sides))
    pairs = groups.select(*by, F.explode("x").alias("x"), F.col("x" if left is right else "y").alias("all")).select(*by, "x", F.explode("all").alias("y"))
    return pairs.select(*by, F.col("x.cls").alias("l"), F.col("y.cls").alias("r"), _score(F.col("x"), F.col("y"), kind).alias("score")).where("score is not null")


def _needed(tokens: Column, share: float) -> Column:
    """Of a smaller set so many members, whichever they are, that one is shared if the shares of both reach `share`."""
    n = F.size(tokens)
    return F.slice(tokens, F.lit(1), n - F.ceil(share * n).cast("int") + 1)


def _signs() -> Column:
    """Everything two entries may share, marked by where it stands: tokens, and wholes after an equals sign, which no token has."""

    def marked(mark: str, tokens: Column) -> Column:
        return F.transform(tokens, lambda t: F.concat(F.lit(mark), t))

    def named(c: str) -> Column:
        return F.filter(F.array_append(text.identity_tokens(c), F.concat(F.lit("="), F.col(c))), lambda t: t != "=")

    return F.array_distinct(F.concat(marked("a", named("a")), marked("b", named("b")), marked("r", F.col("raw")), marked("d", named("date")), marked("t", F.col("tech"))))


def _of(mark: str) -> Column:
    """The tokens of one mark, rarest first, without wholes."""
    return F.filter("all", lambda t: t.startswith(mark) & (F.lit(mark == "t") | ~t.startswith(mark + "=")))


def _table(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """A row for each class and side (0 and 1; 0 alone if both are the same): a number n, its form, all its signs, those that few entries of `by` have first, and the few that are looked for.

    Signs are counted by digests of 64 bits and travel as their places: the order only says what is looked for first."""
    sides = [(left, 0)] if left is right else [(left, 0), (right, 1)]
    rows = None
    for side, n in sides:
        own = side.groupBy(*by, "cls").agg(*(F.first(c).alias(c) for c in FORM)).withColumn("side", F.lit(n))
        rows = own if rows is None else rows.unionByName(own)
    rows = staged(rows.withColumn("signs", F.array_sort(_signs())).withColumn("n", F.monotonically_increasing_id()))
    each = rows.select(*by, "n", F.posexplode("signs").alias("nth", "sign")).select("n", "nth", F.xxhash64(*by, "sign").alias("h"))
    times = each.groupBy("h").agg(F.count(F.lit(1)).alias("times"))
    ranked = each.join(times.hint("merge"), "h").groupBy("n").agg(F.array_sort(F.collect_list(F.struct("times", "nth"))).alias("places"))
    rows = rows.join(ranked, "n", "left").withColumn("all", F.transform("places", lambda x: F.get("signs", x["nth"])))
    wholes = F.filter("all", lambda t: t.substr(1, 2).isin("a=", "b=", "d="))
    few = F.concat(_needed(_of("a"), NAME_SHARE), _needed(_of("b"), NAME_SHARE), _needed(_of("r"), RAW_SHARE), _of("d"), _needed(_of("t"), RAW_SHARE), wholes)
    return staged(rows.drop("signs", "places").withColumn("few", few))


def _both_ways(one: DataFrame, two: DataFrame, by: list[str], keep: tuple[str, str]) -> DataFrame:
    """(*keep): pairs of rows with equal k of which a sign that is looked for on one side is any on the other, and a few more. one, two: by, k, few, all and keep[0] or keep[1].

    What must be equal travels as a digest of 64 bits, so some pairs may be of different by or k: who asks tests them."""

    def listed(rows: DataFrame, name: str, first: str, second: str) -> DataFrame:
        ways = F.concat(F.transform(first, lambda s: F.concat(F.lit("1"), s)), F.transform(second, lambda s: F.concat(F.lit("2"), s)))
        return rows.select(*by, "k", name, F.explode(ways).alias("sign")).select(name, F.xxhash64(*by, "k", "sign").alias("h"))

    # an estimate doesn't see how many rows come of a list, so none is broadcast by it
    return listed(one, keep[0], "few", "all").join(listed(two, keep[1], "all", "few").hint("merge"), "h").select(*keep).distinct()


def matches(left: DataFrame, right: DataFrame, kind: str | None, by: list[str]) -> DataFrame:
    """(by, l, r, score): classes of left and right entries of equal `by` that match, each pair once; rows are classed().

    A score is a sum over few parts, and none of them alone reaches the least score but, for some kinds, a first
    name that is equal. So a pair that matches shares a first or second name, or most of its tokens, and
    besides a sign of another part: a token of the other name or of the raw texts, a date or a technology.
    Both are keys of the join, so neither a common name nor a common token alone brings two entries together;
    and of a set's tokens only so many, the rarest, are looked for that one of them must be shared.
    Groups of at most SMALL entries need none of that and are compared pair by pair."""
    own = left.select(*by) if left is right else left.select(*by).unionByName(right.select(*by))
    large = staged(own.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SMALL).select(F.struct(*by).alias("_by")))
    if large.isEmpty():
        return staged(_within(left, right, kind, by))

    def of(side: DataFrame, how: str) -> DataFrame:
        return side.withColumn("_by", F.struct(*by)).join(large, "_by", how).drop("_by")

    few, many = ([one := of(left, how), one if left is right else of(right, how)] for how in ("left_anti", "left_semi"))
    return staged(_within(*few, kind, by).unionByName(_by_signs(*many, kind, by)))


def _by_signs(left: DataFrame, right: DataFrame, kind: str | None, by: list[str]) -> DataFrame:
    """matches() by signs, for groups of any size."""
    table = _table(left, right, by)
    one, two = table.where("side = 0"), table.where(F.col("side") == (0 if left is right else 1))
    fields = ("a", "b")  # projects have no b

    def names(side: DataFrame, name: str) -> DataFrame:
        """Names of a side, each once, by field, with their tokens and themselves as signs."""
        rows = None
        for f in fields:
            whole = F.array(F.concat(F.lit(f + "="), F.col(f)))
            own = side.where(F.col(f) != "").select(*by, F.lit(f).alias("k"), F.col(f).alias(name), F.concat(_needed(_of(f), NAME_SHARE), whole).alias("few"), F.concat(_of(f), whole).alias("all"))
            rows = own if rows is None else rows.unionByName(own)
        return rows.groupBy(*by, "k", name).agg(F.first("few").alias("few"), F.first("all").alias("all"))

    near = _near(names(one, "v"), names(two, "w"), by)

    def probes(side: DataFrame, name: str, paired: bool) -> DataFrame:
        """Entries by a name (the left ones by each name that is near theirs), and the signs of their other parts."""
        rows = None
        for f in fields:
            other = {c: F.filter(c, lambda t, f=f: ~t.startswith(f)).alias(c) for c in ("few", "all")}
            own = side.where(F.col(f) != "").select(*by, F.col("n").alias(name), F.lit(f).alias("f"), F.col(f).alias("v"), *other.values())
            rows = own if rows is None else rows.unionByName(own)
        if paired:
            rows = rows.join(near.withColumnRenamed("k", "f"), [*by, "f", "v"]).drop("v").withColumnRenamed("w", "v")
        rows = rows.select(*by, name, F.concat("f", "v").alias("k"), "few", "all")
        some = F.array(F.lit("="))
        enough = [k for k, (least, _) in ACCEPT.items() if least <= 4.0 and kind in (None, k)]
        if enough:  # an equal first name is enough
            rows = rows.unionByName(side.where((F.col("a") != "") & _kind(kind).isin(*enough)).select(*by, F.col("n").alias(name), F.concat(F.lit("="), "a").alias("k"), some.alias("few"), some.alias("all")))
        if kind in (None, "projects"):  # so are a date, the raw texts and the technologies together
            rows = rows.unionByName(side.where(_kind(kind) == "projects").select(*by, F.col("n").alias(name), F.explode(F.filter("all", lambda t: t.startswith("d"))).alias("k"), _needed(_of("r"), RAW_SHARE).alias("few"), _of("r").alias("all")))
        return rows

    found = _both_ways(probes(one, "l", True), probes(two, "r", False), by, ("l", "r")).withColumnsRenamed({"l": "m", "r": "n"})
    read = _read(F.struct("cls", *FORM))
    found = found.join(one.select(F.col("n").alias("m"), *by, read.alias("x")), "m")
    found = found.join(two.select("n", F.struct(*by).alias("_by"), read.alias("y")), "n").where(F.struct(*by).eqNullSafe(F.col("_by")))
    return found.select(*by, F.col("x.cls").alias("l"), F.col("y.cls").alias("r"), _score(F.col("x"), F.col("y"), kind).alias("score")).where("score is not null")


def _near(one: DataFrame, two: DataFrame, by: list[str]) -> DataFrame:
    """(by, k, v, w): names of a field k that are equal or share NAME_SHARE of the smaller one's tokens."""
    found = _both_ways(one.withColumn("v", F.struct(F.struct(*by, "k").alias("at"), "v")), two.withColumn("w", F.struct(F.struct(*by, "k").alias("at"), "w")), by, ("v", "w"))
    found = found.where("v.at = w.at").select("v.at.*", "v.v", "w.w")
    return found.where((F.col("v") == F.col("w")) | (arrays.overlap(text.identity_tokens("v"), text.identity_tokens("w")) >= NAME_SHARE))

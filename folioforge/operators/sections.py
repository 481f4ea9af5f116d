"""Sections: labelled blocks split at headings, wherever these stand in a block."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import text, vocab
from folioforge.operators import headings

def _map(names: dict[str, str]) -> Column:
    # one expression text: building it literal by literal takes seconds of driver time in a plan this size
    return F.expr("map(" + ", ".join(f"'{x}'" for x in chain.from_iterable(names.items())) + ")")


def _key(t: Column) -> Column:
    """Comparison form of a normalised text as a heading."""
    return F.regexp_replace(F.lower(text.strip(F.regexp_replace(t, r"[:\-–|]+\z", ""))), r"(?U)\s+", " ")


def heading_key(x: Column) -> Column:
    return _key(text.normalize_lines(x))


def canonical(x: Column, aliases: dict[str, str] | None = None) -> Column:
    """Canonical section of a heading, or null."""
    return _named(heading_key(x), aliases)


def _named(key: Column, aliases: dict[str, str] | None = None) -> Column:
    names = _map(aliases or vocab.SECTION_ALIASES)
    return text.let(key, lambda k: F.coalesce(names[k], names[F.replace(k, F.lit("&"), F.lit("and"))]))


def display(x: Column) -> Column:
    """Canonical section of a heading, or the heading itself without a colon."""
    return F.coalesce(canonical(x), F.regexp_replace(text.normalize_lines(x), r":+\z", ""))


def is_heading(t: Column, x0: Column, label: Column | None = None) -> Column:
    """A known heading, or up to four words in capitals or before a colon, near the left edge. With a label, it must be a heading's; without, the test is strict."""

    def test(t: Column) -> Column:
        n = text.words(F.regexp_replace(t, r":+\z", ""))
        shown = text.is_upper(t) | t.endswith(":")
        fits = shown if label is None else shown & label.isin("section_heading", "heading")
        return _named(_key(t)).isNotNull() | ((n > 0) & (n <= 4) & ~t.rlike(r"[.!?]\z") & fits & F.coalesce(x0 <= 140, F.lit(True)))

    return text.let(text.normalize_lines(t), test)


def strip_bleed(x: Column | str) -> Column:
    """Without a section's name and an ampersand at the end."""

    def cut(t: Column) -> Column:
        short = F.rtrim(F.regexp_replace(t, "(?iU)" + vocab.SPLIT_BLEED, ""), F.lit(" -–|"))
        return F.when(t.rlike(r"[&\-–|]\z"), text.normalize_lines(short)).otherwise(t)

    return text.let(text.normalize_lines(x), cut)


#: No alias has more words; a mark may stand after them.
_MOST_WORDS = max(len(a.split()) for a in vocab.SECTION_ALIASES) + 1


def _looks(body: Column, x0: Column) -> Column:
    """is_heading() without a label, for texts of any length: one of many words is none, which is told without normalising it."""
    return F.when(body.rlike(rf"(?U)^\s*\S+(?:\s+\S+){{0,{_MOST_WORDS}}}\s*\z"), is_heading(body, x0)).otherwise(F.lit(False))


def _events(blocks: DataFrame) -> DataFrame:
    """Starts of sections and their contents, in order: doc_id, pos, sub, start (heading or null), block columns, and how many blocks the document has."""
    by = Window.partitionBy("doc_id").orderBy("pos")
    b = blocks.select("doc_id", "pos", "block_id", "page_number", "x0", "label", "text", text.normalize_lines("text").alias("t"))
    b = b.withColumn("hd", headings.found(F.col("t"))).select("*", "hd.kind", "hd.heading", "hd.named", "hd.before", "hd.after").drop("hd")
    lead, inline = F.col("kind") == "leading", F.col("kind") == "inline"
    b = b.withColumn("other", ~F.coalesce(lead | inline, F.lit(False)))
    bound = (F.col("label") == "section_heading") | ((F.col("label") == "heading") & F.col("named").isNotNull())
    b = b.withColumn("bound", F.col("other") & bound)
    b = b.withColumn("trail", F.col("other") & ~F.col("bound") & F.coalesce(F.col("kind") == "trailing", F.lit(False)))
    # a heading at the end of a block waits for the next block that has none of its own within
    last = F.last(F.when(F.col("other"), F.struct(F.when(F.col("trail"), F.col("heading")).alias("h"))), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    b = b.withColumn("waiting", F.when(F.col("other"), last["h"])).withColumn("blocks", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))
    for side in ("before", "after"):
        b = b.withColumn(side, F.when(F.col("kind").isNotNull(), text.normalize_lines(side)).otherwise(""))

    def event(sub: int, when: Column, start: Column | None, body: Column | None) -> Column:
        none = F.lit(None).cast("string")
        return F.when(when, F.struct(F.lit(sub).alias("sub"), (none if start is None else start).alias("start"), (none if body is None else body).alias("body")))

    own = lead | inline
    events = F.array_compact(
        F.array(
            event(0, inline & (F.col("before") != ""), None, F.col("before")),
            event(0, F.col("waiting").isNotNull(), F.col("waiting"), None),
            event(1, own, F.col("heading"), None),
            event(1, F.col("bound"), display(F.col("t")), None),
            event(2, own & (F.col("after") != ""), None, F.col("after")),
            event(2, F.col("trail") & (F.col("before") != ""), None, F.col("before")),
            event(2, F.col("other") & ~F.col("trail"), None, F.col("text")),
        )
    )
    return b.select("doc_id", "pos", "block_id", "page_number", "x0", "label", "blocks", F.explode(events).alias("e")).select("*", "e.sub", "e.start", "e.body").drop("e")


_MEMBER = ("pos", "sub", "block_id", "page_number", "label", "body", "clean", "looks")


def _grouped(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """One row a section: the keys, heading, blocks of its document, and its members in order."""
    return rows.groupBy("doc_id", *keys).agg(F.first("heading").alias("heading"), F.first("blocks").alias("blocks"), F.array_sort(F.collect_list(F.struct(*_MEMBER))).alias("m"), *more)


def _shown(m: Column, raw: Column) -> Column:
    """The texts of a section's members that are no headings."""
    return F.transform(F.filter(m, lambda x: x["label"] != "section_heading"), lambda x: F.when(raw, x["body"]).otherwise(x["clean"]))


def _without_empty(sections: DataFrame, keys: list[str], empty: Column) -> DataFrame:
    """Only a document's first section may be empty."""
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(*keys))
    return sections.withColumn("_n", nth).where((F.col("_n") == 1) | ~empty).drop("_n")


def _initial(blocks: DataFrame) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy("pos", "sub", F.col("start").isNull())
    rows = _events(blocks).withColumn("seq", F.sum(F.col("start").isNotNull().cast("int")).over(w))
    rows = rows.withColumn("heading", F.coalesce(F.last("start", ignorenulls=True).over(w), F.lit("General"))).where("start is null")
    # once for every text, not again for each use
    rows = rows.withColumn("clean", strip_bleed("body")).withColumn("looks", _looks(F.col("body"), F.col("x0")))
    empty = F.forall(_shown(F.col("m"), F.lit(False)), lambda x: x == "")
    found = _grouped(rows, ["seq"]).withColumn("empty", empty)
    return _without_empty(found.where("not empty or heading <> 'General'"), ["seq"], F.col("empty"))


def _figures(over: Window | None = None) -> dict[str, Column]:
    """Figures of a document's sections, as aggregates or over a window."""
    general = F.col("heading") == "General"

    def of(x: Column) -> Column:
        return x if over is None else x.over(over)

    return {
        "section_count": of(F.count(F.lit(1))).cast("int"),
        "general_block_ratio": of(F.sum(F.when(general, F.size("m")).otherwise(0))) / of(F.max("blocks")).cast("double"),
        "all_general": of(F.min(general)),
        "inside": of(F.max(general & F.exists("m", lambda m: m["looks"]))),
    }


def _errors() -> Column:
    """possible_errors from section_count and the other figures."""
    errors = F.array(
        F.when((F.col("section_count") == 1) & F.col("all_general"), "document_collapsed_into_general"),
        F.when(F.col("general_block_ratio") > 0.7, "oversized_general_section"),
        F.when(F.coalesce("inside", F.lit(False)), "heading_candidates_found_inside_general"),
    )
    return F.array_compact(errors)


def split(blocks: DataFrame, between: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(sections, diagnostics) of labelled blocks. between: what writes a table that both read; without it each computes it anew.

    sections: doc_id, section_seq, heading, content, source_pages, block_ids. diagnostics, a row per
    document: section_count, general_block_ratio, possible_errors, recovered_section_splits.
    Documents whose first split looks collapsed have their General sections split again at anything
    that looks like a heading. All steps keep a document's rows where the first of them put them."""
    whole = Window.partitionBy("doc_id")
    first = _initial(blocks)
    seen = first.select("*", *(f.alias(n) for n, f in _figures(whole).items()))
    weak = (F.col("section_count") <= 1) | (F.size(_errors()) > 0)
    rows = seen.select("doc_id", "seq", "blocks", F.col("heading").alias("old"), (weak & (F.col("heading") == "General")).alias("again"), F.explode("m").alias("m"))
    flat = rows.select("doc_id", "seq", "blocks", "old", "again", "m.*")
    section = Window.partitionBy("doc_id", "seq")
    w = section.orderBy("pos", "sub")
    flat = flat.withColumn("cut", F.col("again") & F.col("looks")).withColumn("part", F.sum(F.col("cut").cast("int")).over(w))
    flat = flat.withColumn("parts", F.max("part").over(section) - F.min("part").over(section))
    flat = flat.withColumn("heading", F.coalesce(F.last(F.when(F.col("cut") & (F.col("parts") > 0), display(F.col("body"))), ignorenulls=True).over(w), F.col("old")))
    flat = flat.withColumn("part", F.when(F.col("parts") > 0, F.col("part")).otherwise(0))
    found = _grouped(flat, ["seq", "part"], F.first("parts").alias("parts"))
    lines = F.array_join(_shown(F.col("m"), F.col("parts") > 0), "\n")
    # lines of their own normal form need no more than their empty ones brought together
    found = found.withColumn("content", F.when(F.col("parts") > 0, text.normalize_lines(lines)).otherwise(text.strip(F.regexp_replace(lines, r"\n{3,}", "\n\n"))))
    once = F.row_number().over(section.orderBy("part")) == 1
    found = found.withColumn("splits", F.when(once, F.col("parts")).otherwise(0)).withColumn("splits", F.sum("splits").over(whole))
    final = _without_empty(found, ["seq", "part"], F.col("content") == "")
    if between is not None:
        members = F.transform("m", lambda m: F.struct(m["page_number"].alias("page_number"), m["block_id"].alias("block_id"), m["looks"].alias("looks")))
        final = between(final.select("doc_id", "seq", "part", "heading", "blocks", "content", "splits", members.alias("m")))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq", "part"))
    sections = final.select("doc_id", nth.alias("section_seq"), "heading", "content", F.array_distinct("m.page_number").alias("source_pages"), F.col("m.block_id").alias("block_ids"))
    per = final.groupBy("doc_id").agg(*(f.alias(n) for n, f in _figures().items()), F.max("splits").cast("int").alias("recovered_section_splits"))
    documents = blocks.select("doc_id").distinct()
    diagnostics = documents.join(per, "doc_id", "left").withColumn("section_count", F.coalesce("section_count", F.lit(0))).withColumn("general_block_ratio", F.coalesce("general_block_ratio", F.lit(0.0)))
    diagnostics = diagnostics.select("doc_id", "section_count", "general_block_ratio", _errors().alias("possible_errors"), F.coalesce("recovered_section_splits", F.lit(0)).alias("recovered_section_splits"))
    return sections, diagnostics

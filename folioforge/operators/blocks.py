"""Blocks of text: reading order, merging of fragments, labels.

raw blocks: doc_id, block_id, text, page_number, x0, y0, x1, y1 (the box is null as a whole, or not at all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import text, vocab

LABELS = ("section_heading", "skills_line", "contact_line", "bullet", "date", "location", "heading", "paragraph", "other")


def from_lines(docs: DataFrame, top: float = 14.0, left: float = 72.0, boxes: bool = True) -> DataFrame:
    """Every non-empty line of a text as a raw block, laid out down one page unless boxes is false."""
    lines = docs.select("doc_id", F.posexplode(F.split(text.normalize_lines("text"), "\n")).alias("i", "line")).where("line <> ''")
    own = [F.lit(left), F.col("i") * top, F.lit(left) + F.length("line") * 6.0, F.col("i") * top + 12.0] if boxes else [F.lit(None).cast("double")] * 4
    return lines.select("doc_id", F.format_string("raw-1-%d", "i").alias("block_id"), F.col("line").alias("text"), F.lit(1).alias("page_number"), *(c.alias(n) for c, n in zip(own, ("x0", "y0", "x1", "y1"), strict=True)))


def from_html(pages: DataFrame) -> DataFrame:
    """Headings, paragraphs, list items and divisions of raw HTML as raw blocks without boxes."""
    body = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style|head)\b.*?</\1>|<!--.*?-->", " ")
    marked = F.regexp_replace(body, r"(?i)<li\b[^>]*>", "\n• ")
    marked = F.regexp_replace(marked, r"(?i)</?(h[1-6]|p|div|br|tr|ul|ol|table|section|article|nav|body|html)\b[^>]*>", "\n")
    plain = F.regexp_replace(marked, r"<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return from_lines(pages.select(F.col("page_id").alias("doc_id"), plain.alias("text")), boxes=False)


def in_order(raw: DataFrame) -> DataFrame:
    """Adds pos: reading order within the document, from 1."""
    key = ["page_number", F.bround(F.coalesce("y0", F.lit(0.0)), 2), F.bround(F.coalesce("x0", F.lit(0.0)), 2), "block_id"]
    return raw.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy(*key)))


def _bullet(t: Column) -> Column:
    return (t != "") & F.substring(t, 1, 1).isin(*vocab.BULLETS)


def _candidate(t: Column) -> Column:
    return F.regexp_replace(text.lower(F.regexp_replace(t, r":+\z", "")), r"(?U)\s+", " ")


def _stands_alone(t: Column, c: Column) -> Column:
    """A heading by itself: a known one, or up to four words without lower case. c: _candidate(t)."""
    return (t != "") & ~t.contains("\n") & (c.isin(*vocab.MERGE_HEADINGS) | ((text.words(c) <= 4) & text.is_upper(t) & ~c.isin(*vocab.NOT_HEADINGS)))


#: Headings have no more words; the colon of one may stand alone.
_MOST_WORDS = max(4, *(len(h.split()) for h in vocab.MERGE_HEADINGS)) + 1
#: Blocks of so many words may go on the line before; more aren't told apart.
_TOLD_WORDS = 14


def merge(raw: DataFrame) -> DataFrame:
    """Fragments merged to logical blocks: doc_id, pos, block_id, page_number, box, text, original_text, source_block_ids, source_texts, inferred_kind.

    Whether a block joins the one before depends on both, and on one bit of the group so far: whether
    its head looks like a header line. A block either leaves that bit or sets it to a value that
    doesn't depend on it, so the bit is the last value set: a window, no fold."""
    rows = in_order(raw).withColumn("t", text.normalize_lines("text"))
    rows = rows.withColumn("n_words", text.words_to(F.col("t"), _TOLD_WORDS)).withColumn("c", F.when(F.col("n_words") <= _MOST_WORDS, _candidate(F.col("t"))))
    t, w = F.col("t"), Window.partitionBy("doc_id").orderBy("pos")
    rows = rows.select(
        "*",
        _bullet(t).alias("bullet"),
        F.coalesce(F.col("c").isin(*vocab.MERGE_HEADINGS), F.lit(False)).alias("heading"),
        (F.col("c").isNotNull() & _stands_alone(t, F.col("c"))).alias("alone"),
        (t.endswith(".") | t.endswith("!") | t.endswith("?") | t.endswith(";") | t.endswith(":")).alias("stop"),
        ((t != "") & (F.col("n_words") <= 5) & ~_bullet(t)).alias("header"),
        t.rlike(r"(?U)^\p{Ll}").alias("lower"),
        t.rlike(r"(?U)^[\d(\[/&]").alias("tail"),
    )
    before = {c: F.lag(c).over(w).alias(f"p_{c}") for c in ("page_number", "x0", "y0", "x1", "y1", "t", "bullet", "heading", "stop")}
    rows = rows.select("*", *before.values())
    gap, same = F.col("y0") - F.col("p_y1"), F.abs(F.col("x0") - F.col("p_x0")) <= 8
    width = F.abs((F.col("x1") - F.col("x0")) - (F.col("p_x1") - F.col("p_x0"))) <= 80
    indent = (F.col("x0") >= F.col("p_x0")) & (F.col("x0") - F.col("p_x0") <= 48)
    runs_on = (F.col("p_t") != "") & (t != "") & (F.col("p_bullet") | (~F.col("p_stop") & F.col("lower")))
    wraps = (F.col("p_t") != "") & (t != "") & ~F.col("bullet") & (gap <= 28) & (same | indent) & ~F.col("alone")
    wraps &= F.col("lower") | F.col("tail") | ~F.col("p_stop") | (F.col("n_words") <= _TOLD_WORDS)
    can = F.col("p_page_number").isNotNull() & (F.col("p_page_number") == F.col("page_number")) & ~F.col("alone")
    bare = F.col("x0").isNull() | F.col("p_x0").isNull()

    def joins(under_header: Column) -> Column:
        last = F.when(F.col("p_bullet"), wraps).when(F.col("p_heading"), F.lit(False)).otherwise(under_header)
        return F.coalesce(can & F.when(bare, runs_on).otherwise(last), F.lit(False))

    plain = (gap <= 18) & ~F.col("p_stop") & ((same & width) | indent | runs_on)
    rows = rows.withColumn("m1", joins((gap <= 10) & same)).withColumn("m0", joins(plain))
    m0, m1, h = F.col("m0"), F.col("m1"), F.col("header")
    fixed = F.when(~m0 & ~m1, h).when(~m0 & m1 & h, F.lit(True)).when(m0 & ~m1 & ~h, F.lit(False))
    rows = rows.withColumn("fixed", fixed)
    bit = F.last("fixed", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("joined", F.when(F.coalesce(bit, F.lit(False)), m1).otherwise(m0))
    rows = rows.withColumn("grp", F.sum((~F.col("joined")).cast("int")).over(w) - 1)
    members = F.array_sort(F.collect_list(F.struct("pos", "t", "text", "block_id", "bullet", "header")))
    groups = rows.groupBy("doc_id", "grp").agg(
        F.min("page_number").alias("page_number"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), members.alias("m")
    )
    head = F.col("m")[0]
    between = F.when(~head["bullet"] & head["header"], F.lit(" | ")).otherwise(F.lit(" "))
    groups = groups.withColumn("body", F.call_function("array_join", F.col("m.t"), between)).withColumn("body", text.normalize_lines("body"))
    return groups.select(
        "doc_id",
        F.col("grp").cast("int").alias("pos"),
        F.format_string("norm-%d-%d", "page_number", "grp").alias("block_id"),
        "page_number", "x0", "y0", "x1", "y1",
        F.col("body").alias("text"),
        F.array_join("m.text", "\n").alias("original_text"),
        F.col("m.block_id").alias("source_block_ids"),
        F.col("m.text").alias("source_texts"),
        kind(F.col("body")).alias("inferred_kind"),
    )


def kind(t: Column, capital: str = r"\p{Lu}") -> Column:
    """Kind of a merged block by its text; a heading has a capital letter."""
    many = t.rlike(r"(?U)\S\s+\S+\s+\S+\s+\S")
    return F.when(_bullet(t), "bullet").when(t.contains("|"), "table").when(many, "paragraph").when(text.has_upper_only(t, capital), "heading").otherwise("other")


def has_contact(t: Column) -> Column:
    return (t.contains("@") & t.rlike("(?U)" + vocab.EMAIL)) | t.rlike("(?U)" + vocab.PHONE) | t.rlike("(?iU)" + vocab.URL_WORD)


def label(t: Column, index: Column, x0: Column, y0: Column) -> Column:
    """Semantic label of a block; index counts the document's blocks from 0. The first rule that holds wins.

    t is normalised: blanks and newlines are its only white space."""
    marked = t.rlike("[|•,][^|•,]*[|•,]")
    top = F.coalesce(y0 < 160, F.lit(False)) | (index <= 2)
    left = F.coalesce(x0 < 120, F.lit(False))

    def told(s: Column) -> Column:
        n, low, contact = s["n"], s["low"], s["contact"]
        shown = ((n <= 6) & text.is_upper(t)) | ((n <= 4) & text.is_title(t)) | (left & (n <= 4) & t.endswith(":")) | low.isin(*vocab.LABEL_HEADINGS)
        return (
            F.when(t == "", "other")
            .when(F.regexp_replace(low, "[ \n]+", " ").isin(*vocab.LABEL_HEADINGS), "section_heading")
            .when(s["marked"] & ~contact, "skills_line")
            .when(top & contact, "contact_line")
            .when(F.substring(t, 1, 1).isin(*vocab.BULLETS), "bullet")
            .when((n <= 8) & t.rlike("(?iU)" + vocab.DATE_WORD), "date")
            .when((n <= 6) & t.rlike("(?iU)" + vocab.PLACE_WORD), "location")
            .when((n <= 8) & shown, "heading")
            .when(n >= 4, "paragraph")
            .otherwise("other")
        )

    # contacts decide where the marks or the place let them alone
    def read(n: Column) -> Column:
        return text.let(F.struct(n.alias("n"), ((n <= 20) & marked).alias("marked")), looked)

    def looked(s: Column) -> Column:
        # no heading has more than eight words
        low = F.when(s["n"] <= 8, F.lower(F.regexp_replace(t, r":+\z", ""))).otherwise("")
        return text.let(F.struct(s["n"].alias("n"), s["marked"].alias("marked"), low.alias("low"), F.when(top | s["marked"], has_contact(t)).otherwise(False).alias("contact")), told)

    return text.let(text.words_to(t, 20), read)


HINTS = {"section_heading": "known_section_heading", "skills_line": "skills_delimiter_pattern", "contact_line": "contact_pattern", "bullet": "bullet_marker", "date": "date_pattern", "location": "location_pattern", "heading": "visual_heading", "paragraph": "paragraph_length"}


def classify(blocks: DataFrame) -> DataFrame:
    """Adds label and hints to merged blocks (pos counts from 0 in each document)."""
    out = blocks.withColumn("_t", text.normalize_lines("text"))
    out = out.withColumn("label", label(F.col("_t"), F.col("pos"), F.col("x0"), F.col("y0")))
    hint = F.create_map(*(F.lit(x) for kv in HINTS.items() for x in kv))
    return out.withColumn("hints", F.array_compact(F.array(hint[F.col("label")]))).drop("_t")


def suspicions(t: Column, lab: Column) -> Column:
    """Reasons, in order, why a block's text looks broken."""

    def told(s: Column) -> Column:
        t, lab = s["t"], s["lab"]
        token = ~t.contains(" ") & t.rlike(r"(?U)\d") & ~t.rlike(r"(?U)^\p{L}+\z") & (text.words(t) == 1)
        pipes = F.length(t) - F.length(F.replace(t, F.lit("|"), F.lit("")))
        reasons = F.array(
            F.when((F.length(t) <= 2) & ~lab.isin("date", "location"), "very_short_text"),
            F.when(token, "token_like_fragment"),
            F.when((F.length(t) <= 12) & t.rlike(vocab.NOISE), "layout_noise_fragment"),
            F.when((pipes >= 3) & ~lab.isin("contact_line", "skills_line"), "delimiter_heavy_text"),
        )
        return F.when(t == "", F.array(F.lit("empty_text"))).otherwise(F.array_compact(reasons))

    return text.let(F.struct(t.alias("t"), lab.alias("lab")), told)


def select_pages(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """(doc_id, page_number, extractor, text, block_count): the better extractor's page, or document if their page counts differ; ties go to the primary."""
    def scored(pages: DataFrame, name: str) -> DataFrame:
        own = pages.select("doc_id", "page_number", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("block_count", F.lit(0)).alias("block_count"))
        score = F.length("text") + 20 * F.col("block_count")
        w = Window.partitionBy("doc_id")
        return own.withColumn("score", score).withColumn("pages", F.count(F.lit(1)).over(w)).withColumn("total", F.sum("score").over(w)).withColumn("nth", F.row_number().over(w.orderBy("page_number"))).withColumn("extractor", F.lit(name))

    a, b = scored(primary, "primary"), scored(fallback, "fallback")
    totals = a.select("doc_id", F.col("pages").alias("pa"), F.col("total").alias("ta")).distinct().join(b.select("doc_id", F.col("pages").alias("pb"), F.col("total").alias("tb")).distinct(), "doc_id", "full")
    rival = b.select("doc_id", "nth", F.col("score").alias("rival"))
    keep_a = a.join(totals, "doc_id").join(rival, ["doc_id", "nth"], "left")
    keep_a = keep_a.where(F.when(F.col("pa") == F.col("pb"), ~(F.coalesce("rival", F.lit(-1)) > F.col("score"))).otherwise(~(F.coalesce("tb", F.lit(-1)) > F.col("ta"))))
    mine = a.select("doc_id", "nth", F.col("score").alias("rival"))
    keep_b = b.join(totals, "doc_id").join(mine, ["doc_id", "nth"], "left")
    keep_b = keep_b.where(F.when(F.col("pa") == F.col("pb"), F.col("score") > F.coalesce("rival", F.lit(-1))).otherwise(F.col("tb") > F.coalesce("ta", F.lit(-1))))
    names = ["doc_id", "page_number", "extractor", "text", "block_count"]
    return keep_a.select(*names).unionByName(keep_b.select(*names))


def words_to_lines(words: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """Words (doc_id, page_number, text, x0, top, x1, bottom) to line blocks.

    A word stays on the line while its top is near that of the line's first word, so lines are
    found by a fold over the page's words."""
    w = F.array_sort(F.collect_list(F.struct("top", "x0", "text", "x1", "bottom")))
    page = words.groupBy("doc_id", "page_number").agg(w.alias("w"))
    start = F.struct(F.lit(-1).alias("n"), F.lit(None).cast("double").alias("top"), F.array().cast("array<int>").alias("of"))

    def step(a: Column, x: Column) -> Column:
        stays = F.coalesce(F.abs(x["top"] - a["top"]) <= tolerance, F.lit(False))
        n = F.when(stays, a["n"]).otherwise(a["n"] + 1)
        return F.struct(n.alias("n"), F.when(stays, a["top"]).otherwise(x["top"].cast("double")).alias("top"), F.array_append(a["of"], n).alias("of"))

    page = page.withColumn("line", F.aggregate("w", start, step, lambda a: a["of"]))
    rows = page.select("doc_id", "page_number", F.posexplode("w").alias("i", "x"), "line").select("doc_id", "page_number", F.element_at("line", F.col("i") + 1).alias("line"), "x.*")
    groups = rows.groupBy("doc_id", "page_number", "line").agg(
        F.array_sort(F.collect_list(F.struct("x0", "top", "text"))).alias("m"), F.min("x0").alias("left"), F.min("top").alias("y0"), F.max("x1").alias("x1"), F.max("bottom").alias("y1")
    )
    body = F.array_join("m.text", " ")
    return groups.where(text.normalize_lines(body) != "").select("doc_id", F.format_string("raw-%d-%d", "page_number", "line").alias("block_id"), body.alias("text"), "page_number", F.col("left").alias("x0"), "y0", "x1", "y1")

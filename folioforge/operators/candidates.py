"""Candidates: facts that a document's sections and blocks may hold.

A document is one row: doc_id, full_text, sections (array of struct heading, content, block_ids),
blocks (array of struct block_id, label, text, in order) and diagnostics columns. All steps are
array functions within the row, so no step but the assembly of rows shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import arrays, text, vocab

_ALIASES = {k: v for k, v in vocab.SECTION_ALIASES.items() if k not in vocab.COMPOSITE_ALIASES}


def document_rows(full_text: DataFrame, sections: DataFrame, semantic: DataFrame) -> DataFrame:
    """One row per document from full_text (doc_id, full_text), sections and labelled blocks."""
    s = F.array_sort(F.collect_list(F.struct("section_seq", "heading", "content", "block_ids")))
    b = F.array_sort(F.collect_list(F.struct("pos", "block_id", "label", "text")))
    return full_text.join(sections.groupBy("doc_id").agg(s.alias("sections")), "doc_id", "left").join(semantic.groupBy("doc_id").agg(b.alias("blocks")), "doc_id", "left")


def section_name(x: Column) -> Column:
    """Canonical name of a section, or null for General and unknown ones."""
    key = F.regexp_replace(F.lower(F.regexp_replace(text.strip(text.normalize_lines(x)), r":+\z", "")), r"(?U)\s+", " ")
    names = F.expr("map(" + ", ".join(f"'{v}'" for kv in _ALIASES.items() for v in kv) + ")")
    return F.when(key == "general", F.lit(None)).otherwise(names[key])


def merge_sections(docs: DataFrame) -> DataFrame:
    """Adds named (array of struct name, text, blocks, in the order of first sight) and uncategorized_text."""
    parts = F.transform(
        F.coalesce("sections", F.array()), lambda s: F.struct(section_name(s["heading"]).alias("name"), text.normalize_lines(s["content"]).alias("t"), s["block_ids"].alias("ids"))
    )
    rows = docs.withColumn("_p", parts)
    order = F.array_distinct(F.filter(F.transform("_p", lambda p: p["name"]), lambda n: n.isNotNull()))

    def named(n: Column) -> Column:
        return text.let(F.filter("_p", lambda p: p["name"] == n), lambda own: section(n, own))

    def section(n: Column, own: Column) -> Column:
        body = text.normalize_lines(F.array_join(F.filter(F.transform(own, lambda p: p["t"]), lambda t: t != ""), "\n\n"))
        ids = F.flatten(F.transform(own, lambda p: p["ids"]))
        found = F.flatten(F.transform(ids, lambda i: F.filter("blocks", lambda b: (b["block_id"] == i) & (b["label"] != "section_heading"))))
        return F.struct(n.alias("name"), body.alias("text"), found.alias("blocks"))

    rest = F.filter(F.transform(F.filter("_p", lambda p: p["name"].isNull()), lambda p: p["t"]), lambda t: t != "")
    return rows.withColumn("named", F.transform(order, named)).withColumn("uncategorized_text", text.normalize_lines(F.array_join(rest, "\n\n"))).drop("_p")


def body(name: str) -> Column:
    """Text of a named section, empty if there is none."""
    return F.coalesce(F.get(F.filter("named", lambda s: s["name"] == name), F.lit(0))["text"], F.lit(""))


def members(name: str) -> Column:
    return F.coalesce(F.get(F.filter("named", lambda s: s["name"] == name), F.lit(0))["blocks"], F.array().cast("array<struct<pos:int,block_id:string,label:string,text:string>>"))


def _mail_or_phone(t: Column) -> Column:
    return t.rlike("(?U)" + vocab.EMAIL) | t.rlike("(?U)" + vocab.PHONE)


def _all(t: Column, pattern: str, flags: str = "(?U)") -> Column:
    return F.regexp_extract_all(t, F.lit(flags + pattern), F.lit(0))


def contacts(docs: DataFrame) -> DataFrame:
    """Adds contact_candidates: name, email, phone, location, linkedin, github."""
    blocks = F.coalesce("blocks", F.array().cast("array<struct<pos:int,block_id:string,label:string,text:string>>"))
    head = F.filter(F.slice(blocks, 1, 6), lambda b: b["label"].isin("contact_line", "heading"))
    lines = F.filter(blocks, lambda b: b["label"] == "contact_line")
    pool = F.concat(
        F.filter(F.array(body("Header"), F.col("uncategorized_text")), lambda t: t != ""),
        F.transform(head, lambda b: b["text"]),
        F.transform(lines, lambda b: b["text"]),
        F.array(F.substring(text.col("full_text"), 1, 1200)),
    )
    rows = docs.withColumn("_pool", F.transform(pool, text.normalize_lines))

    def every(f) -> Column:
        return arrays.dedupe_lines(F.flatten(F.transform("_pool", f)))

    def site(t: Column, pattern: str, word: str) -> Column:
        urls = _all(t, pattern, "(?iU)")
        return F.when(F.size(urls) > 0, urls).when(t.rlike(rf"(?iU)\b{word}\b"), F.array(t)).otherwise(F.array().cast("array<string>"))

    names = every(lambda t: F.filter(F.transform(text.split_lines(t), text.normalize_lines), _name_like))
    return rows.withColumn(
        "contact_candidates",
        F.struct(
            titled(names).alias("name"),
            every(lambda t: _all(t, vocab.EMAIL)).alias("email"),
            every(lambda t: F.transform(_all(t, vocab.PHONE), text.strip)).alias("phone"),
            every(lambda t: F.filter(text.split_candidates(t), lambda p: text.has_any(F.lower(p), vocab.CONTACT_PLACES))).alias("location"),
            every(lambda t: site(t, vocab.LINKEDIN_URL, "linkedin")).alias("linkedin"),
            every(lambda t: site(t, vocab.GITHUB_URL, "github")).alias("github"),
        ),
    ).drop("_pool")


def _name_like(t: Column) -> Column:
    n = text.words(t)
    return (t != "") & ~_mail_or_phone(t) & (n >= 2) & (n <= 4) & (text.is_title(t) | text.is_upper(t))


def titled(names: Column) -> Column:
    """Names with those in capitals turned to title case; equal names once."""
    return arrays.dedupe_lines(F.transform(names, lambda x: F.when(text.is_title(x), x).otherwise(text.title(x))))


def is_skill(t: Column) -> Column:
    low = F.lower(t)
    bad = _mail_or_phone(t) | low.startswith("languages:") | low.startswith("certifications:") | low.isin(*vocab.LANGUAGE_NAMES) | text.has_any(low, vocab.NO_SKILL_WORDS)
    return (t != "") & (F.length(t) <= 80) & ~bad & (text.words(t) <= 8)


def is_dense(t: Column) -> Column:
    """Whether a paragraph is a list of skills."""
    low = F.lower(text.normalize_lines(t))
    opens = F.lit(False)
    for o in vocab.DENSE_SKILL_OPENERS:
        opens = opens | low.startswith(o)
    return (F.length(low) - F.length(F.replace(low, F.lit("|"), F.lit(""))) >= 2) | opens


def skills() -> Column:
    own = members("Skills")
    texts = F.concat(
        F.filter(F.array(body("Skills")), lambda t: t != ""),
        F.transform(F.filter(own, lambda b: b["label"] == "skills_line"), lambda b: b["text"]),
        F.transform(F.filter(own, lambda b: (b["label"] == "paragraph") & is_dense(b["text"])), lambda b: b["text"]),
    )
    return arrays.dedupe_lines(F.filter(F.flatten(F.transform(texts, text.split_candidates)), is_skill))


def languages() -> Column:
    said = F.transform(F.filter(F.coalesce("blocks", F.array()), lambda b: F.lower(text.normalize_lines(b["text"])).contains("language")), lambda b: b["text"])
    texts = F.concat(F.filter(F.array(body("Languages"), body("Additional Information")), lambda t: t != ""), said)

    def found(p: Column) -> Column:
        low = F.lower(p)
        label = F.substring_index(low, ":", 1) == "languages"
        rest = F.when(p.contains(":"), p.substr(F.length(F.substring_index(p, ":", 1)) + 2, F.length(p))).otherwise(p)
        none = F.array().cast("array<string>")
        return F.when(label, text.split_candidates(rest)).when(low.isin(*vocab.LANGUAGE_NAMES), F.array(p)).otherwise(none)

    return arrays.dedupe_lines(F.flatten(F.transform(F.flatten(F.transform(texts, text.split_candidates)), found)))


def clean_chunk(x: Column, normalize=text.normalize_lines, prefix: str = vocab.ADAPTER_PREFIX) -> Column:
    """A supplemental chunk without bullet, label and bleed; empty if under three words are left."""
    t = F.regexp_replace(normalize(x), r"^[•●▪·-]\s*", "")
    t = text.strip_any(F.regexp_replace(t, "(?iU)" + prefix, ""), " ,;|")
    t = F.regexp_replace(t, r"(?iU)^publication(?:\s*\([^)]*\))?\s*:\s*", "")
    t = text.strip_any(F.regexp_replace(t, "(?iU)" + vocab.CHUNK_BLEED, ""), " ,;|")
    return text.let(t, lambda s: F.when(text.words(s) < 3, F.lit("")).otherwise(s))


def inline_parts(x: Column, dash: bool) -> Column:
    """Bullet parts of a text, or its lines, split again at bullets within."""
    parts = text.let(text.bullets(x, dash), lambda own: F.when(F.size(own) > 1, own).otherwise(text.nonempty(text.split_lines(x))))
    return F.flatten(F.transform(parts, lambda p: text.nonempty(F.split(p, r"(?U)\s+[•●▪·]\s+"))))


def soft_skills() -> Column:
    parts = F.transform(inline_parts(body("Skills"), True), lambda p: text.trim_label_tail(clean_chunk(p)))
    labelled = F.filter(parts, lambda p: p.contains(":") & text.strip(F.lower(F.substring_index(p, ":", 1))).isin(*vocab.SOFT_SKILL_LABELS))
    return arrays.dedupe_lines(labelled)


def adapter_class(raw: Column, section: Column) -> Column:
    """Class of a chunk at extraction: there are no awards, and anything of Achievements is one."""
    low, c = F.lower(raw), vocab.SUPPLEMENTAL
    return (
        F.when(text.has_any(low, c["publications"]), "publications")
        .when(text.has_any(low, c["activities"]), "activities")
        .when((F.lower(section) == "achievements") | text.has_any(low, c["achievements"]), "achievements")
    )


def recovery_class(raw: Column, section: Column) -> Column:
    """Class of a chunk at recovery: awards come second, the section's name last."""
    low = F.lower(raw)
    out = F.when(F.lit(False), F.lit(""))
    for name, words in vocab.SUPPLEMENTAL.items():
        out = out.when(text.has_any(low, words), name)
    return out.when(F.lower(section) == "achievements", "achievements")


def chunks(classify, normalize, prefix: str) -> Column:
    """Supplemental chunks (raw, cleaned, section) of the Achievements, Additional Information, Education and Skills sections."""

    def of(name: str) -> Column:
        t = text.strip(body(name))
        parts = text.let(text.bullets(t, True), lambda own: F.when(F.size(own) > 1, own).otherwise(text.nonempty(F.split(t, r"\n\s*\n"))))
        return F.transform(parts, lambda p: F.struct(normalize(p).alias("raw"), clean_chunk(p, normalize, prefix).alias("cleaned"), F.lit(name).alias("section")))

    low = F.lower(normalize(body("Education")))
    lines = F.filter(F.transform(text.split_lines(body("Education")), normalize), lambda p: (p != "") & F.coalesce(classify(p, F.lit("Education")) == "publications", F.lit(False)))
    published = F.when(text.has_any(low, vocab.SUPPLEMENTAL_EDUCATION), F.transform(lines, lambda p: F.struct(p.alias("raw"), clean_chunk(p, normalize, prefix).alias("cleaned"), F.lit("Education").alias("section"))))
    tail = text.strip(F.regexp_extract(body("Skills"), "(?isU)" + vocab.VOLUNTEERING, 1))
    rows = F.filter(F.transform(text.split_lines(tail), normalize), lambda p: p != "")
    dated = F.transform(rows, lambda p: F.struct(p.alias("line"), p.rlike("(?iU)" + vocab.DATED_LINE).alias("dated")))

    def helped(dated: Column, x: Column, i: Column) -> Column:
        # the last dated line before this one is its context
        context = F.filter(F.slice(dated, F.lit(1), i), lambda y: y["dated"])
        last = F.coalesce(F.get(context, F.size(context) - 1)["line"], F.lit(""))
        taken = ~x["dated"] & (x["line"].rlike(r"^[\-•●▪·]") | F.coalesce(classify(x["line"], F.lit("Skills")) == "activities", F.lit(False)))
        raw = normalize(text.strip(F.concat(last, F.lit(" "), x["line"])))
        return F.when(taken, F.struct(raw.alias("raw"), clean_chunk(x["line"], normalize, prefix).alias("cleaned"), F.lit("Skills").alias("section")))

    none = F.array().cast("array<struct<raw:string,cleaned:string,section:string>>")
    found = F.concat(of("Achievements"), of("Additional Information"), F.coalesce(published, none), text.let(dated, lambda d: F.array_compact(F.transform(d, lambda x, i: helped(d, x, i)))))
    return arrays.dedupe(F.filter(found, lambda c: c["cleaned"] != ""), lambda c: F.lower(normalize(c["cleaned"])))


def classed_chunks() -> Column:
    """Supplemental chunks at extraction (cleaned, kind)."""
    return F.transform(chunks(adapter_class, text.normalize_lines, vocab.ADAPTER_PREFIX), lambda c: F.struct(c["cleaned"], adapter_class(c["raw"], c["section"]).alias("kind")))


def supplemental(kind: str, found: Column | str | None = None) -> Column:
    """Texts of one kind, of classed chunks that are at hand already if they are given."""
    own = F.filter(classed_chunks() if found is None else found, lambda c: F.coalesce(c["kind"] == kind, F.lit(False)))
    return arrays.dedupe_lines(F.transform(own, lambda c: c["cleaned"]))


def is_entry(t: Column, section: str) -> Column:
    """Project sections have subsections that are no projects."""
    if section != "Projects":
        return t != ""
    first = text.normalize_lines(F.when(t.contains("\n"), F.substring_index(t, "\n", 1)).otherwise(F.substring_index(t, " | ", 1)))
    low = text.strip_any(F.lower(first), ":")
    other = F.coalesce(section_name(first) != "Projects", F.lit(False))
    return (t != "") & ~other & ~low.isin(*vocab.NO_PROJECTS) & ~text.has_any(low, vocab.NO_PROJECT_WORDS)


def _hint_dates(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit("(?iU)" + vocab.DATE_HINT), F.lit(0))


def _entry(t: Column, section: str, dates: Column, heads: Column) -> Column:
    return F.struct(t.alias("text"), F.lit(section).alias("source_section"), F.struct(dates.alias("detected_dates"), heads.alias("possible_header_lines")).alias("hints"))


def entries(section: str) -> Column:
    """Entries of a section: a heading or date block begins a new one if the current one has text; without any, paragraphs."""
    own = F.filter(F.transform(members(section), lambda b: F.struct(b["label"].alias("label"), text.normalize_lines(b["text"]).alias("t"))), lambda b: b["t"] != "")

    def begins(own: Column) -> Column:
        return F.array_compact(F.transform(own, lambda b, i: F.when((i == 0) | b["label"].isin("heading", "date"), i)))

    def group(own: Column, begins: Column, s: Column, k: Column) -> Column:
        end = F.coalesce(F.get(begins, k + 1), F.size(own))
        return text.let(F.slice(own, s + 1, end - s), entry)

    def entry(part: Column) -> Column:
        dates = arrays.dedupe_lines(F.transform(F.filter(part, lambda b: b["label"] == "date"), lambda b: b["t"]))
        heads = arrays.dedupe_lines(F.transform(F.filter(part, lambda b: b["label"] == "heading"), lambda b: b["t"]))
        return _entry(text.normalize_lines(F.array_join(F.transform(part, lambda b: b["t"]), "\n")), section, dates, heads)

    none = F.array().cast("array<string>")
    grouped = text.let(own, lambda o: text.let(begins(o), lambda b: F.transform(b, lambda s, k: group(o, b, s, k))))
    found = F.filter(grouped, lambda e: is_entry(e["text"], section))
    loose = F.filter(F.transform(text.paragraphs(body(section)), lambda p: _entry(p, section, _hint_dates(p), none)), lambda e: is_entry(e["text"], section))
    return text.let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(loose))


def is_training(t: Column) -> Column:
    return text.has_any(F.lower(t), vocab.TRAINING_WORDS)


def trainings() -> Column:
    """Courses, and trainings named in Additional Information; a provider that ends a line of certifications belongs to the next."""
    lines = F.filter(F.transform(text.split_lines(body("Additional Information")), text.normalize_lines), lambda p: p != "")

    def rest(line: Column) -> Column:
        return F.when(line.contains(":"), line.substr(F.length(F.substring_index(line, ":", 1)) + 2, F.length(line))).otherwise("")

    def labelled(line: Column) -> Column:
        low, out = F.lower(line), F.lit(False)
        for label in vocab.TRAINING_LABELS:
            out = out | low.startswith(label)
        return out

    def provider(line: Column) -> Column:
        parts = text.split_candidates(rest(line))
        last = F.get(parts, F.size(parts) - 1)
        return F.when(F.lower(line).startswith("certifications:") & (F.lower(last) == "udemy"), last)

    def state(a: Column, line: Column) -> Column:
        # the provider that waits after each line: set by a line of certifications, used up by the next training
        used = a["waits"].isNotNull() & is_training(line)
        waits = F.when(used, F.lit(None).cast("string")).otherwise(F.coalesce(provider(line), a["waits"]))
        row = F.struct(line.alias("line"), F.when(used, a["waits"]).alias("by"))
        return F.struct(waits.alias("waits"), F.array_append(a["rows"], row).alias("rows"))

    start = F.struct(F.lit(None).cast("string").alias("waits"), F.array().cast("array<struct<line:string,by:string>>").alias("rows"))
    rows = F.aggregate(lines, start, state, lambda a: a["rows"])
    none = F.array().cast("array<string>")

    def found(r: Column) -> Column:
        by = r["by"]
        offered = F.filter(text.split_candidates(r["line"]), is_training)
        mine = F.transform(offered, lambda c: _entry(F.when(F.lower(c).startswith(F.lower(by)), c).otherwise(text.normalize_lines(F.concat(by, F.lit(" "), c))), "Courses", _hint_dates(c), none))
        named = labelled(r["line"]) & ~F.lower(r["line"]).startswith("certification")
        plain = F.transform(F.filter(text.split_candidates(rest(r["line"])), is_training), lambda c: _entry(c, "Courses", _hint_dates(c), none))
        return F.when(by.isNotNull(), mine).when(named, plain).otherwise(F.array().cast("array<struct<text:string,source_section:string,hints:struct<detected_dates:array<string>,possible_header_lines:array<string>>>>"))

    listed = F.concat(entries("Courses"), F.flatten(F.transform(rows, found)))
    return arrays.dedupe(listed, lambda e: F.lower(text.normalize_lines(e["text"])))


def certifications() -> Column:
    lines = F.filter(F.transform(text.split_lines(body("Additional Information")), text.normalize_lines), lambda p: F.lower(p).startswith("certifications:"))
    more = F.flatten(F.transform(lines, lambda p: text.split_candidates(p.substr(F.length(F.substring_index(p, ":", 1)) + 2, F.length(p)))))
    more = F.filter(more, lambda c: (F.lower(c) != "udemy") & ~is_training(c))
    return arrays.dedupe_lines(F.concat(text.split_candidates(body("Certifications")), more))


def flags() -> Column:
    """Diagnostics flags from fallback_used, possible_errors, general_block_ratio, recovered_section_splits and merged_block_count."""
    alias = text.has_any(F.lower(text.normalize_lines("uncategorized_text")), _ALIASES)
    mine = F.array_compact(
        F.array(
            F.when(F.col("general_block_ratio") >= 0.3, "high_general_block_ratio"),
            F.when(F.col("recovered_section_splits") > 0, "suspicious_section_split"),
            F.when((F.col("merged_block_count") > 0) & alias, "normalization_overmerge_risk"),
            F.when((F.size("named") == 0) & (F.col("uncategorized_text") != ""), "document_collapsed_into_general"),
        )
    )
    first = F.array_compact(F.array(F.when(F.col("fallback_used"), F.lit("fallback_used"))))
    return arrays.dedupe_lines(F.concat(first, F.coalesce("possible_errors", F.array().cast("array<string>")), mine))


def source_metadata(path: Column, page_count: Column, extractor: Column, fallback: Column) -> Column:
    """File name, path, page count, extractor and whether the fallback ran."""
    return F.struct(
        F.element_at(F.split(path, "/"), -1).alias("file_name"), path.alias("source_path"), page_count.alias("page_count"), extractor.alias("extractor"), F.coalesce(fallback, F.lit(False)).alias("fallback_triggered")
    )


def build(docs: DataFrame) -> DataFrame:
    """The input of reconciliation: every candidate list of every document."""
    # chunks are found once for their three kinds
    rows = contacts(merge_sections(docs)).withColumn("_chunks", classed_chunks())
    filled = F.filter("named", lambda s: s["text"] != "")
    return rows.select(
        "doc_id",
        F.lit(vocab.CONTRACT_VERSION).alias("contract_version"),
        "full_text",
        F.transform(filled, lambda s: F.struct(s["name"].alias("name"), s["text"].alias("text"))).alias("canonical_sections"),
        "uncategorized_text", "contact_candidates",
        skills().alias("skill_candidates"),
        soft_skills().alias("soft_skill_candidates"),
        languages().alias("language_candidates"),
        entries("Experience").alias("experience_candidates"),
        entries("Projects").alias("project_candidates"),
        entries("Education").alias("education_candidates"),
        certifications().alias("certification_candidates"),
        trainings().alias("training_candidates"),
        supplemental("achievements", "_chunks").alias("achievement_candidates"),
        supplemental("activities", "_chunks").alias("activity_candidates"),
        supplemental("publications", "_chunks").alias("publication_candidates"),
        *([flags().alias("diagnostics_flags")] if "merged_block_count" in docs.columns else []),
        "named",
    )

"""Grounding of values in evidence, and singletons by precedence with a confidence.

A document is one row: full_text, uncategorized_text, canonical_sections (array of struct name,
text), contact_candidates, skill_candidates, language_candidates, certification_candidates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions import arrays, text, vocab

CONTACTS = ("name", "email", "phone", "location", "linkedin", "github")


def evidence() -> Column:
    """All evidence of a document as one text."""
    lists = [F.col(f"contact_candidates.{c}") for c in CONTACTS] + [F.col(c) for c in ("skill_candidates", "language_candidates", "certification_candidates")]
    parts = F.concat(F.array(text.col("full_text"), text.col("uncategorized_text")), F.transform("canonical_sections", lambda s: s["text"]), *(F.coalesce(x, F.array().cast("array<string>")) for x in lists))
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n")


def normal(kind: str, x: Column) -> Column:
    if kind == "phone":
        return text.normalize_phone(x)
    if kind == "url":
        return text.normalize_url(x)
    if kind == "location":
        return F.lower(text.join_places(x))  # in lower case again, so title case needn't be made first
    if kind in ("skill", "language", "certification"):
        return F.lower(text.normalize_skill(x))
    return F.lower(text.normalize_flat(x))


def sources(value: Column, kind: str = "text", parser: dict[str, Column] | None = None) -> Column:
    """Where a value is found: phase2_input (a candidate equals it), full_text (the evidence contains it), parser:<key> (a string or list of strings holds it)."""
    v = normal(kind, value)
    pools = {"skill": ["skill_candidates"], "language": ["language_candidates"], "certification": ["certification_candidates"]}
    names = [f"contact_candidates.{c}" for c in CONTACTS] if kind in ("email", "phone", "url", "location", "name") else pools.get(kind, [])
    held = F.lit(False)
    for n in names:
        held = held | F.exists(F.coalesce(F.col(n), F.array().cast("array<string>")), lambda c: normal(kind, c) == v)
    inside = (v != "") & normal("text" if kind == "skill" else kind, evidence()).contains(v)
    found = [F.when(held, "phase2_input"), F.when(inside, "full_text")]
    for key, p in (parser or {}).items():
        found.append(F.when(F.exists(p, lambda x: normal(kind, x) == v), f"parser:{key}"))
    return F.when(text.col(value) == "", F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*found)))


def is_email(v: Column) -> Column:
    return text.normalize_flat(v).rlike("(?U)^" + vocab.EMAIL + r"\z")


def is_phone(v: Column) -> Column:
    return F.length(F.regexp_replace(text.normalize_phone(v), r"(?U)\D", "")) >= 8


RULES = {
    "email": ("email", "text", is_email),
    "phone_number": ("phone", "phone", is_phone),
    "linkedin": ("linkedin", "url", lambda v: text.normalize_url(v).contains("linkedin")),
    "github": ("github", "url", lambda v: text.normalize_url(v).contains("github")),
}


def _field(value: Column, source: str, confidence: float, grounded: Column, note: str) -> Column:
    return F.struct(value.cast("string").alias("value"), F.lit(source).alias("source"), F.lit(confidence).alias("confidence"), grounded.alias("grounded"), F.array(F.lit(note)).alias("notes"))


def _none(notes: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("value"), F.lit("unresolved").alias("source"), F.lit(0.0).alias("confidence"), F.lit(False).alias("grounded"), notes.alias("notes"))


def _grounded(v: Column, kind: str, parser: dict[str, Column]) -> Column:
    return F.size(sources(v, kind, parser)) > 0


def name(parser_name: Column, optimizer_name: Column, parser: dict[str, Column]) -> Column:
    """struct(value, source, confidence, grounded, notes): the parser's name, else the first candidate, else the optimizer's if grounded."""
    p, o = text.normalize_flat(parser_name), text.normalize_flat(optimizer_name)
    first = F.get("contact_candidates.name", F.lit(0))
    ok = (o != "") & _grounded(o, "name", parser)
    rejected = F.when(o != "", F.array(F.lit("rejected ungrounded optimizer name"))).otherwise(F.array().cast("array<string>"))
    return (
        F.when(p != "", _field(p, "parser", 0.9, _grounded(p, "name", parser), "accepted parser name"))
        .when(first.isNotNull(), _field(first, "phase2_input", 0.88, F.lit(True), "accepted top Phase2Input name candidate"))
        .when(ok, _field(o, "optimizer", 0.7, F.lit(True), "accepted grounded optimizer name"))
        .otherwise(_none(rejected))
    )


def location(parser_value: Column, optimizer_value: Column, parser: dict[str, Column]) -> Column:
    p, o = text.normalize_location(parser_value), text.normalize_location(optimizer_value)
    first = F.get("contact_candidates.location", F.lit(0))
    rejected = F.when(o != "", F.array(F.lit("rejected ungrounded or over-specific optimizer location"))).otherwise(F.array().cast("array<string>"))
    return (
        F.when((p != "") & _grounded(p, "location", parser), _field(p, "parser", 0.86, F.lit(True), "accepted grounded parser location"))
        .when(first.isNotNull(), _field(text.normalize_location(first), "phase2_input", 0.84, F.lit(True), "accepted Phase2Input location candidate"))
        .when((o != "") & _grounded(o, "location", parser), _field(o, "optimizer", 0.72, F.lit(True), "accepted grounded optimizer location"))
        .otherwise(_none(rejected))
    )


def contact(field: str, parser_value: Column, optimizer_value: Column, parser: dict[str, Column]) -> Column:
    """Email, phone or profile link: the first valid candidate, else a valid parser value, else a valid grounded optimizer value."""
    pool, kind, valid = RULES[field]
    first = F.get(F.filter(F.coalesce(f"contact_candidates.{pool}", F.array().cast("array<string>")), valid), F.lit(0))
    p, o = text.normalize_flat(parser_value), text.normalize_flat(optimizer_value)
    ground_kind = "email" if field == "email" else kind
    where = sources(o, ground_kind, parser)
    good = F.struct(o.alias("value"), F.lit("optimizer").alias("source"), F.lit(0.74).alias("confidence"), F.lit(True).alias("grounded"), F.concat(F.array(F.lit(f"accepted grounded optimizer {field}")), where).alias("notes"))
    notes = F.array_compact(F.array(F.when(p != "", f"ignored malformed parser {field}"), F.when((o != "") & valid(o), f"rejected ungrounded optimizer {field}")))
    return (
        F.when(first.isNotNull(), _field(first, "phase2_input", 0.94, F.lit(True), f"accepted Phase2Input candidate for {field}"))
        .when((p != "") & valid(p), _field(p, "parser", 0.89, _grounded(p, ground_kind, parser), f"accepted parser value for {field}"))
        .when((o != "") & valid(o) & (F.size(where) > 0), good)
        .otherwise(_none(notes))
    )


def unique_valid(values: Column, field: str) -> Column:
    """Valid candidates of a contact field, one for each normal form."""
    _, kind, valid = RULES[field]
    return arrays.dedupe(F.filter(values, valid), lambda v: normal(kind, v) if kind != "text" else text.normalize_flat(v))

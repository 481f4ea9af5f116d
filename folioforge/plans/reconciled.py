"""Whole runs of reconciliation over the records of `derived`: its input, part by part, and what it makes of two payloads.

A record's sections and full text come from its notes; so do the payloads of the parser and the optimizer,
by the notes' sizes. Each query runs the plan that a user runs; the SQL puts the rules together anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import vocab
from folioforge.operators import candidates as C
from folioforge.plans import derived as D
from folioforge.plans import extraction as X
from folioforge.plans import queries as base
from folioforge.plans.derived import NOTES, notes
from folioforge.plans.queries import query

_flat, _lines = base._flat, base._lines
_ENTRIES = {"experience_candidates": "Experience", "project_candidates": "Projects", "education_candidates": "Education"}
_VALUES = ("skill_candidates", "soft_skill_candidates", "language_candidates", "certification_candidates")
_KINDS = {"achievement_candidates": "achievements", "activity_candidates": "activities", "publication_candidates": "publications"}
_CONTACTS = ("name", "email", "phone", "location", "linkedin", "github")


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input of reconciliation of every record."""
    no_blocks = F.array().cast("array<struct<pos:int,block_id:string,label:string,text:string>>")
    s = F.struct(F.col("id").alias("section_seq"), "heading", F.col("t").alias("content"), F.array().cast("array<string>").alias("block_ids"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "t"))), lambda x: x["t"]), "\n")
    rows = notes(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(s)).alias("sections"), F.max("size").alias("size"), F.sum("size").alias("total"), whole.alias("full_text"))
    total = F.col("total")
    rows = rows.withColumn("blocks", no_blocks).withColumn("fallback_used", F.col("size") > 49).withColumn("possible_errors", F.when(total % 4 == 0, F.array(F.lit("oversized_general_section"))).otherwise(F.array().cast("array<string>")))
    return C.build(rows.withColumn("general_block_ratio", (total % 10) / F.lit(10.0)).withColumn("recovered_section_splits", total % 3).withColumn("merged_block_count", total % 5))


# contacts come from what has no section and from the head of the whole text, in this order
_POOL = f"""SELECT doc_id, 0 AS k, {_lines('text')} AS t FROM ({D._MERGED}) WHERE name IS NULL AND text <> '' UNION ALL SELECT doc_id, 1, {_lines('substr(t, 1, 1200)')} FROM ({D._RECORDS})"""


def _pool_sql(values: str) -> str:
    return D._dedupe_sql(f"SELECT doc_id, k * 1000000 + i AS i, {_lines('v')} AS v FROM (SELECT doc_id, k, unnest(l) AS v, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, k, {values} AS l FROM ({_POOL})))")


def _site_sql(pattern: str, word: str) -> str:
    urls = f"regexp_extract_all(t, '(?i){pattern}')"
    return f"CASE WHEN len({urls}) > 0 THEN {urls} WHEN regexp_matches(t, '(?i)\\b{word}\\b') THEN [t] ELSE [] END"


_CONTACT_ROWS = {
    "name": f"SELECT doc_id, pos, CASE WHEN {D._TITLED.format(x='value')} THEN value ELSE {D._TITLE_WIDE.format(x='value')} END AS value FROM ({_pool_sql(f'list_filter({D._lines_of(chr(116))}, lambda p: {D._NAME_LIKE})')})",
    "email": _pool_sql(f"regexp_extract_all(t, '{base._EMAIL}')"),
    "phone": _pool_sql(f"regexp_extract_all(t, '{base._PHONE}')"),
    "location": _pool_sql(f"list_filter({D._split_sql('t')}, lambda p: {D._any('lower(p)', vocab.CONTACT_PLACES)})"),
    "linkedin": _pool_sql(_site_sql(vocab.LINKEDIN_URL, "linkedin")),
    "github": _pool_sql(_site_sql(vocab.GITHUB_URL, "github")),
}
_PARTS = [
    f"SELECT doc_id, 'canonical_sections' AS part, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, name || chr(10) || text AS value, '' AS dates FROM ({base.ORACLES['merged_sections']}) WHERE name IS NOT NULL AND text <> ''",
    f"SELECT doc_id, 'uncategorized_text', 0, coalesce(max(text) FILTER (name IS NULL), ''), '' FROM ({D._MERGED}) GROUP BY doc_id",
    f"SELECT doc_id, 'diagnostics_flags', 0, flags, '' FROM ({base.ORACLES['diagnostics_flags']})",
    *(f"SELECT doc_id, '{p}', pos, value, '' FROM ({base.ORACLES[q]})" for p, q in zip(_VALUES, ("skill_candidates", "soft_skill_candidates", "language_candidates", "certification_candidates"), strict=True)),
    *(f"SELECT doc_id, '{p}', pos, text, dates FROM ({base.ORACLES['entry_candidates']}) WHERE section = '{s}'" for p, s in _ENTRIES.items()),
    f"SELECT doc_id, 'training_candidates', pos, text, dates FROM ({base.ORACLES['training_candidates']})",
    *(f"SELECT doc_id, '{p}', pos, value, '' FROM ({base.ORACLES['supplemental_candidates']}) WHERE kind = '{k}'" for p, k in _KINDS.items()),
    *(f"SELECT doc_id, 'contact:{c}', pos, value, '' FROM ({sql})" for c, sql in _CONTACT_ROWS.items()),
]


@query(" UNION ALL ".join(_PARTS))
def reconciliation_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part of every record's input of reconciliation, a value a row."""
    none = F.lit("")

    def own(part: str, values: Column, value=lambda x: x, dates=lambda x: none) -> Column:
        return F.transform(values, lambda x, i: F.struct(F.lit(part).alias("part"), i.cast("long").alias("pos"), value(x).alias("value"), dates(x).alias("dates")))

    parts = [
        own("canonical_sections", F.col("canonical_sections"), lambda s: F.concat(s["name"], F.lit("\n"), s["text"])),
        own("uncategorized_text", F.array("uncategorized_text")),
        own("diagnostics_flags", F.array(F.array_join("diagnostics_flags", ";"))),
        *(own(p, F.col(p)) for p in (*_VALUES, *_KINDS)),
        *(own(p, F.col(p), lambda e: e["text"], lambda e: F.array_join(e["hints"]["detected_dates"], ";")) for p in (*_ENTRIES, "training_candidates")),
        *(own(f"contact:{c}", F.col(f"contact_candidates.{c}")) for c in _CONTACTS),
    ]
    return inputs(spark, sf_dir).select("doc_id", F.explode(F.concat(*parts)).alias("x")).select("doc_id", "x.*")


_LISTS = ("technical_skills", "soft_skills", "languages", "certifications")
_MORE = ("awards", "achievements", "activities", "publications")
_LINKS = ("linkedin", "github")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, parser, optimizer): payloads made of every record's notes; those of even size are the optimizer's."""
    size, at, t = F.col("size"), F.col("id"), F.col("t")
    own = size % 2 == 0
    entries = {
        "experience": F.struct(F.col("kind").alias("company_name"), F.col("name").alias("title"), F.when(size % 3 == 0, "2019 - 2022").otherwise("").alias("duration"), t.alias("description")),
        "projects": F.struct(F.col("name").alias("project_name"), t.alias("description"), F.split("kind", " ").alias("tools"), F.lit("").alias("duration")),
    }

    def listed(where: Column, value: Column | None = None) -> Column:
        value = t if value is None else value
        return F.transform(F.array_sort(F.collect_list(F.when(where, F.struct("id", value.alias("v"))))), lambda x: x["v"])

    def side(mine: Column, links: dict[str, Column], more: tuple[str, ...]) -> Column:
        lists = [listed(mine & (at % 4 == i)).alias(f) for i, f in enumerate(_LISTS)]
        lists += [listed(mine & (size > 40) & (at % 4 == i)).alias(f) for i, f in enumerate(more)]
        groups = [listed(mine & (at % 5 == i), e).alias(f) for i, (f, e) in enumerate(entries.items())]
        return F.to_json(F.struct(*lists, *groups, *(v.alias(f) for f, v in links.items())))

    # the optimizer names a link where a record has a large note; the parser's is the last note
    first = F.transform(F.array_sort(F.collect_list(F.when(size > 47, F.struct("id", "t")))), lambda x: x["t"])
    kept = F.get(first, F.lit(0))
    last = F.max_by("t", "id")
    return notes(spark, sf_dir).groupBy("doc_id").agg(side(~own, dict.fromkeys(_LINKS, last), ()).alias("parser"), side(own, dict.fromkeys(_LINKS, kept), _MORE).alias("optimizer"))


_KEY_SQL = {"technical_skills": base._skill_key_sql, "soft_skills": lambda v: f"lower(trim({_flat(v)}, ' ,;|'))", "languages": lambda v: f"lower(trim({_flat(v)}, ' ,;|'))", "certifications": D._cert_key_sql}
_CLEAN_SQL = {"technical_skills": D._clean_skill_sql, "soft_skills": D._clean_soft_sql, "languages": _flat, "certifications": D._clean_cert_sql}
_TEST_SQL = {"technical_skills": D._technical_sql, "soft_skills": D._soft_sql, "languages": D._language_sql, "certifications": D._cert_sql}
_DOTTED = f"CASE WHEN len({D._bullets_sql('body', False)}) > 1 THEN {D._bullets_sql('body', False)} ELSE {D._raw_lines('body')} END"
_INLINE_MARKS = "string_split_regex(q, '\\s+[•●▪·]\\s+')"
_SOURCE_SQL = {
    "technical_skills": f"SELECT doc_id, pos AS i, value AS v FROM ({base.ORACLES['skill_candidates']})",
    "soft_skills": D._listed(D._body_sql("Skills"), f"flatten(list_transform({_DOTTED}, lambda q: {D._nonempty(_INLINE_MARKS)}))"),
    "languages": f"SELECT doc_id, pos AS i, value AS v FROM ({base.ORACLES['language_candidates']})",
    "certifications": f"SELECT doc_id, pos AS i, value AS v FROM ({base.ORACLES['certification_candidates']})",
}


def _list_sql(field: str) -> str:
    """(doc_id, field, pos, value, added) of one list field."""
    at = _LISTS.index(field)

    def tested(rows: str, priority: int) -> str:
        return f"SELECT doc_id, {priority} AS priority, i, {_flat('c')} AS v FROM (SELECT doc_id, i, {_CLEAN_SQL[field]('v')} AS c FROM ({rows})) WHERE {_TEST_SQL[field]('c')}"

    kept = f"SELECT doc_id, 0 AS priority, id AS i, {_flat('t')} AS v FROM ({NOTES}) WHERE size % 2 = 0 AND id % 4 = {at}"
    # a payload's strings are in normal form, and none is empty
    parsed = f"SELECT doc_id, id AS i, {_flat('t')} AS v FROM ({NOTES}) WHERE size % 2 > 0 AND id % 4 = {at} AND {_flat('t')} <> ''"
    rows = f"SELECT *, {_KEY_SQL[field]('v')} AS key FROM ({kept} UNION ALL {tested(_SOURCE_SQL[field], 1)} UNION ALL {tested(parsed, 2)}) WHERE v <> ''"
    first = f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY doc_id, key ORDER BY priority, i) = 1"
    return f"SELECT doc_id, '{field}' AS field, row_number() OVER (PARTITION BY doc_id ORDER BY priority, i) - 1 AS pos, v AS value, priority > 0 AS added FROM ({first})"


def _clean_flat_sql(x: str) -> str:
    t = f"regexp_replace({_flat(x)}, '^[•●▪·-]\\s*', '')"
    t = f"trim(regexp_replace({t}, '(?i){vocab.RECOVERY_PREFIX}', ''), ' ,;|')"
    t = f"regexp_replace({t}, '(?i)^publication(?:\\s*\\([^)]*\\))?\\s*:\\s*', '')"
    return f"trim(regexp_replace({t}, '(?i){vocab.CHUNK_BLEED}', ''), ' ,;|')"


def _class_sql(x: str, section: str) -> str:
    whens = " ".join(f"WHEN {D._any(f'lower({x})', words)} THEN '{name}'" for name, words in vocab.SUPPLEMENTAL.items())
    return f"CASE {whens} WHEN {section} = 'Achievements' THEN 'achievements' END"


def _flat_lines(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex({x}, '\\r\\n|\\n'), lambda p: {_flat('p')}), lambda p: p <> '')"


def _section_chunks(name: str, at: int) -> str:
    own = D._strip("body")
    parts = f"CASE WHEN len({D._bullets_sql(own, True)}) > 1 THEN {D._bullets_sql(own, True)} ELSE {D._nonempty(f"string_split_regex({own}, '\\n\\s*\\n')")} END"
    return f"SELECT doc_id, {at} + i AS i, {_flat('v')} AS raw, v AS part, '{name}' AS section FROM ({D._listed(D._body_sql(name), parts)})"


_EDUCATED = f"(SELECT * FROM {D._body_sql('Education')} WHERE {D._any(f'lower({_flat(chr(98) + chr(111) + chr(100) + chr(121))})', vocab.SUPPLEMENTAL_EDUCATION)})"
_PUBLISHED = f"SELECT doc_id, 2000000 + i AS i, v AS raw, v AS part, 'Education' AS section FROM ({D._listed(_EDUCATED, _flat_lines('body'))}) WHERE {_class_sql('v', chr(39) + 'Education' + chr(39))} = 'publications'"
_TAIL = D._strip(f"regexp_extract(body, '(?is){vocab.VOLUNTEERING}', 1)")
_HELPED = f"""SELECT doc_id, 3000000 + i AS i, {_flat("coalesce(last_value(CASE WHEN dated THEN v END IGNORE NULLS) OVER b, '') || ' ' || v")} AS raw, v AS part, 'Skills' AS section, dated
FROM (SELECT *, regexp_matches(v, '(?i){vocab.DATED_LINE}') AS dated FROM ({D._listed(D._body_sql('Skills'), _flat_lines(_TAIL))})) WINDOW b AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
_CHUNKS = f"""SELECT * FROM (SELECT doc_id, i, raw, section, {D._short('c')} AS cleaned FROM (SELECT *, {_clean_flat_sql('part')} AS c FROM ({_section_chunks('Achievements', 0)} UNION ALL {_section_chunks('Additional Information', 1000000)} UNION ALL {_PUBLISHED}
UNION ALL SELECT doc_id, i, raw, part, section FROM ({_HELPED}) WHERE NOT dated AND (regexp_matches(part, '^[\\-•●▪·]') OR coalesce({_class_sql('part', chr(39) + 'Skills' + chr(39))} = 'activities', false))))) WHERE cleaned <> ''
QUALIFY row_number() OVER (PARTITION BY doc_id, lower({_flat('cleaned')}) ORDER BY i) = 1"""


def _more_sql() -> str:
    """(doc_id, field, pos, value, added) of the supplemental fields: what the optimizer has, then chunks it lacks."""
    names = "CASE id % 4 " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(_MORE)) + " END"
    have = f"SELECT doc_id, {names} AS field, id AS i, {_flat('t')} AS v, false AS added FROM ({NOTES}) WHERE size % 2 = 0 AND size > 40 AND {_flat('t')} <> ''"
    own = f"SELECT doc_id, {_class_sql('raw', 'section')} AS field, i, cleaned AS v, true AS added FROM ({_CHUNKS})"
    fresh = f"SELECT * FROM ({own}) o WHERE field IS NOT NULL AND {_flat('v')} <> '' AND NOT EXISTS (SELECT 1 FROM ({have}) h WHERE h.doc_id = o.doc_id AND h.field = o.field AND lower(h.v) = lower({_flat('o.v')}))"
    return f"SELECT doc_id, field, row_number() OVER (PARTITION BY doc_id, field ORDER BY added, i) - 1 AS pos, v AS value, added FROM ({have} UNION ALL {fresh})"


def _links_sql(field: str) -> str:
    """(doc_id, field, pos, value, added) of a profile link, where there is one."""
    ends = f"SELECT doc_id, coalesce(min_by(t, id) FILTER (size > 47), '') AS o, max_by(t, id) AS p FROM ({NOTES}) GROUP BY doc_id"
    hits = f"SELECT doc_id, min_by(value, pos) AS s FROM ({_CONTACT_ROWS[field]}) WHERE {D._social_sql(field, 'value')} GROUP BY doc_id"
    value = f"CASE WHEN {D._strip('o')} <> '' THEN o WHEN s IS NOT NULL THEN s WHEN {D._social_sql(field, 'p')} THEN {D._strip('p')} END"
    return f"SELECT doc_id, '{field}' AS field, 0 AS pos, {value} AS value, {D._strip('o')} = '' AS added FROM ({ends}) LEFT JOIN ({hits}) USING (doc_id) WHERE {value} <> ''"


@query(None)
def reconciled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every record's payloads become by its evidence, with the audit. Its lists are held by reconciled_lists, its grouped fields by tests."""
    return X.reconcile(inputs(spark, sf_dir), payloads(spark, sf_dir))


@query(" UNION ALL ".join([*map(_list_sql, _LISTS), f"SELECT * FROM ({_more_sql()})", *map(_links_sql, _LINKS)]))
def reconciled_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of every record's list fields, supplements and links after the whole run, and whether the audit calls them added."""
    lists, links = (*_LISTS, *_MORE), _LINKS
    rows = reconciled_records(spark, sf_dir).withColumn("d", F.from_json("data", ", ".join([*(f"{f} array<string>" for f in lists), *(f"{f} string" for f in links)])))

    def row(field: str, pos: Column, value: Column, added: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), pos.cast("long").alias("pos"), value.alias("value"), added.alias("added"))

    def values(f: str) -> Column:
        return F.transform(f"d.{f}", lambda v, i: row(f, i, v, F.array_contains("recovered_items", F.concat(F.lit(f"{f}:"), v))))

    found = [values(f) for f in lists]
    found += [F.array(row(f, F.lit(0), F.col(f"d.{f}"), F.array_contains("recovered_fields", F.lit(f)))) for f in links]
    return rows.select("doc_id", F.explode(F.concat(*found)).alias("x")).select("doc_id", "x.*").where("value <> '' AND value IS NOT NULL")

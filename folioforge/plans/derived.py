"""Queries of operators that need the vocabulary of records, over records made from whole tables.

The tables' own texts hold no headings, skills or grades, so each row of `part` gives one note: a
phrase chosen by its key, with the part's name in it. Twenty notes are a record; each note is also the
content of a section of it. Spark and SQL make the same notes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import arrays, text, vocab
from folioforge.operators import blocks as B
from folioforge.operators import candidates as C
from folioforge.operators import grounding as GR
from folioforge.operators import grouped as G
from folioforge.operators import lists as L
from folioforge.operators import quality as Q
from folioforge.operators import reports as R
from folioforge.operators import sections as S
from folioforge.plans import queries as base
from folioforge.plans.queries import query, table
from folioforge.sources import payloads as P

PHRASES = [
    "React.js", "Node.js, {}", "ASP.NET Core", "Fast API (certified)", "SQL / SQLite", "type script {}", "Tools: {}", "Python, Go", "working with {} daily", "REST services for {}",
    "teamwork", "languages", "AWS Certified {}", "CCNA Jan 2020 - Feb 2021", "Best Award 2020 {}", "Cisco Fundamentals of Cybersecurity", "worked on networks", "PMP, ", "English", "Native: Arabic",
    "ARABIC", "FR", "German (B2)", "• Teamwork", "Leadership: led {} well", "Time Management.", "Published {} at a conference", "Awarded 1st place for {}", "Member of the technical committee", "Founded {}",
    "Bachelor of {} | Cairo University | GPA: 3.4 | 2018 - 2022", "Master of Science, Specialization: {}", "Graduation Project Grade: (A+) {}", "project grade b", "{} course on Udemy", "Bootcamp: {}", "mail a.b@example.org", "+20 (100) 123-4567",
    "https://github.com/u{}", "linkedin.com/in/x", "github/{} page", "Jan 2020 – Present", "03/2021 - 05/2022", "- {}\n• first {}\n\n{} Cairo", "Cairo , Egypt, {}", "Languages: English, French", "certifications: CCNA | Udemy", "{}\nvolunteering\nmore {}", "{} EDUCATION &", "", "PHP | {} | SQL", "Skills:", "{}",
]
HEADINGS = ["Skills", "TECHNICAL SKILLS:", "Languages", "Certifications", "Courses", "Projects", "Experience", "Education & Certifications", "Achievements", "Additional Information", "General", "Odd & ends", "Education"]


def _quoted(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _chosen(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (at % len(values) + 1).cast("int"))


NOTES = f"""SELECT p_partkey AS id, p_partkey // 20 AS doc_id, replace(list_extract({_quoted(PHRASES)}, p_partkey % {len(PHRASES)} + 1), '{{}}', p_name) AS t,
list_extract({_quoted(HEADINGS)}, p_partkey * 7 % {len(HEADINGS)} + 1) AS heading, p_name AS name, p_type AS kind, p_size AS size, p_brand AS brand FROM part"""


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, doc_id, t, heading, name, kind, size, brand): one note of every part."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("id"), F.floor(k / 20).cast("long").alias("doc_id"), F.replace(_chosen(PHRASES, k), F.lit("{}"), F.col("p_name")).alias("t"),
        _chosen(HEADINGS, k * 7).alias("heading"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand"),
    )


# SQL pieces

_flat, _lines = base._flat, base._lines


def _strip(x: str) -> str:
    return base._STRIP.format(x=x)


def _any(x: str, needles) -> str:
    return "(" + " OR ".join(f"contains({x}, '" + n.replace("'", "''") + "')" for n in needles) + ")"


def _in(x: str, values) -> str:
    return f"{x} IN (" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '\\S+'))"


def _nonempty(parts: str) -> str:
    return f"list_filter(list_transform({parts}, lambda p: {_strip('p')}), lambda p: p <> '')"


def _mail_sql(x: str) -> str:
    return f"(regexp_matches({x}, '{base._EMAIL}') OR regexp_matches({x}, '{base._PHONE}'))"


def _title_sql(x: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all(lower({x}), '[a-z]+|[^a-z]+'), lambda r: upper(r[1]) || r[2:]), '')"


def _places_sql(x: str) -> str:
    whole = f"trim({_flat(x)}, ' ,;|')"
    return f"coalesce(nullif(array_to_string({_nonempty(f'string_split({whole}, chr(44))')}, ', '), ''), {whole})"


def _dates_sql(x: str) -> str:
    return f"regexp_replace(lower({_flat(x)}), '\\s*[-–]\\s*', ' - ', 'g')"


# --- functions over a text


@query(f"SELECT id, {_title_sql(_places_sql('t'))} AS place, {_strip('t')} AS value, {_dates_sql('t')} AS dates, trim({_flat('t')}, ' ,;|') AS skill FROM ({NOTES})")
def note_normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places, plain values, date ranges and skills of every note in normal form."""
    return notes(spark, sf_dir).select("id", text.normalize_location("t").alias("place"), text.normalize_value("t").alias("value"), text.normalize_date_range("t").alias("dates"), text.normalize_skill("t").alias("skill"))


def _paragraphs_sql(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex({_lines(x)}, '\\n{{2,}}'), lambda p: {_lines('p')}), lambda p: p <> '')"


def _bullets_sql(x: str, dash: bool) -> str:
    marks = "•●▪·-" if dash else "•●▪·"
    return _nonempty(f"string_split_regex({x}, '(?m)(?:^|\\n)\\s*[{marks}]\\s*')")


_TAIL_LABELS = ("volunteering", "volunteer work", "activities", "languages", "technical skills", "skills")
_RECORDS = f"SELECT doc_id, string_agg(t, chr(10) ORDER BY id) AS t FROM ({NOTES}) GROUP BY doc_id"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, t): a record's notes, one below the other."""
    return notes(spark, sf_dir).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "t"))), lambda x: x["t"]), "\n").alias("t"))


@query(f"""SELECT doc_id, array_to_string({_paragraphs_sql('t')}, '¦') AS paragraphs, array_to_string({_bullets_sql('t', True)}, '¦') AS dashed, array_to_string({_bullets_sql('t', False)}, '¦') AS dotted FROM ({_RECORDS})""")
def record_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs and bullet parts of every record."""
    return _records(spark, sf_dir).select("doc_id", F.array_join(text.paragraphs("t"), "¦").alias("paragraphs"), F.array_join(text.bullets("t", True), "¦").alias("dashed"), F.array_join(text.bullets("t", False), "¦").alias("dotted"))


@query(f"""WITH l AS (SELECT id, list_filter(list_transform(string_split_regex(t, '\\r\\n|\\n'), lambda p: {_lines('p')}), lambda p: p <> '') AS l FROM ({NOTES})),
c AS (SELECT id, l, list_position(list_transform(l, lambda p: {_in("trim(lower(p), ' :')", _TAIL_LABELS)}), true) AS hit FROM l)
SELECT id, {_lines("array_to_string(CASE WHEN hit > 0 THEN l[1:hit - 1] ELSE l END, ' ')")} AS t FROM c""")
def label_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes(spark, sf_dir).select("id", text.trim_label_tail("t").alias("t"))


@query(f"SELECT id, CASE WHEN t <> '' THEN t WHEN kind <> '' THEN kind ELSE name END AS v FROM ({NOTES})")
def first_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes(spark, sf_dir).select("id", text.first_filled("t", "kind", "name").alias("v"))


def _dedupe_sql(rows: str, key: str = "lower(v)") -> str:
    """(doc_id, pos, value) of rows (doc_id, i, v): the first of every non-empty key."""
    return f"SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1) AS pos, v AS value FROM (SELECT * FROM ({rows}) WHERE {key} <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, {key} ORDER BY i) = 1)"


def _values(rows: DataFrame, values: Column) -> DataFrame:
    return rows.select("doc_id", F.posexplode(values).alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


@query(_dedupe_sql(f"SELECT doc_id, id AS i, {_flat('t')} AS v FROM ({NOTES})"))
def record_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct notes of a record, in order."""
    rows = notes(spark, sf_dir).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "t"))), lambda x: x["t"]).alias("l"))
    return _values(rows, arrays.dedupe_flat(F.col("l")))


def _tokens(x: str) -> str:
    return "list_distinct(" + base._TOKENS.format(x=base._IDENTITY.format(x=_flat(x))) + ")"


@query(f"""WITH p AS (SELECT a.id, {_dates_sql('a.t')} AS x, {_dates_sql('b.t')} AS y FROM ({NOTES}) a JOIN ({NOTES}) b ON b.doc_id = a.doc_id AND b.size = a.size AND b.id > a.id),
q AS (SELECT id, x, y, {_tokens('x')} AS tx, {_tokens('y')} AS ty FROM p)
SELECT id, x, y, CASE WHEN x = '' OR y = '' THEN 0.0 WHEN x = y THEN 1.0 WHEN len(tx) = 0 OR len(ty) = 0 THEN 0.0 ELSE len(list_intersect(tx, ty)) / least(len(tx), len(ty))::DOUBLE END AS share FROM q""")
def date_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of notes of one record and size, read as date ranges."""
    n = notes(spark, sf_dir)
    other = n.select("doc_id", "size", F.col("id").alias("other"), F.col("t").alias("u"))
    rows = n.join(other, ["doc_id", "size"]).where("other > id")
    return rows.select("id", text.normalize_date_range("t").alias("x"), text.normalize_date_range("u").alias("y"), arrays.date_overlap(F.col("t"), F.col("u")).alias("share"))


# --- classes


def _skill_sql(x: str) -> str:
    low = f"lower({x})"
    bad = f"({_mail_sql(x)} OR starts_with({low}, 'languages:') OR starts_with({low}, 'certifications:') OR {_in(low, vocab.LANGUAGE_NAMES)} OR {_any(low, vocab.NO_SKILL_WORDS)})"
    return f"({x} <> '' AND length({x}) <= 80 AND NOT {bad} AND {_words(x)} <= 8)"


def _dense_sql(x: str) -> str:
    low = f"lower({_lines(x)})"
    return f"(length({low}) - length(replace({low}, '|', '')) >= 2 OR {' OR '.join(f'starts_with({low}, {chr(39)}{o}{chr(39)})' for o in vocab.DENSE_SKILL_OPENERS)})"


def _training_sql(x: str) -> str:
    return _any(f"lower({x})", vocab.TRAINING_WORDS)


_KIND = f"""CASE WHEN t <> '' AND {_in('substr(t, 1, 1)', vocab.BULLETS)} THEN 'bullet' WHEN contains(t, '|') THEN 'table' WHEN {_words('t')} >= 4 THEN 'paragraph'
WHEN regexp_matches(t, '[A-Z]') AND t = upper(t) THEN 'heading' ELSE 'other' END"""


@query(f"SELECT id, {_skill_sql('t')} AS skill, {_dense_sql('t')} AS dense, {_training_sql('t')} AS training, {_KIND} AS kind FROM ({NOTES})")
def note_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a note is a skill, a dense list of skills or a training, and its kind as a block."""
    t = F.col("t")
    return notes(spark, sf_dir).select("id", C.is_skill(t).alias("skill"), C.is_dense(t).alias("dense"), C.is_training(t).alias("training"), B.kind(t, "[A-Z]").alias("kind"))


def _clean_skill_sql(x: str) -> str:
    return _flat(f"regexp_replace(trim({_flat(x)}, ' ,;|'), '[.]+$', '')")


def _technical_sql(v: str) -> str:
    low, bare = f"lower({v})", f"trim(lower({v}), ' .')"
    wrapped = f"(contains({v}, ':') AND {_in(_strip(f'split_part({low}, chr(58), 1)'), vocab.SKILL_WRAPPERS)})"
    opens = "(" + " OR ".join(f"starts_with({bare}, '{o}')" for o in vocab.SKILL_OPENERS) + ")"
    comma = f"string_split({v}, ',')"
    several = f"(contains({v}, ', ') AND len({_nonempty(comma)}) > 1)"
    unpaired = f"(length(replace({v}, '(', '')) <> length(replace({v}, ')', '')))"
    joined = f"(regexp_matches({v}, '[—–]') AND {_any(bare, vocab.SKILL_GROUP_WORDS)})"
    no = f"({_in(bare, (*vocab.SECTION_LABELS, *vocab.SKILL_FRAGMENTS, *vocab.COMMON_SOFT_SKILLS))} OR {_in(v, ('▪', '●', '•'))} OR {several} OR {unpaired} OR {joined} OR {opens} OR {_any(bare, vocab.SKILL_FOREIGN)})"
    return f"({v} <> '' AND NOT {wrapped} AND NOT {no} AND ({_words(v)} <= 3 OR {_any(low, vocab.TECHNICAL_WORDS)} OR regexp_matches({v}, '(^|[^\\p{{L}}\\p{{N}}_])[A-Z]{{2,}}($|[^\\p{{L}}\\p{{N}}_])')))"


def _language_sql(v: str) -> str:
    bare = f"trim(lower({v}), ' .')"
    shout = f"({_words(v)} = 1 AND regexp_matches({v}, '[A-Z]') AND {v} = upper({v}) AND length({v}) > 3)"
    return f"({v} <> '' AND NOT {_in(bare, vocab.SECTION_LABELS)} AND NOT contains({v}, ':') AND NOT {shout} AND NOT {_any(bare, vocab.NOT_LANGUAGES)})"


def _clean_soft_sql(x: str) -> str:
    bare = f"regexp_replace({_flat(x)}, '^[•●▪·-]\\s*', '')"
    return _flat(f"trim({bare}, ' ,;|')")


def _soft_sql(v: str) -> str:
    bare = f"trim(lower({v}), ' .')"
    label, after = _strip(f"split_part({bare}, ':', 1)"), f"regexp_replace({bare}, '^[^:]*:', '')"
    told = f"({_in(label, vocab.SOFT_SKILL_LABELS)} AND {_words(after)} >= 3)"
    return f"({v} <> '' AND NOT {_in(bare, vocab.SECTION_LABELS)} AND CASE WHEN contains({v}, ':') THEN {told} ELSE {_in(bare, vocab.COMMON_SOFT_SKILLS)} END)"


def _clean_cert_sql(x: str) -> str:
    t = f"trim(ltrim({_flat(x)}, '•●▪- '), ' ,;|')"
    t = f"trim(regexp_replace({t}, '(?i){vocab.CERTIFICATION_VERBS}', ''), ' ,;|.-')"
    return f"trim(regexp_replace({t}, '(?i){vocab.CERTIFICATION_DATES}', ''), ' ,;|.-')"


def _cert_sql(v: str) -> str:
    low, bare = f"lower({v})", f"trim(lower({v}), ' .')"
    certified = _any(bare, vocab.CERTIFICATION_WORDS)
    no = f"""({_in(bare, (*vocab.SECTION_LABELS, 'systems', 'countries'))} OR {_in(v, ('▪', '●', '•'))} OR {_any(bare, vocab.AWARD_WORDS)} OR (regexp_matches({bare}, '{vocab.CERTIFICATION_DATED}') AND NOT {certified})
OR {_any(bare, vocab.NOT_CERTIFICATIONS)} OR (contains({v}, ':') AND NOT {_any(bare, ('certificate', 'certification'))}) OR ({_words(v)} > 12 AND NOT {certified}))"""
    yes = f"({_any(low, vocab.CERTIFICATION_WORDS)} OR {_any(low, vocab.CERTIFICATION_NAMES)} OR (contains({low}, 'fundamentals') AND {_any(low, ('cisco', 'cybersecurity'))}))"
    return f"({v} <> '' AND NOT {no} AND {yes})"


def _recoverable(name: str, clean_sql, test_sql, clean, test) -> None:
    sql = f"SELECT id, v, {test_sql('v')} AS ok FROM (SELECT id, {clean_sql('t')} AS v FROM ({NOTES}))"
    lines = f"SELECT doc_id, pos, text FROM (SELECT *, {clean_sql('text')} AS v FROM ({base._LINE_ROWS})) WHERE {test_sql('v')}"

    def of_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
        return notes(spark, sf_dir).select("id", text.let(clean(F.col("t")), lambda v: F.struct(v.alias("v"), test(v).alias("ok"))).alias("x")).select("id", "x.v", "x.ok")

    def of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
        return base._line_rows(spark, sf_dir).where(text.let(clean(F.col("text")), test)).select("doc_id", F.col("pos").cast("long").alias("pos"), "text")

    of_notes.__name__, of_lines.__name__ = f"recoverable_{name}", f"recoverable_{name}_lines"
    of_notes.__doc__, of_lines.__doc__ = f"Every note as one of {name}: cleaned, and whether it is worth recovering.", f"Lines of documents that are worth recovering as {name}."
    query(sql)(of_notes)
    query(lines)(of_lines)


_recoverable("skills", _clean_skill_sql, _technical_sql, L.clean_skill, L.is_technical)
_recoverable("languages", _flat, _language_sql, text.normalize_flat, L.is_language)
_recoverable("soft_skills", _clean_soft_sql, _soft_sql, L.clean_soft_skill, L.is_soft_skill)
_recoverable("certs", _clean_cert_sql, _cert_sql, L.clean_certification, L.is_certification)


def _cert_key_sql(x: str) -> str:
    k = f"regexp_replace(lower({_clean_cert_sql(x)}), '{vocab.CERTIFICATION_KEY_DATES}', '', 'g')"
    return f"trim(regexp_replace({k}, '\\s+', ' ', 'g'), ' ,;|.-')"


@query(f"SELECT id, {base._skill_key_sql('t')} AS skill_key, {_cert_key_sql('t')} AS cert_key FROM ({NOTES})")
def comparison_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes(spark, sf_dir).select("id", L.technical_key(F.col("t")).alias("skill_key"), L.certification_key(F.col("t")).alias("cert_key"))


@query(f"SELECT doc_id, pos, text, {base._skill_key_sql('text')} AS skill_key, {_cert_key_sql('text')} AS cert_key FROM ({base._LINE_ROWS})")
def comparison_keys_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = base._line_rows(spark, sf_dir)
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "text", L.technical_key(F.col("text")).alias("skill_key"), L.certification_key(F.col("text")).alias("cert_key"))


def _social_sql(field: str, x: str) -> str:
    t = _strip(x)
    return f"({t} <> '' AND NOT regexp_matches({t}, '[\\n ]') AND (contains(lower({t}), '{field}.com/') OR starts_with(lower({t}), '{field}/')))"


_PHONE_FORM = f"regexp_replace(regexp_replace({_flat('t')}, '[^0-9+]', '', 'g'), '^\\+\\+', '+')"


@query(f"""SELECT id, {_social_sql('github', 't')} AS github, {_social_sql('linkedin', 't')} AS linkedin, regexp_full_match({_flat('t')}, '{base._EMAIL}') AS email,
length(regexp_replace({_PHONE_FORM}, '[^0-9]', '', 'g')) >= 8 AS phone FROM ({NOTES})""")
def contact_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which notes are valid profile links, e-mail addresses and phone numbers."""
    t = F.col("t")
    return notes(spark, sf_dir).select("id", L.is_social("github", t).alias("github"), L.is_social("linkedin", t).alias("linkedin"), GR.is_email(t).alias("email"), GR.is_phone(t).alias("phone"))


def _entry_sql(pattern: str, group: int = 0) -> str:
    return _flat(f"regexp_extract(t, '(?i){pattern.replace(chr(39), chr(39) * 2)}', {group})")


_GRADES = [f"upper(regexp_extract(t, '(?i){p}', 1))" for p in vocab.PROJECT_GRADES]


@query(f"""SELECT id, {_entry_sql(vocab.ENTRY_DATE)} AS date, CASE WHEN {_entry_sql(vocab.DEGREE)} <> '' THEN {_entry_sql(vocab.DEGREE)} WHEN contains(t, '|') THEN {_flat("split_part(t, '|', 1)")} ELSE '' END AS degree,
{_entry_sql(vocab.INSTITUTION, 1)} AS institution, {_entry_sql(vocab.GPA, 1)} AS gpa, CASE WHEN {_GRADES[0]} <> '' THEN {_GRADES[0]} ELSE {_GRADES[1]} END AS grade, {_entry_sql(vocab.SPECIALIZATION, 1)} AS specialization FROM ({NOTES})""")
def entry_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the patterns of entries find in every note."""
    t = F.col("t")
    return notes(spark, sf_dir).select("id", G.entry_date(t).alias("date"), G.degree(t).alias("degree"), G.institution(t).alias("institution"), G.gpa(t).alias("gpa"), G.project_grade(t).alias("grade"), G.specialization(t).alias("specialization"))


# --- singletons


def _kept_sql(field: str) -> str:
    """The optimizer's note of a record, else the first valid one of the source, else the parser's."""
    return f"""SELECT doc_id, o.t AS o, s.l AS l, p.t AS p FROM (SELECT doc_id, min_by(t, id) AS t FROM ({NOTES}) WHERE size > 40 GROUP BY doc_id) o RIGHT JOIN
(SELECT doc_id, list(t ORDER BY id) FILTER ({_social_sql(field, 't')}) AS l FROM ({NOTES}) GROUP BY doc_id) s USING (doc_id) LEFT JOIN (SELECT doc_id, max_by(t, id) AS t FROM ({NOTES}) GROUP BY doc_id) p USING (doc_id)"""


def _link_sql(field: str) -> str:
    return f"""SELECT doc_id, '{field}' AS field, CASE WHEN {_strip("coalesce(o, '')")} <> '' THEN o WHEN l IS NOT NULL THEN l[1] WHEN {_social_sql(field, 'p')} THEN {_strip('p')} END AS value,
CASE WHEN {_strip("coalesce(o, '')")} <> '' THEN 'optimizer' WHEN l IS NOT NULL THEN 'source' WHEN {_social_sql(field, 'p')} THEN 'parser' END AS source FROM ({_kept_sql(field)})"""


@query(f"{_link_sql('github')} UNION ALL {_link_sql('linkedin')}")
def profile_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record's profile links by precedence of optimizer, source and parser."""
    rows = notes(spark, sf_dir).groupBy("doc_id").agg(
        F.min_by("t", F.when(F.col("size") > 40, F.col("id"))).alias("o"), F.transform(F.array_sort(F.collect_list(F.struct("id", "t"))), lambda x: x["t"]).alias("l"), F.max_by("t", "id").alias("p"), F.max("size").alias("most")
    )
    rows = rows.withColumn("o", F.when(F.col("most") > 40, F.col("o")))
    parts = [rows.select("doc_id", F.lit(f).alias("field"), L.recover_singleton(f, F.coalesce("o", F.lit("")), F.col("l"), F.col("p")).alias("r")).select("doc_id", "field", "r.value", "r.source") for f in ("github", "linkedin")]
    return parts[0].unionByName(parts[1])


@query(f"""SELECT id, CASE WHEN p <> '' THEN p WHEN c <> '' THEN c WHEN g THEN o END AS value, CASE WHEN p <> '' THEN 'parser' WHEN c <> '' THEN 'phase2_input' WHEN g THEN 'optimizer' ELSE 'unresolved' END AS source,
CASE WHEN p <> '' THEN 0.9 WHEN c <> '' THEN 0.88 WHEN g THEN 0.7 ELSE 0.0 END::DOUBLE AS confidence FROM (SELECT id, p, o, c, o <> '' AND contains(lower({_flat('x')}), lower(o)) AS g FROM
(SELECT id, CASE WHEN size % 3 = 0 THEN {_flat('t')} ELSE '' END AS p, CASE WHEN size % 5 = 0 THEN kind ELSE '' END AS c, CASE WHEN size % 2 = 0 THEN {_flat('name')} ELSE {_flat('kind')} END AS o, t AS x FROM ({NOTES})))""")
def name_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name by precedence of parser, candidates and the grounded optimizer, with a confidence."""
    size = F.col("size")
    rows = notes(spark, sf_dir).select("id", F.when(size % 3 == 0, F.col("t")).otherwise("").alias("p"), F.when(size % 5 == 0, F.col("kind")).otherwise("").alias("c"), F.when(size % 2 == 0, F.col("name")).otherwise(F.col("kind")).alias("o"), F.col("t").alias("full_text"))
    rows = base._as_input(rows, F.filter(F.array("c"), lambda c: c != ""))
    return rows.select("id", GR.name(F.col("p"), F.col("o"), {"name": F.array("p")}).alias("r")).select("id", "r.value", "r.source", "r.confidence")


# --- sections


_ALIAS_MAP = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in vocab.SECTION_ALIASES.items() if k not in vocab.COMPOSITE_ALIASES) + "}"
_SPLIT_MAP = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in vocab.SECTION_ALIASES.items()) + "}"


def _section_sql(x: str) -> str:
    key = f"regexp_replace(lower(regexp_replace({_lines(x)}, ':+$', '')), '\\s+', ' ', 'g')"
    return f"CASE WHEN {key} <> 'general' THEN {_ALIAS_MAP}[{key}] END"


def _heading_sql(x: str) -> str:
    key = f"regexp_replace(lower({_strip(f'''regexp_replace({_lines(x)}, '[:–|-]+$', '')''')}), '\\s+', ' ', 'g')"
    return f"coalesce({_SPLIT_MAP}[{key}], {_SPLIT_MAP}[replace({key}, '&', 'and')])"


_BLEED_CUT = f"regexp_replace({_lines('t')}, '(?i){vocab.SPLIT_BLEED}', '')"
_UPPER_OR_COLON = f"({_lines('t')} = upper({_lines('t')}) OR ends_with({_lines('t')}, ':'))"
_HEAD_WORDS = _words(f"regexp_replace({_lines('t')}, ':+$', '')")


@query(f"""SELECT id, {_section_sql('heading')} AS section, {_heading_sql('heading')} AS canonical, {_heading_sql('t')} AS named, {_lines(f"rtrim({_BLEED_CUT}, ' -–|')")} AS stripped,
({_heading_sql('t')} IS NOT NULL OR ({_HEAD_WORDS} BETWEEN 1 AND 4 AND NOT regexp_matches({_lines('t')}, '[.!?]$') AND {_UPPER_OR_COLON})) AS is_heading FROM ({NOTES})""")
def section_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical names of headings and notes, notes without bleed, and which notes are headings."""
    t, h = F.col("t"), F.col("heading")
    return notes(spark, sf_dir).select("id", C.section_name(h).alias("section"), S.canonical(h).alias("canonical"), S.canonical(t).alias("named"), S.strip_bleed(t).alias("stripped"), S.is_heading(t, F.lit(None).cast("double")).alias("is_heading"))


_ODD = f"""(SELECT doc_id, id, {_strip('heading')} AS heading, t AS content FROM ({NOTES}))"""


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes(spark, sf_dir).select("doc_id", F.col("id").alias("section_seq"), "heading", F.col("t").alias("content"))


@query(f"""SELECT doc_id, string_agg(m, ';' ORDER BY id) AS markers FROM (SELECT doc_id, min(id) AS id, m FROM (SELECT doc_id, id, heading || ': ' || {_strip(f"string_split({_strip('content')}, chr(10))[-1]")} AS m
FROM {_ODD} WHERE {_strip('content')} <> '' AND regexp_matches({_strip(f"string_split({_strip('content')}, chr(10))[-1]")}, '(?i){vocab.REPORT_BLEED}')) GROUP BY doc_id, m) GROUP BY doc_id""")
def section_bleed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.bleed_markers(_sections(spark, sf_dir)).select("doc_id", F.array_join("markers", ";").alias("markers"))


_JOINED = f"regexp_matches(heading, '(?i)&|/|\\band\\b') AND len(list_filter({_nonempty(chr(10).join(['string_split_regex(lower(heading), ' + chr(39) + chr(92) + 's*(?:&|/|' + chr(92) + 'band' + chr(92) + 'b)' + chr(92) + 's*' + chr(39) + ')']))}, lambda p: {_any('p', vocab.COMPOSITE_PARTS)})) >= 2"


@query(f"SELECT DISTINCT doc_id, heading FROM {_ODD} WHERE {_JOINED}")
def composite_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.composite_headings(_sections(spark, sf_dir)).select("doc_id", F.explode("headings").alias("heading"))


@query(f"""SELECT 'section' AS kind, heading AS name, count(DISTINCT doc_id) AS documents FROM ({NOTES}) GROUP BY heading
UNION ALL SELECT 'error', brand, count(DISTINCT doc_id) FROM ({NOTES}) GROUP BY brand""")
def section_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = notes(spark, sf_dir).groupBy("doc_id").agg(F.collect_list("brand").alias("possible_errors"))
    return Q.frequencies(_sections(spark, sf_dir), errors)


# --- candidates of records: sections in the order of their notes


_MERGED = f"""SELECT doc_id, name, min(id) AS first, {_lines("string_agg(c, chr(10) || chr(10) ORDER BY id) FILTER (c <> '')")} AS text FROM (SELECT doc_id, id, {_section_sql('heading')} AS name, {_lines('t')} AS c FROM ({NOTES})) GROUP BY doc_id, name"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with their named sections."""
    no_blocks = F.array().cast("array<struct<pos:int,block_id:string,label:string,text:string>>")
    s = F.struct(F.col("id").alias("section_seq"), "heading", F.col("t").alias("content"), F.array().cast("array<string>").alias("block_ids"))
    rows = notes(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(s)).alias("sections"), F.max("size").alias("size"), F.sum("size").alias("total"))
    return C.merge_sections(rows.withColumn("blocks", no_blocks).withColumn("full_text", F.lit("")))


def _body_sql(name: str) -> str:
    return f"(SELECT doc_id, coalesce(text, '') AS body FROM ({_MERGED}) WHERE name = '{name}')"


def _split_sql(x: str) -> str:
    """split_candidates in DuckDB."""
    parts = f"flatten(list_transform(string_split({_lines(x)}, chr(10)), lambda y: string_split_regex(regexp_replace(y, ', ([A-Z][a-z])', chr(1) || '\\1', 'g'), '\\s*\\|\\s*|•|\\x01')))"
    return f"list_filter(list_transform({parts}, lambda z: {_lines('z')}), lambda z: z <> '')"


def _listed(bodies: str, values: str, where: str = "true") -> str:
    """Rows (doc_id, i, v) of a list expression over bodies."""
    return f"SELECT doc_id, i, v FROM (SELECT doc_id, unnest(l) AS v, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {values} AS l FROM {bodies})) WHERE {where}"


@query(f"SELECT doc_id, name, row_number() OVER (PARTITION BY doc_id, name IS NULL ORDER BY first) - 1 AS pos, coalesce(text, '') AS text FROM ({_MERGED})")
def merged_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of a record under their canonical names, in the order of first sight; what has no name together."""
    rows = _merged(spark, sf_dir)
    named = rows.select("doc_id", F.posexplode("named").alias("pos", "s")).select("doc_id", "s.name", F.col("pos").cast("long").alias("pos"), "s.text")
    loose = rows.where(F.exists("sections", lambda s: C.section_name(s["heading"]).isNull())).select("doc_id", F.lit(None).cast("string").alias("name"), F.lit(0).cast("long").alias("pos"), F.col("uncategorized_text").alias("text"))
    return named.unionByName(loose)


@query(_dedupe_sql(_listed(_body_sql("Skills"), _split_sql("body"), _skill_sql("v"))))
def skill_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(_merged(spark, sf_dir).select("*"), C.skills())


_LABEL_REST = "CASE WHEN contains(v, ':') THEN substr(v, length(split_part(v, ':', 1)) + 2) ELSE v END"
_TONGUES = f"""SELECT doc_id, list_filter([max(text) FILTER (name = 'Languages'), max(text) FILTER (name = 'Additional Information')], lambda t: t <> '') AS texts FROM ({_MERGED}) GROUP BY doc_id"""
_TONGUE_PARTS = f"SELECT doc_id, unnest(l) AS v, unnest(range(1, len(l) + 1)) AS k FROM (SELECT doc_id, flatten(list_transform(texts, lambda t: {_split_sql('t')})) AS l FROM ({_TONGUES}))"


@query(_dedupe_sql(f"""SELECT doc_id, k * 1000 + j AS i, w AS v FROM (SELECT doc_id, k, unnest(o) AS w, unnest(range(1, len(o) + 1)) AS j FROM (SELECT doc_id, k,
CASE WHEN split_part(lower(v), ':', 1) = 'languages' THEN {_split_sql(_LABEL_REST)} WHEN {_in('lower(v)', vocab.LANGUAGE_NAMES)} THEN [v] ELSE [] END AS o FROM ({_TONGUE_PARTS})))"""))
def language_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(_merged(spark, sf_dir), C.languages())


_CERT_LINES = f"""SELECT doc_id, unnest(l) AS v FROM (SELECT doc_id, list_filter(list_transform(string_split_regex(body, '\\r\\n|\\n'), lambda p: {_lines('p')}), lambda p: starts_with(lower(p), 'certifications:')) AS l FROM {_body_sql('Additional Information')})"""
_CERT_MORE = f"SELECT doc_id, flatten(list({_split_sql(_LABEL_REST)})) AS l FROM ({_CERT_LINES}) GROUP BY doc_id"


@query(_dedupe_sql(f"""{_listed(_body_sql('Certifications'), _split_sql('body'))} UNION ALL SELECT doc_id, 1000000 + i, v FROM ({_listed(f'({_CERT_MORE})', 'l', f"lower(v) <> 'udemy' AND NOT {_training_sql('v')}")})"""))
def certification_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(_merged(spark, sf_dir), C.certifications())


def _entries_sql(section: str) -> str:
    other = f"coalesce({_section_sql('f')} <> 'Projects', false)"
    first = _lines("CASE WHEN contains(v, chr(10)) THEN split_part(v, chr(10), 1) ELSE split_part(v, ' | ', 1) END")
    low = "trim(lower(f), ':')"
    fits = f"NOT {other} AND NOT {_in(low, vocab.NO_PROJECTS)} AND NOT {_any(low, vocab.NO_PROJECT_WORDS)}" if section == "Projects" else "true"
    rows = f"SELECT doc_id, i, v, {first} AS f FROM ({_listed(_body_sql(section), _paragraphs_sql('body'))})"
    return f"""SELECT doc_id, '{section}' AS section, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, v AS text, array_to_string(regexp_extract_all(v, '(?i){vocab.DATE_HINT}'), ';') AS dates FROM ({rows}) WHERE {fits}"""


@query(" UNION ALL ".join(f"SELECT * FROM ({_entries_sql(s)})" for s in ("Experience", "Projects", "Education")))
def entry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a record's sections without blocks: its paragraphs, but for subsections of projects that are none."""
    rows = _merged(spark, sf_dir)
    parts = [rows.select("doc_id", F.lit(s).alias("section"), F.posexplode(C.entries(s)).alias("pos", "e")) for s in ("Experience", "Projects", "Education")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("doc_id", "section", F.col("pos").cast("long").alias("pos"), "e.text", F.array_join("e.hints.detected_dates", ";").alias("dates"))


def _clean_chunk_sql(x: str, prefix: str) -> str:
    t = f"regexp_replace({_lines(x)}, '^[•●▪·-]\\s*', '')"
    t = f"trim(regexp_replace({t}, '(?i){prefix}', ''), ' ,;|')"
    t = f"regexp_replace({t}, '(?i)^publication(?:\\s*\\([^)]*\\))?\\s*:\\s*', '')"
    return f"trim(regexp_replace({t}, '(?i){vocab.CHUNK_BLEED}', ''), ' ,;|')"


@query(f"""SELECT id, CASE WHEN {_words('c')} < 3 THEN '' ELSE c END AS chunk, {base._class_sql(['publications', 'awards', 'activities', 'achievements'], False)[:-4]} WHEN heading = 'Achievements' THEN 'achievements' END AS recovery,
CASE WHEN {_any('lower(t)', vocab.SUPPLEMENTAL['publications'])} THEN 'publications' WHEN {_any('lower(t)', vocab.SUPPLEMENTAL['activities'])} THEN 'activities' WHEN heading = 'Achievements' OR {_any('lower(t)', vocab.SUPPLEMENTAL['achievements'])} THEN 'achievements' END AS adapter
FROM (SELECT *, {_clean_chunk_sql('t', vocab.ADAPTER_PREFIX)} AS c FROM ({NOTES}))""")
def supplemental_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every note as a supplemental chunk of its section: cleaned, and its class at recovery and at extraction."""
    t, h = F.col("t"), F.col("heading")
    return notes(spark, sf_dir).select("id", C.clean_chunk(t).alias("chunk"), C.recovery_class(t, h).alias("recovery"), C.adapter_class(t, h).alias("adapter"))


_FLAG_ALIASES = [k for k in vocab.SECTION_ALIASES if k not in vocab.COMPOSITE_ALIASES]


@query(f"""WITH r AS (SELECT doc_id, max(size) AS size, sum(size) AS total FROM ({NOTES}) GROUP BY doc_id), m AS (SELECT doc_id, coalesce(max(text) FILTER (name IS NULL), '') AS loose, count(*) FILTER (name IS NOT NULL) AS n FROM ({_MERGED}) GROUP BY doc_id)
SELECT doc_id, array_to_string(list_filter([CASE WHEN size > 49 THEN 'fallback_used' END, CASE WHEN total % 4 = 0 THEN 'oversized_general_section' END, CASE WHEN (total % 10) / 10.0 >= 0.3 THEN 'high_general_block_ratio' END, CASE WHEN total % 3 > 0 THEN 'suspicious_section_split' END,
CASE WHEN total % 5 > 0 AND {_any(f"lower({_lines('loose')})", _FLAG_ALIASES)} THEN 'normalization_overmerge_risk' END, CASE WHEN n = 0 AND loose <> '' THEN 'document_collapsed_into_general' END], lambda x: x IS NOT NULL), ';') AS flags FROM r JOIN m USING (doc_id)""")
def diagnostics_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnostics flags of records, with figures made of their parts' sizes."""
    total = F.col("total")
    rows = _merged(spark, sf_dir).withColumn("fallback_used", F.col("size") > 49).withColumn("possible_errors", F.when(total % 4 == 0, F.array(F.lit("oversized_general_section"))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("general_block_ratio", (total % 10) / F.lit(10.0)).withColumn("recovered_section_splits", total % 3).withColumn("merged_block_count", total % 5)
    return rows.select("doc_id", F.array_join(C.flags(), ";").alias("flags"))


@query(f"""SELECT id, string_split(path, '/')[-1] AS file_name, path AS source_path, size AS page_count, kind AS extractor, size > 25 AS fallback_triggered FROM (SELECT *, '/data/' || brand || '/' || name AS path FROM ({NOTES}))""")
def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("/data/"), F.col("brand"), F.lit("/"), F.col("name"))
    return notes(spark, sf_dir).select("id", C.source_metadata(path, F.col("size"), F.col("kind"), F.col("size") > 25).alias("m")).select("id", "m.*")


# --- reports


@query(f"""WITH n AS (SELECT doc_id, list(t ORDER BY id) AS l, max_by(t, id) AS p, max(size) AS size FROM ({NOTES}) GROUP BY doc_id),
e AS (SELECT *, unnest(['github', 'linkedin']) AS field FROM n WHERE size <= 49)
SELECT doc_id, field, 'phase2_input' AS source, v AS value FROM (SELECT doc_id, field, unnest(l) AS raw, unnest(range(1, len(l) + 1)) AS i, {_flat('unnest(l)')} AS v FROM e)
WHERE CASE field WHEN 'github' THEN {_social_sql('github', 'v')} ELSE {_social_sql('linkedin', 'v')} END QUALIFY row_number() OVER (PARTITION BY doc_id, field, lower(v) ORDER BY i) = 1
UNION ALL SELECT doc_id, field, 'parser', {_strip('p')} FROM e WHERE CASE field WHEN 'github' THEN {_social_sql('github', 'p')} ELSE {_social_sql('linkedin', 'p')} END""")
def missing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile links that a record's notes have and its final form, empty for most, lacks."""
    return R.missing_singletons(_link_rows(spark, sf_dir))


def _link_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = notes(spark, sf_dir).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "t"))), lambda x: x["t"]).alias("l"), F.max_by("t", "id").alias("p"), F.max("size").alias("size"))
    final = F.when(F.col("size") > 49, F.lit("kept")).otherwise("")
    return rows.select("doc_id", F.struct(final.alias("github"), final.alias("linkedin")).alias("final"), F.struct(F.col("l").alias("github"), F.col("l").alias("linkedin")).alias("source"), F.struct(F.col("p").alias("github"), F.col("p").alias("linkedin")).alias("parser"))


_LIST_FIELD = "CASE id % 3 WHEN 0 THEN 'technical_skills' WHEN 1 THEN 'languages' ELSE 'certifications' END"
_LIST_ROWS = f"SELECT doc_id, id, size, {_LIST_FIELD} AS field, {_flat('t')} AS value, CASE id % 3 WHEN 0 THEN {base._skill_key_sql('t')} WHEN 1 THEN lower(trim({_flat('t')}, ' ,;|')) ELSE {_cert_key_sql('t')} END AS key, CASE WHEN size > 30 THEN 'parser' ELSE 'phase2_input' END AS source FROM ({NOTES})"
_LIST_GAPS = f"""SELECT doc_id, field, source, value FROM (SELECT * FROM ({_LIST_ROWS}) e WHERE size > 10 AND value <> '' AND NOT EXISTS (SELECT 1 FROM ({_LIST_ROWS}) f WHERE f.size <= 10 AND f.value <> '' AND f.doc_id = e.doc_id AND f.field = e.field AND f.key = e.key))
QUALIFY row_number() OVER (PARTITION BY doc_id, field, source, lower(value) ORDER BY id) = 1"""


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small parts are a record's final values, the others evidence; links as in missing_links; no groups."""
    n = notes(spark, sf_dir)
    field = F.when(F.col("id") % 3 == 0, "technical_skills").when(F.col("id") % 3 == 1, "languages").otherwise("certifications")
    rows = n.select("doc_id", field.alias("field"), F.when(F.col("size") > 30, "parser").otherwise("phase2_input").alias("source"), F.col("id").alias("ord"), F.col("t").alias("value"), "size")
    groups = n.limit(0).select("doc_id", F.lit("projects").alias("field"), F.array().cast("array<string>").alias("candidates"), F.lit("{}").alias("parser"), F.lit("{}").alias("final"))
    return R.coverage(rows.where("size > 10"), rows.where("size <= 10"), groups, _link_rows(spark, sf_dir))


@query(f"SELECT doc_id, field, source, value FROM ({_LIST_GAPS}) UNION ALL SELECT * FROM ({base.ORACLES['missing_links']})")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gaps(spark, sf_dir)


@query(f"""SELECT doc_id, string_agg(m, '¦' ORDER BY m) AS missing FROM (SELECT doc_id, source || ':' || field || ':' || value AS m FROM ({base.ORACLES['coverage_report']})) GROUP BY doc_id""")
def coverage_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.coverage_rows(_gaps(spark, sf_dir)).select("doc_id", F.array_join("missing", "¦").alias("missing"))


# --- soft skills, trainings and supplemental chunks of records


def _lines_of(x: str) -> str:
    """Non-empty normalised lines of a text, as a list."""
    return f"list_filter(list_transform(string_split_regex({x}, '\\r\\n|\\n'), lambda p: {_lines('p')}), lambda p: p <> '')"


def _raw_lines(x: str) -> str:
    return _nonempty(f"string_split_regex({x}, '\\r\\n|\\n')")


def _tail_sql(x: str) -> str:
    """trim_label_tail in DuckDB."""
    own = _lines_of(x)
    hit = f"list_position(list_transform({own}, lambda p: {_in("trim(lower(p), ' :')", _TAIL_LABELS)}), true)"
    return _lines(f"array_to_string(CASE WHEN {hit} > 0 THEN ({own})[1:{hit} - 1] ELSE {own} END, ' ')")


def _short(x: str) -> str:
    return f"CASE WHEN {_words(x)} < 3 THEN '' ELSE {x} END"


_INLINE = f"CASE WHEN len({_bullets_sql('body', True)}) > 1 THEN {_bullets_sql('body', True)} ELSE {_raw_lines('body')} END"
_SOFT_PARTS = f"""SELECT doc_id, i, {_short('c')} AS c FROM (SELECT doc_id, i, {_clean_chunk_sql('v', vocab.ADAPTER_PREFIX)} AS c FROM ({_listed(_body_sql('Skills'), f"flatten(list_transform({_INLINE}, lambda q: {_nonempty(chr(10).join(['string_split_regex(q, ' + chr(39) + chr(92) + 's+[•●▪·]' + chr(92) + 's+' + chr(39) + ')']))}))")}))"""


@query(_dedupe_sql(f"""SELECT doc_id, i, {_lines('v')} AS v FROM (SELECT doc_id, i, {_tail_sql('c')} AS v FROM ({_SOFT_PARTS})) WHERE contains(v, ':') AND {_in(_strip("lower(split_part(v, ':', 1))"), vocab.SOFT_SKILL_LABELS)}"""))
def soft_skill_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(_merged(spark, sf_dir), C.soft_skills())


_MORE_LINES = f"SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {_lines_of('body')} AS l FROM {_body_sql('Additional Information')})"
_REST = "CASE WHEN contains(line, ':') THEN substr(line, length(split_part(line, ':', 1)) + 2) ELSE '' END"
_PROVIDER = f"CASE WHEN starts_with(lower(line), 'certifications:') AND lower(({_split_sql(_REST)})[-1]) = 'udemy' THEN ({_split_sql(_REST)})[-1] END"
# the provider waits from the last line that names one, if no training has come since
_WAITING = f"""SELECT *, CASE WHEN training AND coalesce(max(CASE WHEN provider IS NOT NULL THEN i END) OVER b, 0) > coalesce(max(CASE WHEN training THEN i END) OVER b, 0) THEN last_value(provider IGNORE NULLS) OVER b END AS by_
FROM (SELECT *, {_PROVIDER} AS provider, {_training_sql('line')} AS training FROM ({_MORE_LINES})) WINDOW b AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
_TRAINING_LABEL = "(" + " OR ".join(f"starts_with(lower(line), '{label}')" for label in vocab.TRAINING_LABELS) + ")"
_OFFERED = f"""SELECT doc_id, i, unnest(l) AS c, unnest(range(1, len(l) + 1)) AS j, by_ FROM (SELECT doc_id, i, by_, CASE WHEN by_ IS NOT NULL THEN {_split_sql('line')}
WHEN {_TRAINING_LABEL} AND NOT starts_with(lower(line), 'certification') THEN {_split_sql(_REST)} ELSE [] END AS l FROM ({_WAITING}))"""
_COURSES = f"""{_listed(_body_sql('Courses'), _paragraphs_sql('body'))} UNION ALL SELECT doc_id, 1000000 + i * 1000 + j, CASE WHEN by_ IS NULL OR starts_with(lower(c), lower(by_)) THEN c ELSE {_lines("by_ || ' ' || c")} END FROM ({_OFFERED}) WHERE {_training_sql('c')}"""


@query(f"""SELECT doc_id, pos, value AS text, array_to_string(regexp_extract_all(value, '(?i){vocab.DATE_HINT}'), ';') AS dates FROM ({_dedupe_sql(_COURSES, f"lower({_lines('v')})")})""")
def training_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses, and trainings in the additional information of a record."""
    rows = _merged(spark, sf_dir).select("doc_id", F.posexplode(C.trainings()).alias("pos", "e"))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "e.text", F.array_join("e.hints.detected_dates", ";").alias("dates"))


def _adapter_sql(raw: str, section: str) -> str:
    low, c = f"lower({raw})", vocab.SUPPLEMENTAL
    return f"CASE WHEN {_any(low, c['publications'])} THEN 'publications' WHEN {_any(low, c['activities'])} THEN 'activities' WHEN {section} = 'Achievements' OR {_any(low, c['achievements'])} THEN 'achievements' END"


def _chunk_rows(name: str, at: int) -> str:
    own = _strip("body")
    parts = f"CASE WHEN len({_bullets_sql(own, True)}) > 1 THEN {_bullets_sql(own, True)} ELSE {_nonempty(f"string_split_regex({own}, '\\n\\s*\\n')")} END"
    return f"SELECT doc_id, {at} + i AS i, {_lines('v')} AS raw, v AS part, '{name}' AS section FROM ({_listed(_body_sql(name), parts)})"


_PUBLISHED = f"""SELECT doc_id, 2000000 + i AS i, v AS raw, v AS part, 'Education' AS section FROM ({_listed(f"(SELECT * FROM {_body_sql('Education')} WHERE {_any(f'lower({_lines(chr(98) + chr(111) + chr(100) + chr(121))})', vocab.SUPPLEMENTAL_EDUCATION)})", _lines_of('body'))}) WHERE {_any('lower(v)', vocab.SUPPLEMENTAL['publications'])}"""
_HELPED = f"""SELECT doc_id, 3000000 + i AS i, {_lines(_strip("coalesce(last_value(CASE WHEN dated THEN v END IGNORE NULLS) OVER b, '') || ' ' || v"))} AS raw, v AS part, 'Skills' AS section, dated
FROM (SELECT *, regexp_matches(v, '(?i){vocab.DATED_LINE}') AS dated FROM ({_listed(_body_sql('Skills'), _lines_of(_strip(f"regexp_extract(body, '(?is){vocab.VOLUNTEERING}', 1)")))})) WINDOW b AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
_CHUNKS = f"""SELECT * FROM (SELECT doc_id, i, raw, section, {_short('c')} AS cleaned FROM (SELECT *, {_clean_chunk_sql('part', vocab.ADAPTER_PREFIX)} AS c FROM ({_chunk_rows('Achievements', 0)} UNION ALL {_chunk_rows('Additional Information', 1000000)} UNION ALL {_PUBLISHED}
UNION ALL SELECT doc_id, i, raw, part, section FROM ({_HELPED}) WHERE NOT dated AND (regexp_matches(part, '^[\\-•●▪·]') OR coalesce({_adapter_sql('part', "'Skills'")} = 'activities', false))))) WHERE cleaned <> ''
QUALIFY row_number() OVER (PARTITION BY doc_id, lower({_lines('cleaned')}) ORDER BY i) = 1"""


@query(f"""SELECT doc_id, kind, row_number() OVER (PARTITION BY doc_id, kind ORDER BY i) - 1 AS pos, cleaned AS value FROM (SELECT *, {_adapter_sql('raw', 'section')} AS kind FROM ({_CHUNKS})) WHERE kind IS NOT NULL""")
def supplemental_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Achievements, activities and publications of records."""
    rows = _merged(spark, sf_dir).withColumn("_chunks", C.classed_chunks())
    parts = [_values(rows, C.supplemental(k, "_chunks")).withColumn("kind", F.lit(k)) for k in ("achievements", "activities", "publications")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- sections of records whose blocks are headings and plain sentences


_BLOCK_HEADINGS = ["Skills", "Work Experience", "EDUCATION", "Projects:", "Languages", "Certifications", "Volunteer Work"]
_HEADED = "id % 5 = 0 AND doc_id % 7 > 0 AND NOT (doc_id % 3 = 0 AND id % 20 = 0)"
_BLOCKS = f"""SELECT doc_id, id, CASE WHEN {_HEADED} THEN list_extract({_quoted(_BLOCK_HEADINGS)}, id // 5 % {len(_BLOCK_HEADINGS)} + 1) ELSE lower(name) || ' and ' || lower(kind) || ' in use.' END AS t, {_HEADED} AS head FROM ({NOTES})"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = notes(spark, sf_dir)
    head = (F.col("id") % 5 == 0) & (F.col("doc_id") % 7 > 0) & ~((F.col("doc_id") % 3 == 0) & (F.col("id") % 20 == 0))
    body = F.concat(F.lower("name"), F.lit(" and "), F.lower("kind"), F.lit(" in use."))
    return n.select(
        "doc_id", F.col("id").alias("pos"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("block_id"), F.lit(1).alias("page_number"), F.lit(None).cast("double").alias("x0"),
        F.when(head, _chosen(_BLOCK_HEADINGS, F.floor(F.col("id") / 5))).otherwise(body).alias("text"), F.when(head, "section_heading").otherwise("paragraph").alias("label"),
    )


_SPLIT = f"""WITH b AS (SELECT *, sum(head::INT) OVER (PARTITION BY doc_id ORDER BY id) AS seq FROM ({_BLOCKS})),
s AS (SELECT doc_id, seq, coalesce(max({_heading_sql('t')}) FILTER (head), 'General') AS heading, coalesce({_lines("string_agg(t, chr(10) ORDER BY id) FILTER (NOT head)")}, '') AS content, count(*) FILTER (NOT head) AS blocks, string_agg('b' || id, ';' ORDER BY id) FILTER (NOT head) AS block_ids FROM b GROUP BY doc_id, seq),
k AS (SELECT * FROM s WHERE content <> '' OR heading <> 'General'), f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY seq) = 1 OR content <> '')
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq)::INT AS section_seq, heading, content, block_ids, blocks FROM f"""


@query(f"SELECT doc_id, section_seq, heading, content, block_ids FROM ({_SPLIT})")
def record_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of records: some begin without a heading, some have none."""
    return S.split(_blocks(spark, sf_dir))[0].select("doc_id", "section_seq", "heading", "content", F.array_join("block_ids", ";").alias("block_ids"))


@query(f"""WITH s AS (SELECT doc_id, count(*)::INT AS section_count, sum(blocks) FILTER (heading = 'General') AS general, bool_and(heading = 'General') AS all_general FROM ({_SPLIT}) GROUP BY doc_id), t AS (SELECT doc_id, count(*) AS n FROM ({_BLOCKS}) GROUP BY doc_id)
SELECT doc_id, section_count, coalesce(general, 0) / n::DOUBLE AS general_block_ratio, array_to_string(list_filter([CASE WHEN section_count = 1 AND all_general THEN 'document_collapsed_into_general' END, CASE WHEN coalesce(general, 0) / n::DOUBLE > 0.7 THEN 'oversized_general_section' END], lambda x: x IS NOT NULL), ';') AS possible_errors,
0 AS recovered_section_splits FROM t JOIN s USING (doc_id)""")
def record_section_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split(_blocks(spark, sf_dir))[1].select("doc_id", "section_count", "general_block_ratio", F.array_join("possible_errors", ";").alias("possible_errors"), "recovered_section_splits")


@query(f"""SELECT doc_id, 'b' || id AS block_id FROM ({_BLOCKS}) WHERE NOT head AND id % 3 = 0""")
def record_unassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that no section holds, after every third was taken out of its section."""
    blocks = _blocks(spark, sf_dir)
    sections = S.split(blocks)[0].withColumn("block_ids", F.filter("block_ids", lambda b: F.regexp_replace(b, "b", "").cast("long") % 3 != 0))
    return Q.unassigned(blocks, sections).select("doc_id", "block_id")


# --- merging of boxless blocks: those of HTML pages


_RAW = base.ORACLES["html_blocks"]
_FORM = _lines("text")
_CAND = "regexp_replace(lower(regexp_replace(t, ':+$', '')), '\\s+', ' ', 'g')"
_MERGED_HTML = f"""WITH r AS (SELECT doc_id, block_id, text, {_FORM} AS t, row_number() OVER (PARTITION BY doc_id ORDER BY block_id) AS pos FROM ({_RAW})),
f AS (SELECT *, t <> '' AND {_in('substr(t, 1, 1)', vocab.BULLETS)} AS bullet, regexp_matches(t, '[.!?;:]$') AS stop, regexp_matches(t, '^\\p{{Ll}}') AS low,
t <> '' AND NOT contains(t, chr(10)) AND ({_in(_CAND, vocab.MERGE_HEADINGS)} OR ({_words(_CAND)} <= 4 AND t = upper(t) AND NOT {_in(_CAND, vocab.NOT_HEADINGS)})) AS alone, {_words('t')} AS n FROM r),
j AS (SELECT *, coalesce(lag(t) OVER w IS NOT NULL AND NOT alone AND lag(t) OVER w <> '' AND t <> '' AND (lag(bullet) OVER w OR (NOT lag(stop) OVER w AND low)), false) AS joined FROM f WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT *, sum((NOT joined)::INT) OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS grp FROM j)
SELECT doc_id, grp::INT AS pos, string_agg(block_id, ';' ORDER BY pos) AS source_block_ids, string_agg(text, chr(10) ORDER BY pos) AS original_text,
{_lines("CASE WHEN NOT arg_min(bullet, pos) AND arg_min(t <> '' AND n <= 5 AND NOT bullet, pos) THEN string_agg(t, ' | ' ORDER BY pos) ELSE string_agg(t, ' ' ORDER BY pos) END")} AS text FROM g GROUP BY doc_id, grp"""


@query(f"SELECT doc_id, pos, source_block_ids, original_text, text, {_KIND.replace(chr(91) + 'A-Z' + chr(93), chr(92) + 'p{Lu}').replace('(t, ', '(text, ').replace('(t)', '(text)').replace(' t ', ' text ')} AS inferred_kind FROM ({_MERGED_HTML})")
def html_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of HTML pages merged where they run on; a group's head decides what stands between its parts."""
    rows = B.merge(B.from_html(table(spark, sf_dir, "pages")))
    return rows.select("doc_id", "pos", F.array_join("source_block_ids", ";").alias("source_block_ids"), "original_text", "text", "inferred_kind")


# --- merged groups, batches, JSON


_GROUPED = f"""SELECT doc_id, size % 4 AS grp, id AS ord, CASE size % 3 WHEN 0 THEN 'parser' WHEN 1 THEN 'phase2_input' ELSE 'optimizer' END AS source, size % 3 AS rank, {_flat('t')} AS raw, CASE WHEN size % 5 > 0 THEN {_flat('kind')} ELSE '' END AS d,
{base._IDENTITY.format(x=_flat('name'))} AS p, CASE WHEN size % 2 = 0 THEN {base._IDENTITY.format(x=_flat('kind'))} ELSE '' END AS s, CASE WHEN size % 7 = 0 THEN '2020' ELSE '' END AS dates FROM ({NOTES})"""


@query(f"""WITH e AS ({_GROUPED}) SELECT doc_id, grp, coalesce(arg_min(p, rank * 1000000000 + ord) FILTER (p <> ''), '') AS primary_name, coalesce(arg_min(s, rank * 1000000000 + ord) FILTER (s <> ''), '') AS secondary_name, coalesce(arg_min(dates, rank * 1000000000 + ord) FILTER (dates <> ''), '') AS date_range,
arg_max(CASE WHEN d <> '' THEN d ELSE raw END, (d <> '')::BIGINT * 1000000000000 + length(CASE WHEN d <> '' THEN d ELSE raw END) * 10000000 - ord) AS description, CASE WHEN count(DISTINCT source) > 1 THEN 'merged' ELSE min(source) END AS source,
NOT (count(DISTINCT source) = 1 AND min(source) = 'optimizer') AS grounded, array_to_string(list_filter([CASE WHEN bool_or(source = 'parser') AND bool_or(source = 'phase2_input') THEN 'merged parser with phase2 candidate evidence' END,
CASE WHEN bool_or(source = 'optimizer') AND count(DISTINCT source) > 1 THEN 'accepted grounded optimizer augmentation' END], lambda x: x IS NOT NULL), ';') AS notes FROM e GROUP BY doc_id, grp""")
def merged_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of a record as evidence of four entries, merged."""
    size = F.col("size")
    source = F.when(size % 3 == 0, "parser").when(size % 3 == 1, "phase2_input").otherwise("optimizer")
    rows = notes(spark, sf_dir).select(
        "doc_id", (size % 4).alias("grp"), F.col("id").alias("ord"), F.lit("projects").alias("kind"), source.alias("source"), F.col("t").alias("raw_text"), F.col("name").alias("primary_name"), F.when(size % 2 == 0, F.col("kind")).otherwise("").alias("secondary_name"),
        F.when(size % 7 == 0, "2020").otherwise("").alias("date_range"), F.when(size % 5 > 0, F.col("kind")).otherwise("").alias("description"), F.array().cast("array<string>").alias("technologies"),
    )
    out = G.merge_group(rows)
    return out.select("doc_id", "grp", "primary_name", "secondary_name", "date_range", "description", "source", "grounded", F.array_join("notes", ";").alias("notes"))


def grouped_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes as evidence (doc_id, field, source, ord, entry) of a record's four grouped fields: JSON of the optimizer and the parser, and candidates."""
    size, t = F.col("size"), F.col("t")
    source = F.when(size % 4 == 0, "optimizer").when(size % 4 == 1, "parser").otherwise("source")
    dates = F.when(size % 3 == 0, F.concat((2000 + size % 20).cast("string"), F.lit(" - 2022"))).otherwise("")
    forms = {
        "experience": F.to_json(F.struct(F.col("kind").alias("company_name"), F.col("name").alias("title"), dates.alias("duration"), t.alias("description"))),
        "education": F.to_json(F.struct(F.col("kind").alias("university_name"), F.concat(F.lit("Bachelor of "), "name").alias("degree"), dates.alias("graduation_date"), F.array("name").alias("coursework"))),
        "projects": F.to_json(F.struct(F.col("name").alias("project_name"), F.when(size % 2 == 0, t).otherwise("").alias("description"), F.split("kind", " ").alias("tools"), dates.alias("duration"))),
        "trainings_courses": F.to_json(F.struct(F.col("kind").alias("institution"), F.col("name").alias("title"), F.when(size % 2 == 0, t).otherwise("").alias("description"))),
    }
    field, entry = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (name, form) in enumerate(forms.items()):
        field = F.when(F.col("id") % 4 == i, name).otherwise(field)
        entry = F.when(F.col("id") % 4 == i, form).otherwise(entry)
    text_ = F.concat_ws(" | ", "name", "kind", dates)
    return notes(spark, sf_dir).select("doc_id", field.alias("field"), source.alias("source"), F.col("id").alias("ord"), F.when(source == "source", text_).otherwise(entry).alias("entry"))


@query(None)
def grouped_recovery_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every record's four grouped fields become, an entry a row."""
    return G.recover_entries(grouped_entries(spark, sf_dir))[0]


@query(None)
def grouped_recovery_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was filled or appended, from which evidence."""
    return G.recover_entries(grouped_entries(spark, sf_dir))[1]


@query(f"""SELECT count(*) AS processed_files, count(*) FILTER (weak) AS weak_files, avg(score) AS mean_score, (SELECT count(*) FROM pages) AS failed_files, count(*) + (SELECT count(*) FROM pages) AS total_files FROM ({base.ORACLES['block_quality_audit']})""")
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audited documents, with pages in the place of failures."""
    return Q.batch_summary(base.block_quality_audit(spark, sf_dir), table(spark, sf_dir, "pages"))


@query(f"""SELECT id, array_to_string(list_filter([{_flat('t')}, {_flat('kind')}, {_flat('name')}, {_flat("'\"' || t || ': \\'")}, {_flat('brand')}, {_flat('name')}], lambda x: x <> ''), '¦') AS leaves, array_to_string(list_filter([{_flat('name')}, {_flat('t')}], lambda x: x <> ''), '¦') AS listed, {_flat('kind')} AS single FROM ({NOTES})""")
def json_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String leaves of a JSON record of each note, and its strings under one key."""
    inner = F.struct(F.array(F.array("name"), F.array().cast("array<string>")).alias("y"), F.concat(F.lit('"'), "t", F.lit(": \\")).alias('a "key":'))
    doc = F.to_json(F.struct(F.col("t").alias("z"), F.struct(F.array("kind").alias("c"), F.col("size").alias("n"), F.array(inner).alias("m")).alias("b"), F.array("brand", "name").alias("a")))
    flat = F.parse_json(F.to_json(F.struct(F.array("name", "t").alias("l"), F.col("kind").alias("s"))))
    rows = notes(spark, sf_dir).select("id", doc.alias("doc"), flat.alias("v"))
    return rows.select("id", F.array_join(R.string_leaves(F.col("doc")), "¦").alias("leaves"), F.array_join(P.string_list(F.col("v"), "l"), "¦").alias("listed"), F.array_join(P.string_list(F.col("v"), "s"), "¦").alias("single"))


# --- contacts of documents


def _first_of(x: str, key: str = "lower(v)") -> str:
    """Distinct values of a list in order, joined."""
    return f"(SELECT string_agg(v, '¦' ORDER BY i) FROM (SELECT v, min(i) AS i FROM (SELECT first(v) OVER (PARTITION BY {key} ORDER BY i) AS v, i FROM (SELECT unnest(l) AS v, unnest(range(1, len(l) + 1)) AS i FROM (SELECT {x} AS l))) WHERE v <> '' GROUP BY v))"


_TITLED = "NOT regexp_matches({x}, '(^|[^\\p{{L}}])\\p{{Ll}}') AND NOT regexp_matches({x}, '\\p{{L}}\\p{{Lu}}')"
_TITLE_WIDE = "array_to_string(list_transform(regexp_extract_all(lower({x}), '\\p{{L}}+|[^\\p{{L}}]+'), lambda r: upper(r[1]) || r[2:]), '')"
_NAME_LIKE = f"p <> '' AND NOT {_mail_sql('p')} AND {_words('p')} BETWEEN 2 AND 4 AND (({_TITLED.format(x='p')}) OR p = upper(p))"


@query(f"""SELECT doc_id, coalesce({_first_of(f"list_transform(list_filter({_lines_of('t')}, lambda p: {_NAME_LIKE}), lambda p: CASE WHEN {_TITLED.format(x='p')} THEN p ELSE {_TITLE_WIDE.format(x='p')} END)")}, '') AS name,
coalesce({_first_of(f"regexp_extract_all(t, '{base._EMAIL}')")}, '') AS email, coalesce({_first_of(f"list_transform(regexp_extract_all(t, '{base._PHONE}'), lambda p: {_lines('p')})")}, '') AS phone,
coalesce({_first_of(f"list_filter({_split_sql('t')}, lambda p: {_any('lower(p)', vocab.CONTACT_PLACES)})")}, '') AS location FROM (SELECT doc_id, {_lines("substr(text, 1, 1200)")} AS t FROM documents)""")
def contact_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, addresses, numbers and places that every document offers as contacts; by its rule an operator of this kind reads the head of a text."""
    rows = base.contact_candidates(spark, sf_dir)
    return rows.select("doc_id", *(F.array_join(c, "¦").alias(c) for c in ("name", "email", "phone", "location")))

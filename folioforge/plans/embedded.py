"""Queries of headings inside blocks, over blocks made from whole tables.

Every part gives one block: its words, an alias of a section in one of three spellings, and one of fourteen
ways to put them together (before, behind, between pipes, on lines of their own), so that the parts have
thousands of shapes. Twenty blocks are a record; the blocks of every fifth record hold no alias. Spark and
SQL make the same blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text, vocab
from folioforge.operators import headings
from folioforge.operators import sections as S
from folioforge.plans import queries as base
from folioforge.plans.queries import query, table

_ORDER = list(vocab.SECTION_ALIASES)
_ALIASES = "(VALUES " + ", ".join(f"({i}, '{a}', '{vocab.SECTION_ALIASES[a]}')" for i, a in enumerate(sorted(_ORDER, key=len, reverse=True))) + ") AS x(ord, alias, name)"
_NAMES = "map {" + ", ".join(f"'{a}': '{n}'" for a, n in vocab.SECTION_ALIASES.items()) + "}"
#: {h} the alias, {u} it in capitals, {a} and {b} words of the part, {s} two of them in capitals.
SHAPES = ["{h} {a}", "{h}: {a}", "{h}\n{a}", "{h} {a}\n{b}", "{a} | {h} | {b}", "{a} | {h} {b}", "{a} {h} | {b}", "{a} {u}", "{a}\n{u}", "{a}\n{h}:", "{a} and {b}.", "• {a} {h}", "{s}", "{h}"]


def _shape_sql() -> str:
    whens = []
    for i, shape in enumerate(SHAPES):
        x = "'" + shape.replace("\n", "¶") + "'"
        for name in "huabs":
            x = f"replace({x}, '{{{name}}}', {name})"
        whens.append(f"WHEN {i} THEN replace({x}, '¶', chr(10))")
    return f"CASE way {' '.join(whens)} END"


_LISTED = "[" + ", ".join(f"'{a}'" for a in _ORDER) + "]"
BLOCKS = f"""SELECT id, doc_id, {_shape_sql()} AS t, CASE WHEN way = 12 AND id % 2 = 0 THEN 'section_heading' ELSE 'paragraph' END AS label FROM (
SELECT *, upper(h) AS u, upper(array_to_string(string_split(a, ' ')[1:2], ' ')) AS s, CASE WHEN doc_id % 5 = 0 THEN CASE WHEN id % 7 = 3 THEN 12 ELSE 10 END ELSE (id * 5 + id // 14) % {len(SHAPES)} END AS way FROM (
SELECT *, CASE id // 3 % 3 WHEN 0 THEN alias WHEN 1 THEN upper(alias) ELSE upper(alias[1]) || alias[2:] END AS h FROM (
SELECT p_partkey AS id, p_partkey // 20 AS doc_id, trim(lower(p_name)) AS a, trim(lower(p_type)) AS b, list_extract({_LISTED}, p_partkey * 11 % {len(_ORDER)} + 1) AS alias FROM part)))"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled blocks (doc_id, pos, block_id, page_number, x0, text, label), one of every part."""
    k, d = F.col("p_partkey"), F.floor(F.col("p_partkey") / 20).cast("long")
    alias = F.element_at(F.array(*map(F.lit, _ORDER)), (k * 11 % len(_ORDER) + 1).cast("int"))
    rows = table(spark, sf_dir, "part").select(k.alias("pos"), d.alias("doc_id"), F.trim(F.lower("p_name")).alias("a"), F.trim(F.lower("p_type")).alias("b"), alias.alias("alias"))
    style = F.floor(F.col("pos") / 3) % 3
    rows = rows.withColumn("h", F.when(style == 0, F.col("alias")).when(style == 1, F.upper("alias")).otherwise(F.concat(F.upper(F.left("alias", F.lit(1))), F.expr("substring(alias, 2)"))))
    rows = rows.withColumn("u", F.upper("h")).withColumn("s", F.upper(F.array_join(F.slice(F.split("a", " "), 1, 2), " ")))
    plain = F.when(F.col("pos") % 7 == 3, 12).otherwise(10)
    rows = rows.withColumn("way", F.when(F.col("doc_id") % 5 == 0, plain).otherwise((F.col("pos") * 5 + F.floor(F.col("pos") / 14)) % len(SHAPES)))
    t = F.element_at(F.array(*map(F.lit, SHAPES)), (F.col("way") + 1).cast("int"))
    for name in "huabs":
        t = F.replace(t, F.lit("{" + name + "}"), F.col(name))
    label = F.when((F.col("way") == 12) & (F.col("pos") % 2 == 0), "section_heading").otherwise("paragraph")
    return rows.select("doc_id", "pos", F.concat(F.lit("b"), F.col("pos").cast("string")).alias("block_id"), F.lit(1).alias("page_number"), F.lit(None).cast("double").alias("x0"), t.alias("text"), label.alias("label"))


def _key(x: str) -> str:
    return f"regexp_replace(lower(trim(regexp_replace({x}, '[:|–-]+$', ''), ' ' || chr(10))), '\\s+', ' ', 'g')"


def _named(k: str) -> str:
    return f"coalesce({_NAMES}[{k}], {_NAMES}[replace({k}, '&', 'and')])"


def _join(parts: str) -> str:
    return f"array_to_string(list_filter({parts}, lambda p: p <> ''), ' | ')"


# the rules one after another: what begins a block, what stands between pipes, what ends it
FOUND = f"""WITH b AS (SELECT *, split_part(t, chr(10), 1) AS line, CASE WHEN contains(t, chr(10)) THEN substr(t, strpos(t, chr(10)) + 1) ELSE '' END AS rest, {_named(_key('t'))} AS named FROM ({BLOCKS})),
l1 AS (SELECT id, arg_min(name, ord) AS h, arg_min(alias, ord) AS alias FROM b, {_ALIASES} WHERE starts_with({_key('line')}, alias || ' ') AND ltrim(substr(line, length(alias) + 1), ' |:-–') <> '' GROUP BY id),
lead AS (SELECT b.id, coalesce({_named(_key('line'))}, h) AS h, CASE WHEN {_named(_key('line'))} IS NOT NULL THEN rest ELSE ltrim(substr(line, length(alias) + 1), ' |:-–') || CASE WHEN rest <> '' THEN chr(10) || rest ELSE '' END END AS after FROM b LEFT JOIN l1 USING (id)),
p AS (SELECT id, ps, i, trim(ps[i], ' ' || chr(10)) AS p FROM (SELECT id, string_split(t, '|') AS ps, unnest(range(1, len(string_split(t, '|')) + 1)) AS i FROM b WHERE contains(t, '|'))),
p1 AS (SELECT id, i, arg_min(name, ord) AS h, arg_min(alias, ord) AS alias, arg_min(starts_with({_key('p')}, alias || ' '), ord) AS first FROM p, {_ALIASES} WHERE starts_with({_key('p')}, alias || ' ') OR ends_with({_key('p')}, ' ' || alias) GROUP BY id, i),
p2 AS (SELECT p.*, {_named(_key('p'))} AS own, h, alias, first, string_split(p, ' ') AS w, len(string_split(alias, ' ')) AS n FROM p LEFT JOIN p1 USING (id, i)),
inl AS (SELECT id, coalesce(own, h) AS h, {_join("list_append(list_transform(ps[1:i - 1], lambda q: trim(q, ' ' || chr(10))), CASE WHEN own IS NULL AND NOT first THEN array_to_string(w[1:len(w) - n], ' ') ELSE '' END)")} AS before,
{_join("list_prepend(CASE WHEN own IS NULL AND first THEN array_to_string(w[n + 1:], ' ') ELSE '' END, list_transform(ps[i + 1:], lambda q: trim(q, ' ' || chr(10))))")} AS after FROM p2 WHERE own IS NOT NULL OR h IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY i) = 1),
z AS (SELECT id, t, list_filter(string_split(t, chr(10)), lambda q: trim(q) <> '') AS ls FROM b),
t1 AS (SELECT id, arg_min(name, ord) AS h, arg_min(alias, ord) AS alias FROM b, {_ALIASES} WHERE ends_with(t, ' ' || upper(alias)) GROUP BY id),
trail AS (SELECT z.id, CASE WHEN shown THEN own ELSE h END AS h, CASE WHEN shown THEN array_to_string(ls[1:len(ls) - 1], chr(10)) ELSE trim(substr(t, 1, length(t) - length(alias))) END AS before
FROM (SELECT *, {_named(_key('ls[-1]'))} AS own, {_named(_key('ls[-1]'))} IS NOT NULL AND (regexp_matches(ls[-1], '^[A-Z][A-Z\\s/&-]{{2,}}$') OR ends_with(ls[-1], ':')) AS shown FROM z) z LEFT JOIN t1 USING (id))
SELECT b.id, b.doc_id, b.t, b.label, b.named, CASE WHEN lead.h IS NOT NULL THEN 'leading' WHEN inl.h IS NOT NULL THEN 'inline' WHEN trail.h IS NOT NULL THEN 'trailing' END AS kind, coalesce(lead.h, inl.h, trail.h) AS heading,
CASE WHEN lead.h IS NOT NULL THEN '' WHEN inl.h IS NOT NULL THEN inl.before WHEN trail.h IS NOT NULL THEN trail.before END AS before, CASE WHEN lead.h IS NOT NULL THEN lead.after WHEN inl.h IS NOT NULL THEN inl.after WHEN trail.h IS NOT NULL THEN '' END AS after
FROM b LEFT JOIN lead USING (id) LEFT JOIN inl USING (id) LEFT JOIN trail USING (id)"""


@query(f"SELECT id, kind, heading, before, after, named FROM ({FOUND})")
def embedded_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The heading inside every block, where it stands, and what is left of the block."""
    rows = blocks(spark, sf_dir).select(F.col("pos").alias("id"), text.normalize_lines("text").alias("t"))
    return rows.select("id", headings.found(F.col("t")).alias("f")).select("id", "f.kind", "f.heading", *(F.when(F.col("f.kind").isNotNull(), text.normalize_lines(f"f.{c}")).alias(c) for c in ("before", "after")), "f.named")


_OTHER = "coalesce(kind, 'trailing') = 'trailing'"
_SHOWN = "regexp_replace(t, ':+$', '')"


def _looks(x: str) -> str:
    n = f"len(regexp_extract_all(regexp_replace({x}, ':+$', ''), '\\S+'))"
    return f"({_named(_key(x))} IS NOT NULL OR ({n} BETWEEN 1 AND 4 AND NOT regexp_matches({x}, '[.!?]$') AND ({x} = upper({x}) OR ends_with({x}, ':'))))"


_PIECES = f"""WITH f AS (SELECT *, {_OTHER} AS other, {_OTHER} AND label = 'section_heading' AS bound FROM ({FOUND})), g AS (SELECT *, other AND NOT bound AND kind IS NOT NULL AS trail FROM f),
w AS (SELECT *, CASE WHEN other THEN lag(CASE WHEN trail THEN heading END) OVER (PARTITION BY doc_id, other ORDER BY id) END AS waiting, count(*) OVER (PARTITION BY doc_id) AS blocks FROM g),
e AS (SELECT doc_id, id, 0 AS sub, NULL AS start, before AS body, label, blocks FROM w WHERE kind = 'inline' AND before <> '' UNION ALL SELECT doc_id, id, 0, waiting, NULL, label, blocks FROM w WHERE waiting IS NOT NULL
UNION ALL SELECT doc_id, id, 1, heading, NULL, label, blocks FROM w WHERE NOT other UNION ALL SELECT doc_id, id, 1, coalesce(named, {_SHOWN}), NULL, label, blocks FROM w WHERE bound
UNION ALL SELECT doc_id, id, 2, NULL, after, label, blocks FROM w WHERE NOT other AND after <> '' UNION ALL SELECT doc_id, id, 2, NULL, before, label, blocks FROM w WHERE trail AND before <> '' UNION ALL SELECT doc_id, id, 2, NULL, t, label, blocks FROM w WHERE other AND NOT trail),
q AS (SELECT *, count(start) OVER o AS seq, coalesce(last_value(start IGNORE NULLS) OVER o, 'General') AS heading FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY id, sub, start IS NULL ROWS UNBOUNDED PRECEDING)),
c AS (SELECT doc_id, id, sub, seq, heading, body, label, blocks, rtrim(body, ' -–|') AS clean, {_looks('body')} AS looks FROM q WHERE start IS NULL),
s AS (SELECT doc_id, seq, any_value(heading) AS heading, any_value(blocks) AS blocks, count(*) AS n, bool_or(looks) AS looks, coalesce(bool_and(clean = '') FILTER (label <> 'section_heading'), true) AS empty FROM c GROUP BY doc_id, seq),
k AS (SELECT * FROM s WHERE NOT empty OR heading <> 'General' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY seq) = 1 OR NOT empty),
d AS (SELECT *, count(*) OVER x AS sections, sum(CASE WHEN heading = 'General' THEN n ELSE 0 END) OVER x / blocks::DOUBLE AS ratio, bool_or(heading = 'General' AND looks) OVER x AS inside FROM k WINDOW x AS (PARTITION BY doc_id)),
r AS (SELECT c.*, d.heading = 'General' AND (sections <= 1 OR ratio > 0.7 OR inside) AND looks_ AS cut FROM (SELECT *, looks AS looks_ FROM c) c JOIN d USING (doc_id, seq)),
v AS (SELECT *, sum(cut::INT) OVER (PARTITION BY doc_id, seq ORDER BY id, sub) AS part FROM r), y AS (SELECT *, max(part) OVER m - min(part) OVER m AS parts, CASE WHEN cut THEN coalesce({_named(_key('body'))}, regexp_replace(body, ':+$', '')) END AS named FROM v WINDOW m AS (PARTITION BY doc_id, seq)),
h AS (SELECT *, CASE WHEN parts > 0 THEN coalesce(last_value(named IGNORE NULLS) OVER (PARTITION BY doc_id, seq ORDER BY id, sub ROWS UNBOUNDED PRECEDING), heading) ELSE heading END AS shown, CASE WHEN parts > 0 THEN part ELSE 0 END AS place FROM y),
u AS (SELECT doc_id, seq, place, arg_min(shown, (id, sub)) AS heading, any_value(blocks) AS blocks, any_value(parts) AS parts, count(*) AS n, bool_or(looks) AS looks, string_agg('b' || id, ';' ORDER BY id, sub) AS block_ids,
coalesce(string_agg(CASE WHEN parts > 0 THEN body ELSE clean END, chr(10) ORDER BY id, sub) FILTER (label <> 'section_heading'), '') AS content FROM h GROUP BY doc_id, seq, place),
a AS (SELECT *, sum(CASE WHEN first THEN parts ELSE 0 END) OVER (PARTITION BY doc_id) AS splits FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, seq ORDER BY place) = 1 AS first FROM u)),
final AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY seq, place) = 1 OR content <> '')"""


@query(f"{_PIECES} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY seq, place)::INT AS section_seq, heading, content, block_ids FROM final")
def embedded_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of records whose headings stand anywhere in their blocks; those that look collapsed are split again."""
    return S.split(blocks(spark, sf_dir))[0].select("doc_id", "section_seq", "heading", "content", F.array_join("block_ids", ";").alias("block_ids"))


@query(f"""{_PIECES} SELECT doc_id, count(*)::INT AS section_count, sum(CASE WHEN heading = 'General' THEN n ELSE 0 END) / any_value(blocks)::DOUBLE AS general_block_ratio, array_to_string(list_filter([
CASE WHEN count(*) = 1 AND bool_and(heading = 'General') THEN 'document_collapsed_into_general' END, CASE WHEN sum(CASE WHEN heading = 'General' THEN n ELSE 0 END) / any_value(blocks)::DOUBLE > 0.7 THEN 'oversized_general_section' END,
CASE WHEN bool_or(heading = 'General' AND looks) THEN 'heading_candidates_found_inside_general' END], lambda x: x IS NOT NULL), ';') AS possible_errors, any_value(splits)::INT AS recovered_section_splits FROM final GROUP BY doc_id""")
def embedded_section_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What looks wrong with those sections, and how many came from splitting again."""
    return S.split(blocks(spark, sf_dir))[1].select("doc_id", "section_count", "general_block_ratio", F.array_join("possible_errors", ";").alias("possible_errors"), "recovered_section_splits")

"""The registered queries of the reference operators, with the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import arrays, text, vocab
from folioforge.operators import blocks as B
from folioforge.operators import candidates as C
from folioforge.operators import grounding as GR
from folioforge.operators import grouped as G
from folioforge.operators import lists as L
from folioforge.operators import matching as M
from folioforge.operators import quality as Q
from folioforge.operators import reports as R
from folioforge.operators import sections as S
from folioforge.plans import extraction as X
from folioforge.sources import payloads as P
from folioforge.sources.staging import staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL pieces, for RE2

_STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
_FLAT = "trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def _flat(x: str) -> str:
    return _FLAT.format(x=x)


def _lines(x: str) -> str:
    """normalize_lines in DuckDB."""
    x = f"regexp_replace({x}, '\\r\\n?|\\x{{2028}}|\\x{{2029}}', chr(10), 'g')"
    x = f"regexp_replace({x}, '[^\\S\\n]+', ' ', 'g')"
    x = f"regexp_replace({x}, '(?m)^ | $', '', 'g')"
    x = f"regexp_replace({x}, '(?m)^([•\\-*▪◦–]) ?', '\\1 ', 'g')"
    x = f"regexp_replace({x}, '(?m)^([•\\-*▪◦–]) $', '\\1', 'g')"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return _STRIP.format(x=x)


def _words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '\\S+'))"


_EMAIL, _PHONE, _URL = r"[\p{L}\p{N}_.\-+%]+@[\p{L}\p{N}_.\-]+\.[A-Za-z]{2,}", r"(\+?\p{Nd}[\p{Nd}\s().-]{7,}\p{Nd})", r"(?i)\b(?:linkedin|github|portfolio|www\.|https?://)"


def _label(t: str, i: str) -> str:
    """The label of a line without a box."""
    heads = ", ".join(f"'{h}'" for h in vocab.LABEL_HEADINGS)
    marks = ", ".join(f"'{m}'" for m in vocab.BULLETS)
    contact = f"(regexp_matches({t}, '{_EMAIL}') OR regexp_matches({t}, '{_PHONE}') OR regexp_matches({t}, '{_URL}'))"
    low = f"lower(regexp_replace({t}, ':+$', ''))"
    n = _words(t)
    # no lower case begins a run of letters, no upper case follows a letter
    titled = f"NOT regexp_matches({t}, '(^|[^\\p{{L}}])\\p{{Ll}}') AND NOT regexp_matches({t}, '\\p{{L}}\\p{{Lu}}')"
    return f"""CASE WHEN {t} = '' THEN 'other' WHEN regexp_replace({low}, '\\s+', ' ', 'g') IN ({heads}) THEN 'section_heading'
WHEN NOT {contact} AND length({t}) - length(replace(replace(replace({t}, '|', ''), '•', ''), ',', '')) >= 2 AND {n} <= 20 THEN 'skills_line'
WHEN {contact} AND {i} <= 2 THEN 'contact_line' WHEN substr({t}, 1, 1) IN ({marks}) THEN 'bullet'
WHEN regexp_matches({t}, '(?i){vocab.DATE_WORD}') AND {n} <= 8 THEN 'date' WHEN regexp_matches({t}, '(?i){vocab.PLACE_WORD}') AND {n} <= 6 THEN 'location'
WHEN {n} <= 8 AND (({t} = upper({t}) AND {n} <= 6) OR ({titled} AND {n} <= 4) OR {low} IN ({heads})) THEN 'heading'
WHEN {n} >= 4 THEN 'paragraph' ELSE 'other' END"""


_LINE_ROWS = f"""SELECT doc_id, pos - 1 AS pos, line AS text FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
FROM (SELECT doc_id, list_filter(string_split({_lines('text')}, chr(10)), lambda x: x <> '') AS l FROM documents))"""


def _line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every non-empty line of documents with its place."""
    lines = F.filter(F.split(text.normalize_lines("text"), "\n"), lambda x: x != "")
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(lines).alias("pos", "text"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("double")
    return _line_rows(spark, sf_dir).withColumn("label", B.label(F.col("text"), F.col("pos"), none, none))


_LABELLED = f"SELECT doc_id, pos, text, {_label('text', 'pos')} AS label FROM ({_LINE_ROWS})"


# --- scalar text functions


@query(f"SELECT doc_id, {_lines('text')} AS t FROM documents")
def text_normalize_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_lines("text").alias("t"))


@query(f"SELECT doc_id, {_flat('text')} AS t FROM documents")
def text_normalize_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_flat("text").alias("t"))


_MATCH = "trim(regexp_replace(regexp_replace(replace(lower({x}), '&', ' and '), '[^a-z0-9+#./ ]+', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"SELECT item_id, {_MATCH.format(x=_flat('text'))} AS t FROM benchmark UNION ALL SELECT doc_id, {_MATCH.format(x=_flat('text'))} FROM documents")
def text_normalize_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "benchmark").select("item_id", "text").unionByName(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text"))
    return both.select("item_id", text.normalize_for_match("text").alias("t"))


@query("SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9+#./]+'))::INT AS n_tokens, len(list_distinct(regexp_extract_all(lower(text), '[a-z0-9+#./]+')))::INT AS n_distinct FROM documents")
def match_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", text.match_tokens("text").alias("t"))
    return rows.select("doc_id", F.size("t").alias("n_tokens"), F.size(F.array_distinct("t")).alias("n_distinct"))


_IDENTITY = "trim(regexp_replace(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_\\s.+#/\\-&]', ' ', 'g'), '\\s+', ' ', 'g'))"
_TOKENS = "list_filter(regexp_extract_all({x}, '[A-Za-z0-9+#/.]+'), lambda t: length(t) > 1)"


@query(f"SELECT p_partkey, {_IDENTITY.format(x=_flat('p_name'))} AS name, array_to_string({_TOKENS.format(x=_IDENTITY.format(x=_flat('p_name')))}, '|') AS tokens FROM part")
def identity_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_identity("p_name").alias("name"), F.array_join(text.identity_tokens("p_name"), "|").alias("tokens"))


@query("SELECT page_id, rtrim(lower(regexp_replace(regexp_replace(trim(url, ' ,;|/'), '(?i)^https?://', ''), '(?i)^www\\.', '')), '/') AS t FROM pages")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.normalize_url("url").alias("t"))


@query(f"""SELECT doc_id, unnest(p) AS raw, regexp_replace(regexp_replace(unnest(p), '[^0-9+]', '', 'g'), '^\\+\\+', '+') AS phone
FROM (SELECT doc_id, regexp_extract_all({_flat('text')}, '\\+?[0-9][0-9 ().-]{{7,}}[0-9]') AS p FROM documents)""")
def phone_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all(text.normalize_flat("text"), F.lit(r"\+?[0-9][0-9 ().-]{7,}[0-9]"), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("raw")).withColumn("phone", text.normalize_phone("raw"))


@query(f"""SELECT doc_id, e AS email FROM (SELECT doc_id, e, min(i) AS i FROM (SELECT doc_id, unnest(l) AS e, unnest(range(1, len(l) + 1)) AS i
FROM (SELECT doc_id, regexp_extract_all({_lines('text')}, '[A-Za-z0-9_.\\-+%]+@[A-Za-z0-9_.\\-]+\\.[A-Za-z]{{2,}}') AS l FROM documents)) GROUP BY doc_id, lower(e), e QUALIFY row_number() OVER (PARTITION BY doc_id, lower(e) ORDER BY min(i)) = 1)""")
def contact_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all(text.normalize_lines("text"), F.lit(r"[A-Za-z0-9_.\-+%]+@[A-Za-z0-9_.\-]+\.[A-Za-z]{2,}"), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(arrays.dedupe_lines(found)).alias("email"))


@query(f"""SELECT doc_id, i, trim(p) AS part FROM (SELECT doc_id, unnest(l) AS p, unnest(range(1, len(l) + 1)) AS i FROM (
SELECT doc_id, list_filter(list_transform(flatten(list_transform(string_split({_lines('text')}, chr(10)), lambda y: string_split_regex(regexp_replace(y, ', ([A-Z][a-z])', chr(1) || '\\1', 'g'), '\\s*\\|\\s*|•|\\x01'))), lambda z: trim(z)), lambda z: z <> '') AS l FROM documents))""")
def split_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.split_candidates("text")).alias("i", "part"))
    return rows.select("doc_id", (F.col("i") + 1).cast("long").alias("i"), "part")


# --- labels and quality


@query(f"SELECT doc_id, pos, label FROM ({_LABELLED})")
def block_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("doc_id", F.col("pos").cast("long").alias("pos"), "label")


@query(f"SELECT label, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM ({_LABELLED}) GROUP BY label")
def label_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_docs"))


_SUSPICIONS = """CASE WHEN text = '' THEN ['empty_text'] ELSE list_filter([
CASE WHEN length(text) <= 2 AND label NOT IN ('date', 'location') THEN 'very_short_text' END,
CASE WHEN len(regexp_extract_all(text, '\\S+')) = 1 AND NOT regexp_matches(text, '^\\p{L}+$') AND regexp_matches(text, '\\p{Nd}') THEN 'token_like_fragment' END,
CASE WHEN regexp_matches(text, '[|_~`^<>\\[\\]{}]') AND length(text) <= 12 THEN 'layout_noise_fragment' END,
CASE WHEN length(text) - length(replace(text, '|', '')) >= 3 AND label NOT IN ('contact_line', 'skills_line') THEN 'delimiter_heavy_text' END], lambda r: r IS NOT NULL) END"""


@query(f"SELECT doc_id, pos, unnest({_SUSPICIONS}) AS reason FROM ({_LABELLED})")
def suspicious_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir).withColumn("block_id", F.col("pos")).withColumn("page_number", F.lit(1))
    return Q.suspicious(rows).select("doc_id", F.col("pos").cast("long").alias("pos"), "reason")


_AUDIT = f"""WITH l AS ({_LABELLED}), s AS (SELECT doc_id, sum(len({_SUSPICIONS})) AS suspicious, count(*) AS blocks FROM l GROUP BY doc_id),
d AS (SELECT doc_id, {_lines('text')} AS t FROM documents),
m AS (SELECT d.doc_id, length(t) AS size, CASE WHEN length(t) > 0 THEN len(regexp_extract_all(t, '[A-Za-z0-9]')) / length(t)::DOUBLE ELSE 0 END AS alnum,
len(regexp_extract_all(t, '[|_~`^<>\\[\\]{{}}]')) / greatest(1, length(replace(t, ' ', '')))::DOUBLE AS noise, coalesce(suspicious, 0) AS suspicious, coalesce(blocks, 0) AS blocks FROM d LEFT JOIN s USING (doc_id)),
p AS (SELECT *, 50 * (size < 120)::INT + 25 * (size >= 800)::INT + 12 * (suspicious >= greatest(5, blocks // 3))::INT + 25 * (alnum < 0.45)::INT + 12 * (noise > 0.08)::INT + 5 * (blocks > 8)::INT AS off FROM m)
SELECT doc_id, size AS text_length, suspicious::BIGINT AS suspicious_count, greatest(0, 100 - off) AS score, (size < 120 OR size >= 800 OR alnum < 0.45 OR 100 - off < 70) AS weak, round_even(alnum, 3) AS alnum_ratio, round_even(noise, 3) AS noise_ratio FROM p"""


@query(_AUDIT)
def block_quality_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised lines, their labels, what is suspicious about them, and a score for every document, in one pass without a shuffle."""
    none = F.lit(None).cast("double")
    docs = table(spark, sf_dir, "documents").select("doc_id", text.normalize_lines("text").alias("full_text"))
    lines = F.filter(F.split("full_text", "\n"), lambda x: x != "")
    odd = F.transform(lines, lambda x, i: F.size(B.suspicions(x, B.label(x, i, none, none))))
    docs = docs.select("*", odd.alias("odd")).select("doc_id", "full_text", F.aggregate("odd", F.lit(0), lambda a, n: a + n).cast("long").alias("suspicious_count"), F.size("odd").alias("semantic_count"))
    docs = docs.select(
        "*", F.lit(1).alias("section_count"), F.lit(0.0).alias("general_block_ratio"), F.array().cast("array<string>").alias("possible_errors"), F.lit(0).alias("merged_block_count"), F.col("semantic_count").alias("raw_count"), F.lit(1).alias("page_count")
    )
    return Q.audit(docs).select("doc_id", F.length("full_text").cast("long").alias("text_length"), "suspicious_count", F.col("score").cast("int").alias("score"), "weak", "alnum_ratio", "noise_ratio")


@query(f"""WITH p AS (SELECT page_id % 20 AS doc_id, {_flat('url')} AS t, 1 AS b FROM pages)
SELECT doc_id, count(*) AS page_count, count(*) FILTER (t = '') AS empty_pages, sum(length(t))::BIGINT AS text_chars, sum(b)::BIGINT AS block_count,
(sum(length(t)) < 80 OR count(*) FILTER (t = '') * 2 >= count(*) OR sum(b) <= greatest(1, count(*) // 2)) AS weak FROM p GROUP BY doc_id""")
def extraction_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select((F.col("page_id") % 20).alias("doc_id"), F.col("page_id").alias("page_number"), text.normalize_flat("url").alias("text"), F.lit(1).alias("block_count"))
    return Q.weak(pages)


def _html_sql(x: str) -> str:
    for tag in ("script", "style", "head"):  # from the first of them on, each up to its own end
        x = f"regexp_replace({x}, '(?is)<{tag}\\b.*?</{tag}>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?i)<li\\b[^>]*>', chr(10) || '• ', 'g')"
    x = f"regexp_replace({x}, '(?i)</?(h[1-6]|p|div|br|tr|ul|ol|table|section|article|nav|body|html)\\b[^>]*>', chr(10), 'g')"
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


@query(f"""SELECT doc_id, 'raw-1-' || (pos - 1) AS block_id, line AS text, 1 AS page_number FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
FROM (SELECT page_id AS doc_id, string_split({_lines(_html_sql("coalesce(html, '')"))}, chr(10)) AS l FROM pages)) WHERE line <> ''""")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.from_html(table(spark, sf_dir, "pages")).select("doc_id", "block_id", "text", "page_number")


@query(None)
def block_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.merge(B.from_lines(table(spark, sf_dir, "documents")))


@query(None)
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split(B.classify(B.merge(B.from_lines(table(spark, sf_dir, "documents")))))[0]


@query(None)
def section_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = X.extract(B.from_lines(table(spark, sf_dir, "documents")))
    return X.audited(e).select("doc_id", "section_count", "general_block_ratio", "possible_errors", "score", "weak")


@query(None)
def unassigned_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    semantic = staged(B.classify(B.merge(B.from_lines(table(spark, sf_dir, "documents")))).select("doc_id", "pos", "block_id", "page_number", "x0", "label", "text"))
    return Q.unassigned(semantic, S.split(semantic)[0])


# --- chunks and classes


@query(f"""WITH c AS (SELECT conv_id, turn, {_STRIP.format(x="text")} AS t FROM conversations),
p AS (SELECT conv_id, turn, list_filter(list_transform(string_split_regex(t, '\\n\\s*\\n'), lambda x: {_flat('x')}), lambda x: len(regexp_extract_all(lower(x), '[a-z0-9+#./]+')) >= 3) AS l FROM c),
r AS (SELECT conv_id, turn, unnest(l) AS chunk, unnest(range(1, len(l) + 1)) AS i FROM p)
SELECT conv_id, turn, chunk FROM r QUALIFY row_number() OVER (PARTITION BY conv_id, turn, {_MATCH.format(x='chunk')} ORDER BY i) = 1""")
def chunk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(R.chunks("text")).alias("chunk"))


def _class_sql(order: list[str], section_first: bool) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower(t), '{'|'.join(vocab.SUPPLEMENTAL[k])}') THEN '{k}'" for k in order)
    return f"CASE {whens} END"


_SUPPLEMENTS = "(VALUES ('Published paper at a conference'), ('Awarded 1st place in hackathon'), ('Member of the technical committee'), ('Founded an initiative'), ('Plain words'), ('Finalist in a journal competition'))"
_SUPPLEMENT_ROWS = f"SELECT * FROM {_SUPPLEMENTS} v(t) UNION ALL SELECT name FROM (SELECT p_name AS name FROM part)"


def _supplement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(f"SELECT * FROM VALUES {_SUPPLEMENTS[8:-1]} AS v(t)")
    return own.unionByName(table(spark, sf_dir, "part").select(F.col("p_name").alias("t")))


@query(f"SELECT t, {_class_sql(['publications', 'awards', 'activities', 'achievements'], False)} AS class FROM ({_SUPPLEMENT_ROWS})")
def supplemental_class_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplement_rows(spark, sf_dir).withColumn("class", C.recovery_class(F.col("t"), F.lit("")))


@query(f"SELECT t, {_class_sql(['publications', 'activities', 'achievements'], True)} AS class FROM ({_SUPPLEMENT_ROWS})")
def supplemental_class_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplement_rows(spark, sf_dir).withColumn("class", C.adapter_class(F.col("t"), F.lit("")))


# --- ordered unions


_EVIDENCE = """SELECT o_custkey AS doc_id, o_orderpriority AS value, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS ord,
CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS priority FROM orders"""
_UNION = f"""WITH e AS ({_EVIDENCE}), k AS (SELECT *, lower(trim(value, ' ,;|')) AS key FROM e),
f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY doc_id, key ORDER BY priority, ord) = 1)"""


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as evidence: status F, O and P stand for the three sources."""
    source = F.when(F.col("o_orderstatus") == "F", "optimizer").when(F.col("o_orderstatus") == "O", "source").otherwise("parser")
    ord_ = F.row_number().over(Window.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderkey"))
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.lit("priorities").alias("field"), source.alias("source"), ord_.alias("ord"), F.col("o_orderpriority").alias("value"))


@query(f"{_UNION} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY priority, ord) AS pos, value FROM f")
def list_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.recover_long(_evidence(spark, sf_dir)).select("doc_id", F.col("pos").cast("long").alias("pos"), "value")


@query(f"{_UNION} SELECT doc_id, 'Recovered prioritie: ' || value || ' from ' || CASE priority WHEN 1 THEN 'source' ELSE 'parser' END || ' evidence' AS note, 'priorities:' || value AS item FROM f WHERE priority > 0")
def list_recovery_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.recover_long(_evidence(spark, sf_dir)).where("note IS NOT NULL").select("doc_id", "note", "item")


@query(f"""WITH e AS ({_EVIDENCE}), k AS (SELECT *, lower(trim(value, ' ,;|')) AS key FROM e), m AS (SELECT * FROM k WHERE priority > 0 AND NOT EXISTS (SELECT 1 FROM k f WHERE f.priority = 0 AND f.doc_id = k.doc_id AND f.key = k.key))
SELECT doc_id, CASE priority WHEN 1 THEN 'source' ELSE 'parser' END AS source, value FROM m GROUP BY doc_id, priority, value""")
def coverage_gaps_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _evidence(spark, sf_dir)
    return R.missing_values(rows.where("source <> 'optimizer'"), rows.where("source = 'optimizer'")).select("doc_id", "source", "value")


@query(f"""WITH f(ord, field) AS (VALUES {', '.join(f"({i}, '{n}')" for i, n in enumerate(vocab.COVERAGE_FIELDS))}),
m AS (SELECT o_custkey AS doc_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'languages' WHEN '2-HIGH' THEN 'projects' ELSE 'github' END AS field, CASE o_orderstatus WHEN 'O' THEN 'phase2_input' ELSE 'parser' END AS source FROM orders WHERE o_orderstatus <> 'F')
SELECT f.field, count(DISTINCT doc_id) AS rows_affected, count(*) FILTER (source = 'phase2_input') AS phase2_input_missing_count, count(*) FILTER (source = 'parser') AS parser_missing_count FROM f LEFT JOIN m USING (field) GROUP BY f.field""")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    field = F.when(p == "1-URGENT", "languages").when(p == "2-HIGH", "projects").otherwise("github")
    rows = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.col("o_custkey").alias("doc_id"), field.alias("field"), F.when(s == "O", "phase2_input").otherwise("parser").alias("source"))
    return R.coverage_summary(rows).drop("ord")


def _skill_key_sql(x: str) -> str:
    k = f"lower(trim({_flat(x)}, ' ,;|'))"
    for n in vocab.SKILL_NOTES:
        k = f"trim(replace({k}, '{n}', ''))"
    for a, b in vocab.SKILL_SPELLINGS:
        k = f"replace({k}, '{a}', '{b}')"
    k = f"regexp_replace(regexp_replace({k}, '\\s*/\\s*', '/', 'g'), '\\s*,\\s*', ',', 'g')"
    return _flat(f"replace({k}, 'sql/sqlite', 'sql,sqlite')")


# --- matching


_ENTRY = "SELECT p_partkey AS id, p_brand AS brand, coalesce(p_name, '') AS n, coalesce(p_type, '') AS t FROM part"


def _overlap_sql(a: str, b: str) -> str:
    x, y = f"list_distinct({_TOKENS.format(x=_IDENTITY.format(x=a))})", f"list_distinct({_TOKENS.format(x=_IDENTITY.format(x=b))})"
    return f"CASE WHEN len({x}) = 0 OR len({y}) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y})) / greatest(1, least(len({x}), len({y})))::DOUBLE END"


_PAIRS = f"""WITH e AS ({_ENTRY}), p AS (SELECT a.id AS l, b.id AS r, a.n AS an, b.n AS bn, a.t AS ay, b.t AS byy FROM e a JOIN e b ON a.brand = b.brand AND a.id < b.id),
s AS (SELECT l, r, CASE WHEN lower(an) = lower(bn) THEN 4.0 WHEN {_overlap_sql('an', 'bn')} >= 0.6 THEN 2.5 ELSE 0 END AS n, CASE WHEN lower(ay) = lower(byy) THEN 3.0 WHEN {_overlap_sql('ay', 'byy')} >= 0.6 THEN 2.0 ELSE 0 END AS o,
CASE WHEN {_overlap_sql("an || ' ' || ay", "bn || ' ' || byy")} >= 0.5 THEN 1.5 ELSE 0 END AS k FROM p)"""


def _entry(n: str, y: str) -> Column:
    return F.struct(F.concat_ws(" ", n, y).alias("raw_text"), F.coalesce(n, F.lit("")).alias("primary_name"), F.coalesce(y, F.lit("")).alias("secondary_name"), F.lit("").alias("date_range"), F.array().cast("array<string>").alias("technologies"))


def _whole(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All parts as classed trainings of their brand (id, brand, cls); and the classes that match (brand, l, r, score), in both orders."""
    e = M.classed(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), _entry("p_name", "p_type").alias("entry")), "trainings_courses", ["brand"])
    return e.select("id", "brand", "cls"), M.matches(e, e, "trainings_courses", ["brand"])


_CLASSES = f"""WITH e0 AS ({_ENTRY}), e AS (SELECT min(id) AS id, max(id) AS last, brand, any_value(n) AS n, any_value(t) AS t, {_IDENTITY.format(x=_flat('n'))} AS kn, {_IDENTITY.format(x=_flat('t'))} AS kt FROM e0 GROUP BY brand, kn, kt),"""
_PAIRS_OF_CLASSES = _PAIRS.replace(f"WITH e AS ({_ENTRY}),", _CLASSES)


_OWN_CLASS = f"e.brand = e0.brand AND e.kn = {_IDENTITY.format(x=_flat('e0.n'))} AND e.kt = {_IDENTITY.format(x=_flat('e0.t'))}"
_COPIES = f"UNION ALL SELECT e.id, e0.id, e.n, e0.n, e.t, e0.t FROM e JOIN e0 ON {_OWN_CLASS} AND e0.id > e.id"
_PAIRS_AND_COPIES = _PAIRS_OF_CLASSES.replace("AND a.id < b.id)", f"AND a.id < b.id {_COPIES})")


@query(f"{_PAIRS_AND_COPIES} SELECT l, r, (n + o + k)::DOUBLE AS score FROM s WHERE n + o + k >= 4.0")
def entity_match_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a brand that match as trainings: different entries, each by its smallest part, and every other part of an entry with its smallest one."""
    e, found = _whole(spark, sf_dir)
    least = e.groupBy("cls").agg(F.min("id").alias("id"))
    rows = found.join(least.select(F.col("cls").alias("l"), F.col("id").alias("a")), "l")
    pairs = rows.where("l <> r").join(least.select(F.col("cls").alias("r"), F.col("id").alias("b")), "r")
    copies = rows.where("l = r").join(e.select(F.col("cls").alias("r"), F.col("id").alias("b")), "r")
    return pairs.unionByName(copies).where("a < b").select(F.col("a").alias("l"), F.col("b").alias("r"), "score")


@query(f"{_CLASSES[:-1]} SELECT e0.id, e.id AS class FROM e0 JOIN e ON {_OWN_CLASS}")
def entity_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest part of its brand that is the same entry, for every part."""
    e = M.classed(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), _entry("p_name", "p_type").alias("entry")), "trainings_courses", ["brand"])
    return e.join(e.groupBy("cls").agg(F.min("id").alias("class")), "cls").select("id", "class")


#: Ids of a class are looked up in ranges of so many, so a class of any size spreads over tasks.
_SPAN = 1 << 16


def _next(probes: DataFrame, members: DataFrame) -> DataFrame:
    """(cls, id, next): the smallest member (cls, id) of a probe's class with a larger id than the probe's, where there is one."""
    ranged = [d.select("cls", "id", F.floor(F.col("id") / _SPAN).alias("range"), F.lit(m).alias("member")) for d, m in ((probes, False), (members, True))]
    w = Window.partitionBy("cls", "range").orderBy(F.desc("id"), "member").rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged[0].unionByName(ranged[1]).withColumn("next", F.last(F.when(F.col("member"), F.col("id")), ignorenulls=True).over(w)).where("not member")
    first = ranged[1].groupBy("cls", F.col("range").alias("later")).agg(F.min("id").alias("first"))
    beyond = rows.where("next is null").join(first, "cls").where("later > range").groupBy("cls", "id").agg(F.min("first").alias("next"))
    return rows.where("next is not null").select("cls", "id", "next").unionByName(beyond)


@query(f"{_PAIRS} SELECT l, r, (n + o + k)::DOUBLE AS score FROM s WHERE n + o + k >= 4.0 QUALIFY row_number() OVER (PARTITION BY l ORDER BY n + o + k DESC, r) = 1")
def entity_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the later parts of its brand the one that each part matches best, the first of equals.

    Classes are compared, not parts: of those that match a part's own and have a later part, the best ones' next part."""
    e, found = _whole(spark, sf_dir)
    last = e.groupBy(F.col("cls").alias("r")).agg(F.max("id").alias("last"))
    rows = e.select("id", F.col("cls").alias("l")).join(found.join(last, "r").select("l", "r", "score", "last"), "l").where("last > id")
    rows = rows.withColumn("n", F.rank().over(Window.partitionBy("id").orderBy(F.desc("score")))).where("n = 1")
    probes = rows.select(F.col("r").alias("cls"), "id", "score")
    after = _next(probes, e.select("cls", "id")).groupBy("id").agg(F.min("next").alias("r"))
    return probes.groupBy("id").agg(F.first("score").alias("score")).join(after, "id").select(F.col("id").alias("l"), "r", "score")


@query(f"{_PAIRS} SELECT id FROM ({_ENTRY}) WHERE id NOT IN (SELECT r FROM s WHERE n + o + k >= 4.0)")
def coverage_gaps_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a brand that match none of the brand's earlier ones: the earliest match of a class decides."""
    e, found = _whole(spark, sf_dir)
    first = e.groupBy(F.col("cls").alias("l")).agg(F.min("id").alias("first"))
    earliest = found.join(first, "l").groupBy(F.col("r").alias("cls")).agg(F.min("first").alias("first"))
    return e.join(earliest, "cls", "left").where("first IS NULL OR first >= id").select("id")


_SUPPLIED = """SELECT p_partkey AS id, p_partkey // 10 AS doc_id, p_size, p_name AS n, p_type AS t FROM part"""
_GAP_PAIRS = f"""WITH e AS ({_SUPPLIED}), p AS (SELECT a.id AS l, b.id AS r, a.n AS an, b.n AS bn, a.t AS ay, b.t AS byy FROM e a JOIN e b ON a.doc_id = b.doc_id AND a.p_size > 15 AND b.p_size <= 15),
s AS (SELECT l, r, CASE WHEN lower(an) = lower(bn) THEN 4.0 WHEN {_overlap_sql('an', 'bn')} >= 0.6 THEN 2.5 ELSE 0 END AS n, CASE WHEN lower(ay) = lower(byy) THEN 3.0 WHEN {_overlap_sql('ay', 'byy')} >= 0.6 THEN 2.0 ELSE 0 END AS o,
CASE WHEN {_overlap_sql("an || ' ' || ay", "bn || ' ' || byy")} >= 0.5 THEN 1.5 ELSE 0 END AS k FROM p)"""


@query(f"{_GAP_PAIRS} SELECT doc_id, CASE WHEN p_size > 30 THEN 'parser' ELSE 'phase2_input' END AS source, id AS ord FROM e WHERE p_size > 15 AND id NOT IN (SELECT l FROM s WHERE n + o + k >= 4.0)")
def missing_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten parts are a record: small ones its final trainings, the others evidence that may lack there."""
    rows = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 10).cast("long").alias("doc_id"), F.when(F.col("p_size") > 30, "parser").otherwise("phase2_input").alias("source"), F.col("p_partkey").alias("ord"), _entry("p_name", "p_type").alias("entry"), "p_size")
    return R.missing_entries(rows.where("p_size > 15"), rows.where("p_size <= 15"), "trainings_courses").select("doc_id", "source", "ord")


@query(None)
def grouped_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a brand as trainings: small ones by the optimizer, middle ones by the parser, large ones as candidates."""
    t = F.struct(F.col("p_name").alias("title"), F.col("p_type").alias("institution"), F.lit("").alias("description"))
    small, middle = F.col("p_size") <= 3, F.col("p_size").between(4, 6)
    by = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.min("p_partkey").alias("doc_id"),
        *(F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("p_partkey", t.alias("t"))))), lambda x: x["t"]).alias(n) for c, n in ((small, "o"), (middle, "p"))),
        F.array_sort(F.collect_list(F.when(~small & ~middle, F.concat_ws(" | ", "p_name", "p_type")))).alias("candidates"),
    )
    rows = by.select("doc_id", F.lit("trainings_courses").alias("field"), "candidates", F.to_json(F.struct(F.col("p").alias("trainings_courses"))).alias("parser"), F.to_json(F.struct(F.col("o").alias("trainings_courses"))).alias("optimizer"))
    return G.recover(rows)


# --- singletons, payloads, pairing, pages


@query("""SELECT user_id, kept AS value, CASE WHEN kept LIKE 'github.com/%' THEN 'source' END AS source FROM (SELECT user_id, min('github.com/u' || user_id::VARCHAR) AS kept FROM events GROUP BY user_id)""")
def singleton_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    pool = F.array(F.lit("my github page"), F.concat(F.lit("github.com/u"), F.col("user_id").cast("string")))
    return users.select("user_id", L.recover_singleton("github", F.lit(""), pool, F.lit(None).cast("string")).alias("r")).select("user_id", "r.value", "r.source")


@query("SELECT event_id, 'k=' || json_extract_string(props, '$.k') AS payload FROM events")
def payload_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's properties, wrapped in each of the ways that are known, and unwrapped again."""
    k, props = F.col("event_id") % 4, F.col("props")
    text_ = F.to_json(F.struct(props.alias("json_output")))
    wrapped = F.when(k == 0, F.concat(F.lit('{"parser_payload": '), props, F.lit("}"))).when(k == 1, text_).when(k == 2, F.concat(F.lit('[{"optimizer_payload": '), props, F.lit('}, {"x": 1}]'))).otherwise(props)
    found = F.from_json(P.unwrap(wrapped), "map<string,string>")
    pairs = F.array_sort(F.transform(F.map_entries(found), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(pairs, ";").alias("payload"))


_TURNS = """SELECT row_number() OVER (ORDER BY conv_id, turn, text) AS n, conv_id, CASE WHEN turn % 3 > 0 THEN role || '/' || conv_id ELSE '' END AS path, text FROM conversations WHERE role = '{role}'"""


@query(f"""SELECT n AS row, u.conv_id::VARCHAR AS cv_id, CASE WHEN u.path <> '' THEN u.path ELSE a.path END AS pdf_path, u.path = '' AND a.path = '' AS skipped FROM ({_TURNS.format(role='user')}) u JOIN ({_TURNS.format(role='assistant')}) a USING (n)""")
def positional_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns and assistant turns as the lines of two files, paired by position."""
    rows = table(spark, sf_dir, "conversations")
    path = F.when(F.col("turn") % 3 > 0, F.concat_ws("/", "role", F.col("conv_id").cast("string"))).otherwise("")
    line = F.to_json(F.struct(path.alias("pdf_path"), F.col("conv_id").cast("string").alias("cv_id"), "text"))
    sides = [P.numbered(rows.where(F.col("role") == r), "conv_id", "turn", "text").select("row", line.alias("line")) for r in ("user", "assistant")]
    return P.pair_by_position(*sides).select("row", "cv_id", "pdf_path", "skipped")


@query("""WITH a AS (SELECT page_id % 50 AS doc_id, page_id AS page_number, url AS text, 1 AS b FROM pages), f AS (SELECT page_id % 50 AS doc_id, page_id AS page_number, html AS text, 0 AS b FROM pages)
SELECT a.doc_id, a.page_number, CASE WHEN length(coalesce(f.text, '')) > length(coalesce(a.text, '')) + 20 THEN 'fallback' ELSE 'primary' END AS extractor FROM a JOIN f USING (doc_id, page_number)""")
def extractor_page_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page by page, the URL as one extractor's text and the html as the other's."""
    pages = table(spark, sf_dir, "pages").select((F.col("page_id") % 50).alias("doc_id"), F.col("page_id").alias("page_number"), "url", "html")
    one, two = (pages.select("doc_id", "page_number", F.col(c).alias("text"), F.lit(b).alias("block_count")) for c, b in (("url", 1), ("html", 0)))
    return B.select_pages(one, two).select("doc_id", "page_number", "extractor")


# --- recovery of missed content


def _missed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as missed text; a conversation's turns with the same number as what was recovered."""
    missed = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("cv_id"), F.col("text").alias("missed_from_raw_text"))
    none = F.array().cast("array<struct<gpa:string,grade:string>>")
    strings = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: text.normalize_flat(x["text"]))
    results = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(strings.alias("strings")).select(F.col("conv_id").cast("string").alias("cv_id"), F.lit("").alias("file_path"), "strings", none.alias("education"), F.lit(1).alias("ord"))
    return R.recovery_rows(missed, results)


def _chunks_sql(x: str) -> str:
    """Comparison chunks in DuckDB; texts without bullets at all, or with."""
    t = _STRIP.format(x=f"regexp_replace({x}, '\\r\\n?', chr(10), 'g')")

    def kept(parts: str) -> str:
        return f"list_filter(list_transform({parts}, lambda p: {_STRIP.format(x='p')}), lambda p: p <> '')"

    marked = kept(f"string_split_regex({t}, '(?m)(?:^|\\n)\\s*[•●▪·]\\s*')")
    plain = kept(f"string_split_regex({t}, '\\n\\s*\\n')")
    paragraphs = kept("string_split_regex(q, '\\n\\s*\\n')")
    parts = f"flatten(list_transform(CASE WHEN len({marked}) > 1 THEN {marked} ELSE {plain} END, lambda q: {paragraphs}))"
    return f"list_filter(list_transform({parts}, lambda p: {_flat('p')}), lambda p: len(regexp_extract_all(lower(p), '[a-z0-9+#./]+')) >= 3)"


_TOKEN_SET = "list_distinct(regexp_extract_all({x}, '[a-z0-9+#./]+'))"
_MISSED = f"""WITH c AS (SELECT item_id::VARCHAR AS cv_id, unnest(l) AS chunk, unnest(range(1, len(l) + 1)) AS i FROM (SELECT item_id, {_chunks_sql('text')} AS l FROM benchmark)),
d AS (SELECT *, {_MATCH.format(x='chunk')} AS k FROM c), e AS (SELECT * FROM d WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY cv_id, k ORDER BY i) = 1),
m AS (SELECT cv_id, chunk, k, row_number() OVER (PARTITION BY cv_id ORDER BY i) - 1 AS ord, {_TOKEN_SET.format(x='k')} AS kt FROM e),
s AS (SELECT conv_id::VARCHAR AS cv_id, {_MATCH.format(x=_flat('text'))} AS n, {_flat('text')} AS raw, turn FROM conversations),
w AS (SELECT cv_id, {_MATCH.format(x="string_agg(raw, ' ' ORDER BY turn, raw)")} AS whole FROM s GROUP BY cv_id),
x AS (SELECT m.cv_id, m.ord, bool_or(n <> '' AND len(kt) > 0 AND len({_TOKEN_SET.format(x='n')}) > 0 AND len(list_intersect(kt, {_TOKEN_SET.format(x='n')})) / least(len(kt), len({_TOKEN_SET.format(x='n')}))::DOUBLE >= 0.8) AS near FROM m JOIN s USING (cv_id) GROUP BY ALL)
SELECT m.cv_id, '' AS file_path, CASE WHEN w.cv_id IS NULL THEN 'missing_phase2_result' ELSE 'matched' END AS status, m.ord::INT AS ord, m.chunk, coalesce(contains(whole, k) OR (len(regexp_extract_all(k, '[a-z0-9+#./]+')) >= 3 AND near), false) AS recovered
FROM m LEFT JOIN w USING (cv_id) LEFT JOIN x ON x.cv_id = m.cv_id AND x.ord = m.ord"""


@query(_MISSED)
def missed_content_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _missed(spark, sf_dir)


@query(f"""SELECT count(DISTINCT cv_id) AS total_rows_with_missed_content, count(DISTINCT cv_id) FILTER (recovered) AS rows_with_any_recovered_content, count(*) AS total_missed_chunks,
count(*) FILTER (recovered) AS recovered_chunks, round_even(count(*) FILTER (recovered) / greatest(1, count(*))::DOUBLE, 3) AS recovery_rate FROM ({_MISSED})""")
def recovery_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.recovery_totals(_missed(spark, sf_dir))


_TURN_COUNTS = "SELECT conv_id AS doc_id, count(*) FILTER (role = 'user') AS projects, count(*) FILTER (role = 'assistant') AS experience FROM conversations GROUP BY conv_id"


@query(f"SELECT doc_id, 0 AS is_total, projects::BIGINT AS projects, experience::BIGINT AS experience FROM ({_TURN_COUNTS}) UNION ALL SELECT NULL, 1, sum(projects)::BIGINT, sum(experience)::BIGINT FROM ({_TURN_COUNTS})")
def candidate_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count_if(F.col("role") == "user").alias("projects"), F.count_if(F.col("role") == "assistant").alias("experience"))
    return Q.candidate_totals(counts).select("doc_id", F.col("is_total").cast("int").alias("is_total"), "projects", "experience")


@query(None)
def regression_candidate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = X.extract(B.from_lines(table(spark, sf_dir, "documents")))
    return X.regression_counts(X.reconciliation_input(e))



def _as_input(rows: DataFrame, names: Column | None = None) -> DataFrame:
    """Rows with full_text as inputs of grounding, without other evidence than names."""
    none = F.array().cast("array<string>")
    own = [(none if n != "name" or names is None else names).alias(n) for n in GR.CONTACTS]
    return rows.select(
        "*", F.lit("").alias("uncategorized_text"), F.array().cast("array<struct<name:string,text:string>>").alias("canonical_sections"), F.struct(*own).alias("contact_candidates"),
        none.alias("skill_candidates"), none.alias("language_candidates"), none.alias("certification_candidates"),
    )


@query(f"SELECT doc_id, CASE WHEN v <> '' AND contains(lower({_flat('text')}), v) THEN 'full_text' ELSE '' END AS sources FROM (SELECT doc_id, text, lower({_flat('source')}) AS v FROM documents)")
def grounding_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a document's source stands in its text."""
    rows = _as_input(table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text").alias("full_text")))
    return rows.select("doc_id", F.array_join(GR.sources(F.col("source")), ",").alias("sources"))


@query(None)
def contact_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts of every document from its text alone."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("full_text"), F.lit("").alias("uncategorized_text"))
    rows = rows.withColumn("blocks", F.array().cast("array<struct<pos:int,block_id:string,label:string,text:string>>")).withColumn("named", F.array().cast("array<struct<name:string,text:string,blocks:array<struct<pos:int,block_id:string,label:string,text:string>>>>"))
    return C.contacts(rows).select("doc_id", "contact_candidates.*")

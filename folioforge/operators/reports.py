"""Reports: what evidence a final record lacks, and how much missed text was recovered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import arrays, text, vocab
from folioforge.operators import grouped as G
from folioforge.operators import lists as L
from folioforge.operators import matching as M
from folioforge.sources.staging import staged


def missing_values(evidence: DataFrame, final: DataFrame) -> DataFrame:
    """Evidence values (doc_id, field, source, ord, value) whose key no final value (doc_id, field, value) has; one per source and value."""

    def keyed(rows: DataFrame) -> DataFrame:
        v, key = text.normalize_flat("value"), F.lit(None).cast("string")
        for field, f in L.KEYS.items():
            key = F.when(F.col("field") == field, f(v)).otherwise(key)
        return rows.withColumn("value", v).where("value <> ''").withColumn("key", F.coalesce(key, L.generic_key(v)))

    lost = keyed(evidence).join(keyed(final).select("doc_id", "field", "key").distinct(), ["doc_id", "field", "key"], "left_anti")
    w = Window.partitionBy("doc_id", "field", "source", F.lower("value")).orderBy("ord")
    return lost.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("doc_id", "field", "source", "ord", "value")


def missing_entries(evidence: DataFrame, final: DataFrame, kind: str) -> DataFrame:
    """Evidence entries (doc_id, source, ord, entry) of a kind that match no final entry (doc_id, entry); entries are comparable structs."""
    mine, known = (M.classed(e, kind, ["doc_id"]) for e in (evidence, final))
    found = M.matches(mine, known, kind, ["doc_id"]).select(F.col("l").alias("cls")).distinct()
    return mine.join(found, "cls", "left_anti").select(*evidence.columns)


def missing_singletons(docs: DataFrame) -> DataFrame:
    """(doc_id, field, source, value) of profile links that evidence has and the record lacks.

    docs: doc_id, final, source and parser, structs or maps of linkedin and github (source: arrays)."""
    parts = []
    for field in ("linkedin", "github"):
        empty = text.normalize_flat(F.col(f"final.{field}")) == ""
        found = arrays.dedupe_flat(F.filter(F.coalesce(F.col(f"source.{field}"), F.array().cast("array<string>")), lambda v, f=field: v.isNotNull()))
        found = F.filter(found, _social(field))
        mine = F.filter(F.array(text.col(F.col(f"parser.{field}"))), _social(field))
        rows = F.concat(F.transform(found, lambda v: F.struct(F.lit("phase2_input").alias("source"), v.alias("value"))), F.transform(mine, lambda v: F.struct(F.lit("parser").alias("source"), text.strip(v).alias("value"))))
        parts.append(docs.where(empty).select("doc_id", F.lit(field).alias("field"), F.explode(rows).alias("r")).select("doc_id", "field", "r.source", "r.value"))
    return parts[0].unionByName(parts[1])


def _social(field: str):
    return lambda v: L.is_social(field, v)


def coverage_summary(missing: DataFrame) -> DataFrame:
    """(field, rows_affected, phase2_input_missing_count, parser_missing_count) for every field, from (doc_id, field, source)."""
    fields = missing.sparkSession.createDataFrame([(i, f) for i, f in enumerate(vocab.COVERAGE_FIELDS)], "ord int, field string")
    per = missing.groupBy("field").agg(
        F.countDistinct("doc_id").alias("rows_affected"),
        F.count_if(F.col("source").isin("phase2_input", "source")).alias("phase2_input_missing_count"),
        F.count_if(F.col("source") == "parser").alias("parser_missing_count"),
    )
    return F.broadcast(fields).join(per, "field", "left").na.fill(0).select("ord", "field", "rows_affected", "phase2_input_missing_count", "parser_missing_count")


def chunks(x: Column | str) -> Column:
    """Comparison chunks of missed text: bullet parts, or paragraphs, of at least three tokens."""
    t = text.strip(F.regexp_replace(text.col(x), "\r\n?", "\n"))
    parts = text.let(text.bullets(t, False), lambda own: F.when(F.size(own) > 1, own).otherwise(text.nonempty(F.split(t, r"\n\s*\n"))))
    parts = F.transform(F.flatten(F.transform(parts, lambda p: text.nonempty(F.split(p, r"\n\s*\n")))), text.normalize_flat)
    return arrays.dedupe_for_match(F.filter(parts, lambda p: F.size(text.match_tokens(p)) >= 3))


def grade_recovered(chunk: Column, education: Column) -> Column:
    """Whether an education entry (struct gpa, grade) holds the chunk's GPA ratio or project grade."""
    norm = text.normalize_for_match(chunk)
    ratio = F.regexp_extract_all(chunk, F.lit(r"(?U)(\d+(?:\.\d+)?)\s*/\s*(\d+(?:\.\d+)?)"), F.lit(0))
    wanted = F.regexp_replace(text.normalize_for_match(F.get(ratio, F.lit(0))), r"\s+", "")
    has_gpa = norm.contains("gpa")
    by_gpa = F.exists(education, lambda e: F.regexp_replace(text.normalize_for_match(e["gpa"]), r"\s+", "").contains(wanted))
    stop = has_gpa & ((F.size(ratio) == 0) | F.regexp_replace(norm, r"\s+", "").contains(wanted))
    grade = F.upper(F.regexp_extract(chunk, r"(?iU)\(\s*([A-F][+-]?)\s*\)", 1))

    def graded(e: Column) -> Column:
        v = F.upper(text.normalize_for_match(e["grade"]))
        return (v == grade) | F.concat(F.lit(" "), v, F.lit(" ")).contains(F.concat(F.lit(" "), grade, F.lit(" ")))

    by_grade = (grade != "") & norm.contains("project grade") & F.exists(education, graded)
    return F.when(has_gpa & (F.size(ratio) > 0) & (wanted != "") & by_gpa, True).when(stop, False).otherwise(by_grade)


def is_recovered(chunk: Column, whole: Column, segments: Column, education: Column | None = None) -> Column:
    """Whether a chunk stands in the evidence: in it as a whole, or sharing 0.8 of the smaller token set with a segment.

    whole and segments are normal forms of normalize_for_match, made once per document."""
    norm = text.normalize_for_match(chunk)
    near = (F.size(text.match_tokens(norm)) >= 3) & F.exists(segments, lambda s: arrays.overlap(text.match_tokens(norm), text.match_tokens(s)) >= 0.8)
    out = whole.contains(norm) | near
    if education is not None:
        out = out | ((F.size(text.match_tokens(norm)) >= 3) & F.coalesce(grade_recovered(chunk, education), F.lit(False)))
    return (norm != "") & out


def recovery_rows(missed: DataFrame, results: DataFrame) -> DataFrame:
    """One row per missed chunk: cv_id, file_path, status, ord, chunk, recovered.

    missed: cv_id, missed_from_raw_text. results: cv_id, file_path, strings (array, in order),
    education (array of struct gpa, grade), ord. Of equal ids the last result counts."""
    w = Window.partitionBy("cv_id").orderBy(F.desc("ord"))
    last = results.where("cv_id is not null").withColumn("cv_id", text.strip("cv_id")).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    norms = F.filter(F.transform("strings", text.normalize_for_match), lambda s: s != "")
    last = last.select("cv_id", "file_path", text.normalize_for_match(F.array_join("strings", " ")).alias("whole"), norms.alias("segments"), "education")
    rows = missed.select(text.strip("cv_id").alias("cv_id"), chunks("missed_from_raw_text").alias("chunks")).where(F.size("chunks") > 0)
    rows = rows.join(last, "cv_id", "left").select("*", F.posexplode("chunks").alias("ord", "chunk"))
    known = F.col("whole").isNotNull()
    hit = F.when(known, is_recovered(F.col("chunk"), F.col("whole"), F.col("segments"), F.col("education"))).otherwise(False)
    return rows.select("cv_id", F.coalesce("file_path", F.lit("")).alias("file_path"), F.when(known, "matched").otherwise("missing_phase2_result").alias("status"), "ord", "chunk", hit.alias("recovered"))


def recovery_per_row(chunk_rows: DataFrame) -> DataFrame:
    """One row per benchmark row: its chunks, which were recovered, and the ratio."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "chunk", "recovered")))
    out = chunk_rows.groupBy("cv_id", "file_path", "status").agg(ordered.alias("c"))
    yes, no = F.filter("c", lambda x: x["recovered"]), F.filter("c", lambda x: ~x["recovered"])
    return out.select(
        "cv_id", "file_path", "status", F.col("c.chunk").alias("missed_chunks"), F.transform(yes, lambda x: x["chunk"]).alias("recovered_chunks"), F.transform(no, lambda x: x["chunk"]).alias("unrecovered_chunks"),
        F.bround(F.size(yes) / F.greatest(F.lit(1), F.size("c")).cast("double"), 3).alias("recovered_ratio"),
    )


def recovery_totals(chunk_rows: DataFrame) -> DataFrame:
    """Totals over all rows, and the rate."""
    out = chunk_rows.agg(
        F.countDistinct("cv_id").alias("total_rows_with_missed_content"),
        F.countDistinct(F.when(F.col("recovered"), F.col("cv_id"))).alias("rows_with_any_recovered_content"),
        F.count(F.lit(1)).alias("total_missed_chunks"),
        F.count_if("recovered").alias("recovered_chunks"),
    )
    return out.withColumn("recovery_rate", F.bround(F.col("recovered_chunks") / F.greatest(F.lit(1), F.col("total_missed_chunks")).cast("double"), 3))


def string_leaves(payload: Column) -> Column:
    """All strings in a JSON text, depth first in the order they stand, blanks collapsed, empty ones left out; none of null or an empty text.

    In a JSON text the strings stand in just this order, and those that are keys are the ones before a colon;
    so they are read off the text. A variant would not do: it sorts the keys of its objects."""
    strings = F.regexp_extract_all(payload, F.lit(r'"(?:[^"\\]|\\.)*+"(?:\s*:)?+'), F.lit(0))
    values = F.filter(strings, lambda s: s.endswith('"'))
    read = F.from_json(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")), "array<string>")
    leaves = F.filter(F.transform(read, text.normalize_flat), lambda t: t != "")
    broken = F.raise_error(F.lit("no JSON")).cast("array<string>")
    return F.when(F.coalesce(payload, F.lit("")) == "", F.array().cast("array<string>")).when(F.try_parse_json(payload).isNull(), broken).otherwise(leaves)


def missing_groups(rows: DataFrame) -> DataFrame:
    """(doc_id, field, source, ord, value): candidates and parser entries that match no final entry, for payloads as JSON.

    rows: doc_id, field, candidates array<string>, parser string, final string; the value is the
    candidate's text or the entry as JSON. Candidates for trainings that are certifications are left out."""
    entries, skip = G.entries_of(rows, {"parser": "parser", "final": "optimizer"})
    formed = staged(G.formed(entries))
    known = formed.where("source = 'optimizer' and entry like '{%'")
    mine, _, pairs = G.matched(formed.where("source <> 'optimizer'").select("doc_id", "field", "source", "ord", "title", F.col("entry").alias("value"), F.col("probe").alias("entry")), known.select("doc_id", "field", F.col("known").alias("entry")))
    lost = mine.join(pairs.select(F.col("l").alias("cls")).distinct(), "cls", "left_anti")
    titles = skip.select("doc_id", F.lower(text.normalize_flat("title")).alias("title")).distinct().withColumn("certified", F.lit(True))
    lost = lost.join(titles, ["doc_id", "title"], "left").where("certified is null or source <> 'source' or field <> 'trainings_courses'")
    return lost.select("doc_id", "field", F.when(F.col("source") == "source", "phase2_input").otherwise(F.col("source")).alias("source"), F.col("ord").cast("int").alias("ord"), "value")


def coverage(evidence: DataFrame, final: DataFrame, groups: DataFrame, links: DataFrame) -> DataFrame:
    """All that evidence has and final records lack, as (doc_id, field, source, value): values of lists
    (missing_values), entries of groups (missing_groups) and profile links (missing_singletons)."""
    names = ["doc_id", "field", "source", "value"]
    return missing_values(evidence, final).select(*names).unionByName(missing_groups(groups).select(*names)).unionByName(missing_singletons(links).select(*names))


def coverage_rows(gaps: DataFrame) -> DataFrame:
    """(doc_id, missing): the gaps of every document that has any, as source:field:value in order."""
    return gaps.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.concat_ws(":", "source", "field", "value"))).alias("missing"))

"""Extraction quality: weak documents, diagnostics, audits, regression metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from folioforge.functions import arrays, text, vocab
from folioforge.operators import blocks as B


def weak(pages: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """(doc_id, page_count, empty_pages, text_chars, block_count, weak) from pages (doc_id, page_number, text, block_count).

    Documents without a page are weak; they appear if `documents` (doc_id) is given."""
    t = text.strip("text")
    out = pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("page_count"), F.count_if(t == "").alias("empty_pages"), F.sum(F.length(t)).alias("text_chars"), F.sum(F.coalesce("block_count", F.lit(0))).alias("block_count")
    )
    if documents is not None:
        out = documents.select("doc_id").distinct().join(out, "doc_id", "left").na.fill(0)
    few = F.col("block_count") <= F.greatest(F.lit(1), F.floor(F.col("page_count") / 2))
    return out.withColumn("weak", (F.col("page_count") == 0) | (F.col("text_chars") < 80) | (F.col("empty_pages") * 2 >= F.col("page_count")) | few)


def suspicious(semantic: DataFrame) -> DataFrame:
    """(doc_id, pos, block_id, page_number, reason, text), one row per reason."""
    t = text.normalize_lines("text")
    return semantic.select("doc_id", "pos", "block_id", "page_number", F.posexplode(B.suspicions(t, F.col("label"))).alias("ord", "reason"), "text")


def unassigned(semantic: DataFrame, sections: DataFrame) -> DataFrame:
    """Blocks, but for section headings, that no section holds."""
    held = sections.select("doc_id", F.explode("block_ids").alias("block_id"))
    return semantic.where("label <> 'section_heading'").join(held, ["doc_id", "block_id"], "left_anti").select("doc_id", "pos", "block_id")


def diagnostics(semantic: DataFrame, sections: DataFrame, split: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """One row per document: merged_block_count, unassigned_blocks, suspicious_blocks, the split's figures and fallback_used."""
    merged = semantic.groupBy("doc_id").agg(F.count_if(F.size("source_block_ids") > 1).alias("merged_block_count"))
    loose = unassigned(semantic, sections).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "block_id"))), lambda x: x["block_id"]).alias("unassigned_blocks"))
    odd = suspicious(semantic).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "ord", "block_id", "page_number", "reason", "text"))).alias("s"))
    odd = odd.select("doc_id", F.transform("s", lambda x: F.struct(x["block_id"].alias("block_id"), x["page_number"].alias("page_number"), x["reason"].alias("reason"), x["text"].alias("text"))).alias("suspicious_blocks"))
    out = merged.join(loose, "doc_id", "left").join(odd, "doc_id", "left").join(split, "doc_id", "left")
    if fallback is not None:
        out = out.join(fallback.select("doc_id", F.col("fallback_triggered").alias("fallback_used")), "doc_id", "left")
    else:
        out = out.withColumn("fallback_used", F.lit(False))
    empty = F.array().cast("array<string>")
    none = F.array().cast("array<struct<block_id:string,page_number:int,reason:string,text:string>>")
    return out.withColumn("unassigned_blocks", F.coalesce("unassigned_blocks", empty)).withColumn("suspicious_blocks", F.coalesce("suspicious_blocks", none)).withColumn("fallback_used", F.coalesce("fallback_used", F.lit(False)))


def _reason(when: Column, code: str, severity: str, metric: Column) -> Column:
    return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), metric.cast("double").alias("metric")))


def audit(docs: DataFrame) -> DataFrame:
    """Adds score, weak, reasons, alnum_ratio and noise_ratio to documents.

    Needs full_text, section_count, general_block_ratio, possible_errors, suspicious_count,
    merged_block_count, semantic_count, raw_count and page_count."""
    t, size = F.col("full_text"), F.length("full_text")
    alnum = F.when(size > 0, F.regexp_count(t, F.lit("[A-Za-z0-9]")) / size.cast("double")).otherwise(0.0)
    noise = F.regexp_count(t, F.lit(vocab.NOISE)) / F.greatest(F.lit(1), F.length(F.replace(t, F.lit(" "), F.lit("")))).cast("double")
    rows = docs.withColumn("_alnum", alnum).withColumn("_noise", noise)

    def error(code: str) -> Column:
        return F.array_contains("possible_errors", code)

    reasons = F.array_compact(
        F.array(
            _reason(size < 120, "very_low_text", "critical", size),
            _reason((F.col("section_count") <= 1) & (size >= 800), "collapsed_sections", "high", F.col("section_count")),
            _reason(error("document_collapsed_into_general"), "document_collapsed_into_general", "high", F.lit(1)),
            _reason(error("oversized_general_section"), "oversized_general_section", "medium", F.col("general_block_ratio")),
            _reason(error("heading_candidates_found_inside_general"), "heading_candidates_found_inside_general", "medium", F.lit(1)),
            _reason(F.col("suspicious_count") >= F.greatest(F.lit(5), F.floor(F.col("semantic_count") / 3)), "many_suspicious_blocks", "medium", F.col("suspicious_count")),
            _reason(F.col("_alnum") < 0.45, "low_alnum_ratio", "high", F.bround("_alnum", 3)),
            _reason(F.col("_noise") > 0.08, "high_noise_ratio", "medium", F.bround("_noise", 3)),
            _reason((F.col("merged_block_count") == 0) & (F.col("raw_count") > F.col("page_count") * 8), "no_merges_detected", "low", F.col("merged_block_count")),
        )
    )
    rows = rows.withColumn("reasons", reasons)
    points = F.create_map(*(F.lit(x) for kv in vocab.SEVERITY.items() for x in kv))
    score = F.greatest(F.lit(0), 100 - F.aggregate("reasons", F.lit(0), lambda a, r: a + points[r["severity"]]))
    rows = rows.withColumn("score", score)
    bad = F.exists("reasons", lambda r: r["severity"].isin("critical", "high")) | (F.col("score") < 70)
    return rows.withColumn("weak", bad).withColumn("alnum_ratio", F.bround("_alnum", 3)).withColumn("noise_ratio", F.bround("_noise", 3)).drop("_alnum", "_noise")


def batch_summary(audited: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """One row over a batch: processed, weak, total and failed documents, and the ids of the weak ones counted by reason."""
    out = audited.agg(F.count(F.lit(1)).alias("processed_files"), F.count_if("weak").alias("weak_files"), F.avg("score").alias("mean_score"))
    failed = failures.agg(F.count(F.lit(1)).alias("failed_files")) if failures is not None else audited.limit(0).agg(F.count(F.lit(1)).alias("failed_files"))
    return out.join(F.broadcast(failed)).withColumn("total_files", F.col("processed_files") + F.col("failed_files"))


def written(audited: DataFrame, path: str) -> dict[str, float]:
    """Writes audited documents (doc_id, score, weak, section_count, general_block_ratio, possible_errors) as Parquet and gives the batch's figures, observed as the rows pass: the documents are read once.

    The figures: those of batch_summary() but failures, the mean number of sections, and of each kind of error how many documents have it."""
    seen = Observation()
    errors = ("document_collapsed_into_general", "oversized_general_section", "heading_candidates_found_inside_general")
    figures = [F.count(F.lit(1)).alias("processed_files"), F.count_if("weak").alias("weak_files"), F.avg("score").alias("mean_score"), F.avg("section_count").alias("mean_sections"), F.avg("general_block_ratio").alias("mean_general_ratio")]
    figures += [F.count_if(F.array_contains("possible_errors", e)).alias(e) for e in errors]
    audited.observe(seen, *figures).write.mode("overwrite").parquet(path)
    return seen.get


def bleed_markers(sections: DataFrame) -> DataFrame:
    """(doc_id, markers): sections whose last line ends in another section's name and an ampersand."""
    body = text.strip("content")
    last = text.strip(F.element_at(text.split_lines(body), -1))
    found = sections.where((body != "") & last.rlike("(?iU)" + vocab.REPORT_BLEED)).select("doc_id", "section_seq", F.concat_ws(": ", "heading", last).alias("m"))
    lists = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("section_seq", "m"))).alias("x"))
    return lists.select("doc_id", arrays.dedupe_trimmed(F.col("x.m")).alias("markers"))


def is_composite(heading: Column) -> Column:
    """Whether a heading joins at least two known sections."""
    parts = text.nonempty(F.split(F.lower(text.strip(heading)), r"(?iU)\s*(?:&|/|\band\b)\s*"))
    known = F.filter(parts, lambda p: text.has_any(p, vocab.COMPOSITE_PARTS))
    return text.strip(heading).rlike(r"(?iU)&|/|\band\b") & (F.size(parts) >= 2) & (F.size(known) >= 2)


def composite_headings(sections: DataFrame) -> DataFrame:
    """(doc_id, headings) of sections whose headings look composite."""
    found = sections.where(is_composite(F.col("heading"))).select("doc_id", "section_seq", text.strip("heading").alias("h"))
    lists = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("section_seq", "h"))).alias("x"))
    return lists.select("doc_id", arrays.dedupe_trimmed(F.col("x.h")).alias("headings"))


def frequencies(sections: DataFrame, diagnostics_rows: DataFrame) -> DataFrame:
    """(kind, name, documents): in how many documents each section heading and each possible error stands."""
    heads = sections.groupBy(F.lit("section").alias("kind"), F.col("heading").alias("name")).agg(F.countDistinct("doc_id").alias("documents"))
    errors = diagnostics_rows.select("doc_id", F.explode("possible_errors").alias("name")).groupBy(F.lit("error").alias("kind"), "name").agg(F.countDistinct("doc_id").alias("documents"))
    return heads.unionByName(errors)


COUNTS = ("projects", "experience", "education", "certifications", "trainings", "achievements", "activities", "publications", "soft_skills")


def candidate_totals(counts: DataFrame) -> DataFrame:
    """Candidate counts per document and over all (doc_id null), in one pass."""
    return counts.groupingSets([["doc_id"], []], "doc_id").agg(F.grouping("doc_id").alias("is_total"), *(F.sum(c).alias(c) for c in COUNTS if c in counts.columns))

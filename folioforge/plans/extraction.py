"""Whole runs: extraction from raw blocks, reconciliation, reports."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text
from folioforge.operators import blocks as B
from folioforge.operators import candidates as C
from folioforge.operators import grouped as G
from folioforge.operators import lists as L
from folioforge.operators import quality as Q
from folioforge.operators import sections as S
from folioforge.sources import payloads as P
from folioforge.sources.staging import bound_batches, staged


@dataclass
class Extraction:
    raw: DataFrame
    semantic: DataFrame
    sections: DataFrame
    diagnostics: DataFrame
    full_text: DataFrame
    pages: DataFrame


def extract(raw: DataFrame, fallback: DataFrame | None = None) -> Extraction:
    """Raw blocks to labelled blocks, sections, diagnostics, page and document texts.

    Labelled blocks and sections are read by many steps, so both are written once."""
    semantic = staged(B.classify(B.merge(raw)))
    sections, split = S.split(semantic, staged)
    diagnostics = Q.diagnostics(semantic, sections, split, fallback)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
    whole = semantic.groupBy("doc_id").agg(parts.alias("t")).select("doc_id", text.normalize_lines(F.array_join(F.filter("t", lambda t: t != ""), "\n\n")).alias("full_text"))
    pages = semantic.groupBy("doc_id", "page_number").agg(parts.alias("t"), F.count(F.lit(1)).alias("block_count"))
    pages = pages.select("doc_id", "page_number", text.normalize_lines(F.array_join("t", "\n")).alias("text"), "block_count")
    return Extraction(raw, semantic, sections, diagnostics, whole, pages)


def audited(e: Extraction) -> DataFrame:
    """One row per document with its audit."""
    counts = e.raw.groupBy("doc_id").agg(F.count(F.lit(1)).alias("raw_count"), F.countDistinct("page_number").alias("page_count"))
    blocks = e.semantic.groupBy("doc_id").agg(F.count(F.lit(1)).alias("semantic_count"))
    rows = e.full_text.join(e.diagnostics, "doc_id").join(counts, "doc_id").join(blocks, "doc_id")
    return Q.audit(rows.withColumn("suspicious_count", F.size("suspicious_blocks")))


def reconciliation_input(e: Extraction) -> DataFrame:
    docs = C.document_rows(e.full_text, e.sections, e.semantic)
    return C.build(docs.join(e.diagnostics.select("doc_id", "merged_block_count", "general_block_ratio", "possible_errors", "recovered_section_splits", "fallback_used"), "doc_id", "left"))


def reconcile(inputs: DataFrame, payloads: DataFrame) -> DataFrame:
    """(doc_id, data, recovered_items, recovered_fields, notes, mode, error): the optimizer's payload with what evidence adds, as JSON.

    payloads: doc_id, parser, optimizer, both as JSON; a document without any has empty ones. A payload
    that is no JSON object fails its document alone: data is null then and error says which it was."""
    bound_batches(inputs.sparkSession)
    rows = inputs.join(payloads.select("doc_id", "parser", "optimizer"), "doc_id", "left")
    rows = rows.withColumn("parser", F.coalesce("parser", F.lit("{}"))).withColumn("optimizer", F.coalesce("optimizer", F.lit("{}")))

    def broken(side: str):
        return ~F.coalesce(F.schema_of_variant(F.try_parse_json(side)).startswith("OBJECT"), F.lit(False))

    rows = rows.withColumn("error", F.when(broken("parser"), "the parser's payload is no JSON object").when(broken("optimizer"), "the optimizer's payload is no JSON object"))
    rows = rows.withColumn("parser", F.when(F.col("error").isNull(), F.col("parser")).otherwise("{}")).withColumn("optimizer", F.when(F.col("error").isNull(), F.col("optimizer")).otherwise("{}"))
    rows = rows.withColumn("_p", F.parse_json("parser")).withColumn("_o", F.parse_json("optimizer"))

    def of(side: str, key: str):
        return P.string_list(F.col(side), key)

    lists = {
        "technical_skills": (L.technical(F.col("skill_candidates")), L.technical(of("_p", "technical_skills"))),
        "soft_skills": (L.source_soft_skills(C.body("Skills")), L.soft_skills(of("_p", "soft_skills"))),
        "languages": (L.languages(F.col("language_candidates")), L.languages(of("_p", "languages"))),
        "certifications": (L.certifications(F.col("certification_candidates")), L.certifications(of("_p", "certifications"))),
    }
    out = rows.select(
        "doc_id", "parser", "optimizer", "error",
        *(L.recover(of("_o", f), source, parser, f).alias(f) for f, (source, parser) in lists.items()),
        L.recover_supplemental({f: of("_o", f) for f in ("awards", "achievements", "activities", "publications")}).alias("supplemental"),
        *(L.recover_singleton(f, text.col(F.try_variant_get("_o", f"$.{f}", "string")), F.col(f"contact_candidates.{f}"), F.try_variant_get("_p", f"$.{f}", "string")).alias(f) for f in ("linkedin", "github")),
        *(F.transform(c, lambda e: e["text"]).alias(f"{f}_texts") for f, c in (("experience", "experience_candidates"), ("projects", "project_candidates"), ("education", "education_candidates"), ("trainings_courses", "training_candidates"))),
    )
    # grouped fields by joins over all documents, then one struct a field; both sides read the evidence from one table
    out = staged(out)
    groups = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}_texts").alias("candidates")) for f in G.FIELDS)))
    found = G.recover(out.select("doc_id", "parser", "optimizer", groups.alias("g")).select("doc_id", "g.field", "g.candidates", "parser", "optimizer"))
    found = found.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("entries", "recovered_items", "recovered_fields", "notes")))).alias("_groups"))
    out = out.join(found, "doc_id").select("*", *(F.col("_groups")[f].alias(f) for f in G.FIELDS)).drop("_groups", *(f"{f}_texts" for f in G.FIELDS))
    return out.mapInPandas(_assemble, "doc_id long, data string, recovered_items array<string>, recovered_fields array<string>, notes array<string>, mode string, error string")


def _assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One document's record, field by field in the audit's order."""
    for b in batches:
        out = []
        for r in b.to_dict("records"):
            if isinstance(r["error"], str):
                out.append((r["doc_id"], None, [], [], [], "coverage", r["error"]))
                continue
            optimizer = json.loads(r["optimizer"])
            data, items, fields, notes = dict(optimizer), [], [], []
            for f in L.KEYS:
                data[f] = list(r[f]["values"])
                items += list(r[f]["items"])
                notes += list(r[f]["notes"])
            for f in ("experience", "projects", "education", "trainings_courses"):
                data[f] = json.loads(r[f]["entries"])
                items += list(r[f]["recovered_items"])
                fields += list(r[f]["recovered_fields"])
                notes += list(r[f]["notes"])
            for f, v in r["supplemental"].items():
                data[f] = list(v["values"])
                items += list(v["items"])
                notes += list(v["notes"])
            for f in ("linkedin", "github"):
                if r[f]["source"] in ("source", "parser"):
                    data[f] = r[f]["value"]
                    fields.append(f)
                    notes.append(f"Recovered missing {f} from {r[f]['source']} evidence")
            out.append((r["doc_id"], json.dumps(data, ensure_ascii=False), items, fields, notes, "coverage", None))
        yield pd.DataFrame(out, columns=["doc_id", "data", "recovered_items", "recovered_fields", "notes", "mode", "error"])


def regression_counts(inputs: DataFrame) -> DataFrame:
    """Candidate counts of every document, with empty payloads."""
    none = F.array().cast("array<string>")
    more = L.recover_supplemental({f: none for f in ("awards", "achievements", "activities", "publications")})
    soft = L.recover(none, L.source_soft_skills(C.body("Skills")), none, "soft_skills")
    return inputs.withColumn("_s", more).withColumn("_soft", soft).select(
        "doc_id",
        *(F.size(c).alias(n) for n, c in (("projects", "project_candidates"), ("experience", "experience_candidates"), ("education", "education_candidates"), ("certifications", "certification_candidates"), ("trainings", "training_candidates"))),
        *(F.size(F.col(f"_s.{f}.values")).alias(f) for f in ("achievements", "activities", "publications")),
        F.size("_soft.values").alias("soft_skills"),
    )


def regression_report(e: Extraction, inputs: DataFrame) -> DataFrame:
    """One row per document: section count, oversized General, bleed markers, composite headings, candidate counts."""
    bleed, odd = Q.bleed_markers(e.sections), Q.composite_headings(e.sections)
    empty = F.array().cast("array<string>")
    rows = e.diagnostics.select("doc_id", "section_count", "general_block_ratio", "possible_errors", F.array_contains("possible_errors", "oversized_general_section").alias("oversized_general"))
    rows = rows.join(bleed, "doc_id", "left").join(odd, "doc_id", "left").join(regression_counts(inputs), "doc_id", "left")
    return rows.withColumn("markers", F.coalesce("markers", empty)).withColumn("headings", F.coalesce("headings", empty))

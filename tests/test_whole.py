"""Registered queries over whole tables, against brute force on small ones."""

import json
import random

from folioforge.plans import derived, queries as plan  # noqa: F401  derived registers queries
from test_grouped import score as plain_score


def parts(spark, folder):
    r = random.Random(11)
    words = ["red", "blue", "gear", "ring", "bolt", "a", "C++", "old-new"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 3))), f"Brand#{i % 3}", r.choice(["SMALL", "LARGE STEEL", "b", ""]), r.randint(1, 50)) for i in range(150)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.mode("overwrite").parquet(f"{folder}/part.parquet")
    return rows


def test_matches_of_all_parts(spark, tmp_path):
    rows = parts(spark, tmp_path)

    def entry(n, y):
        return {"raw_text": f"{n} {y}", "primary_name": n, "secondary_name": y, "date_range": "", "technologies": []}

    scores = {(a[0], b[0]): plain_score("trainings_courses", entry(a[1], a[3]), entry(b[1], b[3])) for a in rows for b in rows if a[2] == b[2] and a[0] < b[0]}
    least = {}
    for i, n, b, y, _ in rows:  # of equal entries the first stands for all
        least.setdefault((b, n.lower(), y.lower()), i)
    own = {i: least[b, n.lower(), y.lower()] for i, n, b, y, _ in rows}
    assert {x["id"]: x["class"] for x in plan.QUERIES["entity_classes"](spark, str(tmp_path)).collect()} == own
    got = {(x["l"], x["r"]): x["score"] for x in plan.QUERIES["entity_match_scores"](spark, str(tmp_path)).collect()}
    assert got == {(a, b): s for (a, b), (ok, s) in scores.items() if ok and own[a] == a and own[b] in (a, b)}
    assert any(own[b] == a for a, b in got)
    best = {}
    for (left, right), (ok, score) in sorted(scores.items()):
        if ok and score > best.get(left, (0, 0.0))[1]:
            best[left] = (right, score)
    assert {x["l"]: (x["r"], x["score"]) for x in plan.QUERIES["entity_best_match"](spark, str(tmp_path)).collect()} == best
    gaps = {x[0] for x in rows} - {right for (_, right), (ok, _) in scores.items() if ok}
    assert sorted(x["id"] for x in plan.QUERIES["coverage_gaps_grouped"](spark, str(tmp_path)).collect()) == sorted(gaps)


def test_recovery_reads_all_parts(spark, tmp_path):
    rows = [(1, "red gear", "Brand#1", "SMALL", 1), (2, "blue ring", "Brand#1", "LARGE", 5), (3, "odd spindle", "Brand#1", "PROMO", 40)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = plan.QUERIES["grouped_recovery"](spark, str(tmp_path)).first()
    assert [e["title"] for e in json.loads(got["entries"])] == ["red gear", "blue ring", "odd spindle"]


def test_pages_by_whole_texts(spark, tmp_path):
    url = "http://example.test/" + "p" * 80
    rows = [(1, url, "h" * (len(url) + 21)), (2, url, "h" * (len(url) + 20)), (3, url, "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_number"]: r["extractor"] for r in plan.QUERIES["extractor_page_select"](spark, str(tmp_path)).collect()}
    assert got == {1: "fallback", 2: "primary", 3: "primary"}


def test_lists_read_documents(spark, tmp_path):
    lines = ["React.js", "AWS Certified Developer", "English", "• Teamwork", "working with many people daily"]
    spark.createDataFrame([(1, "\n".join(lines)), (2, "plain words")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def found(name):
        return {(r["doc_id"], r["text"].replace("\u2022 ", "")): r for r in plan.QUERIES[name](spark, str(tmp_path)).collect()}

    keys = found("comparison_keys_lines")
    assert keys[1, "React.js"]["skill_key"] == "react" and len(keys) == 6 and keys[1, "AWS Certified Developer"]["cert_key"] == "aws certified developer"
    for name, line in (("skills", "React.js"), ("certs", "AWS Certified Developer"), ("languages", "English"), ("soft_skills", "Teamwork")):
        hits = found(f"recoverable_{name}_lines")
        assert (1, line) in hits and (name == "languages" or (1, lines[-1]) not in hits)

import random

import pytest

from folioforge.operators import blocks as B
from folioforge.operators import quality as Q
from folioforge.operators import sections as S

RAW = "doc_id long, block_id string, text string, page_number int, x0 double, y0 double, x1 double, y1 double"


def merged(spark, rows):
    data = [(1, f"raw-1-{i}", t, 1, *map(float, box)) for i, (t, box) in enumerate(rows)]
    return B.merge(spark.createDataFrame(data, RAW)).orderBy("pos").collect()


def test_wrapped_bullet_is_one_block(spark):
    out = merged(spark, [("• Built a pipeline", (72, 100, 260, 114)), ("for many teams", (90, 116, 290, 130))])
    assert len(out) == 1 and out[0]["source_block_ids"] == ["raw-1-0", "raw-1-1"] and out[0]["inferred_kind"] == "bullet"


def test_new_bullet_begins_a_block(spark):
    assert len(merged(spark, [("• One thing", (72, 100, 260, 114)), ("with a tail", (118, 116, 290, 130)), ("• Another", (72, 142, 260, 156))])) == 2


def test_heading_is_not_absorbed(spark):
    assert len(merged(spark, [("School of Things", (72, 100, 260, 114)), ("Work Experience", (72, 116, 260, 130))])) == 2


def test_html_blocks_merge_as_in_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from folioforge.plans import derived  # noqa: F401  registers the query
    from folioforge.plans import queries as plan

    r = random.Random(5)
    words = ["È.", "É", "ÉCOLE", "école", "МОСКВА", "A", "a", "1", "•", "-", "|", "GPA", "Skills", "Skİlls", "SUMMARY:", "ß", "ﬁ", "ŉ", "ᾼ", "Σ", "ς", "日本"]
    pages = [(0, "u", "<p>È.</p><p>ÉÉ</p><p>É1</p><p>1</p><p>Éa</p>")]
    pages += [(i, "u", "".join(r.choice(["<p>%s</p>", "<li>%s</li>"]) % " ".join(r.choice(words) for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 8)))) for i in range(1, 400)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = sorted(con.sql(plan.ORACLES["html_merge"]).fetchall())
    got = sorted(map(tuple, plan.QUERIES["html_merge"](spark, str(tmp_path)).collect()))
    assert got == want and [x[5] for x in got if x[0] == 0] == ["heading", "heading", "heading", "other", "other"]


def test_every_raw_block_in_one_group(spark):
    docs = spark.createDataFrame([(1, "A line\nand more.\nHEADING\n• x\ny z\n\nend"), (2, "")], "doc_id long, text string")
    raw = B.from_lines(docs)
    ids = [i for r in B.merge(raw).collect() for i in r["source_block_ids"]]
    assert sorted(ids) == sorted(r["block_id"] for r in raw.collect())


SEMANTIC = "doc_id long, pos int, block_id string, page_number int, x0 double, text string, label string"


def split(spark, blocks):
    rows = [(1, i, f"b{i}", 1, None, t, label) for i, (t, label) in enumerate(blocks)]
    sections, diagnostics = S.split(spark.createDataFrame(rows, SEMANTIC))
    return [(r["heading"], r["content"]) for r in sections.orderBy("section_seq").collect()], diagnostics.first()


def test_plain_sections(spark):
    got, d = split(spark, [("SUMMARY", "section_heading"), ("Does things.", "paragraph"), ("Work Experience", "section_heading"), ("At a place.", "paragraph")])
    assert got == [("Summary", "Does things."), ("Experience", "At a place.")] and d["section_count"] == 2


def test_leading_inline_and_trailing_headings(spark):
    got, _ = split(spark, [("Skills\nPython", "paragraph"), ("a place | EDUCATION | a school", "paragraph"), ("more text PROJECTS", "paragraph"), ("one project", "paragraph")])
    assert got == [("Skills", "Python\na place"), ("Education", "a school\nmore text"), ("Projects", "one project")]


def test_bleed_is_stripped_and_collapse_found(spark):
    got, _ = split(spark, [("SUMMARY", "section_heading"), ("Does things EDUCATION &", "paragraph")])
    assert got == [("Summary", "Does things")]
    _, d = split(spark, [("just words here now", "paragraph")])
    assert d["possible_errors"] == ["document_collapsed_into_general", "oversized_general_section"]


def test_weak(spark):
    pages = spark.createDataFrame([(1, 1, "", 0), (1, 2, "Short", 1), (2, 1, "x" * 100, 4)], "doc_id long, page_number int, text string, block_count int")
    assert {r["doc_id"]: r["weak"] for r in Q.weak(pages).collect()} == {1: True, 2: False}


def test_page_selection(spark):
    schema = "doc_id long, page_number int, text string, block_count int"
    one = spark.createDataFrame([(1, 1, "", 0), (1, 2, "good text", 1)], schema)
    two = spark.createDataFrame([(1, 1, "found here", 2), (1, 2, "good text", 1)], schema)
    assert {r["page_number"]: r["extractor"] for r in B.select_pages(one, two).collect()} == {1: "fallback", 2: "primary"}


def test_words_to_lines(spark):
    rows = [(1, 1, "a", 10.0, 100.0, 15.0, 110.0), (1, 1, "b", 20.0, 102.0, 25.0, 112.0), (1, 1, "c", 10.0, 104.0, 15.0, 114.0)]
    got = B.words_to_lines(spark.createDataFrame(rows, "doc_id long, page_number int, text string, x0 double, top double, x1 double, bottom double"))
    assert sorted(r["text"] for r in got.collect()) == ["a b", "c"]


def test_blocks_are_merged_once(spark, tmp_path):
    # no merging (a window of lags) in the plan of the result: its steps read blocks, and the audit's sections too, from tables
    from folioforge.plans import queries as plan

    text = "Summary\nAn engineer of many years.\nSkills\nPython | SQL | Go\nEducation\nBSc at Cairo University 2019"
    spark.createDataFrame([(1, text), (2, "one line"), (3, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("unassigned_blocks", "section_quality"):
        shown = plan.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert "lag(" not in shown and (name != "section_quality" or "_found(" not in shown)
    assert plan.QUERIES["unassigned_blocks"](spark, str(tmp_path)).count() == 0
    assert sorted(r["doc_id"] for r in plan.QUERIES["section_quality"](spark, str(tmp_path)).collect()) == [1, 2]

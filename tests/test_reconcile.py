import json

from pyspark.sql import functions as F

from folioforge.operators import blocks as B
from folioforge.operators import lists as L
from folioforge.operators import reports as R
from folioforge.plans import extraction as X
from folioforge.sources import payloads as P

CV = "Jane Doe\njane@example.com\nSKILLS\nPython | SQL | Docker\nLanguages\nEnglish, Arabic\nEDUCATION\nBachelor of Science, Cairo University, 2020. GPA: 3.4"


def test_end_to_end(spark):
    docs = spark.createDataFrame([(1, CV), (2, "plain words that go on")], "doc_id long, text string")
    inputs = X.reconciliation_input(X.extract(B.from_lines(docs)))
    optimizer = {"technical_skills": ["Python"], "education": [{"university_name": "Cairo University", "degree": "Bachelor of Science", "GPA": ""}]}
    payloads = spark.createDataFrame([(1, json.dumps({"technical_skills": ["python", "Go"]}), json.dumps(optimizer))], "doc_id long, parser string, optimizer string")
    got = {r["doc_id"]: r for r in X.reconcile(inputs, payloads).collect()}
    data = json.loads(got[1]["data"])
    assert data["technical_skills"] == ["Python", "SQL", "Docker", "Go"]
    assert data["education"][0]["GPA"] == "3.4" and "education.GPA" in got[1]["recovered_fields"]
    assert json.loads(got[2]["data"])["technical_skills"] == []


def test_union_keeps_precedence(spark):
    r = spark.range(1).select(L.recover(F.array(F.lit("React.js"), F.lit("SQL")), F.array(F.lit("react"), F.lit("Docker")), F.array(F.lit("docker"), F.lit("Go")), "technical_skills").alias("r")).first()["r"]
    assert r["values"] == ["React.js", "SQL", "Docker", "Go"] and r["items"] == ["technical_skills:Docker", "technical_skills:Go"]


def test_filters(spark):
    def kept(f, values):
        return spark.range(1).select(f(F.array(*map(F.lit, values)))).first()[0]

    assert kept(L.technical, ["Python.", "Tools: git", "a, b", "teamwork", "(x"]) == ["Python"]
    assert kept(L.languages, ["English", "Python", "Skills", "a: b", "LOUD"]) == ["English"]
    assert kept(L.soft_skills, ["• Leadership", "Teamwork: works with many people", "Odd: one two three"]) == ["Leadership", "Teamwork: works with many people"]
    assert kept(L.certifications, ["AWS Certified Architect completed in May", "Best award 2020", "Systems"]) == ["AWS Certified Architect"]


def test_missed_content(spark):
    missed = spark.createDataFrame([("1", "alpha beta gamma delta\n\nnever seen these words"), ("2", "no result for this")], "cv_id string, missed_from_raw_text string")
    results = spark.createDataFrame([("1", "f", ["Alpha beta gamma delta & more"], [], 1)], "cv_id string, file_path string, strings array<string>, education array<struct<gpa:string,grade:string>>, ord int")
    rows = R.recovery_rows(missed, results)
    assert {(r["cv_id"], r["ord"]): (r["status"], r["recovered"]) for r in rows.collect()} == {("1", 0): ("matched", True), ("1", 1): ("matched", False), ("2", 0): ("missing_phase2_result", False)}
    t = R.recovery_totals(rows).first()
    assert (t["total_missed_chunks"], t["recovered_chunks"], t["recovery_rate"]) == (3, 1, 0.333)


def test_payloads(spark, tmp_path):
    rows = spark.createDataFrame([('{"json_output": "{\\"a\\": 1}"}',), ('{"parser_payload": {"b": 2}}',), ('[{"c": 3}]',), ("[]",)], "x string")
    assert [json.loads(r[0]) for r in rows.select(P.unwrap("x")).collect()] == [{"a": 1}, {"b": 2}, {"c": 3}, {}]
    (tmp_path / "a.jsonl").write_text('{"pdf_path": "x.pdf", "cv_id": "7"}\n\n{"cv_id": "8"}\n')
    lines = P.jsonl(spark, str(tmp_path / "a.jsonl"))
    assert [r["row"] for r in lines.orderBy("row").collect()] == [1, 2]
    assert {r["row"]: (r["cv_id"], r["skipped"]) for r in P.pair_by_position(lines, lines).collect()} == {1: ("7", False), 2: ("8", True)}
    (tmp_path / "m.csv").write_text('\ufeffcv_id,missed_count,missed_from_raw_text\n 1 ,2,"a\nb"\n2,,\n', encoding="utf-8")
    got = P.benchmark(spark, str(tmp_path / "m.csv")).orderBy("cv_id").collect()
    assert [(r["cv_id"], r["missed_count"], r["missed_from_raw_text"]) for r in got] == [("1", 2, "a\nb"), ("2", 0, "")]

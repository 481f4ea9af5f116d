"""Sources, sinks and failures of single files or payloads."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge.operators import blocks as B
from folioforge.plans import extraction as X
from folioforge.sources import payloads as P
from folioforge.sources import pdf, sinks


def test_snapshots_and_results(spark, tmp_path):
    one = {"full_text": "a", "sections": [{"heading": "Skills", "content": "SQL", "source_pages": [1], "block_ids": ["b1"]}], "metadata": {"source_path": "x.pdf", "cv_id": "old"}, "cv_id": "7", "semantic_blocks": [{"block_id": "b1", "label": "other", "text": "SQL", "page_number": 1}], "diagnostics": {"merged_block_count": 2, "possible_errors": ["e"]}, "more": 1}
    (tmp_path / "s.jsonl").write_text(json.dumps(one) + "\n\n" + json.dumps({"full_text": "b"}) + "\n")
    got = {r["full_text"]: r for r in P.snapshot(spark, str(tmp_path / "s.jsonl")).collect()}
    assert got["a"]["metadata"] == {"source_path": "x.pdf", "cv_id": "7"} and got["a"]["sections"][0]["heading"] == "Skills"
    assert got["a"]["diagnostics"]["merged_block_count"] == 2 and got["b"]["metadata"] == {} and got["b"]["sections"] is None
    (tmp_path / "bad.jsonl").write_text("{no json\n")
    with pytest.raises(Exception):
        P.snapshot(spark, str(tmp_path / "bad.jsonl")).collect()
    values = P.results(spark, str(tmp_path / "s.jsonl")).select(F.try_variant_get("v", "$.full_text", "string").alias("t")).collect()
    assert sorted(r["t"] for r in values if r["t"]) == ["a", "b"]


def test_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"parser_payload": {"name": "x"}}))
    (tmp_path / "empty.json").write_text("  ")
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert [json.loads(P.payload_rows(spark, p, n).first()[0]) for p, n in ((str(tmp_path / "a.json"), 1), (str(tmp_path / "empty.json"), 1), (str(tmp_path / "b.jsonl"), 2), (None, 1))] == [{"name": "x"}, {}, {"a": 2}, {}]
    for path, row, error in ((str(tmp_path / "b.jsonl"), 3, IndexError), (str(tmp_path / "b.jsonl"), 0, ValueError), ("x.txt", 1, ValueError)):
        with pytest.raises(error):
            P.payload_rows(spark, path, row)


def test_string_lists(spark):
    v = F.parse_json(F.lit('{"a": ["x", " y  z ", ""], "b": "one", "c": 3, "d": null}'))
    got = spark.range(1).select(*(P.string_list(v, k).alias(k) for k in "abcde")).first()
    assert tuple(got) == (["x", "y z"], ["one"], [], [], [])


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "é")], "id int, t string")
    for _ in range(2):
        sinks.append_jsonl(rows, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    sinks.write_report(rows, str(tmp_path / "report"))
    assert json.loads("\n".join(r[0] for r in spark.read.text(str(tmp_path / "report"), wholetext=True).collect())) == {"id": 1, "t": "é"}
    with pytest.raises(ValueError):
        sinks.write_report(rows.union(rows), str(tmp_path / "report2"))
    out = json.loads(rows.select(sinks.output_payload(["id", "t"], F.lit("f.pdf"), F.struct(F.lit(90).alias("score")))).first()[0])
    assert out == {"id": 1, "t": "é", "file_path": "f.pdf", "audit": {"score": 90}}
    lit = [F.struct(F.lit(i).alias("x")) for i in range(4)]
    result = json.loads(rows.select(sinks.result_payload(*lit, F.lit("f.pdf"), F.lit("7"))).first()[0])
    assert result["mode"] == "coverage" and result["milestone"] == "2" and result["cv_id"] == "7" and result["optimizer_payload"] == {"x": 3}


def test_pdf_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pdf.files(spark, str(tmp_path))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "broken.pdf").write_bytes(b"no pdf")
    (tmp_path / "in" / "note.txt").write_text("x")
    found = pdf.files(spark, str(tmp_path))
    assert found.count() == 1
    # whether or not a PDF library is installed, a broken file is one row with its error
    failed = pdf.failures(pdf.extract(found)).collect()
    assert len(failed) == 1 and failed[0]["file_path"].endswith("broken.pdf") and failed[0]["error"]


def test_words_to_lines(spark):
    words = [(1, 1, "world", 60.0, 10.5, 90.0, 20.0), (1, 1, "hello", 10.0, 10.0, 50.0, 20.0), (1, 1, "below", 10.0, 30.0, 50.0, 40.0), (1, 2, "next", 10.0, 10.0, 50.0, 20.0)]
    rows = spark.createDataFrame(words, "doc_id long, page_number int, text string, x0 double, top double, x1 double, bottom double")
    got = {(r["page_number"], r["block_id"]): (r["text"], r["x0"], r["x1"]) for r in B.words_to_lines(rows).collect()}
    assert got == {(1, "raw-1-0"): ("hello world", 10.0, 90.0), (1, "raw-1-1"): ("below", 10.0, 50.0), (2, "raw-2-0"): ("next", 10.0, 50.0)}


def test_one_malformed_payload_fails_alone(spark):
    docs = spark.createDataFrame([(1, "SKILLS\nPython"), (2, "SKILLS\nSQL"), (3, "SKILLS\nGo")], "doc_id long, text string")
    inputs = X.reconciliation_input(X.extract(B.from_lines(docs)))
    payloads = spark.createDataFrame([(1, "{broken", "{}"), (2, "{}", "[1]"), (3, "{}", '{"technical_skills": ["Rust"]}')], "doc_id long, parser string, optimizer string")
    got = {r["doc_id"]: r for r in X.reconcile(inputs, payloads).collect()}
    assert got[1]["data"] is None and "parser" in got[1]["error"] and got[2]["data"] is None and "optimizer" in got[2]["error"]
    assert got[3]["error"] is None and json.loads(got[3]["data"])["technical_skills"] == ["Rust", "Go"]


def test_lines_are_numbered_across_ranges(spark, tmp_path):
    """A file that is split over many tasks, with blank lines and both kinds of line ends, has the numbers of one that is read as a whole."""
    body = "".join(f'{{"n": {i}}}' + ("\r\n" if i % 3 else "\n") + ("\n  \n" if i % 7 == 0 else "") for i in range(4000))
    (tmp_path / "a.jsonl").write_text(body, newline="")
    (tmp_path / "b.jsonl").write_text('{"n": 0}\n{"n": 1}')
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = P.jsonl(spark, str(tmp_path / "*.jsonl"))
        assert spark.read.text(str(tmp_path / "a.jsonl")).rdd.getNumPartitions() > 8
        got = sorted((r["row"], json.loads(r["line"])["n"]) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == sorted([(i + 1, i) for i in range(4000)] + [(1, 0), (2, 1)])


def test_positions_without_one_task(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("x").alias("t")).repartition(7)
    got = P.numbered(rows, "k", "t").orderBy("row").collect()
    assert [r["row"] for r in got] == list(range(1, 5001)) and [r["k"] for r in got] == sorted(r["k"] for r in got)
    assert P.numbered(rows.limit(0), "k").collect() == []


def test_json_leaves(spark):
    from folioforge.operators import reports as R

    docs = [{"b": ["x", {"z": " y\t y ", "a": [["deep"], [], 3, None, True]}], "a": "last"}, ["only", ["a\"b: c", "é\\", " z"]], {"k:": {"k\"": "v"}}, {}, "one", 3, {"": ""}]

    def walk(v):
        if isinstance(v, str):
            return [" ".join(v.split())] if v.split() else []
        return [x for y in (v.values() if isinstance(v, dict) else v if isinstance(v, list) else []) for x in walk(y)]

    rows = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=bool(i % 2), indent=i or None)) for i, d in enumerate(docs)] + [(90, None), (91, "")], "i int, p string")
    got = {r["i"]: r["l"] for r in rows.select("i", R.string_leaves(F.col("p")).alias("l")).collect()}
    assert got == {i: walk(d) for i, d in enumerate(docs)} | {90: [], 91: []}
    with pytest.raises(Exception, match="no JSON"):
        spark.createDataFrame([("{broken",)], "p string").select(R.string_leaves(F.col("p"))).collect()


def test_batches_are_bounded_unless_the_caller_says_so(spark):
    from folioforge.sources.staging import bound_batches

    rows, size = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    kept = {k: spark.conf.get(k) for k in (rows, size)}
    try:
        spark.conf.unset(rows), bound_batches(spark)
        assert (spark.conf.get(rows), spark.conf.get(size)) == ("2000", str(4 << 20))
        seen = spark.range(0, 9000, 1, 1).mapInPandas(lambda batches: (b.assign(id=len(b)) for b in batches), "id long")
        assert seen.agg({"id": "max"}).first()[0] <= 2000
        spark.conf.set(rows, "77"), bound_batches(spark)
        assert spark.conf.get(rows) == "77"
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)

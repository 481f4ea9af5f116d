"""Data source, sink, dead letters and observed figures."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from folioforge.operators import quality as Q
from folioforge.sources import letters, lines, paged


@pytest.fixture
def pushed(spark):
    paged.register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield spark
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "deep").mkdir()
    for i in range(6):
        (tmp_path / "deep" / f"f{i}.txt").write_text("\f".join(f"file {i} page {p}\n\nsecond" for p in range(1, 4)))
    (tmp_path / "big.txt").write_text("\f".join(f"big page {p}" for p in range(1, 41)))
    (tmp_path / "other.md").write_text("not read")
    (tmp_path / "broken.pdf").write_bytes(b"no pdf")
    return str(tmp_path)


def load(spark, folder, **options):
    return spark.read.format("paged_blocks").options(extractor="text", pattern="*.txt", taskBytes=100, pagesPerTask=15, **options).load(folder)


def test_pages_of_all_files(pushed, folder):
    got = load(pushed, folder)
    assert got.rdd.getNumPartitions() > 3  # a large file is several tasks' work, small ones share a task
    rows = got.collect()
    big = sorted((r["page_number"], r["text"]) for r in rows if r["path"].endswith("big.txt"))
    assert big == [(p, f"big page {p}") for p in range(1, 41)]
    assert len(rows) == 40 + 6 * 3 * 2 and {r["error"] for r in rows} == {None}
    assert {r["block_index"] for r in rows} == {0, 1} and all(r["page_count"] in (3, 40) for r in rows)


def test_filters_reach_the_scan(pushed, folder):
    whole = load(pushed, folder).collect()
    for where, keep in (
        ("page_number = 2", lambda r: r["page_number"] == 2),
        ("page_number > 20 and page_number <= 33", lambda r: 20 < r["page_number"] <= 33),
        ("page_number < 1", lambda r: False),
        ("page_number >= 3 and text like '%second%'", lambda r: r["page_number"] >= 3 and "second" in r["text"]),
        ("extractor = 'fallback'", lambda r: False),
        (f"path = '{folder}/big.txt' and page_number = 40", lambda r: r["path"].endswith("big.txt") and r["page_number"] == 40),
    ):
        got = load(pushed, folder).where(where)
        assert sorted(map(str, got.collect())) == sorted(str(r) for r in whole if keep(r)), where
    few = load(pushed, folder).where("page_number = 40")
    plan = few._jdf.queryExecution().executedPlan().toString()
    # what the scan takes is no filter of the plan any more
    assert "(page_number" not in plan.replace(" ", "").split("BatchScan")[0] or "Filterisnotnull" in plan.replace(" ", "")


def test_ranges_that_are_ruled_out_are_no_tasks(folder):
    from pyspark.sql.datasource import EqualTo, LessThan

    def shares(*filters):
        reader = paged.PagedReader({"path": folder, "extractor": "text", "pattern": "*.txt", "taskbytes": "100", "pagespertask": "15"})
        left = list(reader.pushFilters(list(filters)))
        return [f for s in reader.partitions() for f in s.files], left

    every, _ = shares()
    assert sum(f[0].endswith("big.txt") for f in every) > 2
    some, left = shares(EqualTo(("page_number",), 16), EqualTo(("text",), "x"))
    assert [f[1:] for f in some if f[0].endswith("big.txt")] == [(16, 30)] and left == [EqualTo(("text",), "x")]
    assert shares(LessThan(("page_number",), 1))[0] == []
    assert [f[0] for f in shares(EqualTo(("path",), f"{folder}/deep/f1.txt"))[0]] == [f"{folder}/deep/f1.txt"]


def test_broken_file_is_one_row(pushed, folder):
    rows = pushed.read.format("paged_blocks").load(folder).collect()
    assert len(rows) == 1 and rows[0]["path"].endswith("broken.pdf") and rows[0]["error"] and rows[0]["page_number"] is None
    assert pushed.read.format("paged_blocks").load(folder).where("page_number = 1").collect() == []
    with pytest.raises(Exception, match="no extractor"):
        pushed.read.format("paged_blocks").option("extractor", "magic").load(folder).collect()


def read_lines(folder):
    return sorted(json.loads(line)["i"] for f in folder.glob("*.jsonl") for line in f.read_text().splitlines())


def test_lines_are_added_once(spark, tmp_path):
    lines.register(spark)
    out = tmp_path / "out"
    rows = spark.range(100).select(F.col("id").alias("i"), F.struct(F.lit("é").alias("x")).alias("s")).repartition(4)
    for _ in range(2):
        rows.write.format("json_lines").mode("append").save(str(out))
    assert read_lines(out) == sorted([*range(100)] * 2)
    rows.where("i < 3").write.format("json_lines").mode("overwrite").save(str(out))
    assert read_lines(out) == [0, 1, 2] and not list(out.glob("_pending*"))
    assert json.loads(next(out.glob("*.jsonl")).read_text().splitlines()[0])["s"] == {"x": "é"}


def test_a_failed_job_adds_nothing(spark, tmp_path):
    lines.register(spark)
    out = tmp_path / "out"
    spark.range(5).select(F.col("id").alias("i")).write.format("json_lines").mode("append").save(str(out))
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("i")).repartition(4)
    with pytest.raises(Exception, match="broken"):
        bad.write.format("json_lines").mode("append").save(str(out))
    assert read_lines(out) == [*range(5)] and not list(out.glob("_pending*"))


def test_a_task_that_fails_once_adds_its_lines_once(tmp_path):
    """What Spark does when a task is run again: the first attempt wrote some lines and died, the second's message is committed."""
    writer = lines.LinesWriter(str(tmp_path / "out"), False)

    def dies():
        yield Row(i=1)
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(dies())
    twice = [writer.write(iter([Row(i=1), Row(i=2)])) for _ in range(2)]  # and a speculative copy
    writer.commit([twice[1], writer.write(iter([Row(i=3)])), writer.write(iter([])), None])
    assert read_lines(tmp_path / "out") == [1, 2, 3] and not list((tmp_path / "out").glob("_pending*"))


def test_dead_letters(spark, tmp_path):
    path = str(tmp_path / "letters")
    inputs = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "doc_id long, t string")

    def run(rows, n, broken):
        done = rows.withColumn("error", F.when(F.col("doc_id").isin(broken), F.concat(F.lit(f"run {n}: "), "t")))
        return sorted(r["doc_id"] for r in letters.record(done, path, "extract", "doc_id", n).collect())

    assert run(inputs, 1, [1, 3, 5]) == [0, 2, 4]
    again = letters.retry(inputs, letters.read(spark, path), "extract", "doc_id")
    assert sorted(r["doc_id"] for r in again.collect()) == [1, 3, 5]
    assert run(again, 2, [3]) == [1, 5]
    open_ = {r["key"]: (r["cause"], r["run"], r["tries"]) for r in letters.pending(letters.read(spark, path), "extract").collect()}
    assert open_ == {"3": ("run 2: t3", 2, 2)}
    assert letters.pending(letters.read(spark, path), "other").collect() == []
    assert run(letters.retry(inputs, letters.read(spark, path), "extract", "doc_id"), 3, [9]) == [3]
    assert letters.pending(letters.read(spark, path), "extract").collect() == []
    assert run(inputs, 4, [3]) == [0, 1, 2, 4, 5]  # a new failure opens it again
    assert [(r["key"], r["tries"]) for r in letters.pending(letters.read(spark, path), "extract").collect()] == [("3", 1)]


def test_figures_are_observed_while_writing(spark, tmp_path):
    rows = spark.createDataFrame([(1, 90, False, 3, 0.1, ["a"]), (2, 50, True, 1, 1.0, ["document_collapsed_into_general", "oversized_general_section"])], "doc_id long, score int, weak boolean, section_count int, general_block_ratio double, possible_errors array<string>")
    got = Q.written(rows, str(tmp_path / "audit"))
    want = Q.batch_summary(rows).first().asDict()
    assert {k: got[k] for k in ("processed_files", "weak_files", "mean_score")} == {k: want[k] for k in ("processed_files", "weak_files", "mean_score")}
    assert got["mean_sections"] == 2.0 and got["oversized_general_section"] == 1 and got["heading_candidates_found_inside_general"] == 0
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 2

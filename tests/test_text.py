import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.functions import arrays, text, vocab

SAMPLES = ["", "  a  b\r\n\n\n\nc\t d ", "•a\n-  b\n* ", "x y z", "ÉCOLE des Été", "+20 (100) 200-3000", "HTTPS://www.Example.com/a/ ", None]


def test_normal_forms(spark):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")
    got = {r["i"]: r for r in rows.select("i", text.normalize_lines("s").alias("lines"), text.normalize_flat("s").alias("flat"), text.normalize_url("s").alias("url"), text.normalize_phone("s").alias("phone")).collect()}
    assert got[1]["lines"] == "a b\n\nc d"
    assert got[2]["lines"] == "• a\n- b\n*"
    for i, s in enumerate(SAMPLES):
        assert got[i]["flat"] == re.sub(r"\s+", " ", s or "").strip()
    assert got[5]["phone"] == "+201002003000"
    assert got[6]["url"] == "example.com/a"


def test_idempotent(spark):
    rows = spark.createDataFrame([(s,) for s in SAMPLES], "s string")
    for f in (text.normalize_lines, text.normalize_flat, text.normalize_for_match, text.normalize_identity):
        once = rows.select(f("s").alias("t"))
        assert once.where(f("t") != F.col("t")).count() == 0


def test_title_is_pythons(spark):
    words = ["o'neil", "3rd floor", "new cairo, egypt", "ÉCOLE"]
    rows = spark.createDataFrame([(w,) for w in words], "s string")
    assert [r[0] for r in rows.select(text.title("s")).collect()] == [w.title() for w in words]
    got = [r[0] for r in rows.select(text.is_title(F.col("s"))).collect()]
    assert got == [w == w.title() for w in words]


def test_dedupe_and_overlap(spark):
    r = spark.sql("SELECT array('B', ' a', 'b', '', 'A ') AS v, array('x', 'y', 'x') AS p, array('y', 'z', 'w') AS q, array() AS e").select(
        arrays.dedupe_flat(F.col("v")).alias("d"), arrays.overlap(F.col("p"), F.col("q")).alias("o"), arrays.overlap(F.col("p"), F.col("e").cast("array<string>")).alias("z"), arrays.date_overlap(F.lit("2020-2022"), F.lit("2020 – 2022")).alias("t")
    ).first()
    assert r["d"] == ["B", "a"] and r["o"] == 0.5 and r["z"] == 0.0 and r["t"] == 1.0


@pytest.mark.parametrize("s, parts", [("Python | SQL, Go", ["Python", "SQL", "Go"]), ("a, b", ["a, b"]), ("", [])])
def test_split_candidates(spark, s, parts):
    assert spark.range(1).select(text.split_candidates(F.lit(s))).first()[0] == parts


def test_shouted_lines_as_in_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from folioforge.plans import derived  # noqa: F401  registers the query
    from folioforge.plans import queries as plan

    lines = ["МОСКВА", "ÄÖÜÄ", "ÄÖÜA", "ARABIC", "ABCß", "ABCﬁ", "ABCᾼ", "ARAbIC", "日本語日本", "Deutsch", "EN"]
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(con.sql(plan.ORACLES["recoverable_languages_lines"]).fetchall())
    got = sorted(map(tuple, plan.QUERIES["recoverable_languages_lines"](spark, str(tmp_path)).collect()))
    assert got == want and (0, 0, "МОСКВА") in got


def test_keys_of_lines_as_in_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from folioforge.plans import derived  # noqa: F401  registers the query
    from folioforge.plans import queries as plan

    r = random.Random(17)
    pieces = ["öauge 4746", "émay 2020", "may 2020é", "AWS", "éidentify", "Identifyß", "completed", "worKed on", "underſtand", "ıdentify", "may ٢٠٢٠", " Mar 2019 - éMay 2020", " JAN 2020 – Feb 2021", " ſep 2020 - Dec 2021ñ", "certified", "ΟΔΟΣ", "İst", "SQL / SQLite", " ", " ", " ", "-", ".", "é", "a"]
    lines = [*pieces, *("".join(r.choice(pieces) for _ in range(r.randint(2, 5))) for _ in range(1000))]
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    for name in ("comparison_keys_lines", "recoverable_certs_lines"):
        want = sorted(con.sql(plan.ORACLES[name]).fetchall())
        got = sorted(map(tuple, plan.QUERIES[name](spark, str(tmp_path)).collect()))
        assert got == want and len(got) > 50
        if name == "comparison_keys_lines":
            assert (0, 0, "öauge 4746", "öauge 4746", "ö") in got


def test_cheap_looks_tell_what_the_patterns_tell(spark):
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace()] + ["\u180e", "\u200b"]
    pieces = ["a", "bc", " ", "  ", "\n", "\n\n\n", "-", "•", "·", "- x", "é", "–", ".", ":", *spaces]
    r = random.Random(3)
    texts = [*pieces, "", *(f"a{s}b" for s in spaces), *(m + t for m in vocab.BULLETS for t in ("", " ", "x", " x", "  x", " \n x")), *("".join(r.choice(pieces) for _ in range(r.randint(1, 6))) for _ in range(3000))]
    rows = spark.createDataFrame([(t,) for t in texts], "x string").withColumn("n", text.normalize_lines("x"))
    rows = rows.select("x", "n", text._tidied(F.col("x")).alias("slow"), text._untidy(F.col("x")).alias("look"), F.col("x").rlike(text._UNTIDY).alias("whole"), text.words("n").alias("words"), text.words_to(F.col("n"), 3).alias("upto"))
    wrong = [tuple(x) for x in rows.collect() if (x["n"], x["look"], min(x["words"], 4)) != (x["slow"], x["whole"], x["upto"])]
    assert not wrong, wrong[:5]

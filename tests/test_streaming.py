"""File streams: each document once, whatever the number of runs, with the labels of a batch."""

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioforge.operators import blocks as B
from folioforge.streaming import ingest


def test_a_stream_labels_like_a_batch(spark, tmp_path):
    docs = [(1, "Jane Doe\njane@example.com\nSKILLS\nPython | SQL | Docker"), (2, "• one thing\nJan 2020 - Feb 2021"), (3, None), (4, "")]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def add(name, rows):
        (tmp_path / "in" / name).write_text("".join(json.dumps({"doc_id": i, "text": t}) + "\n" for i, t in rows))

    def run():
        ingest.write(ingest.labelled_lines(ingest.read_documents(spark, source, 1)), out, checkpoint).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(out).collect()))

    def batch(rows):
        lines = B.from_lines(spark.createDataFrame(rows, "doc_id long, text string"), boxes=False)
        place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.regexp_extract("block_id", r"(\d+)$", 1).cast("int"))) - 1
        none = F.lit(None).cast("double")
        return sorted(map(tuple, lines.withColumn("pos", place).select("doc_id", "pos", "text", B.label(F.col("text"), F.col("pos"), none, none)).collect()))

    add("a.json", docs[:2])
    assert run() == batch(docs[:2])
    assert run() == batch(docs[:2])  # nothing new, nothing twice
    add("b.json", docs[2:])
    add("c.json", [(5, "SKILLS\nGo")])
    assert run() == batch([*docs, (5, "SKILLS\nGo")])

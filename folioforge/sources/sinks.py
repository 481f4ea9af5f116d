"""Writing results and reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.sources import lines


def append_jsonl(rows: DataFrame, path: str) -> None:
    """Rows as lines of JSON, added to what is there: all of them once, or none."""
    lines.register(rows.sparkSession)
    rows.write.format("json_lines").mode("append").save(path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as one indented JSON text with its letters as they are."""
    rows = report.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a report is one row")
    body = json.dumps(rows[0].asDict(recursive=True), indent=2, ensure_ascii=False, default=str)
    spark = report.sparkSession
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def output_payload(columns: list[str], file_path: Column, audit: Column) -> Column:
    """An extraction as JSON, with its path and audit."""
    return F.to_json(F.struct(*columns, file_path.alias("file_path"), audit.alias("audit")))


def result_payload(phase2_input: Column, validated: Column, parser: Column, optimizer: Column, file_path: Column, cv_id: Column, mode: str = "coverage", milestone: str = "2") -> Column:
    """A reconciliation as JSON, with all it was made from."""
    return F.to_json(
        F.struct(file_path.alias("file_path"), F.lit(milestone).alias("milestone"), F.lit(mode).alias("mode"), phase2_input.alias("phase2_input"), validated.alias("validated_cv"), parser.alias("parser_payload"), optimizer.alias("optimizer_payload"), cv_id.alias("cv_id"))
    )

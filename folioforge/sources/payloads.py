"""Reading snapshots, results, benchmarks and payloads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import text
from folioforge.sources.staging import staged

#: Keys of an extraction snapshot that are read; cv_id and file_path move into its metadata.
SNAPSHOT = ("full_text", "pages", "sections", "metadata", "raw_blocks", "normalized_blocks", "semantic_blocks", "diagnostics")
_BLOCK = "struct<block_id:string,page_number:int,bbox:array<double>,text:string,original_text:string,source_block_ids:array<string>,label:string,hints:array<string>>"
SNAPSHOT_SCHEMA = (
    "full_text string, sections array<struct<heading:string,content:string,source_pages:array<int>,block_ids:array<string>>>, "
    f"semantic_blocks array<{_BLOCK}>, metadata map<string,string>, "
    "diagnostics struct<merged_block_count:int,unassigned_blocks:array<string>,suspicious_blocks:array<struct<block_id:string,page_number:int,reason:string,text:string>>,"
    "section_count:int,general_block_ratio:double,possible_errors:array<string>,recovered_section_splits:int,fallback_used:boolean>, cv_id string, file_path string"
)


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Extraction snapshots, one JSON object per line; blank lines are skipped, broken ones fail the read."""
    rows = spark.read.schema(SNAPSHOT_SCHEMA).option("mode", "FAILFAST").json(path)
    own = F.map_filter(F.create_map(F.lit("cv_id"), F.col("cv_id"), F.lit("file_path"), F.col("file_path")), lambda k, v: v.isNotNull())
    kept = F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin("cv_id", "file_path") | ~F.map_contains_key(own, k))
    return rows.select("full_text", "sections", "semantic_blocks", F.map_concat(kept, own).alias("metadata"), "diagnostics")


def jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(row, line): lines of JSON-lines files as text with their position among the file's non-blank ones, from 1.

    A file of any size is read in many tasks. Two passes number it: the first counts the lines of each range of
    bytes, and running sums over a file's ranges say at which number each begins; the second counts on from there."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))
    lines = lines.withColumn("value", F.regexp_replace("value", "\r$", "")).where(F.trim("value") != "")
    counts = lines.groupBy("file", "range").agg(F.count(F.lit(1)).alias("n"))  # a row for each range of every file
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The place of every line in its range: a task reads ranges one after another, each in order."""
        last, n = None, 0
        for b in batches:
            places = []
            for own in zip(b.column("file").to_pylist(), b.column("range").to_pylist(), strict=True):
                n = n + 1 if own == last else 1
                last = own
                places.append(n)
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("range"), pa.array(places, pa.int64()), b.column("value")], ["file", "range", "nth", "line"])

    numbered = lines.select("file", "range", "value").mapInArrow(number, "file string, range long, nth long, line string")
    return numbered.join(starts, ["file", "range"]).select((F.col("before") + F.col("nth")).alias("row"), "line")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with row, their position from 1 in the order of some columns, without one task that sees them all: ranges of the order are sorted each, and begin where those before them end."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranges = staged(ranges.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_nth")))
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # as many rows as partitions
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranges.join(F.broadcast(starts), "_range").withColumn("row", F.col("_before") + F.col("_nth") + 1).drop("_range", "_nth", "_before")


def results(spark: SparkSession, path: str) -> DataFrame:
    """Reconciliation results, one variant per line."""
    return spark.read.option("singleVariantColumn", "v").json(path)


def benchmark(spark: SparkSession, path: str) -> DataFrame:
    """cv_id, missed_count, missed_from_raw_text from a CSV with multi-line cells; a byte-order mark before the first name is dropped."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    raw = raw.toDF(*(c.lstrip("﻿") for c in raw.columns))

    def named(c: str) -> Column:
        return F.col(c) if c in raw.columns else F.lit(None).cast("string")

    count = text.strip(named("missed_count"))
    return raw.select(text.strip(named("cv_id")).alias("cv_id"), F.when(count == "", 0).otherwise(count.cast("int")).alias("missed_count"), text.col(named("missed_from_raw_text")).alias("missed_from_raw_text"))


def payload_rows(spark: SparkSession, path: str | None, row: int = 1) -> DataFrame:
    """One payload as one row (payload string): a JSON file, or a row of a JSON-lines file; no path gives an empty object."""
    if not path:
        return spark.sql("SELECT '{}' AS payload")
    if path.lower().endswith(".json"):
        raw = spark.read.text(path, wholetext=True).select(F.when(F.trim("value") == "", "{}").otherwise(F.col("value")).alias("line"))
    elif path.lower().endswith(".jsonl"):
        if row < 1:
            raise ValueError("rows count from 1")
        raw = jsonl(spark, path).where(F.col("row") == row)
        if raw.isEmpty():
            raise IndexError(f"no row {row} in {path}")
    else:
        raise ValueError(f"neither .json nor .jsonl: {path}")
    return raw.select(unwrap("line").alias("payload"))


def unwrap(x: Column | str) -> Column:
    """The payload object in a JSON text, as JSON: under parser_payload, optimizer_payload or json_output (an object or its text), or itself; of a list, in its first item.

    Any other shape fails, as there is no payload to go on with."""
    x = F.col(x) if isinstance(x, str) else x
    v = F.parse_json(x)
    kind = F.schema_of_variant(v)
    listed = kind.startswith("ARRAY")
    v = F.when(listed, F.coalesce(F.try_variant_get(v, "$[0]", "variant"), F.parse_json(F.lit("{}")))).otherwise(v)

    def is_object(y: Column) -> Column:
        return F.schema_of_variant(y).startswith("OBJECT")

    def wrapped(key: str, textual: bool) -> Column:
        y = F.try_variant_get(v, f"$.{key}", "variant")
        as_text = F.try_variant_get(v, f"$.{key}", "string")
        out = F.when(is_object(y), F.to_json(y))
        if textual:
            out = out.when(F.schema_of_variant(y).startswith("STRING") & is_object(F.try_parse_json(as_text)), as_text)
        return F.when(y.isNotNull(), out.otherwise(F.raise_error(F.lit(f"unsupported {key}"))))

    itself = F.when(is_object(v), F.to_json(v)).otherwise(F.raise_error(F.lit("unsupported payload")))
    return F.coalesce(wrapped("parser_payload", False), wrapped("optimizer_payload", False), wrapped("json_output", True), itself)


def string_list(payload: Column, key: str) -> Column:
    """Strings under a key of a variant: null gives none, a string itself, a list its items as text, anything else none; blanks collapsed, empty ones dropped."""
    y = F.try_variant_get(payload, f"$.{key}", "variant")
    kind = F.schema_of_variant(y)
    items = F.when(kind.startswith("STRING"), F.array(F.try_variant_get(payload, f"$.{key}", "string"))).when(kind.startswith("ARRAY"), F.try_variant_get(payload, f"$.{key}", "array<string>"))
    return F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), text.normalize_flat), lambda t: t != "")


def pair_by_position(parser: DataFrame, optimizer: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows (row, line) of two files paired by position; those without a pdf_path in either are marked skipped."""
    if limit is not None and limit < 1:
        raise ValueError("the limit is at least 1")
    both = parser.select("row", F.col("line").alias("parser_line")).join(optimizer.select("row", F.col("line").alias("optimizer_line")), "row")
    if limit is not None:
        both = both.where(F.col("row") <= limit)
    path = text.first_filled(*(text.strip(F.get_json_object(c, "$.pdf_path")) for c in ("parser_line", "optimizer_line")))
    cv = F.coalesce(F.get_json_object("parser_line", "$.cv_id"), F.get_json_object("optimizer_line", "$.cv_id"))
    return both.withColumn("pdf_path", path).withColumn("cv_id", cv).withColumn("skipped", F.col("pdf_path") == "")


def pair_by_id(parser: DataFrame, optimizer: DataFrame) -> DataFrame:
    """The same pairing by cv_id, which needs no order and scales."""
    a = parser.select(F.get_json_object("line", "$.cv_id").alias("cv_id"), F.col("line").alias("parser_line"))
    b = optimizer.select(F.get_json_object("line", "$.cv_id").alias("cv_id"), F.col("line").alias("optimizer_line"))
    return a.join(b, "cv_id")

"""PDF files to pages and raw blocks, where a PDF library is installed; its absence shows when a file is read."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS = "path string, extractor string, page_number int, block_index int, text string, x0 double, y0 double, x1 double, y1 double, page_count int, error string"


def files(spark: SparkSession, folder: str) -> DataFrame:
    """All PDF files under a folder (path, content); fails if there are none."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder)
    if found.isEmpty():
        raise FileNotFoundError(f"no PDF files under {folder}")
    return found.select("path", "content")


def _primary(content: bytes) -> Iterator[tuple]:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as doc:
        for n, page in enumerate(doc, 1):
            for i, b in enumerate(page.get_text("dict", sort=True)["blocks"]):
                if b.get("type") == 0:
                    lines = ["".join(s.get("text", "") for s in line.get("spans", [])) for line in b.get("lines", [])]
                    yield (n, i, "\n".join(x for x in lines if x.strip()), *map(float, b["bbox"]), len(doc))


def _words(content: bytes) -> Iterator[tuple]:
    import pdfplumber

    with pdfplumber.open(io.BytesIO(content)) as doc:
        for n, page in enumerate(doc.pages, 1):
            for i, w in enumerate(page.extract_words(x_tolerance=2, y_tolerance=3, keep_blank_chars=False, use_text_flow=True)):
                yield (n, i, w["text"], float(w["x0"]), float(w["top"]), float(w["x1"]), float(w["bottom"]), len(doc.pages))


def extract(found: DataFrame, extractor: str = "primary") -> DataFrame:
    """Blocks (primary) or words (fallback, for words_to_lines) of files; a file that fails gives one row with its error."""
    read = {"primary": _primary, "fallback": _words}[extractor]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    rows = [(path, extractor, *r, None) for r in read(bytes(content))]
                except Exception as e:  # one broken file must not end the batch
                    rows = [(path, extractor, *[None] * 8, str(e) or type(e).__name__)]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS.split(", ")]).convert_dtypes()

    return found.mapInPandas(run, BLOCKS)


def failures(blocks: DataFrame) -> DataFrame:
    return blocks.where("error is not null").select(F.col("path").alias("file_path"), "error")

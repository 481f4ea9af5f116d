"""A data source of paged files: spark.read.format("paged_blocks").load(folder).

Files are packed to tasks by their sizes; one that is larger than a task's share is read by several, each a
range of its pages. Filters on path, extractor and page_number reach the scan (Spark asks for that with
spark.sql.python.filterPushdown.enabled): files and pages that they rule out aren't opened. Columns are not
pruned, as Spark's Python data sources aren't told which are read.

Options: extractor (primary or fallback, for PDF, or text: plain text with form feeds between pages),
pattern (*.pdf), taskBytes (64 MB), pagesPerTask (200). Folders may lie wherever pyarrow's file systems reach.
A file that fails gives one row with its error. Reading PDF needs the library of the extractor.
"""

from __future__ import annotations

import fnmatch
import posixpath
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from folioforge.sources.pdf import BLOCKS, _primary, _words


def _text(content: bytes) -> Iterator[tuple]:
    pages = content.decode("utf-8", "replace").split("\f")
    for n, page in enumerate(pages, 1):
        for i, block in enumerate(x for x in page.split("\n\n") if x.strip()):
            yield (n, i, block.strip("\n"), None, None, None, None, len(pages))


READERS = {"primary": _primary, "fallback": _words, "text": _text}


def _files(path: str, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files below a folder, or of a file."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if system.get_file_info(root).type == fs.FileType.File:
        return [(root, system.get_file_info(root).size)]
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted((f.path, f.size) for f in found if f.is_file and fnmatch.fnmatch(posixpath.basename(f.path).lower(), pattern))


@dataclass
class Share(InputPartition):
    """What one task reads: files, each with its first and last page (0: to the end)."""

    files: tuple[tuple[str, int, int], ...]


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.options = options["path"], options
        self.extractor = options.get("extractor", "primary")
        if self.extractor not in READERS:
            raise ValueError(f"no extractor {self.extractor}: one of {', '.join(READERS)}")
        self.first, self.last = 1, 0  # pages that are wanted
        self.paths: set[str] | None = None
        self.nothing = self.pages_asked = False

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes what it can decide by file and page; Spark applies the rest."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            if column == "page_number" and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.first = max(self.first, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    last = f.value - isinstance(f, LessThan)
                    self.nothing |= last < 1
                    self.last = last if not self.last else min(self.last, last)
                self.nothing |= bool(self.last) and self.last < self.first
                self.pages_asked = True  # a failed file has no page: no such filter keeps it
            elif column in ("path", "extractor") and isinstance(f, (EqualTo, In)):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                if column == "path":
                    self.paths = wanted if self.paths is None else self.paths & wanted
                else:
                    self.nothing |= self.extractor not in wanted
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        most, pages = int(self.options.get("taskbytes", 64 << 20)), int(self.options.get("pagespertask", 200))
        found = [] if self.nothing else [f for f in _files(self.path, self.options.get("pattern", "*.pdf")) if self.paths is None or f[0] in self.paths]
        shares, own, size = [], [], 0
        for path, n in found:
            if n > most:
                # so many ranges as shares fit in the file; the last goes on to the end, however many pages there are
                ranges = -(-n // most)
                starts = [1 + i * pages for i in range(ranges)]
                wanted = [(path, max(s, self.first), e) for s, e in zip(starts, [*(s - 1 for s in starts[1:]), 0], strict=True) if (not e or e >= self.first) and (not self.last or s <= self.last)]
                shares += [Share((w,)) for w in wanted]
                continue
            if own and size + n > most:
                shares.append(Share(tuple(own)))
                own, size = [], 0
            own.append((path, self.first, 0))
            size += n
        return shares + ([Share(tuple(own))] if own else []) or [Share(())]

    def read(self, partition: Share) -> Iterator[tuple]:
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else fs.LocalFileSystem()
        for path, first, last in partition.files:
            end = min(last or 1 << 60, self.last or 1 << 60)
            try:
                with system.open_input_file(path) as f:
                    content = f.read()
                rows = [(path, self.extractor, *r, None) for r in READERS[self.extractor](content) if first <= r[0] <= end]
            except Exception as e:  # one broken file must not end the task
                rows = [] if first > self.first or self.pages_asked else [(path, self.extractor, *[None] * 8, str(e) or type(e).__name__)]
            yield from rows


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_blocks"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)

"""A sink of JSON lines that adds all of a job's rows or none: rows.write.format("json_lines").mode("append").save(folder).

Each task writes a file of its own under a pending folder; the driver moves the files of those attempts
that Spark took into place, and drops the pending folder with what other attempts left there. So a task that
fails half-way, runs again or runs twice adds no line twice. With mode overwrite the lines that stood there go
when the new ones are in place. Folders may lie wherever pyarrow's file systems reach.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    lines: int


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class LinesWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Written:
        system, root = _system(self.path)
        pending = f"{root}/_pending-{self.job}"
        name, n, out = f"{uuid.uuid4().hex}.jsonl", 0, None
        try:
            for row in iterator:
                if out is None:
                    system.create_dir(pending, recursive=True)
                    out = system.open_output_stream(f"{pending}/{name}")
                out.write((json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str) + "\n").encode())
                n += 1
        finally:
            if out is not None:
                out.close()
        return Written(name if n else None, n)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, root = _system(self.path)
        system.create_dir(root, recursive=True)
        old = [f.path for f in system.get_file_info(fs.FileSelector(root)) if f.is_file] if self.overwrite else []
        for i, m in enumerate(messages):
            if m is not None and m.file is not None:
                system.move(f"{root}/_pending-{self.job}/{m.file}", f"{root}/part-{i:05d}-{self.job}.jsonl")
        for path in old:
            system.delete_file(path)
        self._drop(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._drop(*_system(self.path))

    def _drop(self, system, root: str) -> None:
        from pyarrow import fs

        pending = f"{root}/_pending-{self.job}"
        if system.get_file_info(pending).type == fs.FileType.Directory:
            system.delete_dir(pending)


class LinesSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_lines"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return LinesWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LinesSink)

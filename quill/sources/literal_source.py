"""Python-literal lines as a Spark data source:

    register(spark)
    spark.read.format("python_literals").schema(schema).load(path)

Files are split by byte range (option ``splitBytes``), so one large file is read by many
tasks; a line belongs to the range that its first byte is in. Only the fields of the given
schema are converted. Files are opened by ``pyarrow.fs`` in the tasks (local paths,
``hdfs:``, ``s3:``, ``gs:`` URIs); for a store that only Spark can open, use
:func:`quill.sources.files.read_python_literals`, which has the same result.
"""

from __future__ import annotations

import ast
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from quill.sources.files import _to_field

FORMAT = "python_literals"
SPLIT_BYTES = 64 << 20
#: lines that one Arrow batch holds
BATCH_LINES = 2000


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int

    def __post_init__(self):
        super().__init__(None)


class LiteralReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.lenient = options.get("mode", "FAILFAST").upper() == "PERMISSIVE"

    def _files(self) -> list[fs.FileInfo]:
        store, path = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = store.get_file_info(fs.FileSelector(path)) if info.type == fs.FileType.Directory else [info]
        return sorted((f for f in found if f.is_file and f.base_name[0] not in "._"), key=lambda f: f.path)

    def partitions(self) -> list[ByteRange]:
        return [ByteRange(f.path, a, min(a + self.split, f.size)) for f in self._files() for a in range(0, f.size, self.split)]

    def _lines(self, part: ByteRange) -> Iterator[str]:
        store, _ = fs.FileSystem.from_uri(self.path)
        with io.BufferedReader(store.open_input_file(part.path), 1 << 20) as raw:
            at = part.start
            if at:                                      # a line that begins before belongs to the range before
                raw.seek(at - 1)
                at += len(raw.readline()) - 1
            while at < part.end:
                line = raw.readline()
                if not line:
                    return
                at += len(line)
                yield line.decode().rstrip("\r\n")

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        schema, rows = to_arrow_schema(self.schema), []
        for line in self._lines(part):
            if not line.strip():
                continue
            try:
                rows.append(_to_field(ast.literal_eval(line), self.schema))
            except Exception:
                if not self.lenient:
                    raise
                rows.append({f.name: None for f in self.schema.fields})
            if len(rows) == BATCH_LINES:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class LiteralSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> LiteralReader:
        return LiteralReader(schema, dict(self.options))


def register(spark: SparkSession) -> str:
    """Makes the format known to the session; returns its name."""
    spark.dataSource.register(LiteralSource)
    return FORMAT

"""File sources and sinks with explicit schemas.

JSON lines and CSV use Spark's own readers (split per file block, column
pruning through the declared schema). Python-literal lines (``{'a': None,
'b': True, 'c': u'x'}``), which no Spark reader parses, are read as text and
decoded per Arrow batch by ``mapInArrow`` with :func:`ast.literal_eval`;
only that small per-row helper runs in Python.
"""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quill.sources.scratch import written


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str,
                    mode: str = "FAILFAST") -> DataFrame:
    """One JSON object per line. Fields not in ``schema`` are not parsed;
    missing fields are null. ``mode='FAILFAST'`` (default) fails on a
    malformed line, ``'PERMISSIVE'`` turns it into an all-null row."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def parse_json_column(col: str, schema: T.StructType | str) -> F.Column:
    """Parse a JSON string column into a struct."""
    return F.from_json(F.col(col), schema)


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """``(value)``: one stop word per line, used as written (no trimming, no
    case folding)."""
    return spark.read.text(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                   header: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a declared schema (no inference pass). Quoted fields may hold
    the delimiter."""
    return (spark.read.schema(schema).option("header", header).option("mode", mode)
            .option("quote", '"').option("escape", '"').csv(path))


def read_csv_columns(spark: SparkSession, path: str, columns: dict[str, str],
                     mode: str = "FAILFAST") -> DataFrame:
    """CSV with a header, columns picked by *name* and cast to the given types,
    whatever their order in the file. Every field is read as a string first
    (no inference pass); the casts are ANSI-checked."""
    raw = (spark.read.option("header", True).option("mode", mode).option("quote", '"')
           .option("escape", '"').csv(path))
    return raw.select(*[F.col(f"`{name}`").cast(dtype).alias(name) for name, dtype in columns.items()])


def _to_field(value, dtype: T.DataType):
    if value is None:
        return None
    if isinstance(dtype, T.StructType):
        if not isinstance(value, dict):
            raise ValueError(f"expected a dict for {dtype.simpleString()}, got {type(value).__name__}")
        return {f.name: _to_field(value.get(f.name), f.dataType) for f in dtype.fields}
    if isinstance(dtype, T.ArrayType):
        return [_to_field(v, dtype.elementType) for v in value]
    if isinstance(dtype, T.StringType):
        if isinstance(value, bool):
            return "true" if value else "false"
        return str(value)
    if isinstance(dtype, T.BooleanType):
        if isinstance(value, str):
            return {"true": True, "false": False}[value.lower()]
        return bool(value)
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        return int(float(value)) if isinstance(value, str) else int(value)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float(value)
    return value


def _literal_decoder(schema: T.StructType, permissive: bool, corrupt: str | None = None):
    arrow_schema = to_arrow_schema(schema)   # declared types throughout: no integer ever becomes a float

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for line in batch.column(0).to_pylist():
                try:
                    row = _to_field(ast.literal_eval(line), schema)
                    if corrupt is not None:
                        row[corrupt] = None
                    rows.append(row)
                except Exception:
                    if not permissive:
                        raise
                    rows.append({f.name: line if f.name == corrupt else None for f in schema.fields})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)
    return decode


def read_python_literals(spark: SparkSession, path: str, schema: T.StructType,
                         mode: str = "FAILFAST") -> DataFrame:
    """One Python dict literal per line (``None``, ``True``, ``u'..'``,
    ``\\xe9`` escapes, either quote style) into ``schema``. Missing keys are
    null; values are converted to the declared field types. Blank lines are
    skipped. ``mode`` as in :func:`read_json_lines`."""
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
    return lines.mapInArrow(_literal_decoder(schema, mode.upper() == "PERMISSIVE"), schema)


CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType | str) -> T.StructType:
    """``schema`` and a string column for lines that don't fit it."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_lenient(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json",
                 header: bool = True) -> DataFrame:
    """``schema`` and ``_corrupt_record``, which holds the whole line where it is malformed
    (not a JSON object, a literal or a CSV row, or of other types) and is null elsewhere.
    ``fmt``: ``json``, ``csv`` or ``literals``. A malformed line gives one row."""
    full = with_corrupt(schema)
    if fmt == "literals":
        lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
        return lines.mapInArrow(_literal_decoder(full, True, CORRUPT), full)
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        return reader.option("header", header).option("quote", '"').option("escape", '"').csv(path)
    return reader.json(path)


def split_malformed(lenient: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows of :func:`read_lenient`: good ones without the corrupt column, bad
    ones as ``(line)``. Both come from one scan: the rows are written once to the
    shared scratch folder, in two partitions, and read from there."""
    marked = lenient.withColumn("_bad", F.col(CORRUPT).isNotNull())
    both = written(marked, partition_by=["_bad"])
    return (both.where(~F.col("_bad")).drop("_bad", CORRUPT),
            both.where(F.col("_bad")).select(F.col(CORRUPT).alias("line")))


def write_partitions(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    """A sink that can be repeated: replaces the partitions (a rank, a day) that ``df`` has
    and leaves all others, so a job that is run again leaves one copy. Rows are dealt by
    partition with large ones split, so that a day with a third of all rows is not one
    task's."""
    w = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.partitionBy(*by).save(path)


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 header: bool = True, partition_by: list[str] | None = None,
                 single_file: bool = False) -> None:
    """Write a result. ``single_file=True`` is only for small, bounded results
    (a top-k, a metric); big results keep their partitioning."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)

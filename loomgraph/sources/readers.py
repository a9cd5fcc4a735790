"""Scans: JSON lines, JSON objects, raw float32 matrices, records per file, file sets."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines in UTF-8; blank lines are skipped, a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_reporting(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and ``file, line_number, line`` of those that don't parse to an object of the schema.

    Line numbers count from 1 in each file, blank lines included.  Lines are numbered by their place: a file is read in splits in order, and
    the lines of the splits before (one count per split) are added to the place inside the split.  A byte order mark at the start of
    a line is dropped.
    """
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    meta = "_metadata.file_block_start"
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col(meta).alias("block"), F.monotonically_increasing_id().alias("place"), F.regexp_replace("value", "^\\x{FEFF}", "").alias("line"))
    lines = raw.where(F.trim("line") != "")
    parsed = lines.withColumn("row", F.from_json("line", f"{ddl}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("row").isNull() | F.col("row._bad").isNotNull() | ~F.ltrim("line").startswith("{")
    names = [f.strip(" `") for f in StructType.fromDDL(ddl).names]
    # one row per split of a file
    blocks = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    number = (F.col("place") - F.col("first") + F.col("shift") + 1).alias("line_number")
    wrong = parsed.where(bad).select("file", "block", "place", "line").join(shift, ["file", "block"]).select("file", number, "line")
    return parsed.where(~bad).select(*[F.col(f"row.{n}").alias(n) for n in names]), wrong


def read_json_object(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object per file."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_records(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """One record per file at ``root/source/node.json``, with the ids that the path gives."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("recursiveFileLookup", True).json(root)
    path = F.col("_metadata.file_path")
    return rows.withColumn("path_source", F.element_at(F.split(path, "/"), -2)).withColumn("path_node", F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.json\z", ""))


def file_set(spark: SparkSession, root: str) -> DataFrame:
    """``name, bytes, sha256`` of all files under a folder, names relative to it."""
    base = root.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name = F.element_at(F.split("path", F.lit(base.removeprefix("file://"))), -1)
    return files.select(name.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def compare_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``name, problem``: missing, extra, size or hash; both sides have name, bytes and sha256."""
    m = manifest.select("name", F.col("bytes").alias("b"), F.lower("sha256").alias("h"))
    problem = F.when(F.col("bytes").isNull(), "missing").when(F.col("b").isNull(), "extra").when(F.col("bytes") != F.col("b"), "size").when(~F.col("sha256").eqNullSafe(F.col("h")), "hash")
    return files.join(m, "name", "full_outer").select("name", problem.alias("problem")).where("problem is not null")


def denied_files(files: DataFrame, suffixes: list[str], most_bytes: int = 10 << 20) -> DataFrame:
    """Files with a suffix that may not be published, or too large for it."""
    suffix = F.lower(F.regexp_extract("name", r"(\.[^./]+)\z", 1))
    why = F.when(suffix.isin(*suffixes), "suffix").when(F.col("bytes") > most_bytes, "size")
    return files.select("name", why.alias("why")).where("why is not null")


class MatrixSource(DataSource):
    """Raw little-endian float32 matrix: ``spark.read.format("f32matrix").option("dim", 512).load(path)``.

    Rows are numbered from 0.  A file is read in blocks of rows by many tasks; a size that is not whole rows is
    an error.
    """

    BLOCK = 32_768

    @classmethod
    def name(cls) -> str:
        return "f32matrix"

    def schema(self) -> str:
        return "row bigint, embedding array<float>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _MatrixReader(self.options)


class _Block(InputPartition):
    def __init__(self, first: int, rows: int):
        self.first, self.rows = first, rows


class _MatrixReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.dim = options["path"], int(options.get("dim", 512))

    def _open(self):
        if "://" in self.path or self.path.startswith("file:"):
            fs, path = pafs.FileSystem.from_uri(self.path)
        else:
            fs, path = pafs.LocalFileSystem(), os.path.abspath(self.path)
        return fs, path

    def partitions(self) -> list[InputPartition]:
        fs, path = self._open()
        size, width = fs.get_file_info(path).size, self.dim * 4
        if size is None or size % width:
            raise ValueError(f"{self.path}: {size} bytes are not whole rows of {width}")
        n = size // width
        return [_Block(a, min(MatrixSource.BLOCK, n - a)) for a in range(0, n, MatrixSource.BLOCK)] or [_Block(0, 0)]

    def read(self, partition: _Block) -> Iterator[pa.RecordBatch]:
        fs, path = self._open()
        if not partition.rows:
            return
        with fs.open_input_file(path) as f:
            f.seek(partition.first * self.dim * 4)
            x = np.frombuffer(f.read(partition.rows * self.dim * 4), "<f4")
        offsets = pa.array(np.arange(partition.rows + 1, dtype=np.int32) * self.dim)
        rows = pa.array(np.arange(partition.first, partition.first + partition.rows))
        yield pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(offsets, pa.array(x))], ["row", "embedding"])


def read_f32_matrix(spark: SparkSession, path: str, dim: int = 512) -> DataFrame:
    """``row, embedding`` of a raw matrix."""
    spark.dataSource.register(MatrixSource)
    return spark.read.format("f32matrix").option("dim", str(dim)).load(path)

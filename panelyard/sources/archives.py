"""Raw archives: listing, metadata, delimited members, and a manifest that proves them unchanged."""

from __future__ import annotations

import hashlib
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from panelyard.plans import contract as C
from panelyard.sources import sinks


def archives(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """(path, length) of every archive under ``path``; nothing is read but the listing."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length")


def _opened(path: str):
    """The file as a stream that can be moved in, from any store that Arrow knows; a path without a scheme is a local one."""
    files, at = fs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (fs.LocalFileSystem(), path)
    return files.open_input_file(at)


def describe(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, compressed_bytes, uncompressed_bytes, ratio); an archive without exactly one member has ``problem`` set.

    Only the directory at an archive's end is read, in the task.
    """
    def rows(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                try:
                    with _opened(name) as f:
                        members = [m for m in zipfile.ZipFile(f).infolist() if not m.is_dir()]
                    problem = None if len(members) == 1 else f"expected one member, found {len(members)}"
                except zipfile.BadZipFile as e:
                    members, problem = [], str(e)
                m = members[0] if len(members) == 1 else None
                yield pa.RecordBatch.from_pylist([{"path": name, "member": m and m.filename, "compressed_bytes": m and m.compress_size, "uncompressed_bytes": m and m.file_size, "problem": problem}], schema)

    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("compressed_bytes", pa.int64()), ("uncompressed_bytes", pa.int64()), ("problem", pa.string())])
    found = archives(spark, path).select("path").mapInArrow(rows, "path string, member string, compressed_bytes long, uncompressed_bytes long, problem string")
    return found.withColumn("ratio", F.col("uncompressed_bytes") / F.nullif(F.col("compressed_bytes"), F.lit(0)))


def corpus_summary(described: DataFrame) -> DataFrame:
    return described.agg(
        F.count("*").alias("n_archives"), F.sum("compressed_bytes").alias("compressed_bytes"), F.sum("uncompressed_bytes").alias("uncompressed_bytes"),
        F.max("uncompressed_bytes").alias("largest_member"), (F.sum("uncompressed_bytes") / F.nullif(F.sum("compressed_bytes"), F.lit(0))).alias("ratio"))


def read_delimited(spark: SparkSession, path: str, columns: tuple[str, ...] = C.PARSED, sep: str = "|") -> DataFrame:
    """Headerless delimited files by the raw contract: all text, blank stays blank, only ``columns`` are parsed."""
    raw = spark.read.csv(path, schema=C.raw_schema(), sep=sep, header=False, emptyValue="", nullValue="\0", quote="")
    return raw.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns], F.col("_metadata.file_name").alias("source_file"))


def read_commented(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row and ``#`` comment lines before it."""
    return spark.read.csv(path, schema=schema, header=True, comment="#")


def peek(spark: SparkSession, path: str, n: int) -> DataFrame:
    return spark.read.text(path).limit(n)


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ZipReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.options = schema.fieldNames(), options

    def partitions(self) -> list[InputPartition]:
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        if spark is None:
            import glob

            return [_Archive(p) for p in sorted(glob.glob(f"{self.options['path']}/*.zip"))]
        return [_Archive(r.path) for r in archives(spark, self.options["path"]).select("path").orderBy("path").collect()]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        """The archive's one member, inflated and parsed as a stream of batches; a zip cannot be split, so a task reads a whole one."""
        want = [f"c{x}" for x in self.options["positions"].split(",")]
        names = [f"c{i}" for i in range(int(self.options["width"]))]
        with _opened(partition.path) as f, zipfile.ZipFile(f) as z:
            members = [m for m in z.infolist() if not m.is_dir()]
            if len(members) != 1:
                raise ValueError(f"{partition.path}: expected one member, found {len(members)}")
            if not members[0].file_size:
                return
            with z.open(members[0]) as lines:
                batches = csv.open_csv(
                    lines, csv.ReadOptions(column_names=names, block_size=4 << 20), csv.ParseOptions(delimiter=self.options.get("sep", "|"), quote_char=False),
                    csv.ConvertOptions(include_columns=list(dict.fromkeys(want)), column_types=dict.fromkeys(names, pa.binary()), strings_can_be_null=False))
                for batch in batches:
                    yield pa.RecordBatch.from_arrays([_text(batch.column(c)) for c in want], self.names)


def _text(column: pa.Array) -> pa.Array:
    """UTF-8, with what is none replaced."""
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode(errors="replace") for x in column.to_pylist()], pa.string())


class ZipSource(DataSource):
    """``spark.read.format("zip_delimited")``: single-member archives in a store that executors reach."""

    @classmethod
    def name(cls) -> str:
        return "zip_delimited"

    def schema(self) -> str:
        return ", ".join(f"{C.LAYOUT[int(i)].name} string" for i in self.options["positions"].split(","))

    def reader(self, schema: StructType) -> DataSourceReader:
        return ZipReader(schema, self.options)


def read_zips(spark: SparkSession, path: str, columns: tuple[str, ...] = C.PARSED) -> DataFrame:
    spark.dataSource.register(ZipSource)
    at = {f.name: i for i, f in enumerate(C.LAYOUT)}
    return spark.read.format("zip_delimited").options(positions=",".join(str(at[c]) for c in columns), width=str(len(C.LAYOUT))).load(path)


def verify_contract(lines: DataFrame, column: str = "value", sep: str = "|") -> list[str]:
    """Problems of raw lines against the contract: width, the id's fill and length, the month's length."""
    parts = F.split(column, rf"\{sep}", -1)
    loan, month = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    filled = F.coalesce(loan, F.lit("")) != ""
    r = lines.agg(
        F.count("*").alias("n"), F.count_if(F.size(parts) != len(C.LAYOUT)).alias("width"), F.count_if(filled).alias("filled"), F.min(F.when(filled, F.length(loan))).alias("short"),
        F.count_if(F.length(month) != 6).alias("month")).first()
    out = [f"{r.width} records do not have {len(C.LAYOUT)} fields"] if r.width else []
    if r.n and r.filled < 0.999 * r.n:
        out.append("LOAN_ID is blank too often")
    if r.short is not None and r.short < 8:
        out.append("LOAN_ID is too short")
    return [*out, f"{r.month} records have an ACT_PERIOD that is not of six characters"] if r.month else out


def manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, sha256, length) of every file, read in pieces and hashed in the task."""
    def rows(batches):
        for batch in batches:
            for name, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                digest = hashlib.sha256()
                with _opened(name) as f:
                    while piece := f.read(8 << 20):
                        digest.update(piece)
                yield pa.RecordBatch.from_pylist([{"name": name.rsplit("/", 1)[-1], "sha256": digest.hexdigest(), "length": length}])

    return archives(spark, path, pattern).mapInArrow(rows, "name string, sha256 string, length long")


def verify_manifest(current: DataFrame, stored: DataFrame | None) -> tuple[str, DataFrame]:
    """``baseline_created``, ``verified`` or ``MODIFIED``, and the files (name, change) that changed or are missing."""
    if stored is None:
        return "baseline_created", current.select("name", F.lit(None).cast("string").alias("change")).limit(0)
    both = stored.select("name", F.col("sha256").alias("old")).join(current.select("name", F.col("sha256").alias("new")), "name", "left")
    found = both.filter("new is null or new <> old").select("name", F.when(F.col("new").isNull(), "missing").otherwise("changed").alias("change"))
    return ("verified" if found.isEmpty() else "MODIFIED"), found


def read_json(path: str) -> dict:
    with open(path) as f:
        return json.load(f)


def add_snapshot(raw: DataFrame, path: str, snapshot: str) -> bool:
    """Keep ``raw`` as a snapshot under ``path``, once: a finished snapshot is never written again.  Whether it was written."""
    return sinks.once(raw, f"{path}/snapshot_id={snapshot}")


def snapshot(spark: SparkSession, path: str, wanted: str | None = None) -> DataFrame:
    """The rows of a snapshot, the last by name if none is wanted, with its snapshot_id; only its folder is read."""
    rows = spark.read.parquet(path).withColumn("snapshot_id", F.col("snapshot_id").cast("string"))
    if wanted is not None:
        return rows.filter(F.col("snapshot_id") == wanted)
    return rows.filter(F.col("snapshot_id") == rows.agg(F.max("snapshot_id")).scalar())

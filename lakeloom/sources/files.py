"""File sources for RAW data: JSON/CSV/text/whole-file, batch and streaming.

RAW holds exact copies in date-partitioned folders; these readers add no
interpretation beyond parsing. Declared schemas are preferred (stable plans,
streaming needs them, and CSV inference would turn ``01`` into ``1``).
Folders starting with ``_`` (run manifests, control data) are skipped by
Spark's file listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_json_tree(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                   corrupt_column: str | None = None) -> DataFrame:
    """All JSON under ``path`` (any depth): JSON-lines chunks and files holding
    one top-level array (one record per element) alike."""
    r = spark.read.option("recursiveFileLookup", "true")
    if corrupt_column:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_csv_tree(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
                  infer: bool = False, corrupt_column: str | None = None) -> DataFrame:
    """CSV with header, recursive; declared schema (checked against the header) or
    all-text unless ``infer``."""
    r = spark.read.option("recursiveFileLookup", "true").option("header", "true")
    if corrupt_column:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", "false")
    elif infer:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def read_raw(spark: SparkSession, path: str | list[str], fmt: str = "json",
             schema: T.StructType | None = None, corrupt_column: str | None = None) -> DataFrame:
    """RAW files of one format. With ``corrupt_column`` (a text column of ``schema``) it holds the
    text of each row that does not parse under the schema."""
    if fmt == "json":
        return read_json_tree(spark, path, schema, corrupt_column)
    if fmt == "csv":
        return read_csv_tree(spark, path, schema, corrupt_column=corrupt_column)
    if fmt == "parquet":
        paths = [path] if isinstance(path, str) else path
        return spark.read.option("recursiveFileLookup", "true").parquet(*paths)
    raise ValueError(f"unsupported RAW format {fmt!r}")


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (``value``), unparsed -- e.g. NDJSON clickstream."""
    return spark.read.option("recursiveFileLookup", "true").text(path)


def read_whole_files(spark: SparkSession, path: str, binary: bool = True) -> DataFrame:
    """One row per file with its exact content (every file, not just the first).

    ``binaryFile`` gives ``path, modificationTime, length, content``; with
    ``binary=False`` the content is text (``value``) plus the file path.
    """
    if binary:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    df = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)
    return df.selectExpr("_metadata.file_path AS path", "value")


def read_json_stream(spark: SparkSession, path: str, schema: T.StructType,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental file source: each new file under ``path`` is read once.

    The checkpoint of the consuming query records which files were processed
    (exactly-once file tracking)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path)


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of an upstream (streaming or batch) parquet table."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)

"""Table writers for each layer.

Parquet folders stand in for transactional tables, so the writers follow two
rules: data is written first to a folder nobody reads yet, and a small commit
record makes it visible (``write_version`` / ``read_current``); appends are
path-based with schema merging on read (catalog appends refuse new columns).
Before partitioned writes the data is rebalanced (``rebalance`` hint on the
partition columns) so each output partition gets reasonably sized files
instead of one file per task per value, with hot values split by AQE.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, list_names


# A task that meets few partition values keeps a file of each open instead of sorting its rows by them.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


# --------------------------------------------------------------------------- appends
def append_partitioned(df: DataFrame, path: str,
                       partition_cols: Sequence[str] = ("ingestion_date",)) -> None:
    """Append, partitioned by load date; new columns are allowed (merged on read)."""
    (rebalanced(df, partition_cols).write.mode("append").partitionBy(*partition_cols).parquet(path))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read an appended table whose files carry different column sets."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def put_immutable(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write once: fail if the (batch-unique) target already exists."""
    df.write.mode("errorifexists").format(fmt).save(path)


def append_text(df: DataFrame, path: str) -> None:
    """Raw lines, appended as-is (one folder per batch)."""
    df.select(F.col(df.columns[0]).cast("string").alias("value")).write.mode("append").text(path)


def write_jsonl_batch(df: DataFrame, batch_path: str, chunk_rows: int = 0) -> None:
    """JSON lines of one batch as they are dealt and sorted, in files of ``chunk_rows`` rows
    at most (0: no bound). The batch owns its folder and replaces it as a whole, so a
    retried batch leaves no row of the first try."""
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "static").option("maxRecordsPerFile", str(chunk_rows))
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(batch_path))


# --------------------------------------------------------------------------- overwrites
def rebalanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Shuffle by the output partition columns with the ``rebalance`` hint: AQE
    splits a hot value (one month holding a third of the rows) over several
    tasks and merges tiny ones, so file sizes stay even."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def overwrite(df: DataFrame, path: str, partition_cols: Sequence[str] = (), clustered: bool = False) -> None:
    """Replace a table (optionally partitioned by e.g. month or snapshot date).
    ``clustered`` rows keep the order ``cluster_by`` gave them: no shuffle here."""
    w = (df if clustered else rebalanced(df, partition_cols)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "static")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


_COMMITS = "_commits"
_COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("rows", T.LongType()),
])


def write_version(df: DataFrame, base: str, partition_cols: Sequence[str] = (), clustered: bool = False,
                  keep: int = 2) -> str:
    """Overwrite-by-swap: data goes to a fresh version folder, then a commit
    record points readers at it. A table can thus be rebuilt from itself, and
    a crash before the commit leaves readers on the previous version. Rows are
    counted as they are written. The last ``keep`` versions stay (a reader may
    still be on the one before); older ones are removed after the commit."""
    spark, base = df.sparkSession, base.rstrip("/")
    version = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
    target = f"{base}/version={version}"
    counted = Observation()
    df = df if clustered else rebalanced(df, partition_cols)
    w = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(target)
    commit = spark.createDataFrame(
        [(version, datetime.now(timezone.utc), counted.get["rows"])], _COMMIT_SCHEMA)
    commit.coalesce(1).write.mode("append").parquet(f"{base}/{_COMMITS}")
    old = [n for n in list_names(spark, base) if n.startswith("version=") and n < f"version={version}"]
    for name in old[:max(0, len(old) - keep + 1)]:
        delete_path(spark, f"{base}/{name}")
    return target


def current_version(spark: SparkSession, base: str) -> str | None:
    commits = spark.read.parquet(f"{base.rstrip('/')}/{_COMMITS}")
    last = commits.orderBy(F.col("committed_at").desc(), F.col("version").desc()).limit(1).collect()
    return last[0]["version"] if last else None


def read_current(spark: SparkSession, base: str) -> DataFrame:
    version = current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"no committed version under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/version={version}")


# --------------------------------------------------------------------------- layout
def _as_number(df: DataFrame, col: str):
    """A double in the order of the column: days, seconds, numbers, or the leading bytes of a text."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp").cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    return F.conv(F.rpad(F.hex(F.substring(c.cast("string").cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")


def _text_edge(number: float) -> bytes:
    """The least text whose ``_as_number`` is this; texts compare with it as their numbers do."""
    return int(number).to_bytes(6, "big").rstrip(b"\0")


def _with_bucket(df: DataFrame, col: str, edges: Sequence[float], bits: int, name: str) -> DataFrame:
    """``df`` with how many of the ascending ``edges`` (fewer than 2^bits, as ``_as_number`` gives them) are
    not above the column's value (none for a null): a search by halving, ``bits`` steps a row. Each step
    is a projection: plain generated code, where a lambda would be interpreted for every row."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.NumericType)):
        at = F.array(*[F.lit(float(x)) for x in edges]).cast("array<double>")
        df = df.withColumn(f"{name}n", _as_number(df, col))
    else:
        at = F.array(*[F.lit(_text_edge(x)) for x in edges]).cast("array<binary>")
        df = df.withColumn(f"{name}n", F.col(col).cast("string").cast("binary"))
    df = df.withColumn(name, F.lit(0))
    for step in (1 << i for i in reversed(range(bits))):
        n = F.col(name)
        df = df.withColumn(name, F.when(F.col(f"{name}n") >= F.get(at, n + (step - 1)), n + step).otherwise(n))
    return df


def cluster_by(df: DataFrame, keys: Sequence[str], num_partitions: int | None = None,
               bits: int = 8, within: Sequence[str] = ()) -> DataFrame:
    """Co-locate rows with nearby key values in the same files.

    One key: range partition + sort. Several keys: a Z-order value that
    interleaves the bits of each key's quantile bucket (in the key's own order),
    then range partition on it, so files have narrow min/max ranges on every
    key. ``within`` puts the table's partition columns first. The number of
    files is left to the session and AQE unless given.
    """
    keys, cols = list(keys), list(df.columns)
    # A row hash after the clustering key lets the range partitioner split a
    # single hot value over several files instead of one giant one.
    df = df.withColumn("__spread", F.xxhash64(*[F.col(c) for c in cols]))

    def ranged(out: DataFrame, *by) -> DataFrame:
        by = (*within, *by)
        cut = out.repartitionByRange(num_partitions, *by, "__spread") if num_partitions else out.repartitionByRange(*by, "__spread")
        return cut.sortWithinPartitions(*by).select(*cols)

    if len(keys) == 1:
        return ranged(df, keys[0])
    n = 1 << bits
    numbers = df.select(*(_as_number(df, k).alias(k) for k in keys))
    cuts = numbers.approxQuantile(keys, [i / n for i in range(1, n)], 0.001)  # one pass, n - 1 numbers a key
    z = F.lit(0).cast("long")
    for j, (key, edges) in enumerate(zip(keys, cuts, strict=True)):
        df = _with_bucket(df, key, edges, bits, f"__b{j}")
        # the bits of each bucket number, moved apart
        apart = F.array(*[F.lit(sum((b >> i & 1) << (i * len(keys) + j) for i in range(bits))).cast("long") for b in range(n)])
        z = z.bitwiseOR(F.get(apart, F.col(f"__b{j}")))
    return ranged(df.withColumn("__z", z), "__z")


# --------------------------------------------------------------------------- catalog
def register_table(spark: SparkSession, name: str, path: str, comment: str | None = None,
                   properties: dict[str, str] | None = None) -> None:
    """Catalog entry over a parquet folder with a comment and properties."""
    parts = [f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'"]
    if comment:
        parts.append("COMMENT '" + comment.replace("'", "\\'") + "'")
    if properties:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        parts.append(f"TBLPROPERTIES ({props})")
    spark.sql(" ".join(parts))


def ensure_layers(spark: SparkSession, env: str,
                  layers: Sequence[str] = ("raw", "bronze", "silver", "gold")) -> list[str]:
    """One namespace per layer and environment (``<env>_<layer>``)."""
    names = [f"{env}_{layer}" for layer in layers]
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}")
    return names


def materialise(df: DataFrame, name: str, as_view: bool, path: str | None = None) -> None:
    """Staging models as views, marts as tables."""
    if as_view:
        df.createOrReplaceTempView(name)
    else:
        if path is None:
            raise ValueError("a table needs a path")
        write_version(df, path)

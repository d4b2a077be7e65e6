"""Line dedup: levelled sorted runs of line hashes, compacted periodically.

``LineRuns`` keeps how many documents hold a line as runs: tables (key, n) that are
bucketed and sorted by key. A batch of documents is summed to (key, n), merge-anti-joined
with the runs of *settled* keys (those known to be in ``min_docs`` documents need no more
counting) and what is left becomes a run of level 0. When a level has ``fanout`` runs they
are merged into one run of the next level; keys that reach ``min_docs`` then leave it for
a settled run. A key is thus rewritten once a level, not once a batch, and a
run is not shuffled to be joined with a batch. A manifest written after each step names the
live runs, so a store can be opened again; a run that no manifest names does not count.

A line's key is the 128-bit hash of the line without spaces at both ends, A-Z lower-cased.

``dedup_lines`` counts the lines of a table in batches and drops the lines whose key is
settled. Lines are matched by a shuffle join; the keys that may be hot (at least 1/1000
of a batch's lines, so 1000 a batch at most) are told apart by a broadcast of that bound.
Texts with a dropped line are found by the hash of the text, once for all its copies.

Odd input: a null text is one empty line, as an empty one; empty keys never count; a
line counts once per row, equal rows count as rows; rows without doc_id and rows with
the same doc_id are rows of their own; a text of any length is one row, its lines are
split in one task; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import batches_of, stored
from lakeloom.session import path_exists, scratch_path

MIN_DOCS = 10
FANOUT = 3
LOTS = 16
BATCH_LINES = 1_000_000
HOT_PART = 1_000
SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """16 bytes that stand for the line; none for a line of spaces."""
    line = line.strip(SPACE).lower()  # bytes.lower() changes A-Z only
    return xxhash.xxh3_128_digest(line) if line else b""


@dataclass(frozen=True)
class Run:
    kind: str   # open or settled
    level: int
    name: str   # folder below the root, and table name


class LineRuns:
    """Runs below ``root``; every step ends with a manifest that names the live ones."""

    def __init__(self, spark: SparkSession, root: str, min_docs: int = MIN_DOCS, fanout: int = FANOUT,
                 buckets: int | None = None):
        """``buckets`` is fixed when the store is made: the session's shuffle partitions if not given."""
        self.spark, self.root = spark, root.rstrip("/")
        self.min_docs, self.fanout = min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[Run] = []
        self.version = 0
        if path_exists(spark, f"{self.root}/manifest"):
            rows = spark.read.parquet(f"{self.root}/manifest/*").collect()  # a row per live run and step
            self.version = max(r["version"] for r in rows)
            self.buckets = rows[0]["buckets"]
            self.runs = [Run(r["kind"], r["level"], r["name"]) for r in rows
                         if r["version"] == self.version and r["kind"] != "none"]

    def _commit(self, runs: list[Run]) -> None:
        self.version += 1
        rows = [(self.version, self.buckets, r.kind, r.level, r.name) for r in runs] or [(self.version, self.buckets, "none", 0, "")]
        (self.spark.createDataFrame(rows, "version int, buckets int, kind string, level int, name string")
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v{self.version:08d}"))
        self.runs = runs

    def _write(self, kind: str, level: int, keys: DataFrame) -> Run:
        run = Run(kind, level, scratch_path(self.spark, "run").rsplit("/", 1)[1].replace("-", "_"))
        (keys.select("key", "n").repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
         .option("path", f"{self.root}/{run.name}").saveAsTable(run.name))
        return run

    def _read(self, run: Run) -> DataFrame:
        if not self.spark.catalog.tableExists(run.name):
            self.spark.sql(f"CREATE TABLE {run.name} (key BINARY, n BIGINT) USING parquet CLUSTERED BY (key) "
                           f"SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{run.name}'")
        return self.spark.table(run.name)

    def _files(self, runs: list[Run]) -> DataFrame:
        """All rows of ``runs``, read as files: Spark 4.1 groups a union of bucketed tables as if
        equal buckets of its inputs were one partition, and gives wrong sums."""
        return self.spark.read.schema("key binary, n bigint").parquet(*(f"{self.root}/{r.name}" for r in runs))

    def _of(self, kind: str, level: int | None = None) -> list[Run]:
        return [r for r in self.runs if r.kind == kind and level in (None, r.level)]

    def _unsettled(self, keys: DataFrame) -> DataFrame:
        """``keys`` without those of the settled runs: both sides are sorted buckets, merged run by run."""
        for run in self._of("settled"):
            keys = keys.join(self._read(run).select("key").hint("merge"), "key", "left_anti")
        return keys

    def add(self, counted: DataFrame) -> None:
        """A batch's (key, n): what is not settled yet becomes a run; full levels are merged."""
        self._commit([*self.runs, self._write("open", 0, self._unsettled(counted))])
        level = 0
        while len(self._of("open", level)) >= self.fanout:
            self.compact(self._of("open", level), level + 1)
            level += 1
            if len(self._of("open", level)) < 2:  # a run alone comes from a merge: with a fanout of 1 it would rise for ever
                break

    def compact(self, runs: list[Run], level: int) -> None:
        """One open run of ``level`` from ``runs``; keys that have reached ``min_docs`` become a settled run."""
        merged = stored(self._files(runs).groupBy("key").agg(F.sum("n").alias("n")), "line-merge")
        new = [self._write("open", level, merged.filter(F.col("n") < self.min_docs)),
               self._write("settled", level, merged.filter(F.col("n") >= self.min_docs))]
        self._commit([r for r in self.runs if r not in runs] + new)
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run.name}")  # external: the files stay until the root goes

    def settled(self) -> DataFrame:
        """(key) of all lines in ``min_docs`` documents so far."""
        if len(opened := self._of("open")) > 1 or any(r.level == 0 for r in opened):
            self.compact(opened, 1 + max(r.level for r in opened))
        runs = self._of("settled")
        if not runs:
            return self.spark.createDataFrame([], "key binary")
        return self._files(runs).select("key").distinct()


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, text, t): t stands for the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn(
        "t", F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b")))


def _line_keys(docs: DataFrame) -> DataFrame:
    """(lot, a, b, keys): the distinct keys of each text."""
    def run(rows):
        for batch, texts in batches_of(rows, "text"):
            ends, keys = [0], []
            for text in texts:
                keys += {k for k in map(line_key, text.as_buffer().to_pybytes().split(b"\n")) if k}
                ends.append(len(keys))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.binary()))],
                names=["lot", "a", "b", "keys"])
    return (_identified(docs).select((F.spark_partition_id() % LOTS).alias("lot"), "t.a", "t.b", "text")
            .mapInArrow(run, "lot int, a long, b long, keys array<binary>"))


def _stored_keys(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("lot int, a long, b long, keys array<binary>").parquet(f"{root}/keys")


def _dropped_keys(spark: SparkSession, root: str, min_docs: int, batch_lines: int) -> tuple[DataFrame, DataFrame]:
    """Settled keys over all lots below ``root``/keys, and the few that may be hot."""
    keys = _stored_keys(spark, root)
    sizes = {r["lot"]: r["n"] for r in keys.groupBy("lot").agg(F.sum(F.size("keys")).alias("n")).collect()}  # LOTS rows
    batches: list[list[int]] = []
    size = 0
    for lot in sorted(sizes):
        if not batches or size + sizes[lot] > batch_lines and size:
            batches.append([])
            size = 0
        batches[-1].append(lot)
        size += sizes[lot]
    runs, hot = LineRuns(spark, f"{root}/runs", min_docs), set()
    for lots in batches:
        total = sum(sizes[x] for x in lots)
        counted = stored(keys.filter(F.col("lot").isin(lots)).select(F.explode("keys").alias("key"))
                         .groupBy("key").agg(F.count("*").alias("n")), "line-batch")
        most = max(total // HOT_PART, min_docs)  # so at most HOT_PART keys of a batch
        hot |= {bytes(r["key"]) for r in counted.filter(F.col("n") >= most).select("key").collect()}
        runs.add(counted)
    return runs.settled(), spark.createDataFrame([(bytearray(k),) for k in sorted(hot)], "key binary")


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batch_lines: int = BATCH_LINES) -> DataFrame:
    """(a, b, dropped): per text (by hash) that has such lines, the keys found in ``min_docs`` documents."""
    spark = docs.sparkSession
    root = scratch_path(spark, "line-dedup")
    _line_keys(docs).write.partitionBy("lot").parquet(f"{root}/keys")
    settled, hot = _dropped_keys(spark, root, min_docs, batch_lines)
    settled = stored(settled, "line-settled")
    hot = hot.join(settled.withColumn("drop", F.lit(True)), "key", "left")
    lines = _stored_keys(spark, root).select("a", "b", F.explode("keys").alias("key"))
    known = lines.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "key", "left")
    found = known.filter("drop").select("a", "b", "key").unionByName(
        known.filter(F.col("hot").isNull()).select("a", "b", "key").join(settled, "key", "left_semi"))
    return found.groupBy("a", "b").agg(F.collect_set("key").alias("dropped"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batch_lines: int = BATCH_LINES) -> DataFrame:
    """(doc_id, kept, n_lines, n_dropped, kept_sha256) per row of ``docs``; kept is the text that is left."""
    def run(rows):
        for batch, texts in batches_of(rows, "text"):
            gone, out = batch.column(2), ([], [], [], [])
            for i, text in enumerate(texts):
                raw = text.as_buffer().to_pybytes()
                lines = raw.split(b"\n")
                left = raw
                if gone[i].is_valid:
                    drop = set(gone[i].as_py())
                    kept = [x for x in lines if line_key(x) not in drop]
                    left = b"\n".join(kept)
                for column, value in zip(out, (left.decode(), len(lines), len(lines) - len(kept) if gone[i].is_valid else 0,
                                               hashlib.sha256(left).hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                             names=["doc_id", "kept", "n_lines", "n_dropped", "kept_sha256"])
    texts = _identified(docs).select("doc_id", "text", "t.a", "t.b")
    return (texts.join(dropped_lines(docs, min_docs, batch_lines), ["a", "b"], "left").select("doc_id", "text", "dropped")
            .mapInArrow(run, "doc_id long, kept string, n_lines long, n_dropped long, kept_sha256 string"))


SQL_LINE_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY rid, doc_id
"""

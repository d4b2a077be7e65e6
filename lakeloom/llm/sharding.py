"""Sharding: proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; rank / size of
the source is a row's fractional rank. All rows sorted by fractional rank
interleave the sources in proportion, so each of the equal cuts of that order
has the mixture of the whole. Law ``rows``: shard counts are at most one apart.

Ranks are counted, not sorted in one place: rows fall into buckets by the leading
part of their sort key, bucket sizes are summed to offsets, and only the rows of
one bucket are sorted together. Buckets are made by a hash (or by a fractional
rank, which is even by construction), so a source that holds a third of all rows
is spread like any other.

Odd input: a null source is a source of its own; a null text has 0 bytes (size 16)
and the crc of the empty text; rows without doc_id or equal rows are ordered
arbitrarily among themselves but each gets a slot; a very long text is one row of its
size; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import stored

SHARDS = 40
SEED = 42
BUCKET_ROWS = 20_000
ROW_BYTES = 16


def _offsets(rows: DataFrame, group: list[str], bucket: str) -> DataFrame:
    """(group, bucket, offset, n): rows of the group before the bucket, and of the whole group."""
    sizes = rows.groupBy(*group, bucket).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy(bucket)
    return sizes.select(*group, bucket,
                        (F.sum("__n").over(before) - F.col("__n")).alias("offset"),
                        F.sum("__n").over(Window.partitionBy(*group)).alias("of"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.concat(F.lit("s:"), F.col("source").cast("string")), F.lit("")).alias("source"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")), "shard-rows")
    total = rows.count()
    buckets = max(1, -(-total // BUCKET_ROWS))

    seeded = F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")
    keyed = rows.withColumn("h", seeded).withColumn("b", F.pmod(F.shiftrightunsigned("h", 32), F.lit(buckets)))
    ranked = keyed.withColumn("r", F.row_number().over(Window.partitionBy("source", "b").orderBy("h", "doc_id")) - 1)
    ranked = ranked.join(_offsets(keyed, ["source"], "b"), ["source", "b"])
    # the hash of the source staggers equal fractions, so small sources do not all start at 0
    phase = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    part = ranked.select("doc_id", "size", "text_crc32", "source", "h",
                         ((F.col("offset") + F.col("r") + phase) / F.col("of")).alias("fraction"))
    part = stored(part.withColumn("g", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)).cast("long")), "shard-ranks")

    order = Window.partitionBy("g").orderBy("fraction", "source", "h", "doc_id")
    sizes = part.groupBy("g").agg(F.count("*").alias("n"))
    before = sizes.select("g", (F.sum("n").over(Window.orderBy("g")) - F.col("n")).alias("offset"))  # one row a bucket
    at = part.withColumn("r", F.row_number().over(order) - 1).join(before, "g").withColumn("at", F.col("offset") + F.col("r"))
    shard = F.expr(f"(at * {shards}) div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return at.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("at") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

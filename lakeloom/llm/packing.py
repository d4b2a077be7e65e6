"""Packing: cutting-stock column generation.

Documents become token ids plus an end id; a document longer than a sequence is
cut into full sequences and a rest. Piece lengths are rounded up to classes of
``WIDTH`` tokens. Over the histogram of classes (at most ``length / WIDTH`` rows,
all that reaches the driver) a linear program picks how often each pattern of
classes is used: the restricted program is solved by the revised simplex method,
and a knapsack dynamic program prices new columns until none helps. Solutions are
rounded down; what remains is filled largest first. Patterns are then assigned to
documents by rank: pieces of a class are numbered by counted offsets, and number
ranges of a class belong to the slots of patterns.

Odd input: a null or empty text has only the end id; a very long text is cut;
repeated rows are packed each (pieces are told apart by doc_id, start and an
arbitrary order); rows without doc_id are packed; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import batches_of, stored
from lakeloom.llm.sharding import _offsets

LENGTH = 2048
END_ID = 1
WIDTH = 8
BUCKET_ROWS = 20_000
GAP = 1e-3

#: Texts of these characters, without very long words, are tokenized alike by both libraries.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
_LONG = re.compile(r"\S{1000}")


@functools.cache
def _tokenizer(json_path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


@functools.cache
def _ranks(ranks_path: str, pattern: str):
    """The same vocabulary as ranks, for plain texts."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, json_path: str, ranks_path: str, pattern: str) -> np.ndarray:
    """Ids of a text; each vocabulary is loaded once a worker, when a text first needs it."""
    if "<|" not in text and _PLAIN.fullmatch(text) and not _LONG.search(text):
        return _ranks(ranks_path, pattern).encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
    return np.array(_tokenizer(json_path).encode(text, add_special_tokens=False).ids, np.uint32)


def token_pieces(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, length: int = LENGTH,
                 with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) per piece of each row."""
    fields = ["doc_id long", "start long", "length long", "ids_crc32 long", "doc_tokens long"]

    def run(rows):
        for batch, texts in batches_of(rows, "text"):
            out, ids_out = [[] for _ in fields], []
            for doc_id, text in zip(batch.column(0), texts, strict=True):
                ids = np.append(token_ids(text.as_py() or "", json_path, ranks_path, pattern), np.uint32(END_ID)).astype("<u4")
                for at in range(0, len(ids), length):
                    piece = ids[at:at + length]
                    for col, v in zip(out, (doc_id.as_py(), at, len(piece), zlib.crc32(piece.tobytes()), len(ids)), strict=True):
                        col.append(v)
                    if with_ids:
                        ids_out.append(piece.tolist())
            names = [f.split()[0] for f in fields] + ["ids"] * with_ids
            cols = [pa.array(c, pa.int64()) for c in out] + ([pa.array(ids_out, pa.list_(pa.int32()))] if with_ids else [])
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, ", ".join(fields + ["ids array<int>"] * with_ids))


def price(duals: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of largest dual value and that value."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    for w in range(1, capacity + 1):
        n = fits[w]
        best[w] = best[w - 1]
        if n:
            value = best[w - sizes[:n]] + duals[:n]
            k = value.argmax()
            if value[k] > best[w] + 1e-12:
                best[w], pick[w] = value[k], k
    pattern, w = np.zeros(len(sizes), np.int64), capacity
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            pattern[pick[w]] += 1
            w -= sizes[pick[w]]
    return float(best[capacity]), pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP,
                      most: int = 20_000) -> list[tuple[int, np.ndarray]]:
    """[(times, pattern)] that cover ``demand`` pieces of each size exactly."""
    m = len(sizes)
    if not m:
        return []
    basis = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ demand
    for _ in range(most):
        duals = inverse.sum(axis=0)
        value, pattern = price(duals, sizes, capacity)
        if value <= 1 + 1e-9 or x.sum() * value <= (duals @ demand) * (1 + gap):  # optimal, or near the bound x / value
            break
        direction = inverse @ pattern
        ok = direction > 1e-9
        ratio = np.where(ok, np.maximum(x, 0) / np.where(ok, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        theta = ratio[out]
        x -= theta * direction
        x[out] = theta
        inverse[out] /= direction[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(direction[others], inverse[out])
        basis[:, out] = pattern
    left = demand.astype(np.int64).copy()
    plan = []
    for k in np.argsort(-x, kind="stable"):
        pattern, used = basis[:, k], basis[:, k] > 0
        times = min(int(np.floor(max(x[k], 0) + 1e-9)), int((left[used] // pattern[used]).min()))
        if times:
            plan.append((times, pattern.copy()))
            left -= times * pattern
    while left.any():  # rest: largest first, few sequences of each basis column
        pattern, room = np.zeros(m, np.int64), capacity
        for c in range(m - 1, -1, -1):
            pattern[c] = min(left[c], room // sizes[c])
            room -= pattern[c] * sizes[c]
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        plan.append((times, pattern))
        left -= times * pattern
    return plan


def pack(pieces: DataFrame, length: int = LENGTH, width: int = WIDTH) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, start, length, ...)."""
    spark = pieces.sparkSession
    capacity = length // width
    rows = stored(pieces.withColumn("c", F.expr(f"int((length + {width - 1}) div {width})")), "pack-pieces")
    found = {r["c"]: r["count"] for r in rows.groupBy("c").count().collect()}  # one row per class
    sizes = np.array(sorted(found), np.int64)
    demand = np.array([found[c] for c in sizes.tolist()], np.int64)
    plan = column_generation(sizes, demand, capacity)

    slots, base, used = [], 0, np.zeros(len(sizes), np.int64)
    for times, pattern in plan:
        for k in np.flatnonzero(pattern):
            a = int(pattern[k])
            slots.append((int(sizes[k]), int(used[k]), int(used[k] + times * a), a, base))
            used[k] += times * a
        base += times
    slots = spark.createDataFrame(slots or [], "c int, lo long, hi long, each long, base long")

    buckets = max(1, -(-int(demand.sum()) // BUCKET_ROWS))
    keyed = rows.withColumn("h", F.xxhash64("doc_id", "start", "ids_crc32")).withColumn("b", F.pmod("h", F.lit(buckets)))
    ranked = (keyed.withColumn("r", F.row_number().over(Window.partitionBy("c", "b").orderBy("h", "doc_id")) - 1)
              .join(_offsets(keyed, ["c"], "b"), ["c", "b"]).withColumn("k", F.col("offset") + F.col("r")).drop("offset", "of"))
    # slots are bounded by the number of classes, whatever the number of rows
    placed = ranked.alias("p").join(F.broadcast(slots.alias("s")), (F.col("p.c") == F.col("s.c"))
                                    & (F.col("k") >= F.col("lo")) & (F.col("k") < F.col("hi")))
    placed = placed.select("p.*", F.expr("base + (k - lo) div each").alias("sequence_id"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("c"), "k").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(
        *pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, length: int = LENGTH,
                   with_ids: bool = False) -> DataFrame:
    return pack(token_pieces(docs, json_path, ranks_path, pattern, length, with_ids), length)

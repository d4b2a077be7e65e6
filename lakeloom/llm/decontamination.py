"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

Texts are folded (ASCII lower case; runs of other ASCII characters become one
space). A passage within k edits of an item of m bytes shares at least
``m - q + 1 - k * q`` of the item's q-grams with it, all on diagonals (position
in the document minus position in the item) at most k apart to either side.
Shared q-grams are counted in overlapping bands of diagonals; bands that meet
the bound are verified by an alignment confined to the band. The budget is
k = ``RATE`` * m, lowered where an item is too short for a positive bound.

The benchmark goes to the tasks in blocks of at most ``BLOCK_BYTES`` of text, each
block against all documents; so it may be of any size.

Odd input: null or empty texts and items match nothing; items of fewer than
``Q`` folded bytes are left out (too short to tell); equal items are reported each;
repeated documents are reported each; very long documents are read whole; of regions with
equally few edits the one that shares most q-grams is reported, then the first band's;
other columns are ignored; with an empty benchmark no document is contaminated, with no
documents there are no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import batches_of, release, text_pieces

Q = 12
RATE = 0.07
BLOCK_BYTES = 4 << 20
_BITS = 20
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def fold(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, row offsets in them, place of each folded byte in ``raw``)."""
    out = _FOLD[raw]
    space = out == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    edge = offsets[:-1][offsets[:-1] < len(raw)]
    keep[edge] = ~space[edge]  # no leading space; a trailing one does no harm
    return out[keep], np.concatenate(([0], np.cumsum(keep)))[offsets], np.flatnonzero(keep)


def grams(folded: np.ndarray) -> np.ndarray:
    """64-bit hashes of all 12-byte windows, from two overlapping 8-byte words."""
    n = len(folded) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    size = len(folded) - 7
    word = np.empty(size, np.uint64)
    for s in range(8):
        part = folded[s:s + (len(folded) - s) // 8 * 8].view(np.uint64)
        word[s::8] = part[:len(word[s::8])]
    h = (word[:n] * _C1) ^ (word[Q - 8:Q - 8 + n] * _C2)
    h ^= h >> np.uint64(29)
    return h * _C1


def budget(m: int, rate: float = RATE) -> int:
    return max(0, min(int(rate * m), (m + 1) // Q - 2))


def bound(m: int, k: int) -> int:
    return max(1, m - Q + 1 - k * Q)


class Index:
    """q-grams of a block of items."""

    def __init__(self, items: list[tuple[object, str]]):
        self.items, keys, owner, place = [], [], [], []
        for key, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            folded = fold(raw, np.array([0, len(raw)]))[0]
            folded = folded[:len(folded) - (len(folded) > 0 and folded[-1] == 32)]
            if len(folded) < Q:
                continue
            h = grams(folded)
            keys.append(h)
            owner.append(np.full(len(h), len(self.items)))
            place.append(np.arange(len(h)))
            self.items.append((key, folded))
        none = [np.zeros(0, np.int64)]
        keys = np.concatenate(keys or [np.zeros(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.owner, self.place = np.concatenate(owner or none)[order], np.concatenate(place or none)[order]
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(keys)))
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, folded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, number of the key) of windows that are q-grams of items."""
        h = grams(folded)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        where = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[where] == h[at]
        return at[same], where[same]


def banded_edits(item: np.ndarray, doc: np.ndarray, low: int, high: int, most: int) -> tuple[int, int]:
    """(fewest edits, end in ``doc``) of ``item`` against any stretch of ``doc`` on diagonals low..high.

    Returns most + 1 where it takes more than ``most``. The item starts at any
    diagonal of the band without cost.
    """
    width, big = high - low + 1, most + 1
    diag = np.arange(low, high + 1)
    row = np.where((diag >= 0) & (diag <= len(doc)), 0, big)
    steps = np.arange(width)
    for i in range(len(item)):
        j = i + diag  # before taking item[i], cell j of the document
        inside = (j >= 0) & (j < len(doc))
        same = np.zeros(width, bool)
        same[inside] = doc[j[inside]] == item[i]
        nxt = np.where(inside, row + ~same, big)
        nxt[:-1] = np.minimum(nxt[:-1], row[1:] + 1)  # item's byte left out: one diagonal down
        ok = (j + 1 >= 0) & (j + 1 <= len(doc))
        nxt = np.where(ok, nxt, big)
        nxt = np.minimum.accumulate(nxt - steps) + steps  # extra bytes in the document
        row = np.minimum(np.where(ok, nxt, big), big)
        if row.min() > most:
            return big, -1
    best = int(row.argmin())
    return int(row[best]), int(len(item) + diag[best])


def contaminations(doc: np.ndarray, index: Index, at: np.ndarray, key: np.ndarray, rate: float = RATE):
    """(item number, edits, shared q-grams, start, end) of the best region per item."""
    n = index.count[key]
    which = np.repeat(index.first[key] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    owner, place = index.owner[which], index.place[which]
    diagonal = np.repeat(at, n) - place
    for item in np.flatnonzero(np.bincount(owner) >= 1):
        folded = index.items[item][1]
        k = budget(len(folded), rate)
        need, width = bound(len(folded), k), k + 1
        mine = owner == item
        if mine.sum() < need:
            continue
        d, p = diagonal[mine], place[mine]
        left = d // width
        band = np.concatenate((left, left - 1))  # band b covers diagonals b * width .. (b + 2) * width - 1
        pair = np.unique(np.stack((band, np.concatenate((p, p)))), axis=1)  # a q-gram of the item counts once a band
        bands, shared = np.unique(pair[0], return_counts=True)
        best = None
        for b, s in sorted(zip(bands[shared >= need].tolist(), shared[shared >= need].tolist(), strict=True), key=lambda x: (-x[1], x[0])):
            low, high = b * width, (b + 2) * width - 1
            exact = d[(d >= low) & (d <= high)]
            vals, cnt = np.unique(exact, return_counts=True)
            at0 = int(vals[cnt.argmax()])
            if at0 >= 0 and at0 + len(folded) <= len(doc) and (doc[at0:at0 + len(folded)] == folded).all():
                edits, end = 0, at0 + len(folded)
            else:
                edits, end = banded_edits(folded, doc, low - k, high + k, k)
            if edits <= k and (best is None or edits < best[0]):
                best = (edits, s, max(0, end - len(folded)), end)
            if best and best[0] == 0:
                break
        if best:
            yield (int(item), *best)


def _regions(texts: pa.Array, index: Index, rate: float):
    """(row, item number, edits, shared, start, end) of each contaminated row; code points."""
    for lo, _, raw, offsets in text_pieces(texts):
        folded, cut, place = fold(raw, offsets)
        at, key = index.hits(folded)
        row = np.searchsorted(cut, at, side="right") - 1
        whole = at + Q <= cut[row + 1]
        at, key, row = at[whole], key[whole], row[whole]
        for i in np.unique(row).tolist():
            mine = slice(*np.searchsorted(row, (i, i + 1)))
            own = place[cut[i]:cut[i + 1]] - offsets[i]
            for item, edits, shared, start, end in contaminations(folded[cut[i]:cut[i + 1]], index, at[mine] - cut[i], key[mine], rate):
                chars = np.concatenate(([0], np.cumsum((raw[offsets[i]:offsets[i + 1]] & 0xC0) != 0x80)))
                yield lo + i, item, edits, shared, int(chars[own[start]]), int(chars[own[end - 1] + 1])


def _matches(docs: DataFrame, index: Index, rate: float) -> DataFrame:
    def run(rows):
        for batch, texts in batches_of(rows, "text"):
            found = list(_regions(texts, index, rate))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                 pa.array([index.items[f[1]][0] for f in found], pa.int64()),
                 *(pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4, 5))],
                names=["doc_id", "item_id", "edits", "shared", "start", "end"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, item_id long, edits long, shared long, start long, end long")


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Index of each block of the benchmark: what the driver holds at a time is bounded."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("length(text) > 0")
    sized = items.withColumn("block", F.floor((F.sum(F.octet_length("text")).over(
        Window.orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, 0)) - F.octet_length("text")) / block_bytes))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    for block in range(0, total // block_bytes + 1):
        rows = items if total <= block_bytes else sized.filter(F.col("block") == block).drop("block")
        yield Index([tuple(r) for r in rows.orderBy("item_id", "text").collect()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, edits, shared, start, end): best region of each item in each document; code points."""
    found = None
    for index in _blocks(benchmark, block_bytes):
        part = _matches(docs, index, rate)
        found = part if found is None else found.union(part)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns."""
    at = docs.columns.index("text")
    for index in _blocks(benchmark, block_bytes):
        def run(rows, index=index):
            for batch in rows:
                keep = np.ones(len(batch), bool)
                keep[[f[0] for f in _regions(batch.column(at).cast(pa.string()), index, rate)]] = False
                yield batch.filter(pa.array(keep))
            release()
        docs = docs.mapInArrow(run, docs.schema)
    return docs

"""Hashed terms of texts and bounded, labelled training samples for the text classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import lower_ascii, mix64, release, segment_hashes, text_pieces

_REPEAT = np.uint64(0x0123456789ABCDEF)


def _kinds(raw: np.ndarray) -> np.ndarray:
    """0 space, 1 letters and digits (all bytes from 0x80 on too), 2 other characters."""
    kind = np.full(256, 2, np.uint8)
    kind[[*range(9, 14), 32]] = 0
    kind[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
    return kind[raw]


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, kind) of runs of one kind; spaces are left out, rows end runs."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    kind = _kinds(raw)
    new = np.ones(len(raw), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[offsets[:-1][offsets[:-1] < len(raw)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(raw))
    keep = kind[starts] > 0
    return starts[keep], ends[keep], kind[starts[keep]]


def ngram_terms(texts: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, hashed term, count): words, runs of symbols and their bigrams; a word after itself is one term."""
    for lo, hi, raw, offsets in text_pieces(texts):
        starts, ends, _ = _tokens(raw, offsets)
        h = segment_hashes(lower_ascii(raw), starts, ends)
        bounds = np.searchsorted(starts, offsets)
        pair = np.where(h[1:] == h[:-1], _REPEAT, mix64(h[:-1] ^ mix64(h[1:])))
        for i in range(hi - lo):
            a, b = bounds[i], bounds[i + 1]
            ids = np.concatenate((h[a:b], pair[a:max(a, b - 1)]))
            term, count = np.unique((ids >> np.uint64(64 - bits)).astype(np.int32), return_counts=True)
            yield lo + i, term, count


def word_terms(texts: pa.Array, bits: int, prefixes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, hashed term, count): words and the first bytes of longer words."""
    for lo, hi, raw, offsets in text_pieces(texts):
        raw = lower_ascii(raw)
        starts, ends, kind = _tokens(raw, offsets)
        starts, ends = starts[kind == 1], ends[kind == 1]
        parts = [(segment_hashes(raw, starts, ends), starts)]
        for n in prefixes:
            longer = ends - starts > n
            parts.append((mix64(segment_hashes(raw, starts[longer], starts[longer] + n) ^ np.uint64(n)), starts[longer]))
        cuts = [(h, np.searchsorted(s, offsets)) for h, s in parts]
        for i in range(hi - lo):
            ids = np.concatenate([h[b[i]:b[i + 1]] for h, b in cuts])
            term, count = np.unique((ids >> np.uint64(64 - bits)).astype(np.int32), return_counts=True)
            yield lo + i, term, count


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out part; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def training_sample(labels: DataFrame, label: str, parts: int, part: int, rows: int) -> DataFrame:
    """(doc_id, label) of at most ``rows`` labelled ids outside the held-out part, in order of a hash of the id.

    Repeated label rows are one; where they differ the larger label counts."""
    return (labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
            .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), parts, part))
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def sample_terms(docs: DataFrame, sample: DataFrame, terms) -> DataFrame:
    """(doc_id, label, terms, counts) of the sampled documents; the sample's size is bounded, so it is broadcast.

    One row a doc_id, of the texts under it that of the smallest hash, found by partial
    minima: an id that very many rows share is no more than one row of the sample."""
    def run(rows):
        for batch in rows:
            found = list(terms(batch.column(2)))
            ends = pa.array(np.cumsum([0, *(len(t) for _, t, _ in found)]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate([t for _, t, _ in found]), pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate([c for *_, c in found]).astype(np.int32)))],
                names=["doc_id", "label", "terms", "counts"])
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return (one.select("doc_id", "label", "text")
            .mapInArrow(run, "doc_id long, label int, terms array<int>, counts array<int>"))


def train_in_one_task(samples: DataFrame, fit) -> bytes:
    """What ``fit(labels, list of terms, list of counts)`` returns, run in one task on the bounded sample."""
    def run(rows):
        ids, labels, terms, counts = [], [], [], []
        for batch in rows:
            ids += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
            for k, out in ((2, terms), (3, counts)):
                out += [x.values.to_numpy() for x in batch.column(k)]
        order = sorted(range(len(ids)), key=lambda i: (int(mix64(np.array([ids[i] & (2**64 - 1)], np.uint64))[0]), ids[i], labels[i], len(terms[i])))
        del ids
        blob = fit(np.array([labels[i] for i in order], np.float64), [terms[i] for i in order], [counts[i] for i in order])
        del labels, terms, counts
        release()
        yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["model"])
    found = samples.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(found[0]["model"])


def scored(docs: DataFrame, score, parts: int, part: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; ``score(texts)`` gives an array."""
    def run(rows):
        for batch in rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(batch.column(1)), pa.float64())],
                                             names=["doc_id", "score"])
    return (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))

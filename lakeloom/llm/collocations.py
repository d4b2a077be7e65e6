"""Phrase collocation mining: count streams in prefix and suffix order, merge-joined in lockstep.

Counting. A phrase is as frequent as its parts at most, so order 1 is counted over all
texts, then order 2 where both words are frequent, then orders 3 and up where every
bigram is. Tasks know frequent words and bigrams by a bitmap of ``BITMAP_BITS`` (a bound,
whatever the corpus): its false positives cost work and are dropped by their exact count,
made from the phrases themselves.

Estimation. Each order is a stream (lang, phrase, f). Sorted by prefix (the phrase without
its last word) it is merge-joined with the order below, which hands up the counts of all
its leading parts; sorted by suffix, likewise those of all trailing parts. So the counts
left and right of every cut arrive in one row, without a lookup table. The same streams
grouped by prefix and by suffix give the most frequent extension on either side. That
covers longer ones too: if a phrase two words longer has 80 % of the count, so has the
one between.

Scores are whole numbers from decimal arithmetic.

Odd input: a null text has no words; a null lang is ``und``; equal rows count as rows;
texts of any length are read in chunks cut at piece ends (a piece is one chunk, however
long); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import batches_of, mix64, segment_hashes, stored

MAX_WORDS = 4
MIN_COUNT = 30
COVER = 80          # percent of a phrase's count that an extension needs to replace it
TOP = 2_000
SCALE = 2_000_000
CHUNK = 1 << 22
BITMAP_BITS = 1 << 26
ENDS = b".,;:!?\n\x0b\x0c\r"

_KIND = np.zeros(256, np.uint8)  # 0 word, 1 blank, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[list(ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of a chunk: ``said`` holds them lower-cased with a blank after each."""

    def __init__(self, chunk: bytes):
        raw = np.frombuffer(chunk + b"\n", np.uint8)
        kind = _KIND[raw]
        word = kind == 0
        keep = word.copy()
        keep[1:] |= word[:-1]  # each word and the first character after it
        self.said = _LOWER[raw[keep]]
        after = ~word[keep]
        self.said[after] = 0x20
        self.bounds = np.concatenate(([0], np.flatnonzero(after) + 1))
        first = word.copy()
        first[1:] &= ~word[:-1]
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[first]
        n = len(self.bounds) - 1
        told = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(self.bounds.astype(np.int64)), pa.py_buffer(self.said)])
        told = told.dictionary_encode()
        self.ids = told.indices.to_numpy().astype(np.int64)
        values = told.dictionary
        ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
        said = np.frombuffer(values.buffers()[2], np.uint8) if len(values) else np.zeros(0, np.uint8)
        self.size = max(1, len(values))
        self.hashes = segment_hashes(said, ends[:-1], ends[1:] - 1)

    def same_piece(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each place on are of one piece (one value per place with n words)."""
        most = max(0, len(self.ids) - n + 1)
        return self.piece[:most] == self.piece[n - 1:n - 1 + most]

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        starts, ends = self.bounds[at], self.bounds[at + n] - 1
        size = ends - starts
        cuts = np.concatenate(([0], np.cumsum(size)))
        inside = np.repeat(starts - cuts[:-1], size) + np.arange(cuts[-1])
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(self.said[inside])).cast(pa.string())


def _hash_of(lang: bytes, hashes: np.ndarray) -> np.ndarray:
    tag = segment_hashes(np.frombuffer(lang + b"\n", np.uint8), np.array([0]), np.array([len(lang) + 1]))
    return mix64(hashes ^ tag)


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(left ^ mix64(right))


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)


def _counted(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place, count) of each distinct key."""
    _, first, count = np.unique(keys, return_index=True, return_counts=True)
    return places[first], count


def count_words(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(order, places, counts)."""
    yield 1, *_counted(np.arange(len(words.ids)), words.ids)


def count_pairs(words: Words, lang: bytes, frequent: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Bigrams of frequent words."""
    known = _has(frequent, _hash_of(lang, words.hashes))[words.ids]
    at = np.flatnonzero(words.same_piece(2) & known[:-1] & known[1:])
    yield 2, *_counted(at, words.ids[at] * words.size + words.ids[at + 1])


def count_longer(words: Words, lang: bytes, frequent: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Phrases of 3 to ``most`` words all of whose bigrams are frequent."""
    at = np.flatnonzero(words.same_piece(2))
    h = _hash_of(lang, words.hashes)[words.ids]
    at = at[_has(frequent, _pair_hash(h[at], h[at + 1]))]
    held = np.zeros(len(words.ids) + most, bool)
    held[at] = True
    rank = np.zeros(len(words.ids) + most, np.int64)  # number of the phrase that starts here, one word shorter
    if len(at):
        rank[at] = np.unique(words.ids[at] * words.size + words.ids[at + 1], return_inverse=True)[1]
    for n in range(3, most + 1):
        at = at[held[at + n - 2]]  # its last bigram; the shorter phrase holds the others
        if not len(at):
            return
        keys = rank[at] * words.size + words.ids[at + n - 1]
        _, first, number, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        yield n, at[first], count
        rank[at] = number


def _chunks(batch: pa.RecordBatch, texts: pa.Array, limit: int) -> Iterator[tuple[str, bytes]]:
    """(lang, bytes): texts of one lang joined by an end of a piece, long ones cut at one."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
        raw = text.as_buffer().to_pybytes()
        lo = 0
        while len(raw) - lo > limit:
            cut = max(raw.rfind(c, lo, lo + limit) for c in (ENDS[i:i + 1] for i in range(len(ENDS))))
            if cut <= lo:  # a piece longer than the limit stays whole
                later = [x for x in (raw.find(ENDS[i:i + 1], lo + limit) for i in range(len(ENDS))) if x >= 0]
                if not later:
                    break
                cut = min(later)
            yield lang, raw[lo:cut]
            lo = cut + 1
        held.setdefault(lang, []).append(raw[lo:] if lo else raw)
        size[lang] = size.get(lang, 0) + len(raw) - lo + 1
        if size[lang] > limit:
            yield lang, b"\n".join(held.pop(lang))
            size[lang] = 0
    for lang, parts in held.items():
        yield lang, b"\n".join(parts)


def phrase_counts(docs: DataFrame, count, limit: int = CHUNK) -> DataFrame:
    """(lang, words, phrase, f) summed over ``docs`` (lang, text); ``count(words, lang)`` gives (order, places, counts).

    Phrase null, words 0: all word occurrences of the lang (where words are counted)."""
    def run(rows):
        for batch, texts in batches_of(rows, "text"):
            for lang, chunk in _chunks(batch, texts, limit):
                words = Words(chunk)
                if not len(words.ids):
                    continue
                for n, at, counts in count(words, lang.encode()):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), n, np.int32)),
                                                      words.phrases(at, n), pa.array(counts.astype(np.int64))],
                                                     names=["lang", "words", "phrase", "f"])
                    if n == 1:
                        yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([0], pa.int32()), pa.array([None], pa.string()),
                                                          pa.array([len(words.ids)], pa.int64())], names=["lang", "words", "phrase", "f"])
    return docs.mapInArrow(run, "lang string, words int, phrase string, f long").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def phrase_bitmap(stream: DataFrame, n: int, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap (``bits`` at most, whatever the stream) of the hashes of phrases of ``n`` words, 1 or 2."""
    def run(rows):
        for batch, texts in batches_of(rows, "phrase"):
            for lang, chunk in _chunks(batch, texts, CHUNK):
                words = Words(chunk)
                h = _hash_of(lang.encode(), words.hashes)[words.ids]
                if n == 2:
                    at = np.flatnonzero(words.same_piece(2))
                    h = _pair_hash(h[at], h[at + 1])
                yield pa.RecordBatch.from_arrays([pa.array((h & np.uint64(bits - 1)).astype(np.int64) + 1)], names=["p"])
    rows = (stream.select("lang", "phrase").mapInArrow(run, "p long").groupBy(F.bitmap_bucket_number("p").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).toPandas())  # bits / 32768 rows
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for b, m in zip(rows["b"], rows["m"], strict=True):
        out[b - 1] = np.frombuffer(bytes(m), np.uint8)
    return out.ravel()


def _part(n: str, side: str) -> Column:
    return F.expr(f"substring_index(phrase, ' ', {n})").alias(side)


def estimation_streams(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """((lang, n), (lang, words, phrase, f, lefts, rights, extended)) of all phrases with ``min_count``.

    lefts[k-1] and rights[k-1] are the counts of the first k words and of the rest;
    extended is the largest count of a phrase one word longer on either side.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    enough = (F.col("f") >= min_count) | F.col("phrase").isNull()
    ones = stored(phrase_counts(texts, lambda w, lang: count_words(w)).filter(enough), "phrase-words")
    totals = ones.filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
    streams = [ones.filter("phrase IS NOT NULL")]
    if max_words > 1:
        known = phrase_bitmap(streams[0], 1)
        streams.append(stored(phrase_counts(texts, lambda w, lang: count_pairs(w, lang, known)).filter(enough), "phrase-pairs"))
    if max_words > 2:
        pairs = phrase_bitmap(streams[1], 2)
        longer = stored(phrase_counts(texts, lambda w, lang: count_longer(w, lang, pairs, max_words)).filter(enough), "phrase-longer")
        streams += [longer.filter(F.col("words") == n) for n in range(3, max_words + 1)]

    empty = F.array().cast("array<bigint>")
    below = streams[0].select("lang", "phrase", "f", empty.alias("lefts"), empty.alias("rights"))
    out = []
    for n in range(2, max_words + 1):
        stream = streams[n - 1].select("lang", "phrase", "f", _part(str(n - 1), "prefix"), _part(str(1 - n), "suffix"))
        by_prefix = below.select("lang", F.col("phrase").alias("prefix"), F.array_append("lefts", F.col("f")).alias("lefts"))
        by_suffix = below.select("lang", F.col("phrase").alias("suffix"), F.concat(F.array("f"), F.col("rights")).alias("rights"))
        rows = (stream.join(by_prefix.hint("merge"), ["lang", "prefix"]).join(by_suffix.hint("merge"), ["lang", "suffix"])
                .select("lang", "phrase", "f", "lefts", "rights", "prefix", "suffix"))
        rows = stored(rows, f"phrase-stream-{n}")
        out.append(rows.withColumn("words", F.lit(n)))
        below = rows.select("lang", "phrase", "f", "lefts", "rights")
    merged = []
    for rows, longer in zip(out, [*out[1:], None], strict=True):
        if longer is None:
            merged.append(rows.withColumn("extended", F.lit(0).cast("long")))
            continue
        for side in ("prefix", "suffix"):
            most = longer.groupBy("lang", F.col(side).alias("phrase")).agg(F.max("f").alias(f"by_{side}"))
            rows = rows.join(most.hint("merge"), ["lang", "phrase"], "left")
        merged.append(rows.withColumn("extended", F.greatest(F.coalesce("by_prefix", F.lit(0)), F.coalesce("by_suffix", F.lit(0)))))
    rows = merged[0].select("lang", "words", "phrase", "f", "lefts", "rights", "extended")
    for other in merged[1:]:
        rows = rows.unionByName(other.select(*rows.columns))
    return totals, rows


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, cover: int = COVER,
                 top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's first ``top`` phrases."""
    totals, rows = estimation_streams(docs, max_words, min_count)
    wide = "decimal(20,0)"
    cuts = F.expr(f"""array_min(transform(lefts, (l, i) -> struct(
        (cast(f as {wide}) * {SCALE}) div (cast(l as {wide}) + cast(rights[i] as {wide})) as score, i as cut, l as l, rights[i] as r)))""")
    kept = (rows.filter(F.expr(f"cast(extended as {wide}) * 100 < cast(f as {wide}) * {cover}"))
            .select("lang", "phrase", F.col("f").alias("a"), cuts.alias("c"))
            .select("lang", "phrase", "a", "c.l", "c.r", "c.score"))
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)  # cut to `top` before the shuffle too
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_SQL_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
SQL_COLLOCATIONS = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_SQL_LETTERS}),
                  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
cut AS (SELECT c.lang, c.phrase, c.a, c.k, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp
        FROM c, (SELECT unnest([1, 2, 3]) AS j) WHERE j < c.k),
s AS (SELECT cut.lang, cut.phrase, cut.a, lf.f AS l, rf.f AS r, j, ((2000000::HUGEINT * cut.a) // (lf.f + rf.f))::BIGINT AS score
      FROM cut JOIN f lf ON lf.lang = cut.lang AND lf.phrase = lp JOIN f rf ON rf.lang = cut.lang AND rf.phrase = rp),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
part AS (SELECT c.lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS most
         FROM c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i) WHERE m < c.k AND i + m - 1 <= c.k GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN part ON part.lang = best.lang AND part.phrase = best.phrase
         WHERE part.most IS NULL OR 100::HUGEINT * part.most < 80::HUGEINT * best.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n ON n.lang = kept.lang QUALIFY rank <= 2000
"""

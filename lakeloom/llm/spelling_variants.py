"""Spelling variant grouping: asymmetric q-chunks.

Two words are near if one code point inserted, deleted or replaced makes one the other.
The longer word (or either of two as long) gives its two disjoint chunks, its halves; the
other word gives its positional grams of that length where a half can lie: one edit
preserves one of the halves, and moves it by one place at most. Words are joined on
(length, half, chunk), and the edit distance is verified.

Halves of short words are shared by very many words ("the...", "...tion"). So the rest of
the word, in which the one edit lies, is chunked in the same way: one of *its* halves is
preserved too. The join key is the preserved half with the preserved half of the rest,
three quarters of the word; no group is cut or capped. Keys travel as 64-bit hashes,
the verification compares the words.

A word's form is its near word of largest n (ties: smallest word) if that n is at least
``ratio`` times the word's n. Along forms n grows tenfold a step, so there is no cycle
and roots are found by pointer jumping in a few rounds whatever the number of words.

Odd input: a null text has no words; a null doc_id is written as nothing before the ":";
equal rows count as rows; words of any length are kept whole; words without a near word
have n_near 0; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import batches_of, stored

LEAST = 7
MIN_COUNT = 2
RATIO = 10
EDIT_OF = 31
FLUSH = 200_000


def edited(run: str, seed: int) -> str:
    """``run`` (A-Z lower-cased) as it counts: without one code point where the crc of its document and itself says so."""
    h = zlib.crc32(run.encode(), seed)
    if h % EDIT_OF:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least: int = LEAST, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of words of ``least`` code points that occur ``min_count`` times."""
    runs = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % least)  # shorter runs give shorter words

    def out(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    def run(rows):
        total: Counter = Counter()
        for batch, texts in batches_of(rows, "text"):
            for doc_id, text in zip(batch.column(0), texts, strict=True):
                seed = zlib.crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
                found = Counter(runs.findall(text.as_buffer().to_pybytes().lower().decode()))
                for word, n in found.items():
                    total[edited(word, seed)] += n
                if len(total) >= FLUSH:
                    yield out(total)
                    total = Counter()
        yield out(total)

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter((F.char_length("word") >= least) & (F.col("n") >= min_count)))


def _keys(word: str, size: str, length: str) -> Column:
    """Join keys of ``word`` (``size`` code points) as a partner of words of ``length`` (``size`` or one more).

    With q = length div 2, a word of ``length`` has the halves [0, q) and [q, length).
    A preserved first half starts at 0; a preserved second half ends where the word
    ends. What the rest then is, it is for both words, and its halves likewise.
    """
    def part(text, start, n):
        return F.expr(f"substring({text}, {start} + 1, {n})")

    def key(kind, half, quarter):
        return F.xxhash64(F.lit(kind), F.expr(length), half, quarter)

    q, r = f"({length} div 2)", f"({length} - {length} div 2)"
    cuts = []
    # first half preserved: the rest is r long in the longer word
    rest_at, rest_n = q, f"({size} - {q})"
    first, s = part(word, "0", q), f"({r} div 2)"
    cuts += [key(0, first, part(word, rest_at, s)), key(1, first, part(word, f"({size} - ({r} - {s}))", f"({r} - {s})"))]
    # second half preserved: the rest is q long in the longer word
    rest_n = f"({size} - {r})"
    last, s = part(word, rest_n, r), f"({q} div 2)"
    cuts += [key(2, last, part(word, "0", s)), key(3, last, part(word, f"({rest_n} - ({q} - {s}))", f"({q} - {s})"))]
    return F.array(*cuts)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of ``words`` (word, n) that differ by one edit, once."""
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    chunks = sized.select(F.explode(_keys("word", "size", "size")).alias("key"), "word", "n", "size")
    same = sized.withColumn("partner", F.col("size"))
    more = sized.withColumn("partner", F.col("size") + 1)
    grams = same.unionByName(more).select(
        F.explode(_keys("word", "size", "partner")).alias("key"), F.col("word").alias("near"),
        F.col("n").alias("near_n"), F.col("size").alias("near_size"))
    pairs = (chunks.join(grams.hint("merge"), "key")
             .filter((F.col("near_size") < F.col("size")) | (F.col("near_size") == F.col("size")) & (F.col("word") < F.col("near")))
             .filter(F.levenshtein("word", "near", 1) == 1)
             .select("word", "n", "near", "near_n").distinct())
    pairs = stored(pairs, "variant-pairs")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain word -> form; ``forms`` has one row per word that has a form.

    A round doubles the steps that a word has gone; it ends when no target has a form.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("above"))
        nxt = stored(now.join(up, "root", "left").select("word", "root", "above"), "variant-roots")
        if nxt.filter("above IS NOT NULL").isEmpty():
            return nxt.select("word", "root")
        now = nxt.select("word", F.coalesce("above", "root").alias("root"))


def spelling_variants(docs: DataFrame, least: int = LEAST, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per distinct word."""
    words = stored(word_counts(docs, least, min_count), "variant-words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.first("n").alias("own"),
        F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near"))).alias("best"))
    best = stored(best.select("word", "n_near", F.when(-F.col("best.order") >= ratio * F.col("own"), F.col("best.near")).alias("form"),
                              F.when(-F.col("best.order") >= ratio * F.col("own"), -F.col("best.order")).alias("form_n")), "variant-forms")
    ends = roots(best.filter("form IS NOT NULL"))
    return words.join(best, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")

"""N-gram Jaccard join with adaptive multi-match prefixes.

Method. Every document's set of word 5-grams is ordered by one global order
(rare first). Two sets of similarity t share at least T = ceil(t * size) tokens
with either, so they share at least l tokens inside their first
``size - T + l`` tokens (for the smaller l of the two). Each document picks its
own l from the estimated number of candidates its prefix brings; a pair is
verified only if the two prefixes share min(l, l') tokens.

* ``classes``: equal sets collapse to one class (64-bit fingerprint).
* ``token_counts``: counts of *all* tokens of all documents. Three summaries of
  proven size go to the tasks: the most frequent tokens (``FREQUENT`` at most) and
  a bitmap of the next frequent ones, which shape the order and the estimates
  (any order gives the same, whole result), and a bitmap of ``BITMAP_BITS`` at most
  that holds every repeated token, so that tokens outside it, which surely stand
  alone, are not sent. In a large corpus that bitmap fills up and few tokens are
  outside it; the prefixes are therefore shuffled once and stored only as far as
  they are live.
* ``live_postings``: prefix tokens found in two or more classes.
* ``possible_postings``: those of classes that can share enough tokens with another.
* ``linked_components``: rounds link the members of every posting list to one
  member of it (linear in the list). Only classes still in different components
  are compared with each other afterwards, in short lists pair by pair, in long
  ones block by block (``block_links``). So a group of thousands of near copies
  never yields all its pairs as rows, and no link between components is lost.

Definitions for odd input: a null or blank text has size 0, no class and its own
doc_id as component; fewer than five words form one shingle; equal rows and rows
of one doc_id with different texts are separate rows, each put with its own
text's class; rows without doc_id take part, and their component is the smallest
doc_id there is in it (null if none). Other columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import (
    batches_of,
    connected,
    discard,
    lower_ascii,
    mix64,
    release,
    segment_hashes,
    stored,
    text_pieces,
    word_bounds,
)

WORDS = 5
PERCENT = 80
FREQUENT = 1 << 18
BITMAP_BITS = 1 << 26
SETS_BITS = 1 << 26
MAX_MATCH = 8
VERIFY_COST = 20.0
STAR_ROUNDS = 2
PRUNE_ROUNDS = 2
#: Posting lists up to this length are compared pair by pair, longer ones block by block.
SMALL = 16
BLOCK = 256
#: Up to so many rows to drop go to every task.
BROADCAST_ROWS = 200_000
_FLUSH = 1 << 20


def shingle_sets(texts: pa.Array, words: int = WORDS):
    """(row, sorted distinct uint64 shingles) of every row, in order."""
    for lo, hi, raw, offsets in text_pieces(texts):
        raw = lower_ascii(raw)
        starts, ends, _ = word_bounds(raw, offsets)
        h = segment_hashes(raw, starts, ends)
        bounds = np.searchsorted(starts, offsets)
        n = len(h) - words + 1
        gram = np.zeros(max(n, 0), np.uint64)
        for k in range(words if n > 0 else 0):
            gram = mix64(gram ^ h[k:k + n])
        for i in range(hi - lo):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a >= words:
                yield lo + i, np.unique(gram[a:b - words + 1])
            elif b > a:
                z = np.array([b - a], np.uint64)
                for x in h[a:b]:
                    z = mix64(z ^ x)
                yield lo + i, z
            else:
                yield lo + i, np.zeros(0, np.uint64)


def fingerprint(tokens: np.ndarray) -> int:
    """Signed 64-bit fingerprint of a set."""
    total = np.array([mix64(tokens).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(tokens ^ np.uint64(0x5555)))], np.uint64)
    return int(mix64(total[:1] ^ mix64(total[1:] + np.uint64(len(tokens))))[0].view(np.int64))


def classes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, cls) per row of ``docs``; cls is null for empty sets."""
    def run(rows):
        for batch, texts in batches_of(rows, "text"):
            size, cls = [], []
            for _, tokens in shingle_sets(texts, words):
                size.append(len(tokens))
                cls.append(fingerprint(tokens) if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(cls, pa.int64())],
                names=["doc_id", "text_hash", "n_shingles", "cls"])
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
                       F.col("text").cast("string")).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, cls long")


def _new_sets(rows, words):
    """(fingerprint, tokens) of sets not met before in this partition."""
    seen = set()
    for _, texts in batches_of(rows, "text"):
        for _, tokens in shingle_sets(texts, words):
            if len(tokens) and (cls := fingerprint(tokens)) not in seen:
                seen.add(cls)
                yield cls, tokens


def _summed(parts):
    key = np.concatenate([k for k, _ in parts])
    cnt = np.concatenate([c for _, c in parts])
    key, where = np.unique(key, return_inverse=True)
    return key, np.bincount(where, weights=cnt).astype(np.int64)


def _bits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """1 for each uint32 key that is in the bitmap, else 0."""
    at = keys & np.uint32(len(bitmap) * 8 - 1)
    return (bitmap[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8) & np.uint8(1)).astype(np.int64)


class TokenCounts:
    """What the tasks get: sorted frequent keys with their counts, the bitmap of repeated keys, and that
    of keys found ``often`` times or more, if there is one."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bitmap: np.ndarray,
                 often: int = 0, often_bitmap: np.ndarray | None = None):
        self.keys, self.counts, self.bitmap = keys, counts, bitmap
        self.often, self.often_bitmap = often, often_bitmap

    def estimate(self, tokens: np.ndarray) -> np.ndarray:
        """Count of each token; 1 for a token that surely stands alone, ``often`` or 2 for a repeated one not among the frequent."""
        top = (tokens >> np.uint64(32)).astype(np.uint32)
        out = 1 + _bits(self.bitmap, top)
        if self.often_bitmap is not None:
            out = np.where(_bits(self.often_bitmap, top) == 1, self.often, out)
        if len(self.keys):
            where = np.minimum(np.searchsorted(self.keys, top), len(self.keys) - 1)
            out = np.where(self.keys[where] == top, self.counts[where], out)
        return out


def _bitmap(ids, most: int) -> np.ndarray:
    """Bits of the lowest bits of column id: about 16 bits an id, ``most`` at most."""
    bits = 1 << min(most.bit_length() - 1, max(15, (16 * ids.count()).bit_length()))
    place = F.pmod("id", F.lit(bits)) + 1
    rows = (ids.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).toPandas())
    out = np.zeros((bits >> 15, 4096), np.uint8)
    for b, m in zip(rows["b"], rows["m"], strict=True):
        out[b - 1] = np.frombuffer(bytes(m), np.uint8)
    return out.ravel()


def token_counts(docs: DataFrame, words: int = WORDS, keep: int = FREQUENT) -> TokenCounts:
    """Counts of all shingles of all documents, by the upper 32 bits of their hash.

    Tokens travel as sorted arrays, one row per range of tokens and some million
    tokens. The frequent ones are all those of a count at which no more
    than ``keep`` tokens are as frequent; the next frequent ones those of a count
    at which a bitmap of ``BITMAP_BITS`` has 16 bits a token.
    """
    ranges = 1024

    def count(rows):
        def out(parts):
            key, cnt = np.unique(np.concatenate(parts), return_counts=True)
            cut = np.searchsorted(key, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(22))
            at = [i for i in range(ranges) if cut[i] < cut[i + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array(at, pa.int32()),
                # differences of sorted keys are small, so the shuffle's compression takes their upper bytes away
                pa.array([np.diff(key[cut[i]:cut[i + 1]].astype(np.uint32), prepend=np.uint32(0)).view(np.uint8)
                          .reshape(-1, 4).T.tobytes() for i in at], pa.binary()),
                pa.array([cnt[cut[i]:cut[i + 1]].astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
                          for i in at], pa.binary())], names=["part", "keys", "counts"])
        held, n = [], 0
        for _, tokens in _new_sets(rows, words):
            held.append(tokens >> np.uint64(32))
            n += len(tokens)
            if n >= _FLUSH:
                yield from out(held)
                held, n = [], 0
        if held:
            yield from out(held)

    def add(rows):
        parts, n = {}, {}
        unpack = lambda b: np.frombuffer(b.as_buffer(), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
        for batch in rows:
            for part, keys, counts in zip(*(batch.column(i) for i in range(3)), strict=True):
                part = part.as_py()
                parts.setdefault(part, []).append((np.cumsum(unpack(keys), dtype=np.uint32), unpack(counts).astype(np.int64)))
                n[part] = n.get(part, 0) + len(parts[part][-1][0])
                if n[part] > 1 << 20 and len(parts[part]) > 8:
                    parts[part] = [_summed(parts[part])]
                    n[part] = 0
        while parts:
            key, cnt = _summed(parts.popitem()[1])
            often = cnt > 1
            yield pa.RecordBatch.from_arrays([pa.array(key[often].astype(np.int64)), pa.array(cnt[often])],
                                             names=["key", "n"])
        release()

    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stored(docs.select(F.col("text").cast("string")).mapInArrow(count, "part int, keys binary, counts binary")
                   .repartition(spread, "part").mapInArrow(add, "key long, n long"), "ngram-counts")
    level = F.floor(8 * F.log2("n")).cast("int")
    levels = found.groupBy(level.alias("level")).agg(F.count("*").alias("count"), F.min("n").alias("n")).orderBy(F.desc("level")).collect()  # some 400
    least = often = None
    above = 0
    for row in levels:
        above += row["count"]
        if above <= keep:
            least = row["level"]
        if above <= BITMAP_BITS // 16:
            often = row
    rows = found.filter(level >= least).toPandas() if least is not None else found.limit(0).toPandas()
    key = rows["key"].to_numpy(np.uint64).astype(np.uint32)
    order = np.argsort(key)
    ids = found.select(F.col("key").alias("id"), level.alias("level"))
    more = {}
    if often is not None and often["level"] not in (least, levels[-1]["level"]):  # else the others tell as much
        more = {"often": often["n"], "often_bitmap": _bitmap(ids.filter(F.col("level") >= often["level"]).select("id"), BITMAP_BITS)}
    out = TokenCounts(key[order], rows["n"].to_numpy(np.int64)[order], _bitmap(ids.select("id"), BITMAP_BITS), **more)
    discard(found)
    return out


def choose_prefix(df: np.ndarray, need: int, max_match: int = MAX_MATCH, verify: float = VERIFY_COST) -> tuple[int, int]:
    """(l, prefix length) of least estimated cost for counts ``df`` in prefix order.

    Reading the lists costs the sum of (df - 1) over the prefix; each candidate
    needs l of these hits, so at most that sum / l candidates are verified.
    """
    n = len(df)
    hits = np.cumsum(df.astype(np.float64) - 1)
    best = (math.inf, 1, n - need + 1)
    for m in range(1, min(max_match, need) + 1):
        total = hits[n - need + m - 1]
        cost = total + verify * total / m
        if cost < best[0]:
            best = (cost, m, n - need + m)
    return best[1], best[2]


def live_postings(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                  counts: TokenCounts | None = None) -> DataFrame:
    """(token, cls, n, l, least) for prefix tokens that two or more classes have; least is the smallest l of them.

    Most prefix tokens of a large corpus stand alone: they pass through one shuffle and no table.
    """
    counts = counts or token_counts(docs, words)

    def run(rows):
        held, size = [], 0
        def out():
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([t for *_, t in held]).view(np.int64)),
                *(pa.array(np.repeat(np.array([x[i] for x in held], kind), [len(x[3]) for x in held]))
                  for i, kind in enumerate((np.int64, np.int32, np.int32)))], names=["token", "cls", "n", "l"])
        for cls, tokens in _new_sets(rows, words):
            df = counts.estimate(tokens)
            order = np.argsort(df, kind="stable")  # tokens ascend, so ties go by token
            need = -(-len(tokens) * percent // 100)
            match, length = choose_prefix(df[order], need)
            first = order[:length]
            held.append((cls, len(tokens), match, tokens[first[df[first] > 1]]))
            size += len(held[-1][3])
            if size >= 1 << 17:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    posts = docs.select(F.col("text").cast("string")).mapInArrow(run, "token long, cls long, n int, l int")
    return _shared(posts).distinct()  # dealt by token already


def _shared(posts: DataFrame) -> DataFrame:
    """(token, cls, n, l, least): postings of tokens that two or more classes have."""
    here = Window.partitionBy("token")
    return (posts.select("token", "cls", "n", "l", F.min("l").over(here).alias("least"),
                         F.min("cls").over(here).alias("lo"), F.max("cls").over(here).alias("hi"))
            .filter("lo <> hi").drop("lo", "hi"))


def possible_postings(posts: DataFrame, rounds: int = PRUNE_ROUNDS) -> DataFrame:
    """``posts`` (stored; removed) without classes that are in no pair whatever the others' tokens are.

    A pair shares v = min(l, l') tokens, each in a list whose smallest l is v or less. So a
    class without v such tokens for any v has no partner, and its postings only make others'
    lists longer. Each round takes out what the one before has laid bare.
    """
    for _ in range(rounds):
        enough = functools.reduce(Column.__or__, (F.count_if(F.col("least") <= v) >= v for v in range(1, MAX_MATCH + 1)))
        some = posts.groupBy("cls").agg(enough.alias("enough")).filter("enough").select("cls")
        left = stored(_shared(posts.join(some, "cls", "left_semi")), "ngram-postings")
        discard(posts)
        posts = left
    return posts


def live_sets(docs: DataFrame, live: DataFrame, words: int = WORDS) -> DataFrame:
    """(cls, tokens array) of the classes in ``live`` (column cls), one row each.

    A bitmap of bounded size keeps most other sets out of the shuffle; the
    semi-join makes it exact.
    """
    wanted = live.select("cls").distinct()
    bitmap = _bitmap(wanted.select(F.col("cls").alias("id")), SETS_BITS)
    low = len(bitmap) * 8 - 1

    def run(rows):
        size, cls_out, sets = 0, [], []
        def out():
            return pa.RecordBatch.from_arrays([
                pa.array(cls_out, pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()),
                                         pa.array(np.concatenate(sets).view(np.int64)))], names=["cls", "tokens"])
        for cls, tokens in _new_sets(rows, words):
            at = cls & low
            if bitmap[at >> 3] >> (at & 7) & 1:
                cls_out.append(cls)
                sets.append(tokens)
                size += len(tokens)
                if size > 1 << 17:
                    yield out()
                    size, cls_out, sets = 0, [], []
        if sets:
            yield out()
    return (docs.select(F.col("text").cast("string")).mapInArrow(run, "cls long, tokens array<long>")
            .join(wanted, "cls", "left_semi").dropDuplicates(["cls"]))


def _sizes_fit(a, b, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def verified(pairs: DataFrame, prefixes: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that share min(l, l') prefix tokens and are similar enough: (a, b), stored."""
    side = lambda df, name, cols: df.select(F.col("cls").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in cols))
    few = (pairs.join(side(prefixes, "a", ("l", "prefix")), "a").join(side(prefixes, "b", ("l", "prefix")), "b")
           .filter(F.size(F.array_intersect("a_prefix", "b_prefix")) >= F.least("a_l", "b_l")).select("a", "b"))
    few = stored(few, "ngram-pairs")
    wanted = few.select(F.col("a").alias("id")).union(few.select(F.col("b").alias("id")))
    bitmap = _bitmap(wanted, SETS_BITS)
    low = len(bitmap) * 8 - 1

    def some(rows):  # a bounded bitmap keeps most sets without a pair out of the joins
        for batch in rows:
            at = batch.column(0).to_numpy() & low
            yield batch.filter(pa.array((bitmap[at >> 3] >> (at & 7).astype(np.uint8) & np.uint8(1)) == 1))

    sets = sets.mapInArrow(some, sets.schema)
    both = few.join(side(sets, "a", ("tokens",)), "a").join(side(sets, "b", ("tokens",)), "b")
    same = F.size(F.array_intersect("a_tokens", "b_tokens"))
    total = F.size("a_tokens") + F.size("b_tokens")
    out = stored(both.filter(100 * same >= percent * (total - same)).select("a", "b"), "ngram-links")
    discard(few)
    return out


def linked_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                      rounds: int = STAR_ROUNDS) -> DataFrame:
    """(cls, comp) of all classes that have a shared prefix token; others are alone."""
    posts = possible_postings(stored(live_postings(docs, words, percent), "ngram-live"))
    prefixes = stored(posts.groupBy("cls").agg(F.first("n").alias("n"), F.first("l").alias("l"),
                                               F.collect_list("token").alias("prefix")), "ngram-prefixes")
    sets = stored(live_sets(docs, prefixes, words), "ngram-sets")
    comps = stored(prefixes.select("cls", F.col("cls").alias("comp")), "ngram-comps")

    def merged(edges: DataFrame) -> DataFrame:
        """``comps`` (removed) with those that an edge joins made one."""
        where = lambda c: comps.select(F.col("cls").alias(c), F.col("comp").alias(f"{c}_comp"))
        links = edges.join(where("a"), "a").join(where("b"), "b").select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b"))
        labels = connected(links, comps.select(F.col("comp").alias("node")).distinct(), "ngram-comps")
        out = stored(comps.join(labels.withColumnRenamed("node", "comp"), "comp")
                     .select("cls", F.col("label").alias("comp")), "ngram-comps")
        discard(comps, labels)
        return out

    for k in range(rounds):
        here = posts.join(comps, "cls")
        hub = here.groupBy("token").agg(
            F.min_by(F.struct("cls", "n", "comp"), F.xxhash64("cls", F.lit(k))).alias("hub"),
            F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("token", "hub")
        pairs = (here.join(hub, "token").filter((F.col("comp") != F.col("hub.comp")) & _sizes_fit(F.col("n"), F.col("hub.n"), percent))
                 .select(F.least("cls", "hub.cls").alias("a"), F.greatest("cls", "hub.cls").alias("b")).distinct())
        edges = verified(pairs, prefixes, sets, percent)
        none = edges.isEmpty()
        if not none:
            comps = merged(edges)
        discard(edges)
        if none:
            break

    here = posts.join(comps, "cls")
    mixed = (here.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
             .filter("lo <> hi").select("token", "size"))
    here = stored(here.join(mixed, "token"), "ngram-mixed")
    small = here.filter(F.col("size") <= SMALL)
    a, b = small.alias("a"), small.alias("b")
    pairs = (a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.cls") < F.col("b.cls"))
                    & (F.col("a.comp") != F.col("b.comp")) & _sizes_fit(F.col("a.n"), F.col("b.n"), percent))
             .select(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).distinct())
    large = here.filter(F.col("size") > SMALL)
    made = [verified(pairs, prefixes, sets, percent)]
    if not large.isEmpty():
        made.append(block_links(large, prefixes, sets, percent))
    edges = functools.reduce(DataFrame.union, made)
    if not edges.isEmpty():
        comps = merged(edges)
    discard(posts, prefixes, sets, here, *made)
    return comps


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of two blocks, by products of incidence matrices."""
    size = np.array([len(x) for x in (*left, *right)])
    row = np.repeat(np.arange(len(size)), size)
    _, col, count = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = count > 1  # other tokens are in one set only
    keep = shared[col]
    row, col = row[keep], (np.cumsum(shared) - 1)[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(shared.sum()), width):
        here = slice(*np.searchsorted(col, (lo, lo + width)))
        block = np.zeros((len(size), width), np.float32)
        block[row[here], col[here] - lo] = 1
        total += block[:len(left)] @ block[len(left):].T
    return total.astype(np.int64)


def _blocks(large: DataFrame) -> DataFrame:
    """(cls, comp, block, only): the block of each class in its longest list. A component with ``BLOCK``
    classes there has blocks of its own (``only`` is the component), smaller ones share blocks (null)."""
    home = large.groupBy("cls").agg(F.max(F.struct("size", "token")).alias("h"), F.first("comp").alias("comp"))
    home = home.select("cls", "comp", F.col("h.token").alias("token"))
    many = home.groupBy("token", "comp").agg(F.count("*").alias("n")).filter(F.col("n") >= BLOCK).select("token", "comp", F.col("comp").alias("only"))
    home = stored(home.join(many, ["token", "comp"], "left"), "ngram-home")
    parts = home.groupBy("token", "only").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    parts = parts.toDF("list", "kind", "parts")
    return (home.join(parts, (F.col("token") == F.col("list")) & F.col("only").eqNullSafe(F.col("kind")))
            .select("cls", "comp", F.xxhash64("token", "only", F.pmod(F.xxhash64("cls"), "parts")).alias("block"), "only"))


def _block_pairs(large: DataFrame, home: DataFrame) -> DataFrame:
    """(x, y), x <= y: blocks with a token in common that are not both of one component."""
    met = large.join(home.select("cls", "block", "only"), "cls").select("token", "block", "only").distinct()
    return (met.toDF("token", "x", "x_only").join(met.toDF("token", "y", "y_only"), "token").filter("x <= y")
            .filter("x_only IS NULL OR y_only IS NULL OR x_only <> y_only").select("x", "y").distinct())


def block_links(large: DataFrame, prefixes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b), stored, among classes that share a token of a long posting list; enough of them to join their components.

    A class lives in a block of some ``BLOCK`` classes of its longest list. Blocks
    that have a token in common are compared as wholes: the prefixes of both
    blocks first, then the sets of those classes that have a candidate. So what is
    shuffled grows with the number of blocks in a list, not of pairs. Blocks of one
    component are not compared with each other: a class apart beside very many
    copies that are linked already costs one pair of blocks for each of theirs.
    """
    home = _blocks(large)
    met = _block_pairs(large, home)
    home = home.select("cls", "comp", "block")
    member = stored(home.join(prefixes, "cls"), "ngram-members")
    side = lambda c: met.join(member.withColumnRenamed("block", c), c).select(
        "x", "y", F.lit(c).alias("side"), "cls", "comp", "n", "l", "prefix")
    fields = "x long, y long, a array<long>, b array<long>, ca array<long>, cb array<long>"

    def candidates(group: pa.Table) -> pa.Table:
        x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        first = np.array([v == "x" for v in group.column("side").to_pylist()])
        prefix = [np.asarray(v.values) for v in group.column("prefix").combine_chunks()]
        cls, comp, n, need = (group.column(c).to_numpy() for c in ("cls", "comp", "n", "l"))
        i, j = np.flatnonzero(first), np.flatnonzero(~first)
        small, big = np.minimum(n[i][:, None], n[j]), np.maximum(n[i][:, None], n[j])
        ok = ((_overlaps([prefix[k] for k in i], [prefix[k] for k in j]) >= np.minimum(need[i][:, None], need[j]))
              & (comp[i][:, None] != comp[j]) & (100 * small.astype(np.int64) >= percent * big.astype(np.int64)))
        if x == y:
            ok &= cls[i][:, None] < cls[j]
        p, q = np.nonzero(ok)
        some = len(p) > 0
        return pa.table({k: pa.array([v] * some, t) for k, v, t in (
            ("x", x, pa.int64()), ("y", y, pa.int64()), ("a", cls[i[p]], pa.list_(pa.int64())), ("b", cls[j[q]], pa.list_(pa.int64())),
            ("ca", comp[i[p]], pa.list_(pa.int64())), ("cb", comp[j[q]], pa.list_(pa.int64())))})

    found = stored(side("x").union(side("y")).groupBy("x", "y").applyInArrow(candidates, fields), "ngram-blocks")
    wanted = (found.select(F.col("x").alias("u"), F.col("y").alias("v"), F.explode(F.array_distinct(F.concat("a", "b"))).alias("cls"))
              .join(sets, "cls"))

    def links(group: pa.Table, tokens: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        if len(group):
            a, b, ca, cb = (np.asarray(group.column(c).combine_chunks()[0].values) for c in ("a", "b", "ca", "cb"))
            cls = tokens.column("cls").to_numpy()
            at = {c: k for k, c in enumerate(cls.tolist())}
            token = [np.asarray(v.values) for v in tokens.column("tokens").combine_chunks()]
            left, i = np.unique([at[c] for c in a.tolist()], return_inverse=True)
            right, j = np.unique([at[c] for c in b.tolist()], return_inverse=True)
            same = _overlaps([token[k] for k in left], [token[k] for k in right])[i, j]
            size = np.array([len(t) for t in token])
            alike = 100 * same >= percent * (size[left[i]] + size[right[j]] - same)
            up: dict[int, int] = {}

            def top(c):
                while up.get(c, c) != c:
                    up[c] = up.get(up[c], up[c])
                    c = up[c]
                return c
            for k in np.flatnonzero(alike).tolist():  # links that join components
                p, q = top(int(ca[k])), top(int(cb[k]))
                if p != q:
                    up[p] = q
                    out_a.append(int(a[k]))
                    out_b.append(int(b[k]))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    out = stored(found.groupBy("x", "y").cogroup(wanted.groupBy("u", "v")).applyInArrow(links, "a long, b long"), "ngram-links")
    discard(member, found)
    return out


def _joined(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """What ``ngram_jaccard_join`` returns, and the stored tables that it is read from."""
    own = stored(classes(docs, words), "ngram-classes")
    comps = linked_components(docs, words, percent)
    group = (own.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"))
             .join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")))
    least = group.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = group.join(least, "comp").select("cls", "component_id", "comp")
    return own.join(named, "cls", "left").select(
        "doc_id", "text_hash", "n_shingles",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "comp"), [own, comps]


def ngram_jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, comp): one row per row of ``docs``; comp is null for empty sets."""
    return _joined(docs, words, percent)[0]


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest doc_id (then text hash).

    Rows without words all stay. A row is named by doc_id and the hash of its
    text; of rows equal in both, one stays.
    """
    rows, read = _joined(docs, words, percent)
    found = stored(rows.filter("comp is not null")
                   .select("comp", F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash").alias("row")), "ngram-rows")
    discard(*read)
    keep = found.groupBy("comp").agg(F.min("row").alias("row"))
    away = stored(found.distinct().join(keep, ["comp", "row"], "left_anti").select("row"), "ngram-away")
    again = stored(found.groupBy("comp", "row").count().filter("count > 1").join(keep, ["comp", "row"], "left_semi")
                   .select("row"), "ngram-again")
    discard(found)
    name = F.struct(F.col("doc_id").cast("long").isNull().alias("no"), F.col("doc_id").cast("long").alias("doc_id"),
                    F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    cols = docs.columns
    gone = away.withColumnRenamed("row", "__row")
    if away.count() <= BROADCAST_ROWS:  # some tens of MB; beyond, Spark joins by a shuffle
        gone = F.broadcast(gone)
    left = docs.withColumn("__row", name).join(gone, "__row", "left_anti")
    if again.isEmpty():
        return left.select(*cols)
    twice = again.withColumnRenamed("row", "__row")
    return (left.join(twice, "__row", "left_anti").select(*cols)
            .union(left.join(twice, "__row", "left_semi").dropDuplicates(["__row"]).select(*cols)))

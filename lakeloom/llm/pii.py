"""PII by candidate gradient boosting, with DataFrame functions only.

The four fixed formats are always reported. High-recall generators propose
further, overlapping candidates (anything around ``@``, long digit groups,
dotted numbers). Boosted trees look at a candidate's format (lengths, groups of
digits, separators, a Luhn check) and at the character before and after it.
Candidates above a threshold that touch no fixed span are added (kind ``model``).

The trees learn what the fixed formats cannot say. Each fixed span is written
again, at its own place in the text, in ways that no fixed format matches (phones
without ``+``, 3-2-4 identity numbers, cards of 15 digits, addresses with other
letters): these are the positives, ``PERSONAL``. Dates, versions, prices and ids
written at the same places, ``PLAIN``, and candidates of the corpus that are
plainly such (``_plain``) are the negatives. Other candidates of the corpus, among
them all that may be added, have no label. Trees are fitted on at most
``TRAIN_ROWS`` examples (bounded, documented sample in order of a hash, half of
each label), equal ones counted before that; the threshold is calibrated on all of a
quarter the trees do not see, to a precision of ``PRECISION``. The trees become one SQL expression, so scoring needs
no join and no shuffle, and everything runs inside the JVM.

Spans come from ``split`` and ``regexp_extract_all`` with one pattern: matches and
the gaps between them, whose lengths add up to offsets (code points, end
exclusive). The patterns avoid nested repetition, which Java evaluates by
recursion: separators that cannot be inside a match are first replaced by
characters of equal length, after which runs are plain character classes.

Odd input: a null text is empty; an empty text has no spans (hash of the empty
string); very long texts are read whole; repeated rows are read each; equal candidates
get equal margins, at the threshold they are added; without any fixed span nothing is
added; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import stored

TRAIN_ROWS = 10_000
TREES, DEPTH = 16, 4
PRECISION = 0.99
MARGIN = 12

_LOCAL = "A-Za-z0-9._%+-"
# A match starts where a run starts, or right after the match before it.
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?=(?:[0-9][ -]?){16})[0-9][0-9 -]++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
_NONE = "cast(array() as array<struct<kind:string,start:int,end:int,said:string>>)"
_DATE = (r"^(19|20)[0-9]{2}[-./ ](0?[1-9]|1[0-2])[-./ ](0?[1-9]|[12][0-9]|3[01])(\b|$)"
         r"|^(0?[1-9]|[12][0-9]|3[01])[-./ ](0?[1-9]|1[0-2])[-./ ](19|20)[0-9]{2}(\b|$)")
#: Generators of candidates, by quick test and pattern.
GENERATORS = (
    ("@", r"[^\s@]{1,64}+@[^\s@]{1,255}+"),
    ("[0-9]{3}", r"(?:(?<![0-9+])|\G)\+?[0-9][0-9 ()./-]{7,40}[0-9]"),
)


def _dots(text: Column) -> Column:
    """Dots that do not stand between two characters of a domain become %."""
    return F.regexp_replace(text, r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])", "%")


def _separators(text: Column) -> Column:
    """Spaces and dashes that do not stand between two digits become _."""
    return F.regexp_replace(text, r"(?<![0-9])[ -]|[ -](?![0-9])", "_")


def matches(text: Column, pattern: str, kind: str) -> Column:
    """Array of (kind, start, end, said) of all matches, leftmost and not overlapping."""
    said = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    step = F.arrays_zip(F.slice(F.transform(gaps, F.length), 1, F.size(said)).alias("gap"), said.alias("said"))
    start = F.struct(F.lit(0).alias("at"), F.expr(_NONE).alias("out"))

    def add(acc, x):
        a = acc["at"] + x["gap"]
        b = a + F.length(x["said"])
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(F.struct(
            F.lit(kind).alias("kind"), a.alias("start"), b.alias("end"), x["said"].alias("said")))).alias("out"))
    return F.aggregate(step, start, add, lambda acc: acc["out"])


def _digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def _luhn_sum(said: Column) -> Column:
    chars = F.reverse(F.filter(F.split(_digits(said), ""), lambda c: c != ""))
    value = F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(value, F.lit(0), lambda a, v: a + v)


def luhn(said: Column) -> Column:
    """Whether the digits in ``said`` pass the Luhn check."""
    return _luhn_sum(said) % 10 == 0


def _checked(body: Column, off: int = 0) -> Column:
    """``body`` with its Luhn digit, or with one that is ``off`` by so much."""
    return F.concat(body, ((10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10 + off) % 10).cast("string"))


def _grouped(digits: Column, sizes: tuple[int, ...], by: str) -> Column:
    """The first digits in groups of ``sizes``."""
    at = [1 + sum(sizes[:i]) for i in range(len(sizes))]
    return F.concat_ws(by, *(F.substring(digits, a, n) for a, n in zip(at, sizes, strict=True)))


_LATIN, _ACCENTS = "aeiouncAEIOUNC", "äéîöüñçÄÉÎÖÜÑÇ"
_ROMAN, _CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстувщхыз"


def personal(kind: Column, said: Column) -> Column:
    """Array of texts: the span in ways that no fixed format matches, ``PERSONAL``."""
    d = _digits(said)
    ten = F.substring(F.concat(F.lit("2025550"), d), -10, 10)
    phone = [F.substring(said, 2, 40), F.concat(F.lit("00 "), F.substring(said, 2, 40)), F.concat(F.lit("00"), F.substring(said, 2, 40)),
             F.concat(F.lit("00 "), _grouped(d, (2, 3, 7), " ")), F.concat(F.lit("00 "), _grouped(F.concat(F.substring(d, 1, 2), ten), (2, 3, 7), " ")),
             F.concat(F.lit("0"), _grouped(d, (3, 7), " ")),
             F.concat(F.lit("0"), _grouped(d, (3, 7), "/")), F.concat(F.lit("0"), _grouped(d, (3, 3, 2, 2), " ")),
             F.concat(F.lit("("), _grouped(ten, (3,), ""), F.lit(") "), _grouped(F.substring(ten, 4, 7), (3, 4), "-")),
             *(_grouped(ten, (3, 3, 4), by) for by in ("-", " ", "."))]
    identity = [_grouped(F.substring(d, -9, 9), (3, 2, 4), by) for by in ("-", " ")]
    amex = _checked(F.concat(F.lit("3"), F.substring(d, 2, 13)))
    card = [amex, _grouped(amex, (4, 6, 5), " "), _grouped(amex, (4, 6, 5), "-"),
            _grouped(_checked(F.concat(F.lit("3"), F.substring(d, 3, 12))), (4, 6, 4), " "),
            *(F.when(F.length(d) == 16, _grouped(d, (4, 4, 4, 4), by)) for by in (".", "  ", "/"))]
    local, host = F.substring_index(said, "@", 1), F.substring_index(said, "@", -1)
    email = [F.concat(F.translate(local, _LATIN, _ACCENTS), F.lit("é@"), host), F.concat(local, F.lit("@ü"), host),
             F.concat(F.translate(local, _LATIN, _ACCENTS), F.lit("ñ@ö"), F.translate(host, _LATIN, _ACCENTS)),
             F.translate(F.lower(said), _ROMAN, _CYRILLIC), F.concat(F.lit("é@ü."), F.substring_index(host, ".", -1)),
             F.concat(F.lit("ü@"), F.substring_index(host, ".", -2)), F.concat(F.substring(local, 1, 2), F.lit("é@"), F.substring_index(host, ".", -2)),
             F.concat(F.lit("ö@"), F.translate(F.substring(host, 1, 1), _ROMAN, _CYRILLIC), F.lit("."), F.substring(F.substring_index(host, ".", -1), 1, 2))]
    none = F.expr("cast(array() as array<string>)")
    return (F.when(kind == "phone", F.array(*phone, *identity)).when(kind == "card", F.array(*card, *identity))
            .when(kind == "email", F.array(*email)).otherwise(none))


def plain(kind: Column, said: Column) -> Column:
    """Array of texts in the span's place that are not personal: dates, versions, prices, ids, ``PLAIN``."""
    z = F.lpad(F.pmod(F.xxhash64(said), F.lit(10**18)).cast("string"), 18, "0")
    part = lambda at, n: F.substring(z, at, n)
    two = lambda at, most: F.lpad((part(at, 4).cast("int") % most + 1).cast("string"), 2, "0")
    year = F.concat(F.when(part(1, 1) < "5", "19").otherwise("20"), part(2, 2))
    month, day, hour = two(4, 12), two(8, 28), two(12, 23)
    dates = [*(F.concat_ws(by, year, month, day) for by in "-./ "), *(F.concat_ws(by, day, month, year) for by in "-./"),
             F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), hour),
             F.concat(year, month, day, F.lit("-"), hour, part(3, 4)), F.concat(year, month, day, F.lit(" "), hour, part(3, 2)),
             F.concat(year, F.lit("-"), F.lit("20"), part(5, 2))]
    versions = [F.concat_ws(".", part(1, 2), part(3, 1), F.concat(F.lit("1"), part(4, 3)), part(7, 2)),
                F.concat_ws(".", part(1, 1), part(2, 1), F.concat(year, month, day)), F.concat_ws(".", *(part(i, 1) for i in range(1, 7)))]
    lead = F.concat(F.lit("7"), part(1, 2))
    prices = [F.concat_ws(" ", F.lit("1"), part(1, 3), F.concat(part(4, 3), F.lit("."), part(7, 2))), F.concat_ws(".", lead, part(3, 3), part(6, 3)),
              F.concat(F.lit("4"), part(1, 6), F.lit("."), part(7, 2)), F.concat_ws(" ", lead, part(3, 3), part(6, 3)),
              F.concat(part(1, 2), F.lit("."), part(3, 6), F.lit(" "), part(9, 2), F.lit("."), part(11, 6))]
    ids = [*(part(1, n) for n in (9, 10, 11, 12, 13)), _checked(part(1, 13), 3), _checked(part(1, 14), 4), _checked(part(1, 15), 7),
           _grouped(_checked(part(1, 15), 2), (4, 4, 4, 4), " "), _grouped(_checked(part(1, 14), 6), (4, 6, 5), " "),
           _grouped(_checked(part(1, 14), 1), (4, 6, 5), "-"), _grouped(_checked(part(1, 15), 5), (4, 4, 4, 4), "."),
           F.concat(year, F.lit("-"), part(4, 8)), F.concat(F.lit("978-"), _grouped(z, (1, 2, 6, 1), "-")),
           _grouped(z, (6, 4), "-"), _grouped(z, (2, 6, 1), "-"), _grouped(z, (5, 5), "-"), _grouped(z, (4, 4), "-"),
           _grouped(z, (2, 2, 2, 2, 2), " "), _grouped(z, (1,) * 6, " "), _grouped(z, (4, 4, 2), " "),
           F.concat(F.lit("a"), part(1, 12), F.lit("f")), F.concat(F.lit("c"), part(1, 15), F.lit("e")),
           F.concat(F.lit("x"), _grouped(z, (3, 3, 4), "-")), F.concat(_grouped(z, (3, 2, 4), "-"), F.lit("b"))]
    local, host = F.substring_index(said, "@", 1), F.substring_index(F.substring_index(said, "@", -1), ".", 1)
    ats = [F.concat_ws("@", local, host), F.concat(local, F.lit("@"), part(1, 1), F.lit("."), part(2, 2), F.lit("."), part(4, 1)),
           F.concat(F.lit("é@"), host), F.concat(host, F.lit("@é"), F.lit("/"), local), F.concat(part(1, 2), F.lit("@"), part(3, 1), F.lit("."), part(5, 2)),
           F.concat(host, F.lit("é@"), F.lit("v"), part(1, 1), F.lit("."), part(2, 1)), F.concat(F.lit("é@"), host, F.lit("..")), F.concat(F.lit("ü@é"), host),
           F.concat(local, F.lit("é@"), F.substring_index(said, "@", -1), F.lit("."), part(1, 1)), F.concat(local, F.lit("é@"), host, F.lit("/"), host, F.lit(".9")),
           F.concat(F.lit("ü@é."), part(1, 1)), F.concat(local, F.lit("ñ@"), host, host, host)]
    return F.when(kind == "email", F.array(*ats)).otherwise(F.array(*dates, *versions, *prices, *ids))


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind, the spans of the fixed format that pass its check."""
    def found(quick, source, pattern, kind, check):
        return F.when(text.rlike(quick), F.filter(matches(source, pattern, kind), check)).otherwise(F.expr(_NONE))

    def octets(x):
        parts = F.transform(F.split(x["said"], r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))

    count = lambda x: F.length(_digits(x["said"]))
    return {
        "email": found("@", _dots(text), EMAIL, "email", lambda x: F.lit(True)),
        "ip": found(r"[0-9]\.[0-9]", text, IP, "ip", octets),
        "card": found(r"(?:[0-9][ -]?){16}", _separators(text), CARD, "card",
                      lambda x: count(x).between(16, 19) & luhn(x["said"])),
        "phone": found(r"\+[0-9]", text, PHONE, "phone", lambda x: count(x).between(8, 15))}


def _features(said: Column, before: Column, after: Column) -> list[Column]:
    n = lambda c, keep: F.length(F.regexp_replace(c, f"[^{keep}]", "")).cast("double")
    size = F.length(said).cast("double")
    digits = n(said, "0-9")
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    groups = F.split(F.regexp_replace(F.regexp_replace(said, "^[^0-9]+|[^0-9]+$", ""), "[^0-9]+", " "), " ")
    group = lambda i: F.coalesce(F.length(F.get(groups, i)), F.lit(0)).cast("double")
    end = F.substring_index(said, "@", -1)
    return [size, digits, n(said, r"\p{L}"), n(said, "."), n(said, " "), n(said, r"\-"), n(said, "()"), n(said, "/"), n(said, "@"),
            flag(digits.between(13, 19) & luhn(said)), digits / size, F.size(groups).cast("double"),
            group(F.lit(0)), group(F.lit(1)), group(F.lit(2)), group(F.size(groups) - 1),
            flag(said.startswith("0")), flag(said.startswith("00")), flag(said.rlike(_DATE)),
            flag(said.rlike(r"@[\p{L}0-9-]+(\.[\p{L}0-9-]+)*\.\p{L}{2,}[.,;:!?)>]*$")), F.when(end != said, n(end, ".")).otherwise(-1.0),
            flag(before.rlike(r"[\s(]$|^$")), flag(before.rlike(r"[=:/]\s?$")), flag(before.rlike(r"[\p{L}0-9_]$")),
            flag(after.rlike(r"^[\p{L}0-9_]")), flag(after.rlike(r"^[\s.,;)]|^$"))]


def _plain(said: Column, before: Column, after: Column) -> Column:
    """Whether a candidate is plainly a date, a part of a longer word, a failed card number, or has no host after @."""
    glued = before.rlike(r"[\p{L}0-9_]$") | after.rlike(r"^[\p{L}0-9_]")
    failed = said.rlike("^[0-9]{13,}$") & ~luhn(said)
    return F.when(said.contains("@"), ~F.substring_index(said, "@", -1).rlike(r"\.\p{L}")).otherwise(glued | failed | said.rlike(_DATE))


def _around(text: Column, x: Column) -> Column:
    """The span (start, end, said) with the characters before and after it."""
    return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["said"].alias("said"),
                    F.substring(text, F.greatest(x["start"] - MARGIN, F.lit(0)) + 1, F.least(x["start"], F.lit(MARGIN))).alias("before"),
                    F.substring(text, x["end"] + 1, F.lit(MARGIN)).alias("after"))


def candidates(text: Column) -> Column:
    """Array of (kind, start, end, said, before, after) from all generators; they may overlap."""
    parts = []
    for quick, pattern in GENERATORS:
        parts.append(F.when(text.rlike(quick), matches(text, pattern, "model")).otherwise(F.expr(_NONE)))
    return F.transform(F.concat(*parts), lambda x: _around(text, x))


def _prepared(docs: DataFrame, *keep: str) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"), *keep)
    base = base_spans(F.col("t"))
    rows = rows.withColumns({f"s_{k}": v for k, v in base.items()}).withColumn("cand", candidates(F.col("t")))
    return rows.withColumn("base", F.concat(*(F.col(f"s_{k}") for k in KINDS)))


def _touches(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (start < s["end"]))


def examples(docs: DataFrame) -> DataFrame:
    """(said, before, after, label, n, h): distinct candidates that no fixed format touches, with a weak label.

    Equal spans are counted (``n``) before anything is made from them, so a line that very many documents
    repeat is one example, and no task holds its copies.
    """
    rows = _prepared(docs).filter((F.size("cand") > 0) | (F.size("base") > 0))
    fixed = F.transform("base", lambda x: _around(F.col("t"), x))
    free = F.filter("cand", lambda x: ~_touches(F.col("base"), x["start"], x["end"]) & _plain(x["said"], x["before"], x["after"]))
    spans = stored(rows.select(F.explode(F.concat(fixed, free)).alias("x")).groupBy("x.kind", "x.said", "x.before", "x.after")
                   .agg(F.count("*").alias("n")), "pii-spans")
    views = lambda label, texts: F.transform(texts, lambda v: F.struct(F.lit(label).alias("label"), v.alias("view")))
    kind, said = F.col("kind"), F.col("said")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a span becomes some 20 texts: the few files are dealt out first
    made = (spans.filter("kind <> 'model'").repartition(tasks, "said", "before", "after")
            .select("before", "after", "n", F.explode(F.concat(views(1.0, personal(kind, said)), views(0.0, plain(kind, said)))).alias("v"))
            .filter("v.view is not null")
            .select(F.lit(0).alias("doc_id"), F.concat("before", "v.view", "after").alias("text"), F.col("v.label").alias("label"), "n",
                    F.length("before").alias("a"), F.length(F.concat("before", "v.view")).alias("b")))
    inside = lambda x: ~_touches(F.col("base"), x["start"], x["end"]) & (x["start"] < F.col("b")) & (F.col("a") < x["end"])
    made = _prepared(made, "label", "n", "a", "b").select(F.explode(F.filter("cand", inside)).alias("x"), "label", "n")
    each = (made.select("x.said", "x.before", "x.after", "label", "n")
            .unionByName(spans.filter("kind = 'model'").select("said", "before", "after", F.lit(0.0).alias("label"), "n")))
    return (each.groupBy("said", "before", "after", "label").agg(F.sum("n").alias("n"))
            .withColumn("h", F.xxhash64("said", "before", "after")))


def fit(docs: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[tuple[float, object]], float] | None:
    """(weighted trees, least margin) or None without examples of both labels."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    each = stored(examples(docs), "pii-examples")
    feats = F.array(*_features(F.col("said"), F.col("before"), F.col("after")))
    held = F.pmod("h", F.lit(4)) == 0
    half = [each.filter((F.col("label") == y) & ~held).orderBy("h", "said", "before", "after").limit(rows // 2) for y in (0.0, 1.0)]
    # a weight that grows with the logarithm of the copies: no repeated line outweighs the others
    sample = stored(half[0].union(half[1]).select("label", (1 + F.log2("n")).alias("weight"), feats.alias("f")).repartition(2), "pii-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    model = (GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=32, weightCol="weight")
             .fit(sample.withColumn("features", array_to_vector("f"))))
    scores = model.transform(each.filter(held).select("label", "n", array_to_vector(feats).alias("features")))
    yes = lambda c: F.sum(F.when(F.col("label") == 1, F.col(c)).otherwise(0))
    bins = (scores.withColumns({"b": F.floor(vector_to_array("rawPrediction")[1] * 20), "one": F.lit(1)})
            .groupBy("b").agg(yes("n").alias("yes"), F.sum("n").alias("n"), yes("one").alias("yes_once"), F.sum("one").alias("once"))
            .orderBy(F.desc("b")).collect())
    least, sums = float("inf"), [0, 0, 0, 0]
    for r in bins:  # margins in steps of a twentieth, from the surest down; precise by occurrences and by distinct values
        sums = [a + r[c] for a, c in zip(sums, ("yes", "n", "yes_once", "once"), strict=True)]
        if sums[0] >= PRECISION * sums[1] and sums[2] >= PRECISION * sums[3] and r["yes"]:
            least = r["b"] / 20
    trees = [(w, t._call_java("rootNode")) for w, t in zip(model.treeWeights, model.trees, strict=True)]
    # rawPrediction is twice the sum of the weighted trees
    return [(2 * w, t) for w, t in trees], least


def margin(model, said: Column, before: Column, after: Column) -> Column:
    """The boosted trees as one expression over a candidate."""
    feats = _features(said, before, after)

    def node(at):
        if at.subtreeDepth() == 0:
            return F.lit(float(at.prediction()))
        split = at.split()
        return (F.when(feats[split.featureIndex()] <= float(split.threshold()), node(at.leftChild()))
                .otherwise(node(at.rightChild())))
    total = F.lit(0.0)
    for weight, root in model[0]:
        total = total + F.lit(float(weight)) * node(root)
    return total


def find_pii(docs: DataFrame, model="fit") -> DataFrame:
    """Per row: doc_id, counts, base_sha256, spans, redacted text."""
    model = fit(docs) if model == "fit" else model
    rows = _prepared(docs)
    say = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    slim = lambda s: F.transform(s, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    rows = rows.withColumn("base", slim("base"))
    if model is None:
        extra = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    else:
        sure = F.filter("cand", lambda x: ~_touches(F.col("base"), x["start"], x["end"])
                        & (margin(model, x["said"], x["before"], x["after"]) >= F.lit(float(model[1]))))
        extra = F.array_sort(F.transform(sure, lambda x: F.struct(F.lit("model").alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))
        extra = F.array_distinct(extra)
    rows = rows.withColumn("extra", extra)
    return rows.select(
        "doc_id", *(F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in KINDS), F.size("extra").cast("long").alias("n_model"),
        F.sha2(say(F.col("base")), 256).alias("base_sha256"),
        say(F.concat("base", "extra")).alias("spans"), F.col("t").alias("text"), F.concat("base", "extra").alias("found"))


def redact(found: DataFrame, by: str = "[PII]") -> DataFrame:
    """Rows of ``find_pii`` with every (merged) span of ``text`` replaced."""
    order = F.array_sort("found", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(b["end"] - a["end"]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc, x):
        gap = F.substring(F.col("text"), acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(x["end"] <= acc["at"], acc["out"]).when(x["start"] < acc["at"], acc["out"])
                        .otherwise(F.concat(acc["out"], gap, F.lit(by))).alias("out"))
    done = F.aggregate(order, start, add)
    return found.withColumn("text", F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text"))))

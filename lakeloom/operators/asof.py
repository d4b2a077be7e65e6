"""Point-in-time dimension lookup (facts joined to SCD2 versions as of their time).

For each fact the version of its key with the greatest ``effective_from <=
fact time`` is attached. A plain join on the key plus a range condition
would pair every fact of a key with every version of that key; here facts
and versions are merged into one ordered stream instead and the latest
version is carried forward, so the work is linear in rows.

The stream is cut into ranges of (key, time) by fixed cuts, so a key with a
third of all rows spans many of them ("segments"); a version that starts
in an earlier segment reaches later ones through a per-segment table (one
row per segment: bounded, broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ranges import range_cuts

_SEG = "__seg"
_KIND = "__kind"   # 0 = version, 1 = fact: a version starting at the fact's time applies
_T = "__t"
_V = "__ver"


def as_of_join(facts: DataFrame, fact_key: str, fact_ts: str, versions: DataFrame,
               dim_key: str, dim_from: str, dim_cols: Sequence[str],
               num_partitions: int | None = None) -> DataFrame:
    """``facts`` left-joined to the version valid at ``fact_ts`` (NULLs when none)."""
    dim_cols = list(dim_cols)
    fact_cols = list(facts.columns)
    ver = F.struct(*[F.col(c).alias(c) for c in dim_cols])
    f = facts.select(F.col(fact_key).alias("__k"), F.col(fact_ts).alias(_T),
                     F.lit(1).alias(_KIND), F.struct(*fact_cols).alias("__fact"),
                     F.lit(None).cast(ver_type(versions, dim_cols)).alias(_V))
    v = versions.select(F.col(dim_key).alias("__k"), F.col(dim_from).cast(
        facts.schema[fact_ts].dataType).alias(_T), F.lit(0).alias(_KIND),
        F.lit(None).cast(facts.select(F.struct(*fact_cols)).schema[0].dataType).alias("__fact"),
        ver.alias(_V))
    order = ["__k", _T, _KIND]
    both = f.unionByName(v)
    cuts = range_cuts(both, order, num_partitions)
    u = cuts.assign(both, _SEG)

    w = Window.partitionBy(_SEG, "__k").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = u.withColumn("__cur", F.last(_V, ignorenulls=True).over(w))

    # Last version row of each segment (with its key), carried across segments.
    tails = (u.filter(F.col(_KIND) == 0)
             .groupBy(_SEG)
             .agg(F.max_by(F.struct(F.col("__k").alias("k"), F.col(_V).alias("v")),
                           F.struct(*[F.col(c) for c in order])).alias("tail")))
    segs = facts.sparkSession.range(cuts.count).select(F.col("id").cast("int").alias(_SEG)).join(tails, _SEG, "left")
    carry = segs.select(
        _SEG,
        F.last("tail", ignorenulls=True).over(
            Window.orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    out = local.filter(F.col(_KIND) == 1).join(F.broadcast(carry), _SEG, "left")
    # A fact without a key has no version, as in any join.
    found = F.when(F.col("__k").isNull(), F.lit(None)).when(F.col("__cur").isNotNull(), F.col("__cur")) \
        .when(F.col("carry.k") == F.col("__k"), F.col("carry.v"))
    return out.select("__fact.*", *[found[c].alias(c) for c in dim_cols])


def ver_type(versions: DataFrame, dim_cols: Sequence[str]):
    return versions.select(F.struct(*[F.col(c).alias(c) for c in dim_cols])).schema[0].dataType

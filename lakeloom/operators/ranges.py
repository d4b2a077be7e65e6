"""Range cuts that stay the same from one pass over the data to the next.

``repartitionByRange`` samples its bounds anew in every plan, so two passes can agree on
it only if the cut data is written out in between. Here the bounds are taken once, from
the distinct order values whose hash falls into a small part of the hash space (about
``SAMPLE`` a range of those there are, however few, whatever the size of the data), and become constants
of the plan: a row's range is a search by halving, and any pass finds the same one. The source is read again instead of
being written, so it must give the same rows when it is read twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 40
RANGE_ROWS = 100_000  # tables of fewer rows a range get fewer ranges


@dataclass(frozen=True)
class RangeCuts:
    order: tuple[str, ...]
    edges: DataFrame | None   # one row: the ascending lower ends of all ranges but the first
    count: int                # ranges

    def assign(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the number of each row's range, ascending in the order (NULLs first)."""
        if self.edges is None:
            return df.withColumn(name, F.lit(0))
        steps = F.array(*[F.lit(1 << i) for i in reversed(range((self.count - 1).bit_length()))])
        row, at = F.struct(*self.order), F.col("__edges")
        # the row is a variable of the search, else its columns are computed anew at every step
        passed = F.get(F.transform(F.array(row), lambda r: F.aggregate(steps, F.lit(0), lambda n, step: F.when(
            (n + step < self.count) & (r >= F.get(at, n + step - 1)), n + step).otherwise(n))), F.lit(0))
        return df.withColumn("__edges", self.edges.scalar()).withColumn(name, passed).drop("__edges")


def range_cuts(df: DataFrame, order: Sequence[str], count: int | None = None) -> RangeCuts:
    """Cuts of ``df`` into ``count`` ranges of ``order`` (by default as many as the session shuffles
    to, fewer for a small table). Equal order values are never parted."""
    order = tuple(order)
    keys = df.select(*order)
    seen = keys.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(F.xxhash64(*order)).alias("distinct")).first()
    rows = seen["rows"]
    count = count or min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + rows // RANGE_ROWS)
    if count < 2 or not rows:
        return RangeCuts(order, None, 1)
    some = keys.filter(F.pmod(F.xxhash64(*order), F.lit(max(seen["distinct"], 1))) < SAMPLE * count).distinct()
    found = some.orderBy(*(F.col(c).asc_nulls_first() for c in order)).collect()  # about SAMPLE a range
    edges = [found[i * len(found) // count] for i in range(1, count)] if len(found) >= count else found[1:]
    if not edges:
        return RangeCuts(order, None, 1)
    held = df.sparkSession.createDataFrame(edges, keys.schema)
    # the edges are sorted; sorting structs puts NULL fields first, as the comparison does
    return RangeCuts(order, held.agg(F.sort_array(F.collect_list(F.struct(*order)))), len(edges) + 1)

"""Declared rules over several tables, compiled to one aggregation a table.

A rule names a table, a kind and its columns; nobody writes the check itself:

* ``required``   the columns are neither NULL nor blank;
* ``unique``     no two rows have the same values (rows beyond the first count);
* ``between``    a number lies in [low, high] (NULL and blank are no violation);
* ``one_of``     the value is one of ``values`` (NULL is no violation);
* ``reference``  the key exists in ``parent`` (NULL is no violation);
* ``holds``      a SQL condition on the row is not false.

All counts of a table come from one pass: row rules are conditional counts, a reference
is a left join with the distinct parent keys (AQE splits a hot key, or broadcasts a small
parent), uniqueness is rows minus distinct keys. One row a rule is returned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_or_null, numeric_text

KINDS = ("required", "unique", "between", "one_of", "reference", "holds")


@dataclass(frozen=True)
class Rule:
    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()
    condition: str | None = None
    allowed: int = 0

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"{self.name}: unknown kind {self.kind!r}")


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _violations(rule: Rule, found: str) -> Column:
    """Violations of one rule as an aggregate; ``found`` marks rows whose parent exists."""
    columns = [F.col(c) for c in rule.columns]
    if rule.kind == "required":
        return F.count_if(_any([blank_or_null(c) for c in columns]))
    if rule.kind == "unique":
        return F.count(F.lit(1)) - F.count_distinct(F.struct(*columns))
    if rule.kind == "between":
        value = numeric_text(rule.columns[0])
        return F.count_if(_any([value < rule.low] * (rule.low is not None) + [value > rule.high] * (rule.high is not None)))
    if rule.kind == "one_of":
        return F.count_if(~columns[0].isin(*rule.values))
    if rule.kind == "reference":
        return F.count_if(F.col(found).isNull() & ~_any([c.isNull() for c in columns]))
    return F.count_if(~F.expr(rule.condition))


def check_declared(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """(rule, table_name, rows, violations, passed), one row a rule; nothing runs before it is read."""
    parts = []
    for name in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == name]
        df = tables[name]
        for i, rule in enumerate(mine):
            if rule.kind == "reference":
                parent = tables[rule.parent].select(*(F.col(p).alias(f"__p{i}_{j}") for j, p in enumerate(rule.parent_columns or rule.columns)))
                same = reduce(lambda a, b: a & b, [df[c] == F.col(f"__p{i}_{j}") for j, c in enumerate(rule.columns)])
                df = df.join(parent.distinct().withColumn(f"__found{i}", F.lit(True)), same, "left")
        counts = df.agg(F.count(F.lit(1)).alias("rows"),
                        *(_violations(r, f"__found{i}").cast("long").alias(f"v{i}") for i, r in enumerate(mine)))
        each = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(name).alias("table_name"), F.col("rows"),
                                  F.col(f"v{i}").alias("violations"), (F.col(f"v{i}") <= r.allowed).alias("passed"))
                         for i, r in enumerate(mine)))
        parts.append(counts.select(F.inline(each)))
    return reduce(DataFrame.unionAll, parts)

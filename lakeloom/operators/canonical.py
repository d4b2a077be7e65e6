"""Schema-tolerant canonical columns for Bronze.

Sources arrive in different shapes (database extract vs API batches) and
drift over time. Instead of run-time ``if`` chains, each entity has a list of
canonical column rules; ``canonical_columns`` is a pure function of
(the columns actually present, the rules) that returns the projection to add.
Unit-testable without data, and stable for streaming (schema known upfront).

Rule kinds (build the target when absent, fill its NULLs when present):

* ``alias``    -- copy the first present source column;
* ``derive``   -- apply a function to the first present source column;
* ``coalesce`` -- first non-null over the present sources, in priority order;
* ``null``     -- typed NULL;
* ``const``    -- constant default.
Every rule falls back to a typed NULL if none of its sources is present.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_ts
from ..functions.text import numeric_text
from ..registry import DEFAULT_CURRENCY


@dataclass(frozen=True)
class Rule:
    target: str
    kind: str                      # alias | derive | coalesce | null | const
    dtype: str = "string"
    sources: tuple[str, ...] = ()
    value: object = None
    fn: Callable[[Column], Column] | None = None


def canonical_columns(present: Sequence[str], rules: Sequence[Rule]) -> dict[str, Column]:
    """Columns to add or fill.

    A target that is absent is built from its rule. A target that exists but
    may be NULL on some rows (files of both shapes read together) is filled
    row by row from the same rule: ``coalesce(target, rule)``.
    """
    have = set(present)
    out: dict[str, Column] = {}
    for r in rules:
        if r.target in out:
            continue
        srcs = [s for s in r.sources if s in have or s in out]
        col_of = (lambda s: out[s] if s in out else F.col(s))
        built = None
        if r.kind == "const":
            built = F.lit(r.value).cast(r.dtype)
        elif r.kind == "coalesce" and srcs:
            built = F.coalesce(*[col_of(s) for s in srcs]).cast(r.dtype)
        elif r.kind == "alias" and srcs:
            built = col_of(srcs[0]).cast(r.dtype)
        elif r.kind == "derive" and srcs:
            built = r.fn(col_of(srcs[0])).cast(r.dtype)
        if r.target in have:
            if built is not None:
                out[r.target] = F.coalesce(F.col(r.target).try_cast(r.dtype), built)
        else:
            out[r.target] = built if built is not None else F.lit(None).cast(r.dtype)
    return out


def canonicalise(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    cols = canonical_columns(df.columns, rules)
    return df.withColumns(cols) if cols else df


# Canonical Bronze columns per entity. The order of `sources` is the
# priority of the first-non-null rule.
ORDER_RULES: tuple[Rule, ...] = (
    Rule("status", "alias", sources=("order_status",)),
    Rule("order_date", "derive", dtype="date", sources=("order_purchase_timestamp",),
         fn=lambda c: parse_ts(c).cast("date")),
    Rule("created_at", "alias", sources=("order_purchase_timestamp",)),
    Rule("updated_at", "coalesce",
         sources=("order_delivered_customer_date", "order_approved_at",
                  "order_purchase_timestamp", "_source_ingestion_ts")),
    Rule("total_amount", "null", dtype="double"),
    Rule("currency", "const", value=DEFAULT_CURRENCY),
)

CUSTOMER_RULES: tuple[Rule, ...] = (
    Rule("email", "null"),
    Rule("first_name", "null"),
    Rule("last_name", "null"),
    Rule("created_at", "null"),
    Rule("updated_at", "alias", sources=("_source_ingestion_ts",)),
)

PRODUCT_RULES: tuple[Rule, ...] = (
    Rule("name", "null"),
    Rule("category", "alias", sources=("product_category_name",)),
    Rule("sku", "null"),
    Rule("price", "derive", dtype="double", sources=("price",), fn=numeric_text),
    Rule("updated_at", "alias", sources=("_source_ingestion_ts",)),
)

RULES_BY_ENTITY: dict[str, tuple[Rule, ...]] = {
    "orders": ORDER_RULES,
    "customers": CUSTOMER_RULES,
    "products": PRODUCT_RULES,
}

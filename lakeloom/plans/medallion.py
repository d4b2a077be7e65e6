"""Bronze -> Silver -> Gold transformations as DataFrame functions.

Each function takes DataFrames and returns a DataFrame; reading and writing
is done by the caller (``plans.pipeline``), so the same logic serves batch,
``foreachBatch`` streaming and the query catalogue.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_bucket, parse_date, parse_ts
from ..functions.text import clean_key, numeric_text, upper_trim
from ..operators.canonical import RULES_BY_ENTITY, canonicalise
from ..operators.dedupe import latest_by
from ..operators.scd2 import scd2
from ..operators.union import union_by_name_aligned
from ..registry import ENTITIES, INVENTORY, REVENUE_STATUSES, STORE_SALES
from ..sinks.keyed import RANK, latest_ranked


# --------------------------------------------------------------------------- bronze
def bronze_canonical(entity: str, df: DataFrame) -> DataFrame:
    """Entity-specific canonical columns (no-op for entities without rules)."""
    rules = RULES_BY_ENTITY.get(entity)
    return canonicalise(df, rules) if rules else df


# --------------------------------------------------------------------------- silver
def _recency(df: DataFrame, first: Sequence[str]) -> list[Column]:
    """Most-recent-first order over the recency columns that exist.

    Text timestamps are parsed before comparison; a NULL recency sorts last.
    Ties on the business timestamp fall to the source extract time, then the
    batch / chunk stamps, then the load time.
    """
    order = []
    for c in list(first) + ["_source_ingestion_ts"]:
        if c in df.columns:
            order.append(parse_ts(c).desc_nulls_last())
    for c in ("_batch_id", "_chunk_index", "_ingestion_ts"):
        if c in df.columns:
            order.append(F.col(c).desc_nulls_last())
    return order


def clean_orders(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "status": upper_trim("status"),
        "order_date": parse_date(F.col("order_date").cast("string"), "yyyy-MM-dd"),
    })


def clean_customers(df: DataFrame) -> DataFrame:
    return df.withColumn("email", F.trim("email"))


def clean_store_sales(df: DataFrame) -> DataFrame:
    return df.withColumns({"sale_date": parse_date("sale_date"),
                           "amount": numeric_text("amount").cast("double")})


def clean_inventory(df: DataFrame) -> DataFrame:
    return df.withColumns({"snapshot_date": parse_date("snapshot_date"),
                           "quantity": numeric_text("quantity").cast("double")})


def silver_orders(bronze: DataFrame) -> DataFrame:
    """Clean keys first, then keep the latest version per order."""
    df = bronze.withColumn("order_id", clean_key("order_id")).filter(F.col("order_id").isNotNull())
    return clean_orders(latest_by(df, ["order_id"], _recency(df, ["updated_at"])))


def silver_customers(bronze: DataFrame) -> DataFrame:
    df = bronze.withColumn("customer_id", clean_key("customer_id")) \
        .filter(F.col("customer_id").isNotNull())
    return clean_customers(latest_by(df, ["customer_id"], _recency(df, ["updated_at"])))


def silver_products(bronze: DataFrame) -> DataFrame:
    df = bronze.withColumn("product_id", clean_key("product_id")) \
        .filter(F.col("product_id").isNotNull())
    return latest_by(df, ["product_id"], _recency(df, ["updated_at"]))


def silver_generic(bronze: DataFrame, keys: Sequence[str],
                   recency: Sequence[str] = ()) -> DataFrame:
    """Silver for any registry entity: clean keys, drop null keys, latest wins.

    With no key (e.g. geolocation) the whole row is the key: exact copies go.
    """
    if not keys:
        return bronze.dropDuplicates([c for c in bronze.columns if not c.startswith("_")
                                      and c != "ingestion_date"])
    df = bronze.withColumns({k: clean_key(k) for k in keys})
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return latest_by(df, list(keys), _recency(df, recency))


def silver_store_sales(bronze: DataFrame) -> DataFrame:
    return clean_store_sales(silver_generic(bronze, STORE_SALES.keys, STORE_SALES.recency))


def silver_inventory(bronze: DataFrame) -> DataFrame:
    """Observations without copies; a missing store stays (stock kept without one)."""
    return clean_inventory(silver_generic(bronze, INVENTORY.keys))


@dataclass(frozen=True)
class SilverRule:
    """What identifies a row, what orders its versions, and how a version is cleaned."""
    keys: tuple[str, ...]
    recency: tuple[str, ...] = ()
    clean: Callable[[DataFrame], DataFrame] | None = None
    whole_row: bool = False  # no business key: all columns are, NULLs too


_SILVER_RULES = {
    "orders": SilverRule(("order_id",), ("updated_at",), clean_orders),
    "customers": SilverRule(("customer_id",), ("updated_at",), clean_customers),
    "products": SilverRule(("product_id",), ("updated_at",)),
    "store_sales": SilverRule(STORE_SALES.keys, STORE_SALES.recency, clean_store_sales),
    "inventory": SilverRule(INVENTORY.columns, (), clean_inventory, True),
}


def silver_rule(entity: str) -> SilverRule:
    if entity in _SILVER_RULES:
        return _SILVER_RULES[entity]
    e = ENTITIES[entity]
    return SilverRule(e.keys, e.recency) if e.keys else SilverRule(e.columns, (), None, True)


def silver_versions(bronze: DataFrame, rule: SilverRule) -> DataFrame:
    """Cleaned versions with their rank: the order of ``_recency`` as one comparable value, so that
    versions from different loads can be compared later. The rank comes from the row as it was
    before cleaning; its last part, a hash of the columns that have a value, does not
    change when a later load brings more columns."""
    df = bronze
    if not rule.whole_row:
        df = df.withColumns({k: clean_key(k) for k in rule.keys}).dropna(subset=list(rule.keys))

    def held(c: str, kind: str, value: Column | None = None) -> Column:
        return (F.lit(None) if c not in df.columns else F.col(c) if value is None else value).cast(kind)

    parts = [held(c, "timestamp", parse_ts(c)).alias(f"by_{c}") for c in (*rule.recency, "_source_ingestion_ts")]
    parts += [held("_batch_id", "string").alias("batch"), held("_chunk_index", "long").alias("chunk"),
              held("_ingestion_ts", "timestamp").alias("loaded"),
              F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))).alias("row")]
    df = df.withColumn(RANK, F.struct(*parts))
    return rule.clean(df) if rule.clean else df


def silver_rebuilt(bronze: DataFrame, rule: SilverRule) -> DataFrame:
    """Silver from all of Bronze at once; what merging its loads one by one must equal."""
    return latest_ranked(silver_versions(bronze, rule), rule.keys).drop(RANK)


# --------------------------------------------------------------------------- gold
# Columns of the Gold tables, (name in Silver, name in Gold).
GOLD_COLUMNS = {
    "fact_orders": (("order_id", "order_id"), ("customer_id", "customer_id"), ("order_date", "order_date"), ("status", "status"),
                    ("total_amount", "total_amount"), ("currency", "currency"), ("created_at", "created_at"), ("updated_at", "updated_at")),
    "dim_product": (("product_id", "product_id"), ("name", "product_name"), ("category", "category"), ("sku", "sku"), ("price", "price"),
                    ("updated_at", "updated_at")),
    "dim_store": (("store_id", "store_id"), ("store_name", "store_name"), ("region", "region")),
    "inventory_snapshot": (("product_id", "product_id"), ("quantity", "on_hand_quantity"), ("snapshot_date", "snapshot_date"),
                           ("store_id", "store_id")),
}


def gold_columns(table: str, df: DataFrame) -> DataFrame:
    return df.select(*(F.col(source).alias(name) for source, name in GOLD_COLUMNS[table]))


def fact_orders(silver: DataFrame) -> DataFrame:
    return gold_columns("fact_orders", silver).withColumn("order_year_month", month_bucket("order_date"))


def fact_sales(silver_orders_df: DataFrame, store_sales: DataFrame | None) -> DataFrame:
    """Online orders plus store sales (when present), labelled by channel."""
    online = silver_orders_df.withColumns({
        "channel": F.lit("online"),
        "order_year_month": month_bucket("order_date"),
    })
    if store_sales is None:
        return online
    store = store_sales.withColumns({
        "channel": F.lit("store"),
        "order_year_month": month_bucket("sale_date"),
    })
    return union_by_name_aligned(online, store)


def money_sum(col) -> Column:
    """Exact, order-independent money sum (decimal), returned as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def daily_revenue(fact: DataFrame, statuses: Sequence[str] = REVENUE_STATUSES) -> DataFrame:
    return (fact.filter(F.col("status").isin(*statuses))
            .groupBy("order_date")
            .agg(money_sum("total_amount").alias("revenue"),
                 F.count(F.lit(1)).alias("order_count")))


def dim_customer(changes: DataFrame, collapse: bool = False,
                 run_ts: datetime | None = None) -> DataFrame:
    return scd2(changes, ["customer_id"], "updated_at", ["email", "first_name", "last_name"],
                collapse=collapse, run_ts=run_ts)


def dim_product(products: DataFrame) -> DataFrame:
    return gold_columns("dim_product", products).distinct()


def dim_store(stores: DataFrame | None, store_sales: DataFrame | None) -> DataFrame:
    """Stores table when it exists, else the distinct stores seen in sales."""
    if stores is not None:
        return gold_columns("dim_store", stores)
    if store_sales is None:
        raise ValueError("dim_store needs a stores table or store sales")
    return gold_columns("dim_store", store_sales).distinct()


def inventory_snapshot(inventory: DataFrame) -> DataFrame:
    return gold_columns("inventory_snapshot", inventory).filter(F.col("snapshot_date").isNotNull())

"""Entity registry: the source tables, their keys, cursors and layouts.

Everything downstream (extract, Bronze, Silver, quality checks) is driven
from these records instead of per-entity scripts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]                 # true business key (empty = whole row)
    watermark: str | None = None          # incremental cursor column
    watermark_type: str = "timestamp"     # typed watermark (never compared as text)
    recency: tuple[str, ...] = ()         # latest-wins order for Silver, most recent first
    raw_format: str = "json"              # json (lines or arrays) | csv with header

    def string_schema(self) -> T.StructType:
        """Source tables hold text only; RAW lines add the stamping columns."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# ---------------------------------------------------------------------------
# The relational source model (every column is text), the
# extract cursor per table, and the RAW layout. These must equal the source
# system's definitions for results to line up.
# ---------------------------------------------------------------------------
CUSTOMERS = Entity(
    "customers",
    ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
     "customer_state"),
    keys=("customer_id",),
)
ORDERS = Entity(
    "orders",
    ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
     "order_delivered_carrier_date", "order_delivered_customer_date",
     "order_estimated_delivery_date"),
    keys=("order_id",),
    watermark="order_purchase_timestamp",
)
ORDER_ITEMS = Entity(
    "order_items",
    ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
     "freight_value"),
    keys=("order_id", "order_item_id"),
    watermark="shipping_limit_date",
)
PRODUCTS = Entity(
    "products",
    ("product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
     "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
     "product_width_cm"),
    keys=("product_id",),
)
SELLERS = Entity(
    "sellers",
    ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    keys=("seller_id",),
)
ORDER_REVIEWS = Entity(
    "order_reviews",
    ("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
     "review_creation_date", "review_answer_timestamp"),
    keys=("review_id", "order_id"),
    watermark="review_creation_date",
)
ORDER_PAYMENTS = Entity(
    "order_payments",
    ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    keys=("order_id", "payment_sequential"),
    watermark="payment_sequential",
    watermark_type="int",
)
GEOLOCATION = Entity(
    "geolocation",
    ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
     "geolocation_state"),
    keys=(),
)

SOURCE_ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (ORDERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDER_REVIEWS, CUSTOMERS, PRODUCTS, SELLERS,
              GEOLOCATION)
}

# Feeds landed as files, every column text, and the columns of the product catalogue.
STORE_SALES = Entity("store_sales", ("id", "store_id", "store_name", "region", "amount", "sale_date"),
                     keys=("id",), recency=("sale_date",), raw_format="csv")
INVENTORY = Entity("inventory", ("product_id", "store_id", "quantity", "snapshot_date"), keys=())
CLICKSTREAM = Entity("clickstream", ("event_id", "user_id", "event_type", "value", "ts"),
                     keys=("event_id",), recency=("ts",))
CATALOGUE_COLUMNS = ("name", "category", "sku", "price", "updated_at")

FEED_ENTITIES: dict[str, Entity] = {e.name: e for e in (STORE_SALES, INVENTORY, CLICKSTREAM)}
ENTITIES: dict[str, Entity] = SOURCE_ENTITIES | FEED_ENTITIES

# Stamping columns added to every extracted RAW line.
RAW_STAMP_COLUMNS = ("_source_table", "_ingestion_ts", "_batch_id", "_ingestion_mode",
                     "_chunk_index")

# Extraction defaults.
DEFAULT_CHUNK_SIZE = 50000
EXTRACT_MODES = ("initial", "incremental")

# API-shaped order record (declared schema of the orders API).
API_ORDER_SCHEMA_JSON = {
    "type": "record",
    "name": "Order",
    "fields": [
        {"name": "order_id", "type": "string"},
        {"name": "customer_id", "type": "string"},
        {"name": "order_date", "type": "string"},
        {"name": "status", "type": "string"},
        {"name": "total_amount", "type": "double"},
        {"name": "currency", "type": "string"},
        {"name": "line_items", "type": {"type": "array", "items": "string"}},
        {"name": "shipping_address", "type": "string"},
        {"name": "created_at", "type": "string"},
        {"name": "updated_at", "type": "string"},
    ],
}

# Statuses counted as revenue by the daily mart.
REVENUE_STATUSES = ("COMPLETED", "SHIPPED", "DELIVERED")
DEFAULT_CURRENCY = "BRL"
OPEN_END_TS = "9999-12-31 00:00:00"


def raw_schema(entity: str) -> T.StructType:
    """Declared schema of an entity's RAW lines: its columns, the stamps and, for orders
    and products, the fields of the API or catalogue record that the table lacks.
    A CSV file has its own columns only, so that its header can be checked."""
    from .sources.schema import record_to_struct

    fields = list(ENTITIES[entity].string_schema().fields)
    if ENTITIES[entity].raw_format == "csv":
        return T.StructType(fields)
    fields += [T.StructField(c, T.IntegerType() if c == "_chunk_index" else T.StringType()) for c in RAW_STAMP_COLUMNS]
    if entity == "orders":
        names = {f.name for f in fields}
        fields += [f for f in record_to_struct(API_ORDER_SCHEMA_JSON).fields if f.name not in names]
    if entity == "products":
        fields += [T.StructField(c, T.StringType()) for c in CATALOGUE_COLUMNS]
    return T.StructType(fields)

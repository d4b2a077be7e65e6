"""Landed API page files -> records.

A paginated API is landed as one file per page (``page_0001.json`` ...). A
page holds a bare JSON list, or an envelope with the list under ``items`` or
under the entity name. Every landed page is read, in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_NUMBER_PATTERN = r"page[_=-]?0*(\d+)"


def page_items(spark: SparkSession, path: str, entity: str, record: T.StructType) -> DataFrame:
    """One row per landed page: ``page`` number and its parsed ``items`` list."""
    raw = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("path"), "value")
    arr = T.ArrayType(record)
    env = T.StructType([T.StructField("items", arr), T.StructField(entity, arr)])
    text = F.ltrim("value")
    parsed_env = F.from_json("value", env)
    items = F.when(text.startswith("["), F.from_json("value", arr)) \
        .otherwise(F.coalesce(parsed_env["items"], parsed_env[entity]))
    page = F.regexp_extract("path", PAGE_NUMBER_PATTERN, 1).try_cast("int")
    return raw.select(page.alias("page"), items.alias("items"))


def read_page_files(spark: SparkSession, path: str, entity: str, record: T.StructType) -> DataFrame:
    """All records of all landed pages, with their page number (null if the name has none)."""
    pages = page_items(spark, path, entity, record)
    return pages.select("page", F.explode("items").alias("r")).select("page", "r.*")

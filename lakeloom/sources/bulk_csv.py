"""Bulk CSV folder -> all-text tables named after their files.

``olist_<name>_dataset.csv`` becomes table ``<name>``; other files are
skipped. Values stay text (no inference), as in the source database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: file-name rule of the bulk export.
DATASET_FILE = r"^(.*/olist_([^/]+)_dataset\.csv)(?:/.*)?$"


def load_csv_folder(spark: SparkSession, folder: str,
                    required: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Tables by dataset name. A path component (file, or the folder a Spark
    job wrote the CSV parts into) named ``olist_<name>_dataset.csv`` gives the
    table name; all files of one dataset are read together, all columns text.
    Only the distinct components come to the driver, not the files below them."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)  # names; nothing is opened
    found = (listing.select(F.regexp_extract("path", DATASET_FILE, 1).alias("at"), F.regexp_extract("path", DATASET_FILE, 2).alias("name"))
             .filter("at <> ''").distinct().collect())
    groups: dict[str, list[str]] = {}
    for row in sorted(found):
        groups.setdefault(row["name"], []).append(row["at"])
    missing = [r for r in required if r not in groups]
    if missing:
        raise FileNotFoundError(f"missing dataset files for: {missing}")
    return {name: spark.read.option("header", "true").csv(paths)
            for name, paths in sorted(groups.items())}

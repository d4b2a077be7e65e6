"""Table access by name: scans, existence-checked fallbacks, listing, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by qualified name, or a parquet folder by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """The table if it exists, else None -- an existence test, not a bare
    ``except`` that would also hide permission or corruption errors."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def first_existing(spark: SparkSession, *names: str) -> DataFrame:
    for n in names:
        df = table_or_none(spark, n)
        if df is not None:
            return df
    raise LookupError(f"none of the tables exist: {names}")


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def preview(spark: SparkSession, name: str, rows: int = 5,
            database: str | None = None) -> DataFrame:
    """First ``rows`` rows of a known table; unknown names are rejected."""
    known = list_tables(spark, database)
    if name not in known:
        raise LookupError(f"unknown table {name!r}; known: {known}")
    full = f"{database}.{name}" if database else name
    return spark.table(full).limit(rows)

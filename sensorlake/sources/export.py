"""Mart export and publication.

Marts are versioned tables.  Rows are counted while they are written
(``DataFrame.observe``), so the audit costs no second pass over the mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import versions


def write_mart(df: DataFrame, path: str, files: int | None = None) -> int:
    """Write one mart as zstd Parquet, replacing it in one commit; returns the
    row count.

    ``files`` optionally coalesces the output (for small marts); by default
    each task writes its own file so a large mart is written in parallel.
    """
    return versions.replace(df.coalesce(files) if files else df, path)[1]


def export_marts(
    spark: SparkSession, tables: dict[str, DataFrame], marts_dir: str, files: int | None = None
) -> DataFrame:
    """Write every table to ``marts_dir/<name>`` and return ``(table, rows)``."""
    audit = [(name, write_mart(df, f"{marts_dir}/{name}", files)) for name, df in tables.items()]
    return spark.createDataFrame(audit, "table string, rows bigint")


def publish(df: DataFrame, name: str, materialized: str = "view", path: str | None = None) -> DataFrame:
    """Expose a model under ``name`` (S16): a lazy temp view, or a catalog
    table over Parquet at ``path`` (so later readers do not recompute it)."""
    spark = df.sparkSession
    if materialized == "view":
        df.createOrReplaceTempView(name)
        return df
    if materialized != "table" or not path:
        raise ValueError("materialized must be 'view', or 'table' with a path")
    write_mart(df, path)
    (location,) = versions.current(spark, path).paths(path, None)
    stored = spark.read.parquet(location).schema
    spark.catalog.dropTempView(name)
    if spark.catalog.tableExists(name) and spark.table(name).schema == stored:
        # One change of the catalog entry: there is a table at any moment, and
        # the version before stays readable until ``versions.vacuum``.
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
        return spark.table(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # other columns; external: its files stay
    return spark.catalog.createTable(name, location, "parquet")

"""Exported tables: one folder each, such as ``<Table>-<Id>``, loaded as catalog tables ``<Table>_<Id>``."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.session import children, run_jobs

def table_name(folder: str) -> str:
    """Catalog name of a table folder: whatever is no letter, digit or underscore becomes an underscore."""
    return re.sub(r"\W", "_", folder)


def export_folders(spark: SparkSession, base: str) -> list[str]:
    """Names of the table folders under ``base``, whatever they are called, sorted."""
    folders = [name for name, is_folder in children(spark, base) if is_folder]
    if not folders:
        raise FileNotFoundError(f"{base} has no table folders")
    names = [table_name(f) for f in folders]
    if len(set(names)) < len(names):
        raise ValueError(f"{base}: folders share a table name: {folders}")
    return folders


def read_exports(spark: SparkSession, base: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Every exported table under its table name."""
    return {
        table_name(f): spark.read.format(fmt).load(f"{base.rstrip('/')}/{f}") for f in export_folders(spark, base)
    }


def load_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    schema: str,
    fmt: str = "parquet",
    buckets: Mapping[str, tuple[int, Sequence[str]]] | None = None,
) -> list[str]:
    """(Re)write tables as managed tables of ``schema``; returns their full names.

    ``buckets`` gives a number and columns per table. Tables that are always joined on the same
    columns, such as ledger entries and their details, then meet without a shuffle.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")

    def load(name: str) -> str:
        writer = tables[name].write.mode("overwrite").format(fmt)
        if fmt == "delta":
            writer = writer.option("overwriteSchema", "true").option(
                "delta.columnMapping.mode", "name"
            )
        if buckets and name in buckets:
            number, columns = buckets[name]
            writer = writer.bucketBy(number, *columns)
        writer.saveAsTable(f"{schema}.{name}")
        return f"{schema}.{name}"

    return list(run_jobs(spark, {name: partial(load, name) for name in tables}).values())


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def enable_change_feed(spark: SparkSession, names: Sequence[str]) -> None:
    """Switch on the change data feed, so that later loads can read only what changed.

    Only Delta tables have one. Spark would store the property on any table without effect, so
    others are refused.
    """
    for name in names:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
        provider = described.filter("col_name = 'Provider'").select("data_type").first()
        if provider is None or provider[0].lower() != "delta":
            raise ValueError(f"{name} is not a Delta table and has no change data feed")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES (delta.enableChangeDataFeed = true)")

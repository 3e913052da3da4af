"""Readers for the given parquet tables.

Every reader goes through ``spark.read.parquet`` so Catalyst prunes columns and pushes
filters into the scan; callers select only the columns they use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one given table; with ``columns`` only those are projected (pruned at the scan)."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df

"""Parquet tables by name.  Column pruning and filters reach the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(root: str, name: str) -> str:
    """``root/name.parquet`` if it exists, else the folder ``root/name``."""
    root = root.rstrip("/")
    single = f"{root}/{name}.parquet"
    if "://" in root or root.startswith("file:") or os.path.exists(single):
        return single
    return f"{root}/{name}"


def read_table(spark: SparkSession, root: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, root: str, names=TABLES) -> None:
    """Temp views for SQL access (``S3``)."""
    for n in names:
        read_table(spark, root, n).createOrReplaceTempView(n)


def current_user(spark: SparkSession) -> str:
    """``SELECT current_user()`` – the running user, e.g. for experiment paths."""
    return spark.sql("SELECT current_user() AS u").head()[0]

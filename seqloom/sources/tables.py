"""Parquet tables of one scale folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` under ``folder``; columns and filters reach the scan through Catalyst."""
    return spark.read.parquet(f"{folder}/{name}.parquet")

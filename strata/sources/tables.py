"""Parquet table access. Selecting columns here lets the scan read only them
(``ReadSchema`` in the plan); filters written on the result are pushed into
the Parquet reader by Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str, cols: list | None = None) -> DataFrame:
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df

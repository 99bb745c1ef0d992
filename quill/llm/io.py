"""Tables in and out: the input folder and the cluster's shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quill.sources.scratch import written

__all__ = ["table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (any store Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor sees, so a lost executor
    costs a re-read and never a second, possibly different, evaluation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

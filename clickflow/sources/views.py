"""Tables over DataFrames (S6 anonymous, S7 named temporary view)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def sql_over(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """SQL with DataFrame parameters: ``sql_over(spark, "SELECT * FROM {t}", t=df)``."""
    return spark.sql(query, **frames)

"""Parquet tables by name, and projections that survive missing or extra columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` of ``folder``; with ``columns`` only those, so that the scan reads nothing else."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def keep(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the order asked for."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing in every source; Spark would let it compare as the largest number."""
    return df.selectExpr(*[f"nanvl(`{c}`, cast(null as {kind})) as `{c}`" if kind in ("double", "float") else f"`{c}`" for c, kind in df.dtypes])

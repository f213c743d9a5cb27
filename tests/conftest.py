"""One session for all tests, and small tables with the awkward rows that every query must survive."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import local_session

DATA = os.environ.get("LEDGERLAKE_DATA", "/root/testdata")
TABLES = ["emetteurs", "data_cifen", "charges", "data_verification", "extracted_fields", "doc_candidates", "champs_cifen", "profil_attendu", "taux_change", "sources_collecte", "mix_cibles", "documents"]
#: Names the plans use inside, as extra columns of every table.
CLASHING = ["k", "h", "n", "key", "cle", "code", "valeur", "score", "text", "bucket", "source", "nom", "__r", "section", "label"]


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory) -> str:
    """All tables without rows; the catalogue of accounts is a fixed table and stays."""
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        df = spark.read.parquet(f"{DATA}/sf0.001/{name}.parquet")
        (df if name == "champs_cifen" else df.limit(0)).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="session")
def awkward_tables(spark, tmp_path_factory) -> str:
    """The smallest tables with a row of nulls, repeated rows, a very long text and extra columns of clashing names."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    for name in TABLES:
        df = spark.read.parquet(f"{DATA}/sf0.001/{name}.parquet")
        nulls = spark.createDataFrame([(1,)], "one int").select(*[F.lit(None).cast(kind).alias(c) for c, kind in df.dtypes])
        more = df.unionByName(nulls).unionByName(df.limit(2))
        if name == "documents":
            more = more.withColumn("text", F.when(F.col("doc_id") == 3, F.repeat(F.lit("Une ligne de texte très longue, n° 12 345. "), 5000)).when(F.col("doc_id") == 4, F.repeat(F.lit("a"), 100_000)).otherwise(F.col("text")))
        if name == "extracted_fields":
            more = more.withColumn("original_label", F.when(F.col("field_id") == 5, F.repeat(F.lit("Fonds de commerce "), 500)).otherwise(F.col("original_label")))
        extra = [c for c in CLASHING if c not in df.columns]
        more.withColumns({c: F.lit("clash") for c in extra}).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder

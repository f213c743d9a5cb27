"""Sinks: tables as CSV, keyed upserts, appends that resume, per-entity exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.select import upsert
from ledgerlake.session import written


def write_table(df: DataFrame, path: str, sep: str = ";", one_file: bool = False) -> None:
    """CSV with header. ``one_file`` is for reports that are small by nature; large results stay in parts."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").options(header=True, sep=sep, quote='"', escape='"').csv(path)


#: Parts of a keyed table, by the hash of its key, and the column that tells them.
BUCKETS, BUCKET = 64, "compartiment"


def with_bucket(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS)).cast("int"))


def read_target(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of a keyed table with their bucket; none where the table does not exist."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(full).parquet(path) if there else spark.createDataFrame([], full)


def upsert_into(new: DataFrame, path: str, keys: list[str]) -> None:
    """Upsert by key into a parquet table. The table lies in parts by the hash of the key; only parts that new rows fall
    into are read and written again, so a small batch costs its parts and not the table.

    Each part is replaced as a whole when the job commits. A run that fails between parts is made good by running it
    again, since an upsert of the same rows changes nothing.
    """
    spark = new.sparkSession
    rows = written(with_bucket(new, keys))
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most BUCKETS
    if not touched:
        return
    existing = read_target(spark, path, new.schema).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = written(with_bucket(upsert(existing, rows.drop(BUCKET), keys), keys))
    merged.repartition(len(touched), BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def append_into(new: DataFrame, path: str, keys: list[str]) -> None:
    """Append the rows whose key the table lacks, each to its part."""
    existing = read_target(new.sparkSession, path, new.schema)
    fresh = new.join(existing.select(*keys).distinct(), keys, "left_anti")
    with_bucket(fresh, keys).write.mode("append").partitionBy(BUCKET).parquet(path)


def export_entities(df: DataFrame, path: str, entity: str) -> None:
    """One folder for each entity, as JSON lines; rows are brought together by entity first, so each writes few files."""
    df.repartition(entity).write.mode("overwrite").partitionBy(entity).json(path)


def batch_reports(status: DataFrame, path: str) -> None:
    """Report, failures and large files of a batch, from one status table."""
    write_table(status, f"{path}/rapport")
    write_table(status.where("statut = 'FAILED'"), f"{path}/echecs")
    write_table(status.where("statut = 'SKIPPED_LARGE'"), f"{path}/volumineux")


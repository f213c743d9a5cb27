"""Ranked choices: one row for each key, with every tie settled by the caller's order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; null keys form a group. Ties left open by ``order`` fall anywhere."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def last_wins(df: DataFrame, keys: list[str], order: Column, values: list[str]) -> DataFrame:
    """The values of the last row of each key, nulls included, as a partial aggregate: nothing is sorted or gathered."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("__v")).select(*keys, *[F.col(f"__v.{v}").alias(v) for v in values])


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows whose key is not new, and the new rows. Keys are compared as text; null keys equal each other.

    Repeating it with the same rows changes nothing. Columns that only one side has are filled with null.
    """
    text = lambda df: df.select(*[F.coalesce(F.col(k).cast("string"), F.lit("\x00")).alias(f"__{k}") for k in keys]).distinct()
    marked = existing.withColumns({f"__{k}": F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys})
    kept = marked.join(text(new), [f"__{k}" for k in keys], "left_anti").drop(*[f"__{k}" for k in keys])
    return kept.unionByName(new, allowMissingColumns=True)


def append_new(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows and the new rows whose key they lack; never edits a row."""
    return existing.unionByName(new.join(existing.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def majority(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """Most frequent value of each key; of equally frequent ones the first seen."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("p"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("n"), -F.col("p"))).alias(value), F.max("n").alias("n"))


def full_merge(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str) -> DataFrame:
    """Full outer join on a key that may be null, with the side each row comes from in ``origine``."""
    a, b = left.withColumn("__a", F.lit(1)), right.withColumn("__b", F.lit(1)).withColumnRenamed(key, "__k")
    both = a.join(b, F.col(key).eqNullSafe(F.col("__k")), "full_outer")
    side = F.when(F.col("__b").isNull(), left_name).when(F.col("__a").isNull(), right_name).otherwise("les_deux")
    return both.withColumn(key, F.coalesce(key, "__k")).withColumn("origine", side).drop("__a", "__b", "__k")


def left_merge(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """Left join; columns of the right side that clash get ``suffix``."""
    clash = {c: f"{c}{suffix}" for c in right.columns if c != key and c in left.columns}
    return left.join(right.withColumnsRenamed(clash), key, "left")


def contained_names(asked: DataFrame, known: DataFrame) -> DataFrame:
    """(nom, cle, trouve, ordre) pairs in which one key contains the other, exactly, without comparing all pairs.

    ``asked`` has (nom, cle), ``known`` (trouve, cle, ordre). A key that is contained holds no n-gram its container
    lacks, so its first n-gram, of three letters or of its whole length, meets the n-grams of all its containers.
    """
    size = lambda c: F.least(F.length(c), F.lit(3))
    head = lambda c: F.substring(c, F.lit(1), size(c))

    def of_size(c: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))

    def grams(c: Column) -> Column:
        return F.array_distinct(F.flatten(F.array(*[of_size(c, n) for n in (1, 2, 3)])))

    a = asked.where("cle <> ''").select("nom", F.col("cle").alias("ca"))
    b = known.where("cle <> ''").select("trouve", "ordre", F.col("cle").alias("cb"))
    inside = a.withColumn("g", head(F.col("ca"))).join(b.select("*", F.explode(grams(F.col("cb"))).alias("g")), "g").where(F.col("cb").contains(F.col("ca")))
    around = a.select("*", F.explode(grams(F.col("ca"))).alias("g")).join(b.withColumn("g", head(F.col("cb"))), "g").where(F.col("ca").contains(F.col("cb")))
    return inside.unionByName(around.select(inside.columns)).select("nom", F.col("ca").alias("cle"), "trouve", F.col("cb").alias("cle_trouve"), "ordre").distinct()


def longest_run(df: DataFrame, key: str, position: str, gap: int = 2) -> DataFrame:
    """(key, debut, fin, n): longest run of positions with steps of at most ``gap``; the first of equally long ones."""
    order = Window.partitionBy(key).orderBy(position)
    begins = (F.col(position) - F.lag(position).over(order) > gap).cast("int")
    runs = df.select(key, position, F.coalesce(begins, F.lit(0)).alias("b")).withColumn("run", F.sum("b").over(order))
    sizes = runs.groupBy(key, "run").agg(F.min(position).alias("debut"), F.max(position).alias("fin"), F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(key).agg(F.max_by(F.struct("debut", "fin", "n"), F.struct(F.col("n"), -F.col("debut"))).alias("r")).select(key, "r.*")

"""Company spellings to the canonical name of the issuer list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import fold
from ledgerlake.session import broadcast_if_small

#: Legal forms that may stand before or after a company's name, after folding.
FORMS_BEFORE = ("STE", "SOCIETE", "SA")
FORMS_AFTER = ("SA", "S A", "SOCIETE ANONYME", "SARL")


def company_key(name: Column) -> Column:
    """Folded upper-case words without legal form; null where nothing is left."""
    words = F.trim(F.regexp_replace(F.upper(fold(name)), r"[^A-Z0-9]+", " "))
    bare = F.regexp_replace(words, rf"^(?:(?:{'|'.join(FORMS_BEFORE)}) )+(?=\S)", "")
    bare = F.regexp_replace(bare, rf"(?<=\S)(?: (?:{'|'.join(FORMS_AFTER)}))+$", "")
    return F.nullif(bare, F.lit(""))


def company_names(issuers: DataFrame) -> DataFrame:
    """(cle, nom): each issuer by its name and by its ticker. A key that two issuers share names neither."""
    by_name = issuers.select(company_key(F.col("nom")).alias("cle"), "nom")
    by_ticker = issuers.select(company_key(F.col("ticker")).alias("cle"), "nom")
    both = by_name.unionByName(by_ticker).where("cle is not null and nom is not null")
    keys = both.groupBy("cle").agg(F.min("nom").alias("nom"), F.max("nom").alias("last"))
    return keys.where("nom = last").select("cle", "nom")


def resolve_company(df: DataFrame, column: str, issuers: DataFrame, out: str = "nom") -> DataFrame:
    """Add ``out``, the canonical name of ``column``, null where no issuer is meant.

    The list is broadcast only if its row count proves it small. Rows are kept as they are, repeated ones included.
    """
    names = broadcast_if_small(company_names(issuers).withColumnsRenamed({"cle": "__cle", "nom": "__nom"}), 200_000)
    keyed = df.withColumn("__cle", company_key(F.col(column)))
    joined = keyed.join(names, "__cle", "left")
    return joined.withColumn(out, F.col("__nom")).drop("__cle", "__nom")

"""Problem 3: what differs between the wide account table and its long second copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.companies import resolve_company
from ledgerlake.functions.parse import ANY_DECIMALS, parse_amount, parse_year
from ledgerlake.operators.datadiff import differing_keys, rows_to_compare, set_hash
from ledgerlake.session import collected, cut, written
from ledgerlake.sources.tables import table

#: Values that differ by no more than this are the same; also the quantum of the row hash, so that equal hashes
#: never hide a difference beyond it.
TOLERANCE = 0.005


#: Codes a comparison may have; they become columns of the plan.
MOST_CODES = 2_000


def codes_compared(spark: SparkSession, folder: str) -> dict[str, str]:
    """Codes that occur in the long copy: column of the wide copy -> code as spelt in the catalogue.

    The catalogue bounds the result, whatever the number of rows.
    """
    seen = table(spark, folder, "data_verification", "code_cifen").select(F.lower(F.trim("code_cifen")).alias("c")).distinct()
    catalogue = table(spark, folder, "champs_cifen", "code").distinct()
    found = collected(catalogue.join(seen, F.lower("code") == F.col("c"), "left_semi"), MOST_CODES)
    return {code.lower(): code for code in sorted(r.code for r in found)}


def year_bounds(spark: SparkSession, folder: str) -> Column:
    row = table(spark, folder, "profil_attendu").where("colonne = 'annee'").agg(F.min("borne_min"), F.max("borne_max")).first()
    within = F.col("annee").isNotNull()
    for value, sign in ((row[0], 1), (row[1], -1)):
        if value is not None and value == value:
            within = within & (F.col("annee") * sign >= F.lit(value * sign))
    return within


def wide_copy(spark: SparkSession, folder: str, codes: list[str]) -> DataFrame:
    """(nom, annee, vals map code -> value): the latest row of each company and year that takes part."""
    df = table(spark, folder, "data_cifen", "row_id", "entreprise", "annee", "maj_le", *codes).where(year_bounds(spark, folder))
    named = resolve_company(df, "entreprise", table(spark, folder, "emetteurs", "nom", "ticker")).where("nom is not null")
    latest = named.groupBy("nom", "annee").agg(F.max_by(F.struct(F.lit(1).alias("__one"), *codes), F.struct(F.col("maj_le"), F.col("row_id"))).alias("v"))
    pairs = [F.struct(F.lit(c).alias("code"), F.nanvl(F.col(f"v.{c}"), F.lit(None).cast("double")).alias("value")) for c in codes]
    every = F.array(*pairs) if pairs else F.expr("cast(array() as array<struct<code:string,value:double>>)")
    return latest.select("nom", "annee", F.filter(every, lambda p: p["value"].isNotNull()).alias("vals"))


def long_copy(spark: SparkSession, folder: str) -> DataFrame:
    """(nom, annee, vals): the latest row of each company, year and code; cells without a number hold no value.

    The amounts are exports, not read cells: ``490380658.6800`` has four decimals and does not group thousands.
    """
    df = table(spark, folder, "data_verification", "ver_id", "entreprise", "annee", "code_cifen", "valeur_rapport_reel", "verifie_le")
    named = resolve_company(df.withColumn("annee", parse_year(F.col("annee"))), "entreprise", table(spark, folder, "emetteurs", "nom", "ticker"))
    rows = named.where("nom is not null and annee is not null").withColumn("code", F.lower(F.trim("code_cifen")))
    latest = rows.groupBy("nom", "annee", "code").agg(F.max_by("valeur_rapport_reel", F.struct("verifie_le", "ver_id")).alias("text"))
    values = latest.withColumn("value", parse_amount(F.col("text"), ANY_DECIMALS))
    pair = F.when(F.col("value").isNotNull(), F.struct("code", "value"))
    return values.groupBy("nom", "annee").agg(F.collect_list(pair).alias("vals"))


def hashed(copy: DataFrame) -> DataFrame:
    summed = F.aggregate(
        "vals", F.xxhash64(F.lit("row")), lambda h, p: h.bitwiseXOR(set_hash(p["code"], p["value"], TOLERANCE)), lambda h: h
    )
    return copy.select(F.xxhash64("nom", "annee").alias("k"), summed.alias("h"), "nom", "annee", "vals")


def differences(spark: SparkSession, folder: str) -> DataFrame:
    """(entreprise, annee, code_cifen, statut, valeur_cifen, valeur_verification), one row for each difference.

    A key that one copy lacks gives one row with code ``*``; on keys of both, each code whose values differ by more
    than ``TOLERANCE`` or that only one copy fills gives a row ``ecart``. Repeated and superseded rows count once;
    null or unreadable keys take no part; a table without rows makes every key of the other one absent.
    """
    codes = codes_compared(spark, folder)
    # by column, so that the lookup tables read the two hashes and no values
    wide, long = written(hashed(wide_copy(spark, folder, list(codes)))), written(hashed(long_copy(spark, folder)))
    keys = cut(differing_keys(wide, long, max(wide.count(), long.count())))
    buckets = (keys.select("buckets").first() or [1])[0]
    a, b = (rows_to_compare(side.drop("h"), keys, buckets) for side in (wide, long))
    both = a.alias("a").join(b.alias("b"), ["k", "nom", "annee"], "full_outer").select(
        "nom", "annee", F.col("a.vals").alias("va"), F.col("b.vals").alias("vb")
    )
    names = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]) if codes else F.lit(None).cast("map<string,string>")
    one_side = F.array(
        F.struct(
            F.lit("*").alias("code_cifen"), F.when(F.col("va").isNull(), "absent_cifen").otherwise("absent_verification").alias("statut"),
            F.lit(None).cast("double").alias("valeur_cifen"), F.lit(None).cast("double").alias("valeur_verification"),
        )
    )
    ma, mb = F.map_from_entries("va"), F.map_from_entries("vb")
    compared = F.transform(
        F.array_union(F.map_keys(ma), F.map_keys(mb)),
        lambda c: F.struct(names[c].alias("code_cifen"), F.lit("ecart").alias("statut"), ma[c].alias("valeur_cifen"), mb[c].alias("valeur_verification")),
    )
    differ = F.filter(
        compared,
        lambda d: d["valeur_cifen"].isNull() | d["valeur_verification"].isNull() | (F.abs(d["valeur_cifen"] - d["valeur_verification"]) > TOLERANCE),
    )
    found = F.when(F.col("va").isNull() | F.col("vb").isNull(), one_side).otherwise(differ)
    return both.select(F.col("nom").alias("entreprise"), F.col("annee").cast("int").alias("annee"), F.inline(found))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """The differences as cases."""
    return differences(spark, folder).select("entreprise", "annee", "code_cifen", "statut")

"""Problem 1: amounts read in different money units, brought to dirhams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.companies import resolve_company
from ledgerlake.functions.parse import BLANK, DASH, amount_text
from ledgerlake.operators.aliases import LETTERS, alias_dictionary
from ledgerlake.plans.quality import accounts
from ledgerlake.session import broadcast_if_small, collected, cut, is_small, written
from ledgerlake.sources.tables import table

#: The units an amount may be in, as a scale and a currency: dirhams first, then the foreign ones.
UNITS = ("DH", "KDH", "MDH", "GDH", "CDH", "EUR", "KEUR", "MEUR", "KUSD", "MUSD")
#: Where a caption's statements end, and what stands before a unit in one.
CAPTION_CUT, CAPTION_LEAD = r"[;()\[\]–—/|]|,(?!\d)|\. | - ", r"^.*(?:\ben\b|:)\s*"
#: What a statement names: the column of a year, of the year before, of the year.
OF_YEAR, OF_BEFORE, OF_NOW = r"(?<!\d)(\d{4})(?!\d)\s*(?:en\b|:)", r"(?i)\bN ?- ?1\b|pr[ée]c[ée]dent|ant[ée]rieur", r"(?i)\bN\b|exercice|ann[ée]e"
#: What a unit of each scale letter is worth, in its currency.
SCALE = {letter: 10.0**power for power, letter in LETTERS.items()}
HEAD = rf"^[{BLANK}(+{DASH}]*\d"
CELL = rf"{HEAD}[\d.,'’{BLANK}]*[){DASH}]?(.*)$"
FIELDS = {"value_current": 0, "value_previous": 1}
#: Least number of agreeing cells and their least share among the cells that could be compared.
LEAST_VOTES, LEAST_SHARE = 2, 0.3


def text_of(c: Column) -> Column:
    """Trimmed text, null where blank."""
    flat = F.regexp_replace(c, rf"^[{BLANK}]+|[{BLANK}]+$", "")
    return F.nullif(flat, F.lit(""))


def cell_unit(cell: Column) -> Column:
    return F.when(cell.rlike(r"[^\d\s.,()\-]"), text_of(F.regexp_extract(cell, CELL, 1)))


def holds_number(cell: Column) -> Column:
    return F.coalesce(cell.rlike(HEAD), F.lit(False))


def caption_statements(caption: Column) -> Column:
    """(role, mot) of each statement of a caption that may tell a unit: the unit's spelling, and as its role the year of
    the column it is for, ``avant``, ``exercice``, or blank for the whole table.

    A caption is cut at punctuation; what follows ``en`` or a colon, else the whole piece, is the spelling. A piece with
    an amount tells no unit of the table (``capital de 12 MDH``).
    """
    def role(piece: Column) -> Column:
        year = F.regexp_extract(piece, OF_YEAR, 1)
        return F.when(year != "", year).when(piece.rlike(OF_BEFORE), "avant").when(piece.rlike(OF_NOW), "exercice").otherwise("")

    pieces = F.transform(F.split(caption, CAPTION_CUT), lambda p: F.struct(p.alias("piece"), text_of(F.regexp_replace(p, CAPTION_LEAD, "")).alias("mot")))
    kept = F.filter(pieces, lambda s: ~s["mot"].rlike("[1-9]") | s["mot"].rlike(r"^\s*1(?:0\^\d|0*\s)"))
    return F.when(caption.rlike(r"(?i)\ben\b|[:\[(–—]"), F.transform(kept, lambda s: F.struct(role(s["piece"]).alias("role"), s["mot"].alias("mot"))))


def stated(spark: SparkSession, folder: str) -> DataFrame:
    """Fields with the spellings of every place that may state a unit; one scan."""
    df = table(spark, folder, "extracted_fields", "field_id", "tableau_id", "entreprise", "annee", "code", "value_current", "value_previous", "unite", "legende")
    return df.select(
        "field_id", "tableau_id", "entreprise", "annee", "code", *FIELDS, *[cell_unit(F.col(c)).alias(f"c{i}") for c, i in FIELDS.items()],
        text_of(F.col("unite")).alias("u"), "legende", caption_statements(F.col("legende")).alias("t"),
    )


#: Distinct spellings up to which the dictionary goes to the workers.
SMALL_DICTIONARY = 20_000


def with_units(fields: DataFrame, small: int = SMALL_DICTIONARY) -> DataFrame:
    """Fields with unit columns k0 and k1: what cell, ``unite`` or caption state of either amount, null if nothing.

    A small dictionary is broadcast to joins of each place. A larger one meets the places as rows of one join, so that
    fields without any spelling take no part in the shuffle, and what is found goes back to its field.
    """
    words = F.array_compact(F.concat(F.array("c0", "c1", "u"), F.coalesce(F.transform("t", lambda s: s["mot"]), F.array().cast("array<string>"))))
    known = cut(alias_dictionary(fields.select(F.explode(F.array_distinct(words)).alias("mot")).distinct()))
    caption = F.col("t")
    if is_small(known, small):
        # captions are repeated by table: their distinct statements are mapped as a table of their own
        said = fields.where(F.size("t") > 0).groupBy("legende").agg(F.first("t").alias("t")).select("legende", F.inline("t")).join(F.broadcast(known), "mot")
        mapped = cut(said.groupBy("legende").agg(F.collect_list(F.struct("role", "entree")).alias("m")))
        out = fields
        for place in ("c0", "c1", "u"):
            out = out.join(F.broadcast(known.withColumnsRenamed({"mot": f"m_{place}", "entree": f"e_{place}"})), F.col(place) == F.col(f"m_{place}"), "left")
        out = out.join(broadcast_if_small(mapped, small), "legende", "left")
    else:
        empty = F.array().cast("array<struct<role:string,mot:string>>")
        places = F.concat(F.array(*[F.struct(F.lit(p).alias("role"), F.col(p).alias("mot")) for p in ("c0", "c1", "u")]), F.coalesce(F.transform(caption, lambda s: F.struct(F.concat(F.lit("t"), s["role"]).alias("role"), s["mot"].alias("mot"))), empty))
        each = fields.select("field_id", F.inline(places)).where("mot is not null").join(known, "mot")
        of = lambda p: F.max(F.when(F.col("role") == p, F.col("entree"))).alias(f"e_{p}")
        said = F.collect_list(F.when(F.col("role").startswith("t"), F.struct(F.substring("role", 2, 12).alias("role"), "entree"))).alias("m")
        out = fields.join(each.groupBy("field_id").agg(of("c0"), of("c1"), of("u"), said), "field_id", "left")

    def from_caption(back: int) -> Column:
        """A statement of the column's year, then of its rank, then of the table; ``exercice`` alone is of the table."""
        said = F.col("m")
        first = lambda role: F.get(F.filter(said, lambda s: s["role"] == role), F.lit(0))["entree"]
        ranked = F.when(F.exists(said, lambda s: s["role"] == "avant"), first("avant" if back else "exercice"))
        return F.coalesce(first((F.col("annee") - back).cast("string")), ranked, first(""), F.when(~F.exists(said, lambda s: s["role"] == "avant"), first("exercice")))

    return out.select("field_id", "tableau_id", "entreprise", "annee", "code", *FIELDS, *[F.coalesce(f"e_c{i}", "e_u", from_caption(i)).alias(f"k{i}") for i in FIELDS.values()])


def rates(spark: SparkSession, folder: str) -> Column:
    """Dirhams for a unit of each currency and year, as a map; the table is a fixed helper, its size is checked."""
    rows = collected(table(spark, folder, "taux_change"), 20_000)
    pairs = [x for r in rows if r.dh_par_unite for x in (F.lit(f"{r.devise}{r.annee}"), F.lit(float(r.dh_par_unite)))]
    return F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")


def worth(unit: str, year: Column, rate: Column) -> Column:
    """Dirhams for one of ``unit`` in ``year``; null where the year has no rate."""
    currency = unit[-3:] if unit[-3:] in ("EUR", "USD") else None
    scale = F.lit(SCALE[unit.removesuffix(currency or "DH")])
    return scale if currency is None else rate[F.concat(F.lit(currency), year.cast("string"))] * scale


def cells(units: DataFrame) -> DataFrame:
    """One row for each amount that holds a number: (field_id, champ, annee of the amount, texte, unite or null, ...)."""
    parts = F.array(*[
        F.struct(F.lit(c).alias("champ"), (F.col("annee") - i).alias("an"), F.col(c).alias("texte"), F.col(f"k{i}").alias("unite"))
        for c, i in FIELDS.items()
    ])
    return units.select("field_id", "tableau_id", "entreprise", "code", F.inline(F.filter(parts, lambda p: holds_number(p["texte"]))))


def latest_accounts(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """(nom, an, comptes array): the latest row of each company and year."""
    df = table(spark, folder, "data_cifen", "row_id", "entreprise", "annee", "maj_le", *names).where("annee is not null")
    named = resolve_company(df, "entreprise", table(spark, folder, "emetteurs", "nom", "ticker")).where("nom is not null")
    arrayed = named.select("nom", F.col("annee").alias("an"), F.struct("maj_le", "row_id").alias("v"), F.array(*names).alias("comptes"))
    return arrayed.groupBy("nom", "an").agg(F.max_by("comptes", "v").alias("comptes"))


def table_units(spark: SparkSession, folder: str, silent: DataFrame) -> DataFrame:
    """(tableau_id, unite): the unit that makes a table's cells without unit agree with the wide table, where one does.

    Every cell votes for the units in which it equals the account to the last digit shown.
    """
    names = accounts(spark, folder)
    position = F.create_map(*[F.lit(x) for i, c in enumerate(names) for x in (c, i)])
    voters = silent.where("code is not null and tableau_id is not null").withColumn("pos", position[F.lower("code")]).where("pos is not null")
    number = amount_text(F.col("texte"))
    voters = voters.select("tableau_id", "entreprise", "an", "pos", number.alias("x")).where("x is not null")
    named = resolve_company(voters, "entreprise", table(spark, folder, "emetteurs", "nom", "ticker")).where("nom is not null")
    decimals = F.length(F.regexp_extract("x", r"\.(\d*)$", 1))
    joined = named.join(latest_accounts(spark, folder, names), ["nom", "an"]).select(
        "tableau_id", "an", F.col("x").try_cast("double").alias("x"), F.pow(F.lit(10.0), -decimals).alias("step"), F.get("comptes", F.col("pos")).alias("d")
    )
    rate = rates(spark, folder)
    agrees = {
        u: F.abs(F.col("x") * w - F.col("d")) <= F.col("step") * w * 0.51 + F.abs(F.col("d")) * 1e-4
        for u in UNITS for w in [worth(u, F.col("an"), rate)]
    }
    compared = joined.where("d is not null and not isnan(d) and d <> 0 and x <> 0")
    votes = compared.groupBy("tableau_id").agg(F.count(F.lit(1)).alias("cells"), *[F.count(F.when(yes, 1)).alias(u) for u, yes in agrees.items()])
    best = F.array_max(F.array(*[F.struct(F.col(u).alias("n"), F.lit(u == "DH").alias("dh"), F.lit(u).alias("unite")) for u in UNITS]))
    chosen = votes.select("tableau_id", "cells", best.alias("b"))
    clear = (F.col("b.n") >= F.least(F.col("cells"), F.lit(LEAST_VOTES))) & (F.col("b.n") >= F.col("cells") * LEAST_SHARE)
    return chosen.where(clear).select("tableau_id", F.col("b.unite").alias("unite"))


def resolved(spark: SparkSession, folder: str) -> DataFrame:
    """(field_id, champ, an, texte, unite): every cell that holds a number, with its unit."""
    # read apart once: the cells are needed for the dictionary, for the votes and for the result
    each = cells(with_units(written(stated(spark, folder))))
    silent = each.where("unite is null")
    guessed = table_units(spark, folder, silent).withColumnRenamed("unite", "devine")
    known = each.where("unite is not null").select("field_id", "champ", "an", "texte", "unite")
    found = silent.join(guessed, "tableau_id", "left").select("field_id", "champ", "an", "texte", F.coalesce("devine", F.lit("DH")).alias("unite"))
    return known.unionByName(found)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that hold a number and are not in dirhams. Blank, null and non-numeric cells have no row."""
    return resolved(spark, folder).where("unite <> 'DH'").select("field_id", "champ", "unite")


def p1_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Every amount in dirhams; null where it is foreign money of a year without rate."""
    rate = rates(spark, folder)
    factor = F.coalesce(*[F.when(F.col("unite") == u, worth(u, F.col("an"), rate)) for u in UNITS])
    number = F.regexp_extract("texte", rf"({HEAD}[\d.,'’{BLANK}]*[){DASH}]?)", 1)
    return resolved(spark, folder).select("field_id", "champ", F.col("an").alias("annee"), "unite", (amount_text(number).try_cast("double") * factor).alias("dirhams"))

"""Grouped procedural queries on the read tables. SQL cannot express them; small tests hold their results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.fuzzy import LetterIndex, WordRuns, label_key, words_of
from ledgerlake.operators import align as A
from ledgerlake.operators import layout as L
from ledgerlake.plans.catalog import query
from ledgerlake.plans.quality import MOST_ENTRIES
from ledgerlake.plans.texts import block_type, blocks
from ledgerlake.session import broadcast_if_small, collected, cut, width
from ledgerlake.sources.tables import table

#: Least similarity of a name; names asked for and issuers that meet as one block, about.
LEAST_NAME, ASKED_BLOCK, KNOWN_BLOCK = 0.55, 1024, 65536


def entries(spark: SparkSession, folder: str) -> dict[str, list[tuple[str, str]]]:
    """Section -> (code, label) in matching order, of the fixed catalogue."""
    out: dict[str, list[tuple[str, str]]] = {}
    for r in sorted(collected(table(spark, folder, "champs_cifen"), MOST_ENTRIES), key=lambda r: (r.section, r.pos)):
        out.setdefault(r.section, []).append((r.code, r.label))
    return out


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "extracted_fields").select(F.col("tableau_id").alias("table"), F.col("bilan").alias("section"), "rang", "field_id", F.col("original_label").alias("label"), F.col("value_current").alias("courant"), F.col("value_previous").alias("precedent"))


@query()
def align_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every table aligned to the accounts of their section in two passes."""
    return A.align_tables(lines(spark, folder).select("table", "section", "rang", "field_id", "label"), entries(spark, folder))


@query()
def split_fused(spark: SparkSession, folder: str) -> DataFrame:
    """Fused lines split."""
    return A.split_tables(lines(spark, folder), {s: [label for _, label in known] for s, known in entries(spark, folder).items()})


SQL_LINES = "SELECT tableau_id AS \"table\", bilan AS section, rang, field_id, original_label AS label, value_current AS courant, value_previous AS precedent FROM extracted_fields"


@query(f"""
WITH l AS (SELECT *, coalesce(trim(label), '') = '' AND coalesce(trim(courant), '') <> '' AND coalesce(trim(precedent), '') = '' AS orphelin, coalesce(trim(courant), '') = '' AS vide FROM ({SQL_LINES})),
w AS (SELECT *, lead(orphelin) OVER o AS apres, lead(courant) OVER o AS valeur, lag(vide AND NOT orphelin) OVER o AS avant_vide FROM l WINDOW o AS (PARTITION BY "table" ORDER BY rang, field_id))
SELECT "table", section, rang, field_id, label, CASE WHEN vide AND apres AND NOT orphelin THEN valeur ELSE courant END AS courant, precedent FROM w WHERE NOT (orphelin AND coalesce(avant_vide, false))""")
def orphan_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Values of lines without label carried back."""
    return A.carry_orphans(lines(spark, folder))


@query()
def section_values(spark: SparkSession, folder: str) -> DataFrame:
    """Header lines stripped and the value columns chosen by the modal width of the table."""
    from ledgerlake.functions.text import norm_words

    rows = lines(spark, folder).withColumn("cells", F.array(F.coalesce("courant", F.lit("")), F.coalesce("precedent", F.lit(""))))
    return A.value_columns(rows.select("table", "section", "rang", "label", "cells"), norm_words(F.concat_ws(" ", "label", "cells")))


@query()
def fuzzy_name(spark: SparkSession, folder: str) -> DataFrame:
    """(nom, trouve, score): best issuer of each distinct company spelling by ratio and containment, from 0.55 on.

    Equal keys need no comparison; the other keys meet all issuers in blocks, once to find a score that the best is not
    below, once more to compare those whose letters can reach it, so no issuer is left out that could be the best.
    Of equal scores the first name is taken; a spelling without issuer has a null one.
    """

    @F.pandas_udf("string")
    def keyed(names: pd.Series) -> pd.Series:
        return names.map(label_key)

    known = cut(table(spark, folder, "emetteurs", F.col("nom").alias("trouve")).where("trouve is not null").distinct().withColumn("cle_e", keyed("trouve")).where("cle_e <> ''").groupBy("cle_e").agg(F.min("trouve").alias("trouve")))
    names = cut(table(spark, folder, "data_cifen", F.col("entreprise").alias("nom")).where("nom is not null").distinct().withColumn("cle", keyed("nom")))
    exact = names.join(known, F.col("cle") == F.col("cle_e")).select("nom", "trouve", F.lit(1.0).alias("score"))
    asked = cut(names.where("cle <> ''").select("cle").distinct().join(known.select(F.col("cle_e").alias("cle")), "cle", "left_anti"))

    n_asked, n_known = asked.count(), known.count()
    parts = max(-(-n_asked // ASKED_BLOCK), min(width(spark), -(-n_asked // 32)), 1)
    issuers = known.groupBy(F.expr(f"pmod(xxhash64(cle_e), {max(-(-n_known // KNOWN_BLOCK), 1)})").alias("k")).agg(F.collect_list(F.struct("cle_e", "trouve")).alias("e"))
    issuers = issuers.select("k", F.col("e.cle_e").alias("cles_e"), F.col("e.trouve").alias("trouves"))

    def met(keys: DataFrame, run: Callable, schema: str) -> DataFrame:
        blocks_asked = keys.groupBy(F.expr(f"pmod(xxhash64(cle), {parts})").alias("q")).agg(F.collect_list(F.struct("cle", "least")).alias("a"))
        pairs = blocks_asked.select(F.col("a.cle").alias("cles"), F.col("a.least").alias("leasts")).crossJoin(issuers)

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held, index = None, None
            for batch in batches:
                for r in batch.itertuples():
                    if index is None or held != r.k:
                        held, index = r.k, LetterIndex(list(r.cles_e), list(r.trouves))
                    yield run(index, list(r.cles), list(r.leasts))

        return pairs.repartition(width(spark)).mapInPandas(each, schema)

    def first(index: LetterIndex, keys: list[str], _: list[float]) -> pd.DataFrame:
        return pd.DataFrame({"cle": keys, "score": index.first(keys)})

    def best(index: LetterIndex, keys: list[str], leasts: list[float]) -> pd.DataFrame:
        return pd.DataFrame(index.best(keys, leasts), columns=["cle", "trouve", "score"])

    least = met(asked.withColumn("least", F.lit(LEAST_NAME)), first, "cle string, score double").groupBy("cle").agg(F.greatest(F.max("score"), F.lit(LEAST_NAME)).alias("least"))
    scored = met(least, best, "cle string, trouve string, score double").groupBy("cle").agg(F.min(F.struct((-F.col("score")).alias("s"), "trouve")).alias("b"))
    found = exact.unionByName(names.join(scored, "cle").select("nom", "b.trouve", (-F.col("b.s")).alias("score")))
    return names.select("nom").join(found, "nom", "left")


@query()
def field_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Share of a section's labels that each table holds, exactly or nearly."""
    expected = {s: [words_of(label) for _, label in known] for s, known in entries(spark, folder).items()}

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        text = WordRuns(" ".join(words_of(x) for x in pdf.sort_values("field_id")["label"]))
        known = expected.get(key[1], [])
        found = sum(text.holds(e) for e in known)
        return pd.DataFrame({"table": [key[0]], "section": [key[1]], "trouves": [found], "taux": [round(found / len(known), 3) if known else 0.0]})

    return lines(spark, folder).select("table", "section", "field_id", "label").groupBy("table", "section").applyInPandas(run, "table bigint, section string, trouves int, taux double")


#: Phrases that show the sections of a balance sheet in the documents.
SECTIONS = {"bilan": {"actif": "total de l actif", "tresorerie": "tresorerie", "passif": "total du passif"}}


@query()
def partial_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Partial balance blocks of each document completed from their neighbours."""
    typed = blocks(spark, folder).withColumn("genre", F.coalesce(block_type(), F.lit("autre"))).where("n <> ''")
    score = lambda text, kind: min(100, 30 * sum(p in text for p in SECTIONS[kind].values()))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tables = [{"id": int(r.bloc), "bloc": int(r.bloc), "serie": None, "genre": "bilan" if r.genre == "bilan" else "autre", "texte": r.n, "score": score(r.n, "bilan")} for r in pdf.sort_values("bloc").itertuples()]
        done = [t for t in A.repair_partial(tables, SECTIONS, score) if t["genre"] != "autre"]
        return pd.DataFrame({"doc_id": key[0], "bloc": [t["bloc"] for t in done], "genre": [t["genre"] for t in done], "avec": [";".join(map(str, t["avec"])) for t in done], "confiance": [t["confiance"] for t in done], "partiel": [t["partiel"] for t in done]})

    # only documents that hold a balance block at all have anything to repair
    with_sheet = typed.where("genre = 'bilan'").select("doc_id").distinct()
    return typed.join(with_sheet, "doc_id", "left_semi").select("doc_id", "bloc", "genre", "n").groupBy("doc_id").applyInPandas(run, "doc_id bigint, bloc int, genre string, avec string, confiance double, partiel boolean")


@query("""
WITH v AS (SELECT n_name, year(o_orderdate)::INTEGER AS an, round(sum(o_totalprice::DECIMAL(18,2)))::DOUBLE AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderdate IS NOT NULL GROUP BY ALL)
SELECT n_name || ' ' || (an - an % 3) || '-' || (an - an % 3 + 2) AS page, 'chiffre_affaires_annee_' || (an % 3 + 1) AS champ, v AS valeur FROM v""")
def page_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """Indicators of pages made of the orders of a nation, three years a page from a year divisible by three on: a line
    of years, a line of numbers. All three years stand in the header; a year without orders has no value."""
    nations = table(spark, folder, "nation", "n_nationkey", "n_name")
    orders = table(spark, folder, "orders", "o_custkey", "o_orderdate", "o_totalprice").join(table(spark, folder, "customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    sums = orders.groupBy("c_nationkey", F.year("o_orderdate").alias("an")).agg(F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).cast("bigint").alias("v")).where("an is not null")
    sums = sums.withColumn("first", F.col("an") - F.pmod("an", F.lit(3)))
    pages = sums.select("c_nationkey", "first").distinct()
    header = pages.select("c_nationkey", "first", F.explode(F.sequence("first", F.col("first") + 2)).alias("an")).select("c_nationkey", "first", "an", F.lit(0).alias("y"), F.col("an").cast("string").alias("text"))
    values = sums.select("c_nationkey", "first", "an", F.lit(40).alias("y"), F.col("v").cast("string").alias("text"))
    numbers = header.unionByName(values).select("c_nationkey", "first", (300 + (F.col("an") - F.col("first")) * 200).cast("double").alias("left"), F.col("y").cast("double").alias("top"), F.lit(60.0).alias("width"), "text")
    labels = pages.select("c_nationkey", "first", F.lit(10.0).alias("left"), F.lit(41.0).alias("top"), F.lit(80.0).alias("width"), F.lit("Chiffre").alias("text"))
    words = numbers.unionByName(labels).withColumn("height", F.lit(12.0)).join(broadcast_if_small(nations), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("page", F.concat_ws(" ", "n_name", F.concat_ws("-", "first", F.col("first") + 2)))
    return L.indicator_table(words.select("page", "left", "top", "width", "height", "text"))

"""Merges, upserts and changes of shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.parse import ARABIC_DIGITS, parse_amount, parse_year
from ledgerlake.operators import select as S
from ledgerlake.plans.catalog import query
from ledgerlake.plans.quality import MOST_ENTRIES
from ledgerlake.session import collected
from ledgerlake.sources.tables import keep, nan_to_null, table

@query("""
WITH l AS (SELECT entreprise, count(*) AS n_documents FROM documents GROUP BY entreprise), r AS (SELECT entreprise, count(*) AS n_candidats FROM doc_candidates GROUP BY entreprise)
SELECT coalesce(l.entreprise, r.entreprise) AS entreprise, n_documents, n_candidats, CASE WHEN r.n_candidats IS NULL THEN 'documents' WHEN l.n_documents IS NULL THEN 'candidats' ELSE 'les_deux' END AS origine
FROM l FULL JOIN r ON l.entreprise IS NOT DISTINCT FROM r.entreprise""")
def outer_merge_indicator(spark: SparkSession, folder: str) -> DataFrame:
    """Full outer merge with the side each row comes from; null keys meet."""
    a = table(spark, folder, "documents", "entreprise").groupBy("entreprise").agg(F.count(F.lit(1)).alias("n_documents"))
    b = table(spark, folder, "doc_candidates", "entreprise").groupBy("entreprise").agg(F.count(F.lit(1)).alias("n_candidats"))
    return S.full_merge(a, b, "entreprise", "documents", "candidats")


@query("""
SELECT d.cand_id, d.entreprise, d.source, s.rang AS rang, d.score, d.annee, e.secteur, e.ticker FROM doc_candidates d LEFT JOIN sources_collecte s ON s.source = d.source LEFT JOIN emetteurs e ON e.nom = d.entreprise""")
def left_merge_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """Left merges with optional columns, clashing names suffixed, unwanted ones dropped, keys first."""
    docs = keep(table(spark, folder, "doc_candidates"), ["cand_id", "entreprise", "source", "score", "annee", "_warning_ancre"])
    issuers = table(spark, folder, "emetteurs", F.col("nom").alias("entreprise"), "secteur", "ticker")
    merged = S.left_merge(S.left_merge(docs, table(spark, folder, "sources_collecte"), "source", "_src"), issuers, "entreprise", "_e")
    return keep(merged, ["cand_id", "entreprise", "source", "rang", "score", "annee", "secteur", "ticker"])


SQL_SLICE = "SELECT o_custkey, year(o_orderdate)::INTEGER AS annee, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders WHERE {c} GROUP BY ALL"


def order_years(spark: SparkSession, folder: str, condition: str) -> DataFrame:
    orders = table(spark, folder, "orders", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice").where(condition)
    return orders.groupBy("o_custkey", F.year("o_orderdate").alias("annee")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query(f"""
WITH a AS ({SQL_SLICE.format(c="o_orderstatus = 'F'")}), b AS ({SQL_SLICE.format(c="o_orderstatus = 'O'")})
SELECT * FROM a ANTI JOIN b USING (o_custkey, annee) UNION ALL SELECT * FROM b""")
def upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Open orders by customer and year written over closed ones."""
    return S.upsert(order_years(spark, folder, "o_orderstatus = 'F'"), order_years(spark, folder, "o_orderstatus = 'O'"), ["o_custkey", "annee"])


@query(f"""
WITH a AS ({SQL_SLICE.format(c="o_orderstatus = 'F'")}), b AS ({SQL_SLICE.format(c="o_orderstatus = 'O'")})
SELECT * FROM a UNION ALL SELECT * FROM b ANTI JOIN a USING (o_custkey, annee)""")
def append_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Open orders added where no closed ones are."""
    return S.append_new(order_years(spark, folder, "o_orderstatus = 'F'"), order_years(spark, folder, "o_orderstatus = 'O'"), ["o_custkey", "annee"])


@query("""SELECT source, min(cand_id) AS cand_id, url_pdf FROM doc_candidates WHERE url_pdf IS NOT NULL GROUP BY source, url_pdf""")
def keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first of repeated rows, by an order that is told."""
    return table(spark, folder, "doc_candidates", "source", "url_pdf", "cand_id").where("url_pdf is not null").groupBy("source", "url_pdf").agg(F.min("cand_id").alias("cand_id"))


@query("""SELECT entreprise, annee, actif_f, passif_c FROM data_cifen WHERE entreprise IS NOT NULL AND annee IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY row_id DESC) = 1""")
def last_write_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Last row of each key, even where it blanks a value."""
    df = nan_to_null(table(spark, folder, "data_cifen", "entreprise", "annee", "row_id", "actif_f", "passif_c")).where("entreprise is not null and annee is not null")
    return S.last_wins(df, ["entreprise", "annee"], F.col("row_id"), ["actif_f", "passif_c"])


def catalogue_codes(spark: SparkSession, folder: str) -> list[str]:
    """All account codes in catalogue order; the fixed catalogue bounds the list."""
    found = collected(table(spark, folder, "champs_cifen", "section", "pos", "code").na.drop(), MOST_ENTRIES)
    return list(dict.fromkeys(r.code.lower() for r in sorted(found, key=lambda r: (r.section, r.pos))))


@query("""SELECT row_id, code, valeur FROM data_cifen UNPIVOT INCLUDE NULLS (valeur FOR code IN (COLUMNS(* EXCLUDE (row_id, entreprise, annee, charge_id, maj_le))))""")
def melt_long(spark: SparkSession, folder: str) -> DataFrame:
    """All accounts of the catalogue to rows, blanks kept."""
    present = set(table(spark, folder, "data_cifen").columns)
    codes = [c for c in catalogue_codes(spark, folder) if c in present]
    return nan_to_null(table(spark, folder, "data_cifen", "row_id", *codes)).unpivot(["row_id"], codes, "code", "valeur")


@query("""
WITH v AS (SELECT field_id, entreprise, annee, lower(code) AS code, value_current FROM extracted_fields WHERE code IS NOT NULL),
l AS (SELECT entreprise, annee, code, arg_max({'v': value_current}, field_id).v AS valeur FROM v GROUP BY ALL),
m AS (SELECT true AS vrai, * FROM l UNION ALL SELECT false, NULL, NULL, lower(code), NULL FROM champs_cifen)
SELECT * EXCLUDE (vrai) FROM (PIVOT m ON code USING max(valeur) GROUP BY vrai, entreprise, annee) WHERE vrai""")
def pivot_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Read lines to a column for every code of the catalogue; the last line of a repeated code counts, a missing code is
    blank; the codes are given, so no pass looks for them."""
    df = table(spark, folder, "extracted_fields", "entreprise", "annee", "code", "field_id", "value_current").where("code is not null").withColumn("code", F.lower("code"))
    last = S.last_wins(df, ["entreprise", "annee", "code"], F.col("field_id"), ["value_current"])
    return last.groupBy("entreprise", "annee").pivot("code", catalogue_codes(spark, folder)).agg(F.max("value_current"))


@query("SELECT DISTINCT code AS champ FROM extracted_fields WHERE code IS NOT NULL")
def dynamic_header(spark: SparkSession, folder: str) -> DataFrame:
    """The header of a table with open columns: the sorted union of its keys."""
    return table(spark, folder, "extracted_fields", F.col("code").alias("champ")).where("champ is not null").distinct().orderBy("champ")


@query("""SELECT cand_id, champ, valeur FROM (SELECT cand_id, unnest(['titre', 'source', 'type_detecte']) AS champ, unnest([titre, source, type_detecte]) AS valeur FROM doc_candidates) WHERE valeur IS NOT NULL""")
def key_value_export(spark: SparkSession, folder: str) -> DataFrame:
    """Records as key and value rows."""
    docs = table(spark, folder, "doc_candidates", "cand_id", "titre", "source", "type_detecte")
    return docs.select("cand_id", F.explode(F.create_map(*[x for c in ("titre", "source", "type_detecte") for x in (F.lit(c), F.col(c))])).alias("champ", "valeur")).where("valeur is not null")


@query("""
WITH t AS (SELECT entreprise, string_agg(DISTINCT annee::VARCHAR, ', ') AS annees FROM doc_candidates WHERE annee IS NOT NULL GROUP BY entreprise)
SELECT entreprise, trim(a)::INTEGER AS annee FROM (SELECT entreprise, unnest(string_split(annees, ',')) AS a FROM t)""")
def explode_years(spark: SparkSession, folder: str) -> DataFrame:
    """Years out of a comma list; parts that are no number are null and dropped."""
    lists = table(spark, folder, "doc_candidates", "entreprise", "annee").where("annee is not null").groupBy("entreprise").agg(F.array_join(F.collect_set("annee"), ", ").alias("annees"))
    return lists.select("entreprise", F.explode(F.split("annees", ",")).alias("a")).select("entreprise", F.trim("a").try_cast("int").alias("annee")).where("annee is not null")


SQL_REQUESTED = "SELECT DISTINCT entreprise, annee FROM extracted_fields"


@query(f"""
WITH q AS ({SQL_REQUESTED}), p AS (SELECT entreprise, annee, 'rapport' AS origine, annee AS source FROM q UNION ALL SELECT entreprise, annee - 1, 'derive', annee FROM q)
SELECT entreprise, annee, origine, source FROM p QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY origine DESC, source) = 1""")
def year_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Requested years from their own report, the years before from the next one's second column; a requested year is never derived."""
    asked = table(spark, folder, "extracted_fields", "entreprise", "annee").distinct()
    both = F.array(F.struct(F.col("annee").alias("an"), F.lit("rapport").alias("origine")), F.struct((F.col("annee") - 1).alias("an"), F.lit("derive").alias("origine")))
    plans = asked.select("entreprise", F.col("annee").alias("source"), F.inline(both))
    best = plans.groupBy("entreprise", "an").agg(F.min(F.struct((F.col("origine") == "derive").alias("d"), "source", "origine")).alias("b"))
    return best.select("entreprise", F.col("an").alias("annee"), "b.origine", "b.source")


@query("""
SELECT field_id, annee, value_current AS valeur FROM extracted_fields WHERE nullif(trim(value_current), '') IS NOT NULL
UNION ALL SELECT field_id, annee - 1, value_previous FROM extracted_fields WHERE nullif(trim(value_previous), '') IS NOT NULL""")
def two_columns_split(spark: SparkSession, folder: str) -> DataFrame:
    """Each line's two values as rows of their own years, blanks left out."""
    df = table(spark, folder, "extracted_fields", "field_id", "annee", "value_current", "value_previous")
    pairs = F.array(F.struct(F.col("annee").alias("an"), F.col("value_current").alias("valeur")), F.struct((F.col("annee") - 1).alias("an"), F.col("value_previous").alias("valeur")))
    return df.select("field_id", F.inline(pairs)).where("nullif(trim(valeur), '') is not null").select("field_id", F.col("an").alias("annee"), "valeur")


@query("""
WITH l AS (SELECT code, min(section || lpad(pos::VARCHAR, 4, '0')) AS ordre, count(*) AS libelles FROM champs_cifen GROUP BY code) SELECT code, ordre, libelles FROM l""")
def ordered_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct codes in the order of their first label."""
    place = F.concat("section", F.lpad(F.col("pos").cast("string"), 4, "0"))
    return table(spark, folder, "champs_cifen").groupBy("code").agg(F.min(place).alias("ordre"), F.count(F.lit(1)).alias("libelles")).orderBy("ordre")


@query("""
WITH y AS (SELECT o_custkey, year(o_orderdate)::INTEGER AS annee, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS reel FROM orders GROUP BY ALL),
d AS (SELECT o_custkey, (year(o_orderdate) - 1)::INTEGER AS annee, max(o_totalprice) AS derive FROM orders GROUP BY ALL)
SELECT d.o_custkey, d.annee, d.derive, y.reel, d.derive - y.reel AS ecart FROM d LEFT JOIN y USING (o_custkey, annee) WHERE coalesce(d.derive, y.reel) IS NOT NULL""")
def derived_vs_real(spark: SparkSession, folder: str) -> DataFrame:
    """Values derived from the next year's figures against the year's own; pairs with neither are left out."""
    orders = table(spark, folder, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    real = orders.groupBy("o_custkey", F.year("o_orderdate").alias("annee")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("reel"))
    derived = orders.groupBy("o_custkey", (F.year("o_orderdate") - 1).alias("annee")).agg(F.max("o_totalprice").alias("derive"))
    return derived.join(real, ["o_custkey", "annee"], "left").where("coalesce(derive, reel) is not null").withColumn("ecart", F.col("derive") - F.col("reel"))


#: Blanks of all kinds, for the SQL side.
SQL_BLANKS = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
SQL_DIGITS = f"translate({{c}}, '{ARABIC_DIGITS}', '{'0123456789' * 2}')"
SQL_FLAT = r"regexp_replace(regexp_replace(" + SQL_DIGITS.format(c="valeur_rapport_reel") + rf", '{SQL_BLANKS[:-1]}''’]', '', 'g'), '[\x{{2010}}-\x{{2015}}\x{{2212}}]', '-', 'g')"


@query(rf"""
WITH f AS (SELECT ver_id, {SQL_FLAT} AS f FROM data_verification), b AS (SELECT ver_id, f, regexp_replace(f, '[(+)-]', '', 'g') AS b, starts_with(f, '(') OR starts_with(f, '-') OR ends_with(f, '-') AS moins FROM f),
t AS (SELECT *, CASE WHEN contains(b, ',') THEN CASE WHEN regexp_matches(b, ',.*\.') THEN replace(b, ',', '') ELSE replace(replace(b, '.', ''), ',', '.') END WHEN regexp_full_match(b, '[0-9]*\.[0-9]{{1,2}}') THEN b ELSE replace(b, '.', '') END AS t FROM b)
SELECT ver_id, CASE WHEN regexp_full_match(f, '[(+-]*[.,]?[0-9][0-9.,]*[)-]?') THEN try_cast(CASE WHEN moins THEN '-' ELSE '' END || t AS DOUBLE) END AS valeur FROM t""")
def parse_number(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts of every row, in whatever notation, by the rule of read tables; a cell without a number gives null."""
    return table(spark, folder, "data_verification", "ver_id", "valeur_rapport_reel").select("ver_id", parse_amount(F.col("valeur_rapport_reel")).alias("valeur"))


SQL_ZEROS = "regexp_replace(" * 3 + SQL_DIGITS.format(c="annee") + r", '([0-9])[Oo]', '\10', 'g')" * 3
SQL_JOINED = "regexp_replace(" * 2 + SQL_ZEROS + rf", '([0-9]){SQL_BLANKS}+([0-9])', '\1\2', 'g')" * 2


@query(rf"SELECT ver_id, nullif(regexp_extract({SQL_JOINED}, '(?:^|[^0-9])([0-9]{{4}})(?:[^0-9]|$)', 1), '')::INTEGER AS annee FROM data_verification")
def parse_years(spark: SparkSession, folder: str) -> DataFrame:
    """Years of every row, in whatever notation; a cell without four digits in a row gives null."""
    return table(spark, folder, "data_verification", "ver_id", "annee").select("ver_id", parse_year(F.col("annee")).alias("annee"))

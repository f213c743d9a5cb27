"""Accounting checks and quality rates of the wide account table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import rules as R
from ledgerlake.plans.catalog import query
from ledgerlake.session import broadcast_if_small
from ledgerlake.sources.tables import nan_to_null, table

RULES = R.IDENTITIES
#: Fixed value: the sector left out of the scope in the two-scope rates.
OUT_OF_SCOPE = "Assurances"
#: Stock indicators of the stability rule.
STOCKS = ["actif_total_general", "actif_f", "passif_c", "actif_tresor"]


def facts(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return nan_to_null(table(spark, folder, "data_cifen", *columns))


def rule_columns(df: DataFrame) -> list[str]:
    used = {c.lower() for total, _, parts in R.active_rules(RULES, df.columns) for c in (total, *parts)}
    return [c for c in df.columns if c in used]


def rule_facts(spark: SparkSession, folder: str, *keys: str) -> DataFrame:
    df = table(spark, folder, "data_cifen")
    return nan_to_null(df.select(*keys, *rule_columns(df)))


def anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """(entreprise, annee, regle) of broken rules; rows without a key are no group."""
    keyed = rule_facts(spark, folder, "entreprise", "annee").where("entreprise is not null and annee is not null")
    return R.broken(keyed, RULES, R.TOLERANCE, ["entreprise", "annee"])


def sql_value(sign: int, parts: list[str]) -> str:
    return (" + " if sign > 0 else " - ").join(f"coalesce({p.lower()}, 0.0)" for p in parts)


#: One row for each row and rule, for the SQL side.
SQL_CHECKS = "\nUNION ALL\n".join(
    f"SELECT row_id, entreprise, annee, '{t}' AS regle, {t.lower()} IS NOT NULL AS evaluable, abs({t.lower()} - ({sql_value(s, p)})) <= 1.0 AS ok FROM data_cifen"
    for t, s, p in RULES
)
SQL_PCT = "(({a} * 10000 - ({a} * 10000) % {b}) // {b} + CASE WHEN (({a} * 10000) % {b}) * 2 > {b} OR (({a} * 10000) % {b}) * 2 = {b} AND ((({a} * 10000 - ({a} * 10000) % {b}) // {b}) % 2) = 1 THEN 1 ELSE 0 END) / 100.0"


def sql_pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {SQL_PCT.format(a=a, b=b)} END"


@query(f"""
WITH checks AS ({SQL_CHECKS}),
c AS (SELECT regle, count(*) AS n_total, count(*) FILTER (evaluable) AS n_evaluables, count(*) FILTER (ok) AS n_ok FROM checks GROUP BY regle)
SELECT regle, n_total, n_evaluables, n_ok, {sql_pct('n_ok', 'n_evaluables')} AS taux_pct FROM c""")
def rule_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """How often each identity can be evaluated and holds."""
    return R.rule_counts(rule_facts(spark, folder), RULES, R.TOLERANCE).withColumn("taux_pct", R.percent(F.col("n_ok"), F.col("n_evaluables")))


@query(f"""
WITH checks AS ({SQL_CHECKS})
SELECT entreprise, annee, count(*) AS n_anomalies, string_agg(DISTINCT regle, '; ' ORDER BY regle) AS regles
FROM checks WHERE evaluable AND NOT ok AND entreprise IS NOT NULL AND annee IS NOT NULL GROUP BY entreprise, annee""")
def rule_anomalies_by_entity_year(spark: SparkSession, folder: str) -> DataFrame:
    """Broken identities of each company and year; rows without a key are no group."""
    bad = anomalies(spark, folder)
    return bad.groupBy("entreprise", "annee").agg(F.count(F.lit(1)).alias("n_anomalies"), F.array_join(F.array_sort(F.collect_set("regle")), "; ").alias("regles"))


@query(f"""
WITH checks AS ({SQL_CHECKS}),
bad AS (SELECT entreprise, count(DISTINCT annee) AS annees_touchees, count(*) AS n_anomalies, string_agg(DISTINCT regle, '; ' ORDER BY regle) AS regles
  FROM checks WHERE evaluable AND NOT ok AND entreprise IS NOT NULL AND annee IS NOT NULL GROUP BY entreprise),
a AS (SELECT entreprise, count(DISTINCT annee) AS annees FROM data_cifen WHERE entreprise IS NOT NULL AND annee IS NOT NULL GROUP BY entreprise)
SELECT a.entreprise, annees, coalesce(annees_touchees, 0) AS annees_touchees, coalesce(n_anomalies, 0) AS n_anomalies, coalesce(regles, '') AS regles,
  {sql_pct('(annees - coalesce(annees_touchees, 0))', 'annees')} AS annees_saines_pct
FROM a LEFT JOIN bad USING (entreprise)""")
def rule_anomalies_by_entity(spark: SparkSession, folder: str) -> DataFrame:
    """The same by company; companies without anomaly appear with zeros, the worst first."""
    bad = anomalies(spark, folder)
    # distinct years and rules first, so that no group needs its rows in one place
    by_company = bad.groupBy("entreprise").agg(
        F.countDistinct("annee").alias("annees_touchees"), F.count(F.lit(1)).alias("n_anomalies"), F.array_join(F.array_sort(F.collect_set("regle")), "; ").alias("regles")
    )
    years = facts(spark, folder, "entreprise", "annee").where("entreprise is not null and annee is not null").groupBy("entreprise").agg(F.countDistinct("annee").alias("annees"))
    full = years.join(by_company, "entreprise", "left").na.fill(0, ["annees_touchees", "n_anomalies"]).na.fill("", ["regles"])
    return full.withColumn("annees_saines_pct", R.percent(F.col("annees") - F.col("annees_touchees"), F.col("annees"))).orderBy(F.desc("n_anomalies"), "entreprise")


@query(f"""
WITH checks AS ({SQL_CHECKS}),
out AS (SELECT nom FROM emetteurs WHERE secteur = '{OUT_OF_SCOPE}'),
scoped AS (SELECT 'brut' AS portee, evaluable, ok FROM checks UNION ALL
  SELECT 'perimetre', evaluable, ok FROM checks WHERE entreprise IS NULL OR entreprise NOT IN (SELECT nom FROM out)),
c AS (SELECT portee, count(*) AS n_total, count(*) FILTER (evaluable) AS n_evaluables, count(*) FILTER (ok) AS n_ok FROM scoped GROUP BY portee)
SELECT portee, n_total, n_evaluables, n_ok, {sql_pct('n_ok', 'n_evaluables')} AS taux_pct FROM c""")
def coherence_gross_vs_scope(spark: SparkSession, folder: str) -> DataFrame:
    """Global coherence on all rows and on those in scope, in one pass; rows without company stay in scope."""
    out = table(spark, folder, "emetteurs").where(F.col("secteur") == OUT_OF_SCOPE).select(F.col("nom").alias("entreprise"), F.lit(True).alias("exclu")).dropDuplicates(["entreprise"])
    df = table(spark, folder, "data_cifen")
    marked = df.select("entreprise", *rule_columns(df)).join(broadcast_if_small(out), "entreprise", "left")
    can, ok = R.row_counts(RULES, marked.columns, R.TOLERANCE)
    pre = nan_to_null(marked).select("exclu", can.alias("e"), ok.alias("o")).groupBy("exclu").agg(F.count(F.lit(1)).alias("n"), F.sum("e").alias("e"), F.sum("o").alias("o"))
    scopes = F.when(F.col("exclu"), F.array(F.lit("brut"))).otherwise(F.array(F.lit("brut"), F.lit("perimetre")))
    by_scope = pre.select(F.explode(scopes).alias("portee"), "n", "e", "o").groupBy("portee").agg(
        (F.sum("n") * len(R.active_rules(RULES, df.columns))).alias("n_total"), F.sum("e").alias("n_evaluables"), F.sum("o").alias("n_ok")
    )
    return by_scope.withColumn("taux_pct", R.percent(F.col("n_ok"), F.col("n_evaluables")))


@query(f"""
WITH r AS (SELECT count(*) AS n,
  count(*) FILTER (abs(actif_total_general - passif_total_general) <= 1.0) AS n_bilan,
  count(*) FILTER (abs(cpc_xiii - passif_a12) <= 1.0) AS n_resultat,
  count(*) FILTER (abs(actif_total_general - passif_total_general) <= 1.0 AND abs(cpc_xiii - passif_a12) <= 1.0) AS n_deux FROM data_cifen)
SELECT n, n_bilan, n_resultat, n_deux, {sql_pct('n_bilan', 'n')} AS bilan_pct, {sql_pct('n_resultat', 'n')} AS resultat_pct, {sql_pct('n_deux', 'n')} AS deux_pct FROM r""")
def balance_three_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Assets equal liabilities, the two net results agree, both; a null side is a failure, no rows give 0."""
    df = facts(spark, folder, "actif_total_general", "passif_total_general", "cpc_xiii", "passif_a12")
    sheet = F.abs(F.col("actif_total_general") - F.col("passif_total_general")) <= 1.0
    result = F.abs(F.col("cpc_xiii") - F.col("passif_a12")) <= 1.0
    n = df.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(sheet, 1)).alias("n_bilan"), F.count(F.when(result, 1)).alias("n_resultat"), F.count(F.when(sheet & result, 1)).alias("n_deux")
    )
    return n.select("*", *[R.percent(F.col(f"n_{c}"), F.col("n")).alias(f"{c}_pct") for c in ("bilan", "resultat", "deux")])


#: The accounts of the catalogue that no identity uses.
OTHER_ACCOUNTS = ["cpc_i_1", "cpc_i_2", "cpc_i_3", "cpc_i_4", "cpc_i_5", "cpc_i_6", "cpc_i_7", "cpc_i_8", "cpc_xiv"]
#: All 138 accounts.
FILLED = sorted({c.lower() for t, _, p in RULES for c in (t, *p)} | set(OTHER_ACCOUNTS))
SQL_FILLED = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in FILLED)


def filled_counts() -> list:
    return [F.expr(f"count({c})").alias(c) for c in FILLED]


def total_filled():
    return F.expr(" + ".join(FILLED))


#: How many of these accounts a row fills.
ROW_FILLED = " + ".join(f"cast({c} is not null as int)" for c in FILLED)


@query(f"""
WITH r AS (SELECT count(*) * {len(FILLED)} AS cellules, sum({SQL_FILLED})::BIGINT AS remplies FROM data_cifen)
SELECT cellules, remplies, {sql_pct('remplies', 'cellules')} AS taux_pct FROM r""")
def fill_rate_global(spark: SparkSession, folder: str) -> DataFrame:
    """Filled cells of all accounts."""
    counts = facts(spark, folder, *FILLED).agg(F.count(F.lit(1)).alias("n"), *filled_counts())
    return counts.select((F.col("n") * len(FILLED)).alias("cellules"), total_filled().alias("remplies")).withColumn("taux_pct", R.percent(F.col("remplies"), F.col("cellules")))


@query(f"""
WITH out AS (SELECT nom FROM emetteurs WHERE secteur = '{OUT_OF_SCOPE}'), r AS (SELECT entreprise, {SQL_FILLED} AS f FROM data_cifen),
s AS (SELECT 'brut' AS portee, f FROM r UNION ALL SELECT 'perimetre', f FROM r WHERE entreprise IS NULL OR entreprise NOT IN (SELECT nom FROM out)),
c AS (SELECT portee, count(*) * {len(FILLED)} AS cellules, sum(f)::BIGINT AS remplies FROM s GROUP BY portee)
SELECT portee, cellules, remplies, {sql_pct('remplies', 'cellules')} AS taux_pct FROM c""")
def fill_rate_gross_vs_scope(spark: SparkSession, folder: str) -> DataFrame:
    """Fill rate on all rows and on those in scope, in one pass; rows without company stay in scope."""
    out = table(spark, folder, "emetteurs").where(F.col("secteur") == OUT_OF_SCOPE).select(F.col("nom").alias("entreprise"), F.lit(True).alias("exclu")).dropDuplicates(["entreprise"])
    marked = facts(spark, folder, "entreprise", *FILLED).select("entreprise", F.expr(ROW_FILLED).alias("f")).join(broadcast_if_small(out), "entreprise", "left")
    pre = marked.groupBy("exclu").agg(F.count(F.lit(1)).alias("n"), F.sum("f").alias("f"))
    scopes = F.when(F.col("exclu"), F.array(F.lit("brut"))).otherwise(F.array(F.lit("brut"), F.lit("perimetre")))
    by_scope = pre.select(F.explode(scopes).alias("portee"), "n", "f").groupBy("portee").agg((F.sum("n") * len(FILLED)).alias("cellules"), F.sum("f").alias("remplies"))
    return by_scope.withColumn("taux_pct", R.percent(F.col("remplies"), F.col("cellules")))


SQL_FILL_ENTITY = f"""
SELECT entreprise, count(DISTINCT annee) AS annees, count(*) * {len(FILLED)} AS cellules, sum({SQL_FILLED})::BIGINT AS remplies
FROM data_cifen WHERE entreprise IS NOT NULL GROUP BY entreprise"""


@query(f"""WITH r AS ({SQL_FILL_ENTITY}) SELECT entreprise, annees, cellules, remplies, {sql_pct('remplies', 'cellules')} AS taux_pct FROM r""")
def fill_rate_by_entity(spark: SparkSession, folder: str) -> DataFrame:
    """Filled cells by company, the emptiest first. Years and cells are counted apart: a distinct count beside many plain ones would expand every row."""
    df = facts(spark, folder, "entreprise", "annee", *FILLED).where("entreprise is not null")
    row = F.expr(ROW_FILLED)
    by_year = df.groupBy("entreprise", "annee").agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("remplies"))
    rates = by_year.groupBy("entreprise").agg(F.count("annee").alias("annees"), (F.sum("n") * len(FILLED)).alias("cellules"), F.sum("remplies").alias("remplies"))
    return rates.withColumn("taux_pct", R.percent(F.col("remplies"), F.col("cellules"))).orderBy(F.asc_nulls_last("taux_pct"), "entreprise")


@query(f"""WITH r AS ({SQL_FILL_ENTITY}) SELECT entreprise, {sql_pct('remplies', 'cellules')} AS taux_pct FROM r ORDER BY taux_pct, entreprise LIMIT 10""")
def weakest_ten(spark: SparkSession, folder: str) -> DataFrame:
    """The ten emptiest companies; ties by name."""
    return fill_rate_by_entity(spark, folder).select("entreprise", "taux_pct").orderBy("taux_pct", "entreprise").limit(10)


@query(
    "\nUNION ALL\n".join(f"SELECT '{c}' AS champ, count(*) AS lignes, count({c}) AS remplies, {sql_pct(f'count({c})', 'count(*)')} AS taux_pct FROM data_cifen" for c in FILLED)
)
def fill_rate_by_field(spark: SparkSession, folder: str) -> DataFrame:
    """Filled cells by account: one row of counts, unpivoted."""
    counts = facts(spark, folder, *FILLED).agg(F.count(F.lit(1)).alias("lignes"), *filled_counts())
    long = counts.unpivot(["lignes"], FILLED, "champ", "remplies")
    return long.select("champ", "lignes", "remplies").withColumn("taux_pct", R.percent(F.col("remplies"), F.col("lignes"))).orderBy("taux_pct", "champ")


@query("""
SELECT row_id, CASE WHEN abs(cpc_iii - (cpc_i - cpc_ii)) <= 2 THEN 'OK' WHEN abs(cpc_iii + (cpc_i - cpc_ii)) <= 2 THEN 'ERREUR' ELSE 'ALERTE' END AS severite
FROM data_cifen WHERE cpc_iii IS NOT NULL AND cpc_i IS NOT NULL AND cpc_ii IS NOT NULL""")
def technical_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Balance against income less charges: equal, equal with the wrong sign, or off."""
    df = facts(spark, folder, "row_id", "cpc_iii", "cpc_i", "cpc_ii").where("cpc_iii is not null and cpc_i is not null and cpc_ii is not null")
    return df.select("row_id", F.coalesce(R.sign_check(F.col("cpc_iii"), F.col("cpc_i"), F.col("cpc_ii")), F.lit("OK")).alias("severite"))


#: (rule, severity, field, condition that is wrong), one for each plausibility rule of a row.
BOUNDS = [
    ("R2", "ERREUR", "passif_a", "actif_total_general < passif_a"),
    ("R3", "ERREUR", "passif_c", "actif_total_general < passif_c"),
    ("R4", "ALERTE", "cpc_iii", "cpc_iii > cpc_i_3"),
    ("R5", "ALERTE", "cpc_ii_5", "cpc_ii > 0 and (cpc_ii_5 * 100 / cpc_ii < 2 or cpc_ii_5 * 100 / cpc_ii > 60)"),
    ("R7", "ERREUR", "actif_total_general", "actif_total_general <= 0"),
]


@query("\nUNION ALL\n".join(f"SELECT row_id, '{r}' AS regle, '{s}' AS severite, '{f}' AS champ FROM data_cifen WHERE {c}" for r, s, f, c in BOUNDS))
def bound_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Order and range rules of a row; comparisons with a blank are not judged."""
    df = facts(spark, folder, "row_id", "actif_total_general", "passif_a", "passif_c", "cpc_iii", "cpc_i_3", "cpc_ii", "cpc_ii_5")
    hits = [F.when(F.expr(c), F.struct(F.lit(r).alias("regle"), F.lit(s).alias("severite"), F.lit(f).alias("champ"))) for r, s, f, c in BOUNDS]
    return df.select("row_id", F.inline(F.array_compact(F.array(*hits))))


def latest(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The last written row of each company and year."""
    df = facts(spark, folder, "row_id", "entreprise", "annee", "maj_le", *columns).where("entreprise is not null and annee is not null")
    last = df.groupBy("entreprise", "annee").agg(F.max_by(F.struct(*columns), F.struct("maj_le", "row_id")).alias("v"))
    return last.select("entreprise", "annee", "v.*")


SQL_LATEST = "SELECT * FROM data_cifen WHERE entreprise IS NOT NULL AND annee IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY maj_le DESC, row_id DESC) = 1"
SQL_STOCKS = "\nUNION ALL\n".join(f"SELECT entreprise, annee, '{c}' AS champ, {c} AS valeur FROM last WHERE {c} IS NOT NULL" for c in STOCKS)


@query(f"""
WITH last AS ({SQL_LATEST}), series AS ({SQL_STOCKS}),
pairs AS (SELECT *, lag(valeur) OVER w AS avant, lag(annee) OVER w AS annee_avant FROM series WINDOW w AS (PARTITION BY entreprise, champ ORDER BY annee))
SELECT entreprise, champ, annee_avant, annee, valeur, avant FROM pairs WHERE avant <> 0 AND (valeur / avant > 3.0 OR valeur / avant < 1 / 3.0::DOUBLE)""")
def stability_lag(spark: SparkSession, folder: str) -> DataFrame:
    """Jumps of the stock indicators between neighbouring available years."""
    series = latest(spark, folder, *STOCKS).unpivot(["entreprise", "annee"], STOCKS, "champ", "valeur")
    return R.stability(series, "entreprise", "annee", "valeur").select("entreprise", "champ", "annee_avant", "annee", "valeur", "avant")


#: Fixed value: fields a record must fill; and the fields of a collected file that count.
LEAST_FIELDS = 3
FILE_FIELDS = ["titre", "url_pdf", "type_detecte", "nb_pages", "taille_octets", "erreur"]
SQL_FIELDS = " + ".join(f"(coalesce(trim({c}::VARCHAR), '') <> '')::INTEGER" for c in FILE_FIELDS)


@query(f"SELECT cand_id, ({SQL_FIELDS})::INTEGER AS n_remplis FROM doc_candidates WHERE ({SQL_FIELDS}) < {LEAST_FIELDS}")
def completeness_score(spark: SparkSession, folder: str) -> DataFrame:
    """Collected files with fewer than three filled fields, keys aside; a blank text fills nothing."""
    df = table(spark, folder, "doc_candidates", "cand_id", *FILE_FIELDS)
    filled = sum(((F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "").cast("int") for c in FILE_FIELDS), F.lit(0))
    return df.where(R.few_filled(df, FILE_FIELDS, LEAST_FIELDS)).select("cand_id", filled.alias("n_remplis"))


@query("""
WITH b AS (""" + "\nUNION ALL\n".join(f"SELECT row_id, '{s}' AS severite FROM data_cifen WHERE {c}" for _, s, _, c in BOUNDS) + """)
SELECT entreprise AS dossier, count(*) FILTER (severite = 'ERREUR') AS erreurs, count(*) FILTER (severite = 'ALERTE') AS alertes
FROM b JOIN data_cifen USING (row_id) WHERE entreprise IS NOT NULL GROUP BY entreprise""")
def severity_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Errors and alerts of each company."""
    df = facts(spark, folder, "entreprise", "actif_total_general", "passif_a", "passif_c", "cpc_iii", "cpc_i_3", "cpc_ii", "cpc_ii_5").where("entreprise is not null")
    hits = F.explode(F.array_compact(F.array(*[F.when(F.expr(c), F.lit(s)) for _, s, _, c in BOUNDS])))
    return df.select(F.col("entreprise").alias("dossier"), hits.alias("s")).groupBy("dossier").agg(
        F.count(F.when(F.col("s") == "ERREUR", 1)).alias("erreurs"), F.count(F.when(F.col("s") == "ALERTE", 1)).alias("alertes")
    )


@query(f"""
WITH last AS ({SQL_LATEST}), b AS (
{chr(10).join(('UNION ALL ' if i else '') + f"SELECT entreprise, annee, '{r}' AS regle, '{s}' AS severite, '{f}' AS champ FROM last WHERE {c}" for i, (r, s, f, c) in enumerate(BOUNDS))}
UNION ALL SELECT entreprise, annee, 'R1', CASE WHEN abs(cpc_iii + (cpc_i - cpc_ii)) <= 2 THEN 'ERREUR' ELSE 'ALERTE' END, 'cpc_iii' FROM last WHERE abs(cpc_iii - (cpc_i - cpc_ii)) > 2)
SELECT entreprise AS dossier, regle, severite, champ, 'exercice ' || annee AS message FROM b""")
def plausibility_report(spark: SparkSession, folder: str) -> DataFrame:
    """All row rules in one report (dossier, regle, severite, champ, message)."""
    df = latest(spark, folder, "actif_total_general", "passif_a", "passif_c", "cpc_iii", "cpc_i", "cpc_i_3", "cpc_ii", "cpc_ii_5")
    hit = lambda r, s, f: F.struct(F.lit(r).alias("regle"), s.alias("severite"), F.lit(f).alias("champ"))
    sign = R.sign_check(F.col("cpc_iii"), F.col("cpc_i"), F.col("cpc_ii"))
    hits = [F.when(F.expr(c), hit(r, F.lit(s), f)) for r, s, f, c in BOUNDS] + [F.when(sign.isNotNull(), hit("R1", sign, "cpc_iii"))]
    found = df.select(F.col("entreprise").alias("dossier"), "annee", F.inline(F.array_compact(F.array(*hits))))
    return found.select("dossier", "regle", "severite", "champ", F.concat(F.lit("exercice "), F.col("annee").cast("string")).alias("message"))


@query("""SELECT row_id, annee, actif_total_general, passif_total_general FROM data_cifen WHERE entreprise = (SELECT min(nom) FROM emetteurs)""")
def company_zoom(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of one company: the first of the list."""
    first = table(spark, folder, "emetteurs", "nom").agg(F.min("nom").alias("entreprise"))
    return table(spark, folder, "data_cifen", "row_id", "entreprise", "annee", "actif_total_general", "passif_total_general").join(F.broadcast(first), "entreprise", "left_semi").drop("entreprise")

"""Collected report files: the best of each year, missing years, decisions, states of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.scores import first_year, last_year, title_score, title_score_light, title_score_ordered
from ledgerlake.functions.text import norm_name_delete, unaccent
from ledgerlake.operators import select as S
from ledgerlake.plans.catalog import query
from ledgerlake.session import broadcast_if_small
from ledgerlake.sources.tables import table

FIRST_YEAR, LAST_YEAR, LEAST_TITLE, LARGE = 2016, 2026, 60, 20
EXPECTED = (2015, 2024)
#: What a verdict leads to; any other keeps the original.
ACTIONS = {"OK_REEL": "remplacer", "A_VERIFIER": "verifier", "SUSPECT_ANNONCE": "rejeter"}


def candidates(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "doc_candidates", *columns)


@query(f"""
SELECT entreprise, annee, cand_id, score FROM doc_candidates WHERE score >= {LEAST_TITLE} AND annee BETWEEN {FIRST_YEAR} AND {LAST_YEAR}
QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY score DESC, cand_id) = 1""")
def best_doc_per_year(spark: SparkSession, folder: str) -> DataFrame:
    """Highest title score of each company and year, the first collected of equals, as a partial aggregate."""
    docs = candidates(spark, folder, "entreprise", "annee", "cand_id", "score").where((F.col("score") >= LEAST_TITLE) & F.col("annee").between(FIRST_YEAR, LAST_YEAR))
    return docs.groupBy("entreprise", "annee").agg(F.max(F.struct("score", (-F.col("cand_id")).alias("c"))).alias("b")).select("entreprise", "annee", (-F.col("b.c")).alias("cand_id"), F.col("b.score").alias("score"))


SQL_PAGES = "CASE WHEN nb_pages >= 0 THEN nb_pages END"


@query(f"""
SELECT entreprise, annee, cand_id, nb_pages FROM doc_candidates WHERE annee IS NOT NULL AND ({SQL_PAGES}) IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY nb_pages, est_local DESC, cand_id) = 1""")
def lightest_candidate(spark: SparkSession, folder: str) -> DataFrame:
    """Fewest pages of each company and year; a local copy wins a tie; -1 means unknown and is never the fewest."""
    docs = candidates(spark, folder, "entreprise", "annee", "cand_id", "nb_pages", "est_local").where("annee is not null and nb_pages >= 0")
    best = docs.groupBy("entreprise", "annee").agg(F.min(F.struct("nb_pages", (~F.col("est_local")).alias("l"), "cand_id")).alias("b"))
    return best.select("entreprise", "annee", "b.cand_id", "b.nb_pages")


@query("""
SELECT entreprise, annee, cand_id, nb_pages FROM doc_candidates WHERE annee IS NOT NULL AND nb_pages >= 0 AND type_detecte = 'rfa' AND coalesce(erreur, '') = ''
QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY nb_pages, cand_id) = 1""")
def lightest_confirmed(spark: SparkSession, folder: str) -> DataFrame:
    """The same among readable annual reports."""
    docs = candidates(spark, folder, "entreprise", "annee", "cand_id", "nb_pages", "type_detecte", "erreur").where("annee is not null and nb_pages >= 0 and type_detecte = 'rfa' and coalesce(erreur, '') = ''")
    best = docs.groupBy("entreprise", "annee").agg(F.min(F.struct("nb_pages", "cand_id")).alias("b"))
    return best.select("entreprise", "annee", "b.cand_id", "b.nb_pages")


@query("""
SELECT entreprise, annee, cand_id, nb_pages FROM doc_candidates WHERE annee IS NOT NULL AND nb_pages > 1 AND NOT est_local AND score BETWEEN 60 AND 100
QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY nb_pages, cand_id) = 1""")
def alternative_candidate(spark: SparkSession, folder: str) -> DataFrame:
    """The lightest file online with more than a page and a sound title."""
    docs = candidates(spark, folder, "entreprise", "annee", "cand_id", "nb_pages", "est_local", "score").where("annee is not null and nb_pages > 1 and not est_local and score between 60 and 100")
    return S.top(docs, ["entreprise", "annee"], [F.col("nb_pages"), F.col("cand_id")]).select("entreprise", "annee", "cand_id", "nb_pages")


@query(f"""
SELECT source, count(*) FILTER (nb_pages >= {LARGE}) AS volumineux, count(*) FILTER (nb_pages > {LARGE}) AS refuses, count(*) FILTER (nb_pages = 1) AS pages_uniques,
  count(*) FILTER (taille_octets / 1048576.0 > 5) AS trop_lourds FROM doc_candidates GROUP BY source""")
def large_report_gates(spark: SparkSession, folder: str) -> DataFrame:
    """Detection counts a report of exactly twenty pages as large, the batch gate does not; pages and size by source."""
    return candidates(spark, folder, "source", "nb_pages", "taille_octets").groupBy("source").agg(
        F.count(F.when(F.col("nb_pages") >= LARGE, 1)).alias("volumineux"), F.count(F.when(F.col("nb_pages") > LARGE, 1)).alias("refuses"),
        F.count(F.when(F.col("nb_pages") == 1, 1)).alias("pages_uniques"), F.count(F.when(F.col("taille_octets") / 1048576.0 > 5, 1)).alias("trop_lourds"),
    )


SQL_VERDICT = "CASE WHEN coalesce(erreur, '') <> '' OR nb_pages < 0 THEN 'ILLISIBLE' WHEN nb_pages IS NULL THEN 'A_VERIFIER' WHEN nb_pages = 1 AND type_detecte = 'com' THEN 'SUSPECT_ANNONCE' WHEN nb_pages >= 10 AND score BETWEEN 60 AND 100 THEN 'OK_REEL' ELSE 'A_VERIFIER' END"


def verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder, "cand_id", "entreprise", "annee", "source", "titre", "erreur", "nb_pages", "type_detecte", "score").withColumn("verdict", F.expr(SQL_VERDICT))


@query(f"""WITH v AS (SELECT {SQL_VERDICT} AS verdict FROM doc_candidates) SELECT verdict, count(*) AS n FROM v GROUP BY verdict""")
def verdict_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts and how often they fall."""
    return verdicts(spark, folder).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH v AS (SELECT *, {SQL_VERDICT} AS verdict FROM doc_candidates),
d AS (SELECT entreprise, annee, verdict, cand_id FROM v WHERE source = 'bourse' AND annee IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY cand_id) = 1),
o AS (SELECT entreprise, annee, CASE WHEN type_detecte = 'rfa' THEN 'remplacer' WHEN type_detecte = 'com' THEN 'rejeter' END AS action, nullif(titre, '') AS raison FROM v
  WHERE source = 'regulateur' AND annee IS NOT NULL AND type_detecte IN ('rfa', 'com') QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY cand_id DESC) = 1)
SELECT d.entreprise, d.annee, d.verdict, coalesce(o.action, CASE d.verdict WHEN 'OK_REEL' THEN 'remplacer' WHEN 'A_VERIFIER' THEN 'verifier' WHEN 'SUSPECT_ANNONCE' THEN 'rejeter' END, 'garder_original') AS action,
  coalesce('OVERRIDE MANUEL ' || o.raison, 'automatique') AS raison
FROM d LEFT JOIN o USING (entreprise, annee)""")
def override_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Automatic decisions with manual ones over them, field by field; the last valid override of a key counts."""
    v = verdicts(spark, folder).where("annee is not null")
    decisions = S.top(v.where("source = 'bourse'"), ["entreprise", "annee"], [F.col("cand_id")]).select("entreprise", "annee", "verdict")
    valid = v.where("source = 'regulateur' and type_detecte in ('rfa', 'com')").withColumn("o_action", F.when(F.col("type_detecte") == "rfa", "remplacer").otherwise("rejeter"))
    overrides = S.last_wins(valid.withColumn("o_raison", F.nullif("titre", F.lit(""))), ["entreprise", "annee"], F.col("cand_id"), ["o_action", "o_raison"])
    mapped = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])[F.col("verdict")]
    return decisions.join(overrides, ["entreprise", "annee"], "left").select(
        "entreprise", "annee", "verdict", F.coalesce("o_action", mapped, F.lit("garder_original")).alias("action"), F.coalesce(F.concat(F.lit("OVERRIDE MANUEL "), F.col("o_raison")), F.lit("automatique")).alias("raison")
    )


def present_years(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder, "entreprise", "annee").where(F.col("annee").between(*EXPECTED)).distinct()


SQL_PRESENT = f"SELECT DISTINCT entreprise, annee FROM doc_candidates WHERE annee BETWEEN {EXPECTED[0]} AND {EXPECTED[1]}"
SQL_MISSING = f"SELECT e.entreprise, a.annee FROM (SELECT DISTINCT entreprise FROM present) e CROSS JOIN (SELECT unnest(range({EXPECTED[0]}, {EXPECTED[1] + 1}))::INTEGER AS annee) a ANTI JOIN present p ON p.entreprise = e.entreprise AND p.annee = a.annee"


def missing(spark: SparkSession, folder: str) -> DataFrame:
    """One set of present years for each company, subtracted from the expected ones: no join is needed."""
    years = present_years(spark, folder).groupBy("entreprise").agg(F.collect_set("annee").alias("la"))
    return years.withColumn("manque", F.array_except(F.sequence(F.lit(EXPECTED[0]), F.lit(EXPECTED[1])), "la"))


@query(f"WITH present AS ({SQL_PRESENT}) {SQL_MISSING}")
def missing_years(spark: SparkSession, folder: str) -> DataFrame:
    """Expected years without a file, of companies that have one at all."""
    return missing(spark, folder).select("entreprise", F.explode("manque").alias("annee"))


@query(f"""
WITH present AS ({SQL_PRESENT}), m AS ({SQL_MISSING})
SELECT entreprise, count(*) AS n_manquantes, string_agg(annee::VARCHAR, ', ' ORDER BY annee) AS annees_manquantes FROM m GROUP BY entreprise""")
def missing_years_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a list for each company, most missing first."""
    lists = missing(spark, folder).where(F.size("manque") > 0).select("entreprise", F.size("manque").cast("bigint").alias("n_manquantes"), F.array_join(F.array_sort("manque"), ", ").alias("annees_manquantes"))
    return lists.orderBy(F.desc("n_manquantes"), "entreprise")


@query(f"""
WITH present AS ({SQL_PRESENT}), m AS ({SQL_MISSING}),
best AS (SELECT entreprise, year(publie_le)::INTEGER AS annee, max(doc_id) AS doc_id FROM documents WHERE entreprise IS NOT NULL GROUP BY ALL)
SELECT m.entreprise, m.annee, CASE WHEN doc_id IS NULL THEN 'Introuvable' ELSE 'Succès' END AS statut FROM m LEFT JOIN best USING (entreprise, annee)""")
def missing_request_status(spark: SparkSession, folder: str) -> DataFrame:
    """Requests for missing years against what was found elsewhere."""
    best = table(spark, folder, "documents", "entreprise", "publie_le", "doc_id").where("entreprise is not null").groupBy("entreprise", F.year("publie_le").alias("annee")).agg(F.max("doc_id").alias("doc_id"))
    return missing_years(spark, folder).join(best, ["entreprise", "annee"], "left").select("entreprise", "annee", F.when(F.col("doc_id").isNull(), "Introuvable").otherwise("Succès").alias("statut"))


@query("""
WITH u AS (SELECT nom, url_fiche FROM emetteurs QUALIFY row_number() OVER (PARTITION BY nom ORDER BY ticker DESC) = 1), n AS (SELECT DISTINCT entreprise FROM data_cifen WHERE entreprise IS NOT NULL)
SELECT entreprise, url_fiche, url_fiche IS NOT NULL AS resolu FROM n LEFT JOIN u ON nom = entreprise""")
def name_url_map(spark: SparkSession, folder: str) -> DataFrame:
    """Names to addresses; the last of repeated names counts, unresolved names are told."""
    urls = S.last_wins(table(spark, folder, "emetteurs", "nom", "ticker", "url_fiche"), ["nom"], F.col("ticker"), ["url_fiche"]).withColumnRenamed("nom", "entreprise")
    names = table(spark, folder, "data_cifen", "entreprise").where("entreprise is not null").distinct()
    return names.join(broadcast_if_small(urls, 200_000), "entreprise", "left").select("entreprise", "url_fiche", F.col("url_fiche").isNotNull().alias("resolu"))


SQL_KEY = "trim(regexp_replace(regexp_replace(translate(lower({c}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"


@query(f"""
WITH n AS (SELECT DISTINCT entreprise AS nom, {SQL_KEY.format(c='entreprise')} AS cle FROM data_cifen WHERE entreprise IS NOT NULL),
e AS (SELECT nom AS trouve, {SQL_KEY.format(c='nom')} AS cle, ticker AS ordre FROM emetteurs),
p AS (SELECT n.nom, e.trouve, CASE WHEN n.cle = e.cle THEN 0 ELSE 1 END AS rang, e.ordre FROM n JOIN e ON n.cle <> '' AND e.cle <> '' AND (contains(n.cle, e.cle) OR contains(e.cle, n.cle)))
SELECT n.nom, trouve FROM n LEFT JOIN (SELECT nom, trouve FROM p QUALIFY row_number() OVER (PARTITION BY nom ORDER BY rang, ordre) = 1) USING (nom)""")
def name_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """Exact name first, else the first name of which one contains the other."""
    asked = table(spark, folder, "data_cifen", "entreprise").where("entreprise is not null").distinct().select(F.col("entreprise").alias("nom"), norm_name_delete(F.col("entreprise")).alias("cle"))
    known = table(spark, folder, "emetteurs", "nom", "ticker").select(F.col("nom").alias("trouve"), norm_name_delete(F.col("nom")).alias("cle"), F.col("ticker").alias("ordre"))
    pairs = S.contained_names(asked, known).withColumn("rang", (F.col("cle") != F.col("cle_trouve")).cast("int"))
    best = pairs.groupBy("nom").agg(F.min_by("trouve", F.struct("rang", "ordre")).alias("trouve"))
    return asked.select("nom").join(best, "nom", "left")


SQL_WORDS = "list_distinct(list_filter(string_split(" + SQL_KEY + ", ' '), lambda w: length(w) >= 3))"


@query(f"""
WITH q AS (SELECT DISTINCT entreprise AS nom, {SQL_WORDS.format(c='entreprise')} AS mots FROM data_cifen WHERE entreprise IS NOT NULL), p AS (SELECT nom AS page, {SQL_WORDS.format(c='nom')} AS mots FROM emetteurs),
w AS (SELECT nom, len(mots) AS taille, unnest(mots) AS mot FROM q), v AS (SELECT DISTINCT page, unnest(mots) AS mot FROM p)
SELECT nom, page, count(*) AS communs FROM w JOIN v USING (mot) GROUP BY nom, page, taille HAVING count(*) >= 0.9 * taille""")
def token_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that hold at least nine tenths of a spelling's words of three letters or more: words meet by an index, so only
    names with a word in common are compared."""
    words = lambda c: F.array_distinct(F.filter(F.split(norm_name_delete(c), " "), lambda w: F.length(w) >= 3))
    asked = table(spark, folder, "data_cifen", F.col("entreprise").alias("nom")).where("nom is not null").distinct().withColumn("mots", words(F.col("nom")))
    pages = table(spark, folder, "emetteurs", F.col("nom").alias("page")).distinct().select("page", F.explode(words(F.col("page"))).alias("mot"))
    common = asked.select("nom", F.size("mots").alias("taille"), F.explode("mots").alias("mot")).join(pages, "mot").groupBy("nom", "page", "taille").agg(F.count(F.lit(1)).alias("communs"))
    return common.where(F.col("communs") >= 0.9 * F.col("taille")).select("nom", "page", "communs")


@query("SELECT cand_id, entreprise FROM doc_candidates d WHERE EXISTS (SELECT 1 FROM doc_candidates f WHERE coalesce(f.erreur, '') <> '' AND f.url_pdf = d.url_pdf)")
def retry_semi(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs whose file is in the list of failures."""
    failed = candidates(spark, folder, "url_pdf", "erreur").where("coalesce(erreur, '') <> ''").select("url_pdf")
    return candidates(spark, folder, "cand_id", "entreprise", "url_pdf").join(failed, "url_pdf", "left_semi").select("cand_id", "entreprise")


@query("SELECT cand_id, entreprise FROM doc_candidates d WHERE NOT EXISTS (SELECT 1 FROM doc_candidates f WHERE f.est_local AND f.entreprise = d.entreprise AND f.annee = d.annee)")
def resume_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs that no finished one covers."""
    done = candidates(spark, folder, "entreprise", "annee", "est_local").where("est_local").select("entreprise", "annee")
    return candidates(spark, folder, "cand_id", "entreprise", "annee").join(done, ["entreprise", "annee"], "left_anti").select("cand_id", "entreprise")


SQL_STATUS = f"CASE WHEN est_local THEN 'SKIPPED' WHEN nb_pages > {LARGE * 5} THEN 'SKIPPED_LARGE' WHEN coalesce(erreur, '') <> '' OR nb_pages < 0 THEN 'FAILED' ELSE 'SUCCESS' END"


@query(f"WITH s AS (SELECT {SQL_STATUS} AS statut, nb_pages FROM doc_candidates) SELECT statut, count(*) AS n, coalesce(sum(CASE WHEN nb_pages > 0 THEN nb_pages END), 0)::BIGINT AS pages FROM s GROUP BY statut")
def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """States of the batch jobs, in the order of their weight."""
    rank = F.expr("case statut when 'FAILED' then 0 when 'SKIPPED_LARGE' then 1 when 'SKIPPED' then 2 else 3 end")
    states = candidates(spark, folder, "est_local", "nb_pages", "erreur").withColumn("statut", F.expr(SQL_STATUS))
    return states.groupBy("statut").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(F.col("nb_pages") > 0, F.col("nb_pages"))), F.lit(0)).alias("pages")).orderBy(rank)


SQL_FLAGS = {"SANS_ANNEE": "annee IS NULL", "ANNEE_IMPOSSIBLE": "annee NOT BETWEEN 2000 AND 2030", "SCORE_FAIBLE": "score < 60", "SCORE_IMPOSSIBLE": "score > 100", "PAGES_INCONNUES": "nb_pages IS NULL OR nb_pages < 1", "TYPE_INCONNU": "type_detecte = 'inconnu'", "ERREUR": "coalesce(erreur, '') <> ''"}
SQL_FLAG_LIST = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, c in SQL_FLAGS.items()) + "], lambda f: f IS NOT NULL)"


def flags():
    return F.array_compact(F.array(*[F.when(F.expr(c), F.lit(f)) for f, c in SQL_FLAGS.items()]))


@query(f"SELECT cand_id, array_to_string({SQL_FLAG_LIST}, '; ') AS drapeaux FROM doc_candidates WHERE len({SQL_FLAG_LIST}) > 0")
def audit_flags(spark: SparkSession, folder: str) -> DataFrame:
    """What is doubtful about each file."""
    return candidates(spark, folder, "cand_id", "annee", "score", "nb_pages", "type_detecte", "erreur").select("cand_id", flags().alias("f")).where(F.size("f") > 0).select("cand_id", F.array_join("f", "; ").alias("drapeaux"))


@query(f"WITH f AS (SELECT unnest({SQL_FLAG_LIST}) AS drapeau FROM doc_candidates) SELECT drapeau, count(*) AS n FROM f GROUP BY drapeau")
def flag_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Doubts by how often they occur."""
    return candidates(spark, folder, "annee", "score", "nb_pages", "type_detecte", "erreur").select(F.explode(flags()).alias("drapeau")).groupBy("drapeau").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "drapeau")


SQL_TITLE = "translate(lower(titre), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy')"


def sql_title_scores() -> str:
    from ledgerlake.functions.scores import SHORT_PERIODS, TITLE_ORDER, TITLE_WEIGHTS

    q = lambda p: p.replace("'", "''")
    v1 = "greatest(0, " + ", ".join(f"CASE WHEN contains({SQL_TITLE}, '{q(p)}') THEN {w} ELSE 0 END" for p, w in TITLE_WEIGHTS.items()) + ")"
    v2 = "CASE " + " ".join(f"WHEN contains({SQL_TITLE}, '{q(p)}') THEN {w}" for p, w in [*((p, 100 - 5 * i) for i, p in enumerate(TITLE_ORDER)), *SHORT_PERIODS.items()]) + " ELSE 0 END"
    return f"SELECT cand_id, {v1} AS score_1, {v2} AS score_2 FROM doc_candidates"


def sql_title_light() -> str:
    from ledgerlake.functions.scores import TITLE_WEIGHTS_LIGHT

    return "SELECT cand_id, greatest(0, " + ", ".join(f"CASE WHEN contains({SQL_TITLE}, '{p}') THEN {w} ELSE 0 END" for p, w in TITLE_WEIGHTS_LIGHT.items()) + ") AS score_3 FROM doc_candidates"


@query(sql_title_scores())
def title_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Two scores of a title."""
    t = unaccent(F.col("titre"))
    return candidates(spark, folder, "cand_id", "titre").select("cand_id", title_score(t).alias("score_1"), title_score_ordered(t).alias("score_2"))


@query(sql_title_light())
def title_scores_light(spark: SparkSession, folder: str) -> DataFrame:
    """Third score of a title, beside ``title_scores``."""
    return candidates(spark, folder, "cand_id", "titre").select("cand_id", title_score_light(unaccent(F.col("titre"))).alias("score_3"))


@query("""
SELECT cand_id, nullif(regexp_extract(titre, '(20\\d{2})', 1), '')::INTEGER AS premiere, nullif(regexp_extract(concat_ws(' ', titre, url_pdf), '(20\\d{2})', 1), '')::INTEGER AS premiere_url,
  regexp_extract_all(titre, '(20\\d{2})', 1)[-1]::INTEGER AS derniere FROM doc_candidates""")
def year_extract_first_last(spark: SparkSession, folder: str) -> DataFrame:
    """The three ways a year is read: first of the title, first of title and address, last of the title."""
    return candidates(spark, folder, "cand_id", "titre", "url_pdf").select("cand_id", first_year(F.col("titre")).alias("premiere"), first_year(F.concat_ws(" ", "titre", "url_pdf")).alias("premiere_url"), last_year(F.col("titre")).alias("derniere"))


@query("SELECT entreprise, annee, count(*) AS n FROM doc_candidates WHERE entreprise IS NOT NULL GROUP BY entreprise, annee HAVING count(*) > 1")
def dup_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that occur more than once."""
    return candidates(spark, folder, "entreprise", "annee").where("entreprise is not null").groupBy("entreprise", "annee").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("""
WITH c AS (SELECT entreprise, type_detecte, count(*) AS n, min(cand_id) AS p FROM doc_candidates WHERE type_detecte IS NOT NULL GROUP BY ALL)
SELECT entreprise, type_detecte, n FROM c QUALIFY row_number() OVER (PARTITION BY entreprise ORDER BY n DESC, p) = 1""")
def majority_type(spark: SparkSession, folder: str) -> DataFrame:
    """Most frequent type of each company; of equals the first seen."""
    return S.majority(candidates(spark, folder, "entreprise", "type_detecte", "cand_id"), ["entreprise"], "type_detecte", "cand_id")


@query("""
SELECT entreprise, arg_max(titre, {'l': length(regexp_replace(titre, '\\s', '', 'g')), 'p': -cand_id}) AS titre_long, arg_min(url_pdf, cand_id) FILTER (url_pdf IS NOT NULL) AS premier_url FROM doc_candidates GROUP BY entreprise""")
def longest_and_first(spark: SparkSession, folder: str) -> DataFrame:
    """Title with most characters that are no blanks, and the first address that is there."""
    docs = candidates(spark, folder, "entreprise", "titre", "url_pdf", "cand_id")
    size = F.length(F.regexp_replace("titre", r"\s", ""))
    return docs.groupBy("entreprise").agg(F.max_by("titre", F.struct(size, -F.col("cand_id"))).alias("titre_long"), F.min_by(F.col("url_pdf"), F.when(F.col("url_pdf").isNotNull(), F.col("cand_id"))).alias("premier_url"))


@query(f"""
WITH b AS (SELECT entreprise, annee, max(nb_pages) FILTER (est_local AND nb_pages > 0) AS avant, min(nb_pages) FILTER (NOT est_local AND nb_pages > 1) AS apres FROM doc_candidates WHERE annee IS NOT NULL GROUP BY ALL)
SELECT CASE WHEN avant IS NULL THEN 'SANS_LOCAL' WHEN apres IS NULL OR apres >= avant THEN 'GARDE' ELSE 'REMPLACE' END AS statut, count(*) AS n,
  coalesce(sum(CASE WHEN apres < avant THEN avant - apres END), 0)::BIGINT AS pages_gagnees FROM b GROUP BY 1""")
def replacement_recap(spark: SparkSession, folder: str) -> DataFrame:
    """Plan of replacements by lighter files and the pages it saves; nothing is moved."""
    local, online = F.when(F.col("est_local") & (F.col("nb_pages") > 0), F.col("nb_pages")), F.when(~F.col("est_local") & (F.col("nb_pages") > 1), F.col("nb_pages"))
    pairs = candidates(spark, folder, "entreprise", "annee", "est_local", "nb_pages").where("annee is not null").groupBy("entreprise", "annee").agg(F.max(local).alias("avant"), F.min(online).alias("apres"))
    state = F.when(F.col("avant").isNull(), "SANS_LOCAL").when(F.col("apres").isNull() | (F.col("apres") >= F.col("avant")), "GARDE").otherwise("REMPLACE")
    return pairs.groupBy(state.alias("statut")).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(F.col("apres") < F.col("avant"), F.col("avant") - F.col("apres"))), F.lit(0)).alias("pages_gagnees"))


@query("""
WITH r AS (SELECT DISTINCT entreprise, annee FROM documents WHERE entreprise IS NOT NULL AND annee IS NOT NULL),
c AS (SELECT r.entreprise, r.annee, d.cand_id, CASE WHEN d.type_detecte = 'rfa' THEN 0 WHEN contains(lower(d.titre), 'exercice') AND NOT contains(lower(d.titre), 'semestr') THEN 1 END AS rang
  FROM r JOIN doc_candidates d USING (entreprise, annee))
SELECT entreprise, annee, cand_id, rang FROM c WHERE rang IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entreprise, annee ORDER BY rang, cand_id) = 1""")
def request_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Requests grouped by company: an annual report first, else a file of the year that is no half-year one."""
    requests = table(spark, folder, "documents", "entreprise", "annee").where("entreprise is not null and annee is not null").distinct()
    title = F.lower("titre")
    rank = F.when(F.col("type_detecte") == "rfa", 0).when(title.contains("exercice") & ~title.contains("semestr"), 1)
    offers = candidates(spark, folder, "entreprise", "annee", "cand_id", "titre", "type_detecte").withColumn("rang", rank).where("rang is not null")
    best = requests.join(offers, ["entreprise", "annee"]).groupBy("entreprise", "annee").agg(F.min(F.struct("rang", "cand_id")).alias("b"))
    return best.select("entreprise", "annee", "b.cand_id", "b.rang")

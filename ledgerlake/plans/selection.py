"""Selections and their audit: verdicts on whole documents, doubts about chosen tables, wanted companies, years in common."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import scores as K
from ledgerlake.functions import text as T
from ledgerlake.operators import rules as R
from ledgerlake.plans.catalog import query
from ledgerlake.plans.texts import SQL_NORM, SQL_SCORES, documents, sql_count, sql_plain
from ledgerlake.sources.files import table_rows
from ledgerlake.sources.tables import table

#: Statements a report holds, how many make it real, pages up to which tables are looked for.
STATEMENTS, LEAST_STATEMENTS, TABLE_PAGES = ("bilan_actif", "bilan_passif", "cpc"), 2, 15
#: Thresholds of the audit of selected tables, and phrases of the sections that a whole statement shows.
LOW_CONFIDENCE, FEW_KEYWORDS, AMBIGUOUS = 0.5, 2, 8
SECTIONS = {
    "bilan_actif": ["actif immobilise", "actif circulant", "tresorerie actif"],
    "bilan_passif": ["capitaux propres", "dettes de financement", "passif circulant", "tresorerie passif"],
    "cpc": ["compte de produits et charges", "produits d exploitation", "charges d exploitation", "resultat d exploitation"],
}
#: Texts of which a company's name must hold one, in capitals.
WANTED = ["CIMENT", "BANQUE", "TEXTILE"]
#: Companies of a limited run.
COMPANIES = 5

SQL_STATES = "(" + " + ".join(f"({c} >= {K.LEAST_SCORE})::INTEGER" for c in STATEMENTS) + ")"


@query(f"""
WITH d AS (SELECT doc_id, source, n, n_pages, len(regexp_extract_all(text, '(?i)<tr\\b')) >= 3 AS tableau FROM ({SQL_NORM}) JOIN (SELECT doc_id, text, n_pages FROM documents) USING (doc_id)),
s AS (SELECT *, {SQL_SCORES}, {sql_count(K.ANNOUNCEMENTS)} >= 1 AS annonce FROM d), e AS (SELECT *, {SQL_STATES} AS etats FROM s)
SELECT doc_id, etats, CASE WHEN annonce AND etats = 0 THEN 'FAKE_ANNONCE' WHEN etats >= {LEAST_STATEMENTS} AND (coalesce(n_pages, 0) > {TABLE_PAGES} OR tableau) THEN 'OK_REEL' ELSE 'A_VERIFIER' END AS verdict FROM e""")
def content_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on a document of any length by the statements it holds; a table is asked for up to fifteen pages only, an
    unknown number of pages counting as few."""
    d = documents(spark, folder, "text", "n_pages").where("text is not null").select("doc_id", T.norm_words(F.col("text")).alias("n"), (F.regexp_count("text", F.lit(r"(?i)<tr\b")) >= 3).alias("tableau"), F.coalesce("n_pages", F.lit(0)).alias("pages"))
    states = sum(((K.weighted_score(F.col("n"), K.CATEGORIES[c]) >= K.LEAST_SCORE).cast("int") for c in STATEMENTS), F.lit(0))
    e = d.select("doc_id", "tableau", "pages", states.alias("etats"), (K.count_of(F.col("n"), K.ANNOUNCEMENTS) >= 1).alias("annonce"))
    real = (F.col("etats") >= LEAST_STATEMENTS) & ((F.col("pages") > TABLE_PAGES) | F.col("tableau"))
    return e.select("doc_id", "etats", F.when(F.col("annonce") & (F.col("etats") == 0), "FAKE_ANNONCE").when(real, "OK_REEL").otherwise("A_VERIFIER").alias("verdict"))


def sql_flags(category: str) -> str:
    others = [c for c in K.CATEGORIES if c != category]
    rival = f"greatest({', '.join(others)})"
    tests = {
        "LOW_CONFIDENCE": f"{category} < {LOW_CONFIDENCE * 100}", "FEW_KEYWORDS": f"{sql_count(list(K.CATEGORIES[category]))} < {FEW_KEYWORDS}", "NOT_TABULAR": "NOT tableau",
        "NARROW_SUBTABLE": f"{sql_count(SECTIONS[category])} < 1" if category in SECTIONS else "false", "SERIE_CONFLICT": "consolide AND social",
        "PARTIAL_UNRESOLVED": "NOT complet" if category == "bilan_actif" else "false", "AMBIGUOUS_SCORE": f"{category} - {rival} <= {AMBIGUOUS}", "CROSS_SIGNAL": f"{rival} > {category}", "MULTI_SERIE_AMBIGUOUS": "deux_series",
    }
    found = ", ".join(f"CASE WHEN {c} THEN '{f}' END" for f, c in tests.items())
    return f"SELECT doc_id, '{category}' AS categorie, {category} AS score, CASE WHEN {category} = 0 THEN 'NON_TROUVE' ELSE array_to_string(list_filter([{found}], lambda f: f IS NOT NULL), '; ') END AS drapeaux FROM s"


SQL_COMPLETE = f"(contains(n, '{K.BALANCE_TOTAL}') OR (" + " AND ".join(f"{sql_count(p)} >= 1" for p in K.BALANCE_GROUPS.values()) + "))"
SQL_CONSOLIDATED = f"({sql_count(K.STRONG_MARKERS)} >= 1 OR {sql_count(K.WEAK_MARKERS)} >= 2)"
SQL_SOCIAL = "(contains(n, 'comptes sociaux') OR contains(n, 'exercice social'))"


@query(f"""
WITH d AS (SELECT doc_id, n, len(regexp_extract_all(text, '(?i)<tr\\b')) >= 3 AS tableau FROM ({SQL_NORM}) JOIN (SELECT doc_id, text FROM documents) USING (doc_id)),
s AS (SELECT *, {SQL_SCORES}, {SQL_COMPLETE} AS complet, {SQL_CONSOLIDATED} AS consolide, {SQL_SOCIAL} AS social, {SQL_CONSOLIDATED} AND contains(n, 'comptes sociaux') AS deux_series FROM d),
f AS ({" UNION ALL ".join(sql_flags(c) for c in K.CATEGORIES)})
SELECT * FROM f WHERE drapeaux <> ''""")
def selection_audit(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, categorie, score, drapeaux): what is doubtful about taking a document for each of its categories; a category
    without any keyword is not found, one without doubt has no row."""
    d = documents(spark, folder, "text").where("text is not null").select("doc_id", T.norm_words(F.col("text")).alias("n"), (F.regexp_count("text", F.lit(r"(?i)<tr\b")) >= 3).alias("tableau"))
    n = F.col("n")
    consolidated = (K.count_of(n, K.STRONG_MARKERS) >= 1) | (K.count_of(n, K.WEAK_MARKERS) >= 2)
    social = n.contains("comptes sociaux") | n.contains("exercice social")
    s = d.select("*", *[K.weighted_score(n, w).alias(c) for c, w in K.CATEGORIES.items()], K.balance_complete(n).alias("complet"), consolidated.alias("consolide"), social.alias("social"))

    def audit(category: str):
        rival = F.greatest(*[F.col(c) for c in K.CATEGORIES if c != category])
        tests = [
            ("LOW_CONFIDENCE", F.col(category) < LOW_CONFIDENCE * 100), ("FEW_KEYWORDS", K.count_of(n, list(K.CATEGORIES[category])) < FEW_KEYWORDS), ("NOT_TABULAR", ~F.col("tableau")),
            ("NARROW_SUBTABLE", K.count_of(n, SECTIONS[category]) < 1 if category in SECTIONS else F.lit(False)), ("SERIE_CONFLICT", F.col("consolide") & F.col("social")),
            ("PARTIAL_UNRESOLVED", ~F.col("complet") if category == "bilan_actif" else F.lit(False)), ("AMBIGUOUS_SCORE", F.col(category) - rival <= AMBIGUOUS), ("CROSS_SIGNAL", rival > F.col(category)),
            ("MULTI_SERIE_AMBIGUOUS", F.col("consolide") & n.contains("comptes sociaux")),
        ]
        flags = F.array_join(F.array_compact(F.array(*[F.when(test, F.lit(f)) for f, test in tests])), "; ")
        return F.struct(F.lit(category).alias("categorie"), F.col(category).alias("score"), F.when(F.col(category) == 0, "NON_TROUVE").otherwise(flags).alias("drapeaux"))

    return s.select("doc_id", F.inline(F.array(*[audit(c) for c in K.CATEGORIES]))).where("drapeaux <> ''")


@query("""
SELECT d.cand_id, d.source, s.rang, CASE WHEN d.source IS NULL THEN 'NON_TROUVE' WHEN s.source IS NULL THEN 'TABLE_ID_INCOHERENT' ELSE 'OK' END AS etat
FROM doc_candidates d LEFT JOIN (SELECT source, min(rang) AS rang FROM sources_collecte GROUP BY source) s USING (source)""")
def selection_detail(spark: SparkSession, folder: str) -> DataFrame:
    """A chosen id with its detail: without id nothing was found, an id without detail is incoherent."""
    detail = table(spark, folder, "sources_collecte").groupBy("source").agg(F.min("rang").alias("rang"), F.lit(True).alias("la"))
    joined = table(spark, folder, "doc_candidates", "cand_id", "source").join(detail, "source", "left")
    return joined.select("cand_id", "source", "rang", F.when(F.col("source").isNull(), "NON_TROUVE").when(F.col("la").isNull(), "TABLE_ID_INCOHERENT").otherwise("OK").alias("etat"))


@query("SELECT cand_id, entreprise FROM doc_candidates WHERE " + " OR ".join(f"contains(upper(entreprise), '{w}')" for w in WANTED))
def wanted_companies(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of companies whose name holds a wanted text; a null name holds none."""
    name = F.upper("entreprise")
    return table(spark, folder, "doc_candidates", "cand_id", "entreprise").where(F.exists(F.array(*map(F.lit, WANTED)), lambda w: F.contains(name, w)))


@query(f"""
WITH few AS (SELECT DISTINCT entreprise FROM doc_candidates WHERE entreprise IS NOT NULL ORDER BY entreprise LIMIT {COMPANIES})
SELECT entreprise, count(*) AS n FROM doc_candidates JOIN few USING (entreprise) GROUP BY entreprise""")
def first_companies(spark: SparkSession, folder: str) -> DataFrame:
    """A run limited to the first companies by name: the limit is the feature."""
    counts = table(spark, folder, "doc_candidates", "entreprise").where("entreprise is not null").groupBy("entreprise").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("entreprise").limit(COMPANIES)


@query("""
WITH a AS (SELECT DISTINCT entreprise, annee FROM data_cifen WHERE annee IS NOT NULL), b AS (SELECT DISTINCT entreprise, annee FROM extracted_fields WHERE annee IS NOT NULL)
SELECT entreprise, count(*) AS communes, min(annee) AS premiere, max(annee) AS derniere FROM a JOIN b USING (entreprise, annee) GROUP BY entreprise""")
def common_years(spark: SparkSession, folder: str) -> DataFrame:
    """Years that both tables hold of a company: intersection of the two sets."""
    years = lambda name: table(spark, folder, name, "entreprise", "annee").where("entreprise is not null and annee is not null")
    both = years("data_cifen").intersect(years("extracted_fields"))
    return both.groupBy("entreprise").agg(F.count(F.lit(1)).alias("communes"), F.min("annee").alias("premiere"), F.max("annee").alias("derniere"))


@query("SELECT row_id, CASE WHEN actif_f IS NULL OR isnan(actif_f) THEN '' ELSE printf('%.2f', actif_f) END AS texte FROM data_cifen")
def format_value(spark: SparkSession, folder: str) -> DataFrame:
    """An amount as text with two decimals, blank where there is none."""
    value = F.col("actif_f")
    return table(spark, folder, "data_cifen", "row_id", "actif_f").select("row_id", F.when(value.isNull() | F.isnan(value), "").otherwise(F.format_string("%.2f", value)).alias("texte"))


@query(f"SELECT nom, trim(regexp_replace(regexp_replace(lower(strip_accents({sql_plain('nom')})), '[^\\x00-\\x7f]', '', 'g'), '[^a-z0-9]+', ' ', 'g')) AS cle FROM (SELECT DISTINCT entreprise AS nom FROM data_cifen WHERE entreprise IS NOT NULL)")
def identifier_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names for the search of identifiers: what is no ASCII letter after unmarking is dropped, the rest parts words."""
    names = table(spark, folder, "data_cifen", F.col("entreprise").alias("nom")).where("nom is not null").distinct()
    return names.select("nom", F.trim(F.regexp_replace(F.regexp_replace(T.decomposed(F.col("nom")), r"[^\x00-\x7f]", ""), "[^a-z0-9]+", " ")).alias("cle"))


@query(f"""
WITH d AS ({SQL_NORM}), s AS (SELECT coalesce(source, '') AS source, {SQL_SCORES} FROM d),
b AS (SELECT source, {", ".join(f"max({c}) AS {c}" for c in K.CATEGORIES)} FROM s GROUP BY source)
SELECT source, {" + ".join(f"({c} >= {K.LEAST_SCORE})::BIGINT" for c in K.CATEGORIES)} AS couvertes, ({" + ".join(K.CATEGORIES)})::BIGINT AS somme FROM b ORDER BY couvertes DESC, somme DESC, source LIMIT 1""")
def best_series_choice(spark: SparkSession, folder: str) -> DataFrame:
    """The source that covers most categories, then with the largest sum of best scores, then the first by name."""
    from ledgerlake.plans.texts import best_series

    rank = F.struct((-F.col("couvertes")).alias("c"), (-F.col("somme")).alias("s"), "source")
    return best_series(spark, folder).groupBy().agg(F.min(rank).alias("b")).where("b is not null").select("b.source", (-F.col("b.c")).alias("couvertes"), (-F.col("b.s")).alias("somme"))


SQL_CELL = "trim(regexp_replace(regexp_replace(c, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""
WITH r AS (SELECT doc_id, regexp_extract_all(text, '(?is)<tr\\b[^>]*>(.*?)</tr>', 1) AS r FROM documents WHERE text IS NOT NULL), e AS (SELECT doc_id, generate_subscripts(r, 1) - 1 AS rang, unnest(r) AS r FROM r)
SELECT doc_id, rang::INTEGER AS rang, array_to_string(list_transform(regexp_extract_all(r, '(?is)<t[dh]\\b[^>]*>(.*?)</t[dh]>', 1), lambda c: {SQL_CELL}), '|') AS cellules FROM e""")
def html_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the tables in the passages, their cells parted by bars."""
    d = documents(spark, folder, "text").where("text is not null")
    return d.select("doc_id", F.posexplode(table_rows(F.col("text"))).alias("rang", "c")).select("doc_id", "rang", F.array_join("c", "|").alias("cellules"))


SQL_HEADS = "SELECT n_name AS pays, n_nationkey % 3 AS sorte, year(o_orderdate)::INTEGER AS an, sum(o_totalprice::DECIMAL(18,2))::DOUBLE / 1e3 AS charges, count(DISTINCT o_custkey) AS tetes FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"


@query(f"""
WITH b AS (SELECT pays, an, charges, CASE WHEN sorte = 0 THEN tetes END AS effectif, CASE WHEN sorte < 2 THEN tetes * 2 END AS groupe FROM ({SQL_HEADS})),
h AS (SELECT *, CASE WHEN count(effectif) OVER (PARTITION BY pays) > 0 THEN effectif ELSE groupe END AS tetes FROM b)
SELECT pays, an, charges * 1e6 / tetes AS par_tete FROM h WHERE tetes > 0 AND NOT charges * 1e6 / tetes BETWEEN {R.LEAST_COST} AND {R.MOST_COST}""")
def cost_per_head(spark: SparkSession, folder: str) -> DataFrame:
    """Costs per head out of bounds, on the orders of each nation and year as costs and its customers as heads; some
    nations state heads of their own, some of their group only, some none."""
    orders = table(spark, folder, "orders", "o_custkey", "o_orderdate", "o_totalprice").join(table(spark, folder, "customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    # customers of a year first, so that no nation's customers are in one place
    each = orders.groupBy("c_nationkey", F.year("o_orderdate").alias("an"), "o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t"))
    sums = each.groupBy("c_nationkey", "an").agg((F.sum("t").cast("double") / 1e3).alias("charges"), F.count(F.lit(1)).alias("tetes"))
    named = sums.join(table(spark, folder, "nation", "n_nationkey", F.col("n_name").alias("pays")), F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.col("n_nationkey") % 3
    stated = named.select("pays", "an", "charges", F.when(kind == 0, F.col("tetes")).alias("effectif"), F.when(kind < 2, F.col("tetes") * 2).alias("groupe"))
    return R.cost_per_head(stated, "pays", "an", "charges", "effectif", "groupe")

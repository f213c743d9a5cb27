"""Texts of documents: normalisers, keyword scores, markers, series context of blocks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions import scores as K
from ledgerlake.functions import text as T
from ledgerlake.operators import select as S
from ledgerlake.plans.catalog import query
from ledgerlake.sources.tables import table

A, B = T.LATIN1_MARKED, T.LATIN1_PLAIN
#: Blocks back to which a marker gives its series to a block, blocks ahead that may confirm a type.
CONTEXT, AHEAD, NEAR = 60, 3, 6


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents", "doc_id", *columns)


#: White space of any alphabet, for the SQL side; the byte-order mark and zero-width blanks are none.
SQL_SPACE = r"[\s\x0b\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def sql_plain(column: str) -> str:
    """Marks dropped and white space of any kind as one blank, for the SQL side."""
    return f"regexp_replace({column}, '{SQL_SPACE}', ' ', 'g')"


def sql_words(column: str) -> str:
    """The word normaliser over characters of any alphabet, for the SQL side."""
    return f"trim(regexp_replace(regexp_replace(lower(strip_accents({sql_plain(column)})), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def sq(column: str) -> str:
    """The word normaliser, for the SQL side."""
    return f"trim(regexp_replace(regexp_replace(translate(lower({column}), '{A}', '{B}'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""
WITH n AS (SELECT DISTINCT entreprise AS nom, {sql_plain('entreprise')} AS p FROM data_cifen WHERE entreprise IS NOT NULL)
SELECT nom, {sql_words('nom')} AS mots, trim(regexp_replace(translate(lower(p), '{A}', '{B}'), '\\s+', ' ', 'g')) AS avec_ponctuation,
  trim(regexp_replace(regexp_replace(translate(lower(p), '{A}', '{B}'), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')) AS sans,
  trim(regexp_replace(regexp_replace(regexp_replace(translate(lower(p), '{A}', '{B}'), '[''’]', '', 'g'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS espace
FROM n""")
def normalise_label(spark: SparkSession, folder: str) -> DataFrame:
    """Four normalisers side by side over every company spelling, with marks, blanks and signs of any alphabet; they differ
    in what punctuation becomes."""
    names = table(spark, folder, "data_cifen", F.col("entreprise").alias("nom")).where("nom is not null").distinct()
    n = T.plain_blanks(F.col("nom"))
    return names.select("nom", T.norm_words(T.decomposed(n)).alias("mots"), T.norm_keep_punctuation(n).alias("avec_ponctuation"), T.norm_name_delete(n).alias("sans"), T.norm_name_space(n).alias("espace"))


@query(f"""
WITH w AS (SELECT nom, string_split(trim(regexp_replace(regexp_replace(upper(translate(translate(lower(nom), '{A}', '{B}'), '_-', '  ')), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')), ' ') AS m FROM emetteurs)
SELECT nom, array_to_string(list_filter(m, lambda x: x NOT IN ({", ".join(f"'{w}'" for w in T.LEGAL_WORDS)})), ' ') AS cle FROM w""")
def normalise_issuer(spark: SparkSession, folder: str) -> DataFrame:
    """Issuer names without legal words."""
    return table(spark, folder, "emetteurs", "nom").select("nom", T.norm_issuer(F.col("nom")).alias("cle"))


def sql_score(weights: dict[str, int]) -> str:
    return "least(100, " + " + ".join(f"CASE WHEN contains(n, '{p}') THEN {w} ELSE 0 END" for p, w in weights.items()) + ")"


SQL_NORM = f"SELECT doc_id, source, {sq('text')} AS n FROM documents WHERE text IS NOT NULL"
SQL_SCORES = ", ".join(f"{sql_score(w)}::INTEGER AS {c}" for c, w in K.CATEGORIES.items())


@query(f"WITH d AS ({SQL_NORM}) SELECT doc_id, {SQL_SCORES} FROM d")
def keyword_score(spark: SparkSession, folder: str) -> DataFrame:
    """Capped keyword score of each category."""
    d = documents(spark, folder, "text").where("text is not null").select("doc_id", T.norm_words(F.col("text")).alias("n"))
    return d.select("doc_id", *[K.weighted_score(F.col("n"), w).alias(c) for c, w in K.CATEGORIES.items()])


@query(f"""
WITH d AS ({SQL_NORM}), s AS (SELECT doc_id, {SQL_SCORES} FROM d),
u AS (""" + " UNION ALL ".join(f"SELECT doc_id, '{c}' AS c, {i} AS i, {c} AS s FROM s" for i, c in enumerate(K.CATEGORIES)) + f"""),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, i) AS r FROM u)
SELECT a.doc_id, CASE WHEN a.s >= {K.LEAST_SCORE} AND a.s - b.s >= {K.LEAST_MARGIN} THEN a.c ELSE 'autre' END AS categorie, a.s AS score FROM r a JOIN r b ON a.doc_id = b.doc_id AND a.r = 1 AND b.r = 2""")
def category_margin(spark: SparkSession, folder: str) -> DataFrame:
    """Best category with its lead over the second."""
    d = documents(spark, folder, "text").where("text is not null").select("doc_id", T.norm_words(F.col("text")).alias("n"))
    category, score = K.best_category(F.col("n"))
    return d.select("doc_id", category.alias("categorie"), score.alias("score"))


def sql_count(phrases: list[str]) -> str:
    return "(" + " + ".join(f"contains(n, '{p}')::INTEGER" for p in phrases) + ")"


SQL_SERIES = f"CASE WHEN {sql_count(K.STRONG_MARKERS)} >= 1 OR {sql_count(K.WEAK_MARKERS)} >= 2 THEN 'consolide' WHEN contains(n, 'comptes sociaux') OR contains(n, 'exercice social') THEN 'social' END"


@query(f"""WITH d AS ({SQL_NORM}) SELECT doc_id, {sql_count(K.ESG_MARKERS)} >= 2 AS hors_sujet, {SQL_SERIES} AS serie, {sql_count(K.ANNOUNCEMENTS)} >= 1 AS annonce FROM d""")
def marker_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    """Off-topic pages, series of the accounts, announcements, by markers."""
    d = documents(spark, folder, "text").where("text is not null").select("doc_id", T.norm_words(F.col("text")).alias("n"))
    n = F.col("n")
    return d.select("doc_id", (K.count_of(n, K.ESG_MARKERS) >= 2).alias("hors_sujet"), K.series_of(n).alias("serie"), (K.count_of(n, K.ANNOUNCEMENTS) >= 1).alias("annonce"))


@query(f"""
WITH d AS ({SQL_NORM}), s AS (SELECT doc_id, coalesce(source, '') AS source, {SQL_SCORES} FROM d),
u AS (""" + " UNION ALL ".join(f"SELECT source, '{c}' AS c, {c} AS s FROM s" for c in K.CATEGORIES) + """),
b AS (SELECT source, c, max(s) AS m FROM u GROUP BY ALL)
SELECT source, count(*) FILTER (m >= 32) AS couvertes, sum(m)::BIGINT AS somme FROM b GROUP BY source""")
def best_series(spark: SparkSession, folder: str) -> DataFrame:
    """Categories each source covers and the sum of its best scores."""
    d = documents(spark, folder, "source", "text").where("text is not null").select(F.coalesce("source", F.lit("")).alias("source"), T.norm_words(F.col("text")).alias("n"))
    best = d.groupBy("source").agg(*[F.max(K.weighted_score(F.col("n"), w)).alias(c) for c, w in K.CATEGORIES.items()])
    covered = sum(((F.col(c) >= K.LEAST_SCORE).cast("bigint") for c in K.CATEGORIES), F.lit(0).cast("bigint"))
    total = sum((F.col(c).cast("bigint") for c in K.CATEGORIES), F.lit(0).cast("bigint"))
    return best.select("source", covered.alias("couvertes"), total.alias("somme"))


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the documents as ordered blocks."""
    d = documents(spark, folder, "text").where("text is not null")
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("bloc", "ligne")).withColumn("n", T.norm_words(F.col("ligne")))


def blocks_with(spark: SparkSession, folder: str, phrases: list[str]) -> DataFrame:
    """Those of the blocks that can hold one of the phrases: words outlast the normaliser, so lines without the longest word
    of any phrase need none. ``n`` comes out of a generator, or else every use of it would normalise the line anew."""
    d = documents(spark, folder, "text").where("text is not null").select("doc_id", F.split(T.unaccent(F.col("text")), "\n").alias("lignes"))
    may = lambda x: reduce(or_, [x.contains(w) for w in K.longest_words(phrases)])
    normal = F.transform("lignes", lambda x: F.when(may(x), F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))))
    return d.select("doc_id", F.posexplode(normal).alias("bloc", "n")).where("n is not null")


SQL_BLOCKS = f"""
lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
pos AS (SELECT doc_id, unnest(range(0, len(l)))::INTEGER AS bloc, unnest(l) AS ligne FROM lines),
blocks AS (SELECT doc_id, bloc, {sq('ligne')} AS n FROM pos)"""


@query(f"""
WITH {SQL_BLOCKS}, m AS (SELECT doc_id, bloc, {SQL_SERIES} AS marque FROM blocks),
w AS (SELECT doc_id, bloc, last_value(marque IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY bloc ROWS BETWEEN {CONTEXT} PRECEDING AND CURRENT ROW) AS serie, max(marque IS NOT NULL) OVER (PARTITION BY doc_id) AS marque_doc FROM m)
SELECT doc_id, bloc, serie, marque_doc FROM w""")
def series_context(spark: SparkSession, folder: str) -> DataFrame:
    """Series of each block: the nearest marker at most sixty blocks back; and whether the document has any."""
    b = blocks(spark, folder).select("doc_id", "bloc", K.series_of(F.col("n")).alias("marque"))
    back = Window.partitionBy("doc_id").orderBy("bloc").rowsBetween(-CONTEXT, 0)
    return b.select("doc_id", "bloc", F.last("marque", ignorenulls=True).over(back).alias("serie"), F.max(F.col("marque").isNotNull()).over(Window.partitionBy("doc_id")).alias("marque_doc"))


SQL_TYPE = "CASE WHEN contains(n, 'total de l actif') THEN 'bilan' WHEN contains(n, 'chiffre d affaires') THEN 'cpc' WHEN contains(n, 'tresorerie') THEN 'tresorerie' END"


def block_type() -> Column:
    n = F.col("n")
    return F.when(n.contains("total de l actif"), "bilan").when(n.contains("chiffre d affaires"), "cpc").when(n.contains("tresorerie"), "tresorerie")


@query(f"""
WITH {SQL_BLOCKS}, t AS (SELECT doc_id, bloc, {SQL_TYPE} AS genre FROM blocks), u AS (SELECT * FROM t WHERE genre IS NOT NULL)
SELECT doc_id, bloc, genre, coalesce(list_contains(list(genre) OVER (PARTITION BY doc_id ORDER BY bloc ROWS BETWEEN 1 FOLLOWING AND {AHEAD} FOLLOWING), 'cpc'), false) AS suivi FROM u""")
def neighbour_coherence(spark: SparkSession, folder: str) -> DataFrame:
    """Whether one of the next three typed blocks is an income statement."""
    typed = blocks(spark, folder).select("doc_id", "bloc", block_type().alias("genre")).where("genre is not null")
    ahead = Window.partitionBy("doc_id").orderBy("bloc").rowsBetween(1, AHEAD)
    return typed.select("doc_id", "bloc", "genre", F.array_contains(F.collect_list("genre").over(ahead), "cpc").alias("suivi"))


@query(f"""
WITH {SQL_BLOCKS}, t AS (SELECT doc_id, bloc, {SQL_TYPE} AS genre FROM blocks), u AS (SELECT * FROM t WHERE genre IS NOT NULL)
SELECT a.doc_id, a.bloc, b.bloc AS partenaire FROM u a JOIN u b ON a.doc_id = b.doc_id AND a.genre = 'bilan' AND b.genre <> 'bilan' AND abs(a.bloc - b.bloc) <= {NEAR}
QUALIFY row_number() OVER (PARTITION BY a.doc_id, a.bloc ORDER BY abs(a.bloc - b.bloc), b.bloc) = 1""")
def partner_search(spark: SparkSession, folder: str) -> DataFrame:
    """Nearest block of another type within six blocks, the earlier of two equally near: neighbours come from bounded
    frames, so a document with many blocks gives no pairs."""
    typed = blocks(spark, folder).select("doc_id", "bloc", block_type().alias("genre")).where("genre is not null")
    order = Window.partitionBy("doc_id").orderBy("bloc")
    other = F.when(F.col("genre") != "bilan", F.col("bloc"))
    near = typed.withColumn("avant", F.last(other, ignorenulls=True).over(order.rangeBetween(-NEAR, -1))).withColumn("apres", F.first(other, ignorenulls=True).over(order.rangeBetween(1, NEAR)))
    best = F.array_min(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col("bloc") - F.col(c)).alias("d"), F.col(c).alias("b"))) for c in ("avant", "apres")])))
    return near.where("genre = 'bilan'").select("doc_id", "bloc", best["b"].alias("partenaire")).where("partenaire is not null")


SQL_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents WHERE text IS NOT NULL"


@query(f"""
WITH l AS ({SQL_LINES}), a AS (SELECT doc_id, count(*) AS lignes, count(*) FILTER (trim(l) = '') AS blanches FROM l GROUP BY doc_id)
SELECT doc_id, lignes, blanches, CASE WHEN blanches >= 0.85 * lignes THEN 'SCANNE' WHEN blanches <= 0.15 * lignes THEN 'TEXTE' ELSE 'MIXTE' END AS classe FROM a""")
def blank_share_class(spark: SparkSession, folder: str) -> DataFrame:
    """Text or scan by the share of blank lines."""
    d = documents(spark, folder, "text").where("text is not null").select("doc_id", F.split("text", "\n").alias("l"))
    c = d.select("doc_id", F.size("l").cast("bigint").alias("lignes"), F.size(F.filter("l", lambda x: F.trim(x) == "")).cast("bigint").alias("blanches"))
    return c.withColumn("classe", F.when(F.col("blanches") >= 0.85 * F.col("lignes"), "SCANNE").when(F.col("blanches") <= 0.15 * F.col("lignes"), "TEXTE").otherwise("MIXTE"))


@query(f"""
WITH d AS ({SQL_NORM}), e AS (SELECT doc_id, length(n) AS taille, contains(n, 'total de l actif')::INTEGER + contains(n, 'total du passif')::INTEGER + contains(n, 'chiffre d affaires')::INTEGER AS etats, {sql_count(K.ANNOUNCEMENTS)} >= 1 AS annonce, contains(n, 'tableau') AS tableau FROM d)
SELECT doc_id, CASE WHEN taille < 50 THEN 'SCANNE_A_VERIFIER' WHEN annonce AND etats = 0 THEN 'FAKE_ANNONCE' WHEN etats >= 2 AND tableau THEN 'OK_REEL' ELSE 'A_VERIFIER' END AS verdict FROM e""")
def onepage_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on a page by its length, the statements it names, tables and announcements."""
    d = documents(spark, folder, "text").where("text is not null").select("doc_id", T.norm_words(F.col("text")).alias("n"))
    n = F.col("n")
    states = K.count_of(n, ["total de l actif", "total du passif", "chiffre d affaires"])
    verdict = F.when(F.length(n) < 50, "SCANNE_A_VERIFIER").when((K.count_of(n, K.ANNOUNCEMENTS) >= 1) & (states == 0), "FAKE_ANNONCE").when((states >= 2) & n.contains("tableau"), "OK_REEL").otherwise("A_VERIFIER")
    return d.select("doc_id", verdict.alias("verdict"))


@query(f"""
SELECT doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '{SQL_SPACE}', ' ', 'g')) AS texte, len(regexp_extract_all(text, '(?i)<tr\\b'))::INTEGER AS lignes,
  len(regexp_extract_all(text, '(?i)<tr\\b')) >= 3 AS tableau FROM documents WHERE text IS NOT NULL""")
def html_to_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text and table rows of every passage, and whether it has the three rows of a table; marks such as ``<|endoftext|>``
    are tags like any other."""
    d = documents(spark, folder, "text").where("text is not null")
    bare = F.regexp_replace(F.regexp_replace("text", r"<[^>]+>", " "), T.UNICODE_BLANKS, " ")
    return d.select("doc_id", F.trim(bare).alias("texte"), F.regexp_count("text", F.lit(r"(?i)<tr\b")).alias("lignes")).withColumn("tableau", F.col("lignes") >= 3)


#: An address of the web, up to a blank, quote or bracket; closing punctuation belongs to the sentence.
LINK, LINK_END = r"(?i)(?:https?://|www\.)[^\s<>\"\x{00a0}()\[\]]+", r"[.,;:!?»]+$"


@query(f"SELECT doc_id, regexp_replace(l, '{LINK_END}', '') AS lien FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{LINK}')) AS l FROM documents)")
def links(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of the web named in the texts."""
    found = documents(spark, folder, "text").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(LINK), F.lit(0))).alias("l"))
    return found.select("doc_id", F.regexp_replace("l", LINK_END, "").alias("lien"))


@query("""
SELECT p_partkey, regexp_replace(regexp_replace(p_name, '[\\\\/*?:"<>|]', '', 'g'), '\\s+', '_', 'g')[:120] AS fichier, floor(p_retailprice)::BIGINT AS prix FROM part""")
def clean_names(spark: SparkSession, folder: str) -> DataFrame:
    """File names out of part names."""
    return table(spark, folder, "part", "p_partkey", "p_name", "p_retailprice").select("p_partkey", T.clean_file_name(F.col("p_name")).alias("fichier"), F.floor("p_retailprice").alias("prix"))


TYPES = ["rfa", "comptes", "conso", "gestion", "semestre", "com"]
SQL_TYPES = ", ".join(f"{{'d': levenshtein(m, '{t}'), 'i': {i}, 'v': '{t}'}}" for i, t in enumerate(TYPES))


@query(f"""
WITH w AS (SELECT DISTINCT regexp_extract(lower(titre), '([a-z]{{3,}})', 1) AS m FROM doc_candidates), b AS (SELECT m, list_min([{SQL_TYPES}]) AS b FROM w WHERE m <> '')
SELECT m AS mot, CASE WHEN b.d <= 0.25 * length(m) THEN b.v END AS entree FROM b""")
def levenshtein_vocab(spark: SparkSession, folder: str) -> DataFrame:
    """First words of titles against a closed vocabulary."""
    words = table(spark, folder, "doc_candidates", "titre").select(F.regexp_extract(F.lower("titre"), "([a-z]{3,})", 1).alias("mot")).where("mot <> ''").distinct()
    return words.select("mot", K.nearest_word(F.col("mot"), TYPES).alias("entree"))


@query(f"""
WITH l AS (SELECT field_id, {sql_words('original_label')} AS n, coalesce(trim({sql_plain('value_current')}), '') = '' AND coalesce(trim({sql_plain('value_previous')}), '') = '' AS vide FROM extracted_fields WHERE bilan = 'CPC')
SELECT field_id, CASE WHEN coalesce(n, '') = '' THEN 'VIDE' WHEN starts_with(n, 'total') OR contains(n, 'cumul') THEN 'TOTAL' WHEN starts_with(n, 'resultat') OR starts_with(n, 'benefice') OR starts_with(n, 'solde') THEN 'RESULTAT' WHEN vide THEN 'TITRE_SECTION' ELSE 'DETAIL' END AS genre FROM l""")
def row_types(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of all rows of income statements, null labels and any characters included."""
    df = table(spark, folder, "extracted_fields", "field_id", "bilan", "original_label", "value_current", "value_previous").where("bilan = 'CPC'")
    empty = lambda c: F.trim(T.plain_blanks(F.coalesce(c, F.lit("")))) == ""
    label = T.norm_words(T.decomposed(T.plain_blanks(F.col("original_label"))))
    return df.select("field_id", label.alias("n"), (empty("value_current") & empty("value_previous")).alias("vide")).select("field_id", K.row_type(F.col("n"), F.col("vide")).alias("genre"))


@query("""
SELECT nom, capital, CASE WHEN regexp_matches(replace(replace(capital, ' ', ''), chr(160), ''), '^-?[0-9]+([.,][0-9]+)?$') THEN try_cast(replace(replace(replace(capital, ' ', ''), chr(160), ''), ',', '.') AS DOUBLE) END AS valeur FROM emetteurs""")
def capital_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Strict numbers of the capital column."""
    return table(spark, folder, "emetteurs", "nom", "capital").select("nom", "capital", K.clean_number(F.col("capital")).alias("valeur"))


DATE = "[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4}"


@query(f"""
WITH v AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '{DATE}')) AS d FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, d, regexp_extract(d, '^([0-9]+)', 1) AS j, regexp_extract(d, '^[0-9]+[./-]([0-9]+)', 1) AS m, regexp_extract(d, '([0-9]+)$', 1) AS a FROM v)
SELECT doc_id, d AS trouve, lpad(j, 2, '0') || '/' || lpad(m, 2, '0') || '/' || CASE length(a) WHEN 2 THEN CASE WHEN a::INTEGER > 30 THEN '19' ELSE '20' END || a WHEN 3 THEN '1' || a ELSE a END AS date
FROM p WHERE j::INTEGER BETWEEN 1 AND 31 AND m::INTEGER BETWEEN 1 AND 12""")
def dates_in_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Dates of the texts in one notation, years of two, three and four digits."""
    found = documents(spark, folder, "text").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(DATE), F.lit(0))).alias("trouve"))
    return found.distinct().select("doc_id", "trouve", K.extract_date(F.col("trouve")).alias("date")).where("date is not null")


@query(f"""
WITH d AS ({SQL_NORM}) SELECT doc_id, contains(n, '{K.BALANCE_TOTAL}') OR ({" AND ".join(f"{sql_count(p)} >= 1" for p in K.BALANCE_GROUPS.values())}) AS complet,
  CASE WHEN {sql_count(K.STRONG_MARKERS + K.WEAK_MARKERS)} > {sql_count(["comptes sociaux", "social", "sociaux"])} THEN 'consolide' WHEN {sql_count(["comptes sociaux", "social", "sociaux"])} > 0 THEN 'social' ELSE 'indetermine' END AS variante,
  {sql_count(K.COMMON_WORDS)} < 3 AS suspect FROM d""")
def page_state(spark: SparkSession, folder: str) -> DataFrame:
    """Completeness of a balance sheet, variant of the accounts, and whether the letters look misread."""
    d = documents(spark, folder, "text").where("text is not null").select("doc_id", T.norm_words(F.col("text")).alias("n"))
    n = F.col("n")
    return d.select("doc_id", K.balance_complete(n).alias("complet"), K.variant(n).alias("variante"), (K.count_of(n, K.COMMON_WORDS) < 3).alias("suspect"))


@query(f"""
WITH {SQL_BLOCKS}, s AS (SELECT doc_id, bloc, {sql_score(K.CATEGORIES['bilan_actif'])}::INTEGER + CASE WHEN contains(n, 'total de l actif') AND contains(n, 'total du passif') THEN 40 ELSE 0 END AS score, contains(n, 'consolid') AS conso FROM blocks),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY conso, score DESC, bloc) AS r FROM s WHERE score > 0)
SELECT doc_id, bloc, score FROM r WHERE r = 1""")
def best_page(spark: SparkSession, folder: str) -> DataFrame:
    """Best block of each document, with a bonus where both totals stand; blocks of the wanted variant first, any other only if there is none."""
    n = F.col("n")
    bonus = F.when(n.contains("total de l actif") & n.contains("total du passif"), 40).otherwise(0)
    scored = blocks_with(spark, folder, list(K.CATEGORIES["bilan_actif"])).select("doc_id", "bloc", (K.weighted_score(n, K.CATEGORIES["bilan_actif"]) + bonus).alias("score"), n.contains("consolid").alias("conso"))
    # no filter before the aggregate: it would be pushed below the score and have it computed twice
    best = scored.groupBy("doc_id").agg(F.min(F.when(F.col("score") > 0, F.struct("conso", (-F.col("score")).alias("s"), "bloc"))).alias("b")).where("b is not null")
    return best.select("doc_id", "b.bloc", (-F.col("b.s")).alias("score"))


@query(f"""
WITH {SQL_BLOCKS}, t AS (SELECT doc_id, bloc FROM blocks WHERE regexp_matches(n, '[0-9]')),
g AS (SELECT *, CASE WHEN bloc - lag(bloc) OVER (PARTITION BY doc_id ORDER BY bloc) > 2 THEN 1 ELSE 0 END AS b FROM t), h AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY bloc) AS run FROM g),
s AS (SELECT doc_id, run, min(bloc) AS debut, max(bloc) AS fin, count(*) AS n FROM h GROUP BY ALL)
SELECT doc_id, debut, fin, n FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, debut) = 1""")
def longest_block_run(spark: SparkSession, folder: str) -> DataFrame:
    """Longest run of blocks with numbers, gaps of one block allowed."""
    return S.longest_run(blocks(spark, folder).where(F.col("n").rlike("[0-9]")).select("doc_id", "bloc"), "doc_id", "bloc")


@query(r"""
SELECT * FROM (SELECT doc_id, nullif(regexp_extract(text, '\bRC (\d{3,8})\b', 1), '') AS rc, nullif(regexp_extract(text, '\bIF (\d{3,15})\b', 1), '') AS if, nullif(regexp_extract(text, '\bICE (\d{9,20})\b', 1), '') AS ice
FROM documents) WHERE coalesce(rc, if, ice) IS NOT NULL""")
def company_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers of companies stated in the texts, any of the three being enough; the first of each kind."""
    return documents(spark, folder, "text").select("doc_id", K.identifiers(F.col("text")).alias("i")).select("doc_id", "i.*").where("coalesce(rc, if, ice) is not null")


@query(f"""
WITH n AS (SELECT doc_id, entreprise, annee, {sq('text')} AS n FROM documents WHERE text IS NOT NULL AND entreprise IS NOT NULL AND annee IS NOT NULL),
w AS (SELECT unnest(['total du passif', 'capitaux propres', 'chiffre d affaires']) AS libelle), lacks AS (SELECT n.doc_id, n.entreprise, n.annee, w.libelle FROM n CROSS JOIN w WHERE NOT contains(n.n, w.libelle))
SELECT l.doc_id, l.libelle, min(o.doc_id) AS trouve_dans FROM lacks l JOIN n o ON l.entreprise = o.entreprise AND l.annee = o.annee AND contains(o.n, l.libelle) GROUP BY ALL""")
def missing_field_recovery(spark: SparkSession, folder: str) -> DataFrame:
    """For each label a document lacks, the first document of the same company and year that holds it: one row for each
    company, year and label is found first, so that no document meets another."""
    wanted = ["total du passif", "capitaux propres", "chiffre d affaires"]
    docs = documents(spark, folder, "entreprise", "annee", "text").where("text is not null and entreprise is not null and annee is not null").withColumn("n", T.norm_words(F.col("text")))
    each = docs.select("doc_id", "entreprise", "annee", F.inline(F.array(*[F.struct(F.lit(p).alias("libelle"), F.col("n").contains(p).alias("la")) for p in wanted])))
    holders = each.where("la").groupBy("entreprise", "annee", "libelle").agg(F.min("doc_id").alias("trouve_dans"))
    return each.where("not la").join(holders, ["entreprise", "annee", "libelle"]).select("doc_id", "libelle", "trouve_dans")

"""Problem 2: one surviving record for each report file, field by field.

The method: fields are unpivoted to long rows, every row votes for its normalised value with the trust in its source
times the decay of its age, the votes of a value are summed, the winner of each group and field is taken by ``max_by``,
and the winners are pivoted back. ``consensus`` sums the votes in doubles. ``strict`` is the same sum for a base of
trust and decay so large that every row outweighs all weaker ones together: such a sum no longer fits a double, but
its order is that of its leading term, the strongest row, so that term stands for the sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.parse import let
from ledgerlake.session import broadcast_if_small, written
from ledgerlake.sources.tables import table

#: Usable values of the three fields.
USABLE = {"annee": (2000, 2030), "nb_pages": (1, None), "score": (1, 100)}
#: Days in which a vote loses half its weight, and the factor between neighbouring ranks of trust.
HALF_LIFE_DAYS, TRUST_STEP = 180.0, 2.0
#: Marks that a download puts on a repeated file name, after folding of case and separators.
COPY_MARKS = r"(?:\s*(?:\(\d+\)|\[\d+\]|- ?(?:copie|copy)(?: ?\(\d+\))?|\bcopie(?: ?\(\d+\))?|\bcopy(?: ?\(\d+\))?))+$"
LOCAL_MARK = r"^\s*\[local\]\s*"


def unescape(text: Column) -> Column:
    """Percent escapes decoded as UTF-8 where they are well formed, else left; a plus sign stays."""
    safe = F.replace(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(F.contains(text, F.lit("%")), F.coalesce(F.try_url_decode(safe), text)).otherwise(text)


def file_key(url: Column, title: Column) -> Column:
    """What names a report's PDF: its file name without host, path, query, case, escapes, separators and copy marks.

    Rows without URL are named by the title. Null where neither holds a name. Every step is bound by ``let``, so that
    none is evaluated again by a branch that names it twice.
    """
    path = F.substring_index(F.substring_index(F.trim(url), "?", 1), "#", 1)
    from_url = F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)
    from_title = F.regexp_extract(F.regexp_replace(F.lower(title), LOCAL_MARK, ""), r"([^/\\]*)$", 1)
    decoded = let(let(from_url, unescape), unescape)
    raw = F.when(F.length(F.trim(F.coalesce(url, F.lit("")))) > 0, decoded).otherwise(from_title)
    name = F.regexp_replace(F.lower(F.trim(raw)), r"\.pdf(?=$|[\s(\[-])", "")
    flat = F.trim(F.regexp_replace(F.regexp_replace(name, r"[_+\s\u00a0]+", " "), r"(?<=\w)-(?=\w)", " "))
    bare = let(flat, lambda f: F.when(f.rlike(r"[)\]]$|cop(?:ie|y)"), F.regexp_replace(f, COPY_MARKS, "")).otherwise(f))
    return F.nullif(F.trim(F.regexp_replace(bare, r"[\s\-]+", " ")), F.lit(""))


def in_range(column: str) -> Column:
    low, high = USABLE[column]
    usable = F.col(column) >= low
    return usable if high is None else usable & (F.col(column) <= high)


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    """(cle, cand_id, rang, collecte_le, fields): candidates with the name of their file and the trust in their source,
    sources without rank last. Written once: the name is dear, and a filter on it would compute it again."""
    rows = table(spark, folder, "doc_candidates", "cand_id", "titre", "url_pdf", "source", "collecte_le", *USABLE).where("cand_id is not null")
    trust = table(spark, folder, "sources_collecte", "source", "rang").groupBy("source").agg(F.min("rang").alias("rang"))
    named = rows.select(file_key(F.col("url_pdf"), F.col("titre")).alias("cle"), "cand_id", "source", F.col("collecte_le").cast("timestamp").alias("collecte_le"), *USABLE)
    ranked = named.join(broadcast_if_small(trust), "source", "left").drop("source")
    return written(ranked.withColumn("rang", F.coalesce(F.col("rang").cast("long"), F.lit(1 << 30)))).where("cle is not null")


def long_votes(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(cle, champ, valeur, cand_id, rang, collecte_le): one row for each usable value, and one without field for each
    row, which counts the group."""
    cells = [F.struct(F.lit(c).alias("champ"), F.when(in_range(c), F.col(c).cast("long")).alias("valeur")) for c in fields]
    whole = F.struct(F.lit("").alias("champ"), F.lit(None).cast("long").alias("valeur"))
    return rows.select("cle", "cand_id", "rang", "collecte_le", F.inline(F.array(whole, *cells))).where("valeur is not null or champ = ''")


def weight() -> Column:
    """Trust of the source times recency of the collection; a row without time votes with next to nothing."""
    newest = F.unix_timestamp(F.lit("2030-01-01").cast("timestamp"))
    age = (newest - F.unix_timestamp("collecte_le")) / 86400.0
    return F.pow(F.lit(TRUST_STEP), -F.least(F.col("rang"), F.lit(60))) * F.pow(F.lit(0.5), F.coalesce(age, F.lit(1e6)) / HALF_LIFE_DAYS)


def summed_votes(votes: DataFrame, mode: str = "strict") -> DataFrame:
    """(cle, champ, valeur, vote, cand_id, lignes, groupe): the votes of each value, combined before the shuffle.

    ``vote`` orders the sums: their leading term (``strict``), or the sum in doubles and among equal sums the leading
    term (``consensus``). ``cand_id`` is the value's strongest row.
    """
    lead = F.max(F.struct(-F.col("rang"), F.coalesce("collecte_le", F.lit("0001-01-01").cast("timestamp")), -F.col("cand_id"))).alias("lead")
    total = F.sum(weight()) if mode == "consensus" else F.max(F.lit(0.0))
    sums = votes.groupBy("cle", "champ", "valeur").agg(lead, total.alias("total"), F.count(F.lit(1)).alias("lignes"), F.min("cand_id").alias("groupe"))
    return sums.select("cle", "champ", "valeur", F.struct("total", "lead").alias("vote"), (-F.col("lead.col3")).alias("cand_id"), "lignes", "groupe")


def survivors(rows: DataFrame, fields: list[str], mode: str = "strict") -> DataFrame:
    """(groupe, cle, lignes, and of each field its value and ``_cand_id``): one record for each file name.

    A field without usable value is null, and so is its row. A hot name is combined before each of the three shuffles.
    """
    sums = summed_votes(long_votes(rows, fields), mode)
    best = sums.groupBy("cle", "champ").agg(F.max_by(F.struct("valeur", "cand_id"), "vote").alias("b"), F.max("lignes").alias("lignes"), F.min("groupe").alias("groupe"))
    of = lambda c, value: F.max(F.when(F.col("champ") == c, value))
    picked = [x for c in fields for x in (of(c, F.col("b.valeur")).alias(c), of(c, F.col("b.cand_id")).alias(f"{c}_cand_id"))]
    return best.groupBy("cle").agg(of("", F.col("groupe")).alias("groupe"), of("", F.col("lignes")).alias("lignes"), *picked).select("groupe", "cle", "lignes", *[x for c in fields for x in (c, f"{c}_cand_id")])


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The row that supplies each field of each report with two rows or more: the surviving records, unpivoted.

    Rows whose file has no name take no part; repeated rows are rows; a field without usable value gives no row.
    """
    records = survivors(keyed(spark, folder), list(USABLE)).where("lignes >= 2")
    cells = F.array(*[F.struct(F.lit(c).alias("champ"), F.col(f"{c}_cand_id").alias("cand_id")) for c in USABLE])
    return records.select("groupe", F.inline(cells)).where("cand_id is not null")


def p2_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """One record for each report, single rows included: the winning value of each field and the row it comes from."""
    return survivors(keyed(spark, folder), list(USABLE))


def p2_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """Survivors by sums of trust and recency votes, in which many weak rows can outvote a strong one."""
    return survivors(keyed(spark, folder), list(USABLE), "consensus")

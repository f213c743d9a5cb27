"""Problem 5: profile of every column of every load, and what is wrong or has shifted since the load before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.profile import ks_distances, order_statistics, sorted_groups
from ledgerlake.session import collected, cut
from ledgerlake.sources.tables import nan_to_null, table

#: Thresholds of the findings, as the problem states them.
NULL_SHIFT, DISTINCT_RATIO, SCALE_RATIO, SCALE_LEAST, SPREAD = 0.25, 2.0, 30.0, 10, 0.5
KEY_COLUMNS = ["entreprise", "annee"]
#: Entries the account catalogue and the list of expectations may have, and columns a group key can tell apart.
MOST_ENTRIES, MOST_COLUMNS = 5_000, 256


def accounts(spark: SparkSession, folder: str) -> list[str]:
    """The account columns in catalogue order; the fixed catalogue bounds the list."""
    present = set(table(spark, folder, "data_cifen").columns)
    rows = collected(table(spark, folder, "champs_cifen", "section", "pos", "code").na.drop(), MOST_ENTRIES)
    return [c for c in dict.fromkeys(r.code.lower() for r in sorted(rows, key=lambda r: (r.section, r.pos))) if c in present]


def load_word(charge: Column) -> Column:
    """Upper 56 bits of a group key; the column's number takes the lower 8."""
    return F.xxhash64(charge).bitwiseAND(F.lit(~0xFF))


def unpivoted(df: DataFrame, columns: list[str], value) -> DataFrame:
    """(key, v): one row for each non-null value of the account columns."""
    if len(columns) > MOST_COLUMNS:
        raise ValueError("too many columns for the group key")
    each = df.select(load_word(F.col("charge_id")).alias("load"), F.posexplode(F.array(*[value(F.col(c)) for c in columns])).alias("pos", "v"))
    return each.where("v is not null and not isnan(v)").select(F.col("load").bitwiseOR(F.col("pos").cast("long")).alias("key"), "v")


def expectations(spark: SparkSession, folder: str, present: set[str]) -> list[tuple[str, str, Column]]:
    """(column, finding, violated) of each expectation on a column that exists; one row a column, so few."""
    out = []
    for r in sorted(collected(table(spark, folder, "profil_attendu").where("colonne is not null"), MOST_ENTRIES), key=lambda r: r.colonne):
        c = r.colonne.lower()
        if c not in present:
            continue
        if r.motif is not None:
            out.append((c, "motif", ~F.col(c).cast("string").rlike(r.motif)))
        least, most = (F.col(c) < F.lit(r.borne_min), F.col(c) > F.lit(r.borne_max))
        bounds = [x for x, b in ((least, r.borne_min), (most, r.borne_max)) if b is not None and b == b]
        if bounds:
            out.append((c, "bornes", bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]))
    return out


def load_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """One row for each load: rows, non-null counts of the key columns, violations; one narrow scan."""
    df = table(spark, folder, "data_cifen")
    checks = expectations(spark, folder, set(df.columns))
    found = df.groupBy("charge_id").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{c}") for c in KEY_COLUMNS],
        *[F.coalesce(F.max(bad.cast("int")), F.lit(0)).alias(f"x{i}") for i, (_, _, bad) in enumerate(checks)],
    )
    return found, [(c, kind) for c, kind, _ in checks]


def key_histograms(spark: SparkSession, folder: str, columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """(charge_id, colonne, valeur, n) of the key columns; equal values are combined before the shuffle."""
    df = table(spark, folder, "data_cifen", *dict.fromkeys(["charge_id", *columns]))
    pairs = F.array(*[F.struct(F.lit(c).alias("colonne"), F.col(c).cast("string").alias("valeur")) for c in columns])
    return df.select("charge_id", F.inline(pairs)).where("valeur is not null").groupBy("charge_id", "colonne", "valeur").agg(F.count(F.lit(1)).alias("n"))


def profile_grid(spark: SparkSession, folder: str, probabilities: list[float], value=F.abs) -> DataFrame:
    """(charge_id, charge_prec, colonne, compte, rows, n, uniques, lo, hi, q) for every load and column, written once."""
    names = accounts(spark, folder)
    df = table(spark, folder, "data_cifen", "charge_id", *names)
    groups = sorted_groups(unpivoted(df, names, value), probabilities, df.count() * len(names))
    stats = order_statistics(groups, probabilities)
    loads, _ = load_rows(spark, folder)
    chain = table(spark, folder, "charges", "charge_id", "charge_prec").dropDuplicates(["charge_id"])
    loads = loads.join(chain, "charge_id", "left")
    numbered = F.posexplode(F.array(*[F.lit(c) for c in names])).alias("pos", "colonne")
    grid = loads.select("charge_id", "charge_prec", "rows", numbered).withColumn("key", load_word(F.col("charge_id")).bitwiseOR(F.col("pos").cast("long")))
    wide = grid.join(stats, "key", "left").select(
        "charge_id", "charge_prec", "colonne", F.lit(True).alias("compte"), "rows", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("uniques", F.lit(0)).alias("uniques"), "lo", "hi", "q"
    )
    distinct = key_histograms(spark, folder).groupBy("charge_id", "colonne").agg(F.count(F.lit(1)).alias("uniques"))
    key_rows = loads.select(
        "charge_id", "charge_prec", "rows", F.inline(F.array(*[F.struct(F.lit(c).alias("colonne"), F.col(f"n_{c}").alias("n")) for c in KEY_COLUMNS]))
    ).join(distinct, ["charge_id", "colonne"], "left")
    none = F.lit(None).cast("double")
    keys = key_rows.select(
        "charge_id", "charge_prec", "colonne", F.lit(False).alias("compte"), "rows", "n", F.coalesce("uniques", F.lit(0)).alias("uniques"), none.alias("lo"), none.alias("hi"), F.lit(None).cast("array<double>").alias("q")
    )
    return cut(wide.unionByName(keys))


def spread(spark: SparkSession, folder: str, columns: list[str] = KEY_COLUMNS) -> DataFrame:
    """(charge_id, colonne, distance): half the L1 distance between the shares of a key column in a load and the one before."""
    shares = key_histograms(spark, folder, columns)
    total = shares.groupBy("charge_id", "colonne").agg(F.sum("n").alias("t"))
    shares = shares.join(total, ["charge_id", "colonne"]).select("charge_id", "colonne", "valeur", (F.col("n") / F.col("t")).alias("p"))
    chain = table(spark, folder, "charges", "charge_id", "charge_prec").dropDuplicates(["charge_id"]).where("charge_prec is not null")
    filled = total.select("charge_id", "colonne")
    pairs = chain.join(filled, "charge_id").join(filled.withColumnRenamed("charge_id", "charge_prec"), ["charge_prec", "colonne"]).select("charge_id", "charge_prec", "colonne")
    now = pairs.join(shares, ["charge_id", "colonne"]).select("charge_id", "colonne", "valeur", "p")
    before = pairs.join(shares.withColumnRenamed("charge_id", "charge_prec"), ["charge_prec", "colonne"]).select("charge_id", "colonne", "valeur", (-F.col("p")).alias("p"))
    apart = now.unionByName(before).groupBy("charge_id", "colonne", "valeur").agg(F.sum("p").alias("d"))
    return apart.groupBy("charge_id", "colonne").agg((F.sum(F.abs("d")) / 2).alias("distance"))


def findings(spark: SparkSession, folder: str) -> DataFrame:
    """(charge_id, colonne, constat), each at most once.

    A load without rows, without an earlier load, or whose earlier load has no rows has no comparing finding. NaN
    counts as null. Columns that no expectation names and columns beyond the catalogue are not judged.
    """
    loads, checks = load_rows(spark, folder)
    broken = F.filter(
        F.array(*[F.when(F.col(f"x{i}") == 1, F.struct(F.lit(c).alias("colonne"), F.lit(kind).alias("constat"))) for i, (c, kind) in enumerate(checks)]),
        lambda s: s.isNotNull(),
    ) if checks else F.array().cast("array<struct<colonne:string,constat:string>>")
    own = loads.select("charge_id", F.inline(broken))
    grid = profile_grid(spark, folder, [0.5]).withColumn("median", F.element_at("q", 1))
    past = grid.select(F.col("charge_id").alias("charge_prec"), "colonne", F.col("rows").alias("rows0"), F.col("n").alias("n0"), F.col("uniques").alias("u0"), F.col("median").alias("m0"))
    both = grid.join(past, ["charge_prec", "colonne"])
    nulls = F.abs((F.col("rows") - F.col("n")) / F.col("rows") - (F.col("rows0") - F.col("n0")) / F.col("rows0")) > NULL_SHIFT
    distinct = ~F.col("compte") & ((F.col("uniques") * DISTINCT_RATIO < F.col("u0")) | (F.col("uniques") > F.col("u0") * DISTINCT_RATIO))
    scale = F.col("compte") & (F.least("n", "n0") >= SCALE_LEAST) & ((F.col("median") > F.col("m0") * SCALE_RATIO) | (F.col("m0") > F.col("median") * SCALE_RATIO))
    shifted = both.select(
        "charge_id", "colonne", F.explode(F.array_compact(F.array(F.when(nulls, "nuls"), F.when(distinct, "distincts"), F.when(scale, "echelle")))).alias("constat")
    )
    moved = spread(spark, folder).where((F.col("distance") > SPREAD + 1e-12) & (F.col("colonne") == "annee")).select("charge_id", "colonne", F.lit("repartition").alias("constat"))
    return own.unionByName(shifted).unionByName(moved)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return findings(spark, folder)


#: Quartiles of the profile; those of texts are the first value, by value order, up to which that share of the rows lies.
QUARTILES = [0.25, 0.5, 0.75]


def as_number(c: str, kind: T.DataType) -> Column:
    """A number of the range sort: microseconds of a time, days of a date, whole numbers exact up to 2^53."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return (F.unix_date(c) if isinstance(kind, T.DateType) else F.col(c)).cast("double")


def other_columns(spark: SparkSession, folder: str) -> tuple[dict[str, T.DataType], list[str]]:
    """The columns beyond the accounts: those with an order of numbers, and the texts (any other kind is read as text)."""
    known = set(accounts(spark, folder))
    kinds = {f.name: f.dataType for f in table(spark, folder, "data_cifen").schema if f.name not in known}
    numbers = {c: k for c, k in kinds.items() if isinstance(k, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType))}
    return numbers, [c for c in kinds if c not in numbers]


def text_statistics(df: DataFrame, texts: list[str], first: int) -> DataFrame:
    """(key, n, uniques, lo, hi, q) of the text columns out of their histograms; values are combined before the shuffle."""
    each = df.select(load_word(F.col("charge_id")).alias("load"), F.posexplode(F.array(*[F.col(c).cast("string") for c in texts])).alias("pos", "v")).where("v is not null")
    counts = each.groupBy(F.col("load").bitwiseOR((F.col("pos") + first).cast("long")).alias("key"), "v").agg(F.count(F.lit(1)).alias("c"))
    total = counts.groupBy("key").agg(F.sum("c").alias("n"))
    upto = F.sum("c").over(Window.partitionBy("key").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    q = F.array(*[F.min(F.when(F.col("upto") >= F.col("n") * p, F.col("v"))) for p in QUARTILES])
    return counts.withColumn("upto", upto).join(total, "key").groupBy("key").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("uniques"), F.min("v").alias("lo"), F.max("v").alias("hi"), q.alias("q"))


def violations(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[tuple[str, str], str]]:
    """One row for each load: its rows, and of each expectation how many break it; and the count's name by (column, kind)."""
    df = nan_to_null(table(spark, folder, "data_cifen"))
    broken: dict[tuple[str, str], Column] = {}
    for c, kind, bad in expectations(spark, folder, set(df.columns)):
        broken[c, kind] = broken[c, kind] | bad if (c, kind) in broken else bad
    names = {k: f"x{i}" for i, k in enumerate(broken)}
    return df.groupBy("charge_id").agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(names[k]) for k, bad in broken.items()]), names


def p5_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of every load: rows, nulls, distincts, range, quartiles, broken expectations, distance to the load before.

    Ranges and quartiles of numbers and times (seconds since 1970) are in the plain columns, those of texts in the columns
    ``_texte``. Counts of violations are null where nothing is expected of a column. The distance is Kolmogorov-Smirnov's
    for numbers, half the L1 distance of the shares for ``annee`` and texts; NaN counts as null.
    """
    names = accounts(spark, folder)
    kinds, texts = other_columns(spark, folder)
    measured = [*names, *kinds]
    source = table(spark, folder, "data_cifen")
    df = source.select("charge_id", *names, *[as_number(c, k).alias(c) for c, k in kinds.items()])
    # one sort: a group holds the values of its load and, as its old sample, those of the load before
    chain = table(spark, folder, "charges", "charge_id", "charge_prec").dropDuplicates(["charge_id"]).where("charge_prec is not null")
    earlier = df.withColumnRenamed("charge_id", "charge_prec").join(chain, "charge_prec")
    now, before = (unpivoted(part, measured, lambda c: c).withColumn("old", F.lit(old)) for part, old in ((df, False), (earlier, True)))
    groups = sorted_groups(now.unionByName(before), QUARTILES, 2 * df.count() * len(measured))
    stats, ks = order_statistics(groups, QUARTILES), ks_distances(groups)
    worded = text_statistics(source.select(*texts), texts, len(measured))
    blank, void = F.lit(None).cast("double"), F.lit(None).cast("string")
    stats = stats.select("key", "n", "uniques", "lo", "hi", "q", void.alias("lo_t"), void.alias("hi_t"), F.lit(None).cast("array<string>").alias("q_t")).unionByName(
        worded.select("key", "n", "uniques", blank.alias("lo"), blank.alias("hi"), F.lit(None).cast("array<double>").alias("q"), F.col("lo").alias("lo_t"), F.col("hi").alias("hi_t"), F.col("q").alias("q_t"))
    )
    loads, broken = violations(spark, folder)
    count = lambda c, kind: F.col(broken[c, kind]) if (c, kind) in broken else F.lit(None).cast("long")
    times = [c for c, k in kinds.items() if isinstance(k, (T.TimestampType, T.TimestampNTZType))]
    each = [
        F.struct(F.lit(c).alias("colonne"), F.lit(i).alias("pos"), F.lit(1e6 if c in times else 1.0).alias("par"), count(c, "motif").alias("hors_motif"), count(c, "bornes").alias("hors_bornes"))
        for i, c in enumerate([*measured, *texts])
    ]
    grid = loads.select("charge_id", "rows", F.inline(F.array(*each))).withColumn("key", load_word(F.col("charge_id")).bitwiseOR(F.col("pos").cast("long")))
    rest = F.col("rows") - F.coalesce("n", F.lit(0))
    number = lambda c: (c / F.col("par"))
    return (
        grid.join(stats, "key", "left").join(ks, "key", "left").join(spread(spark, folder, ["annee", *texts]), ["charge_id", "colonne"], "left")
        .select(
            "charge_id", "colonne", F.col("rows").alias("lignes"), rest.alias("nuls"), (rest / F.col("rows")).alias("part_nuls"), F.coalesce("uniques", F.lit(0)).alias("distincts"),
            number(F.col("lo")).alias("minimum"), *[number(F.get("q", F.lit(i))).alias(a) for i, a in enumerate(("q25", "mediane", "q75"))], number(F.col("hi")).alias("maximum"),
            F.col("lo_t").alias("minimum_texte"), *[F.get("q_t", F.lit(i)).alias(f"{a}_texte") for i, a in enumerate(("q25", "mediane", "q75"))], F.col("hi_t").alias("maximum_texte"),
            "hors_motif", "hors_bornes", F.coalesce("distance", "ks").alias("distance_charge_prec"),
        )
    )


#: The findings as SQL, for the comparison: whole tables, no sketch.
P5_FOUND = """
WITH a AS (SELECT charge_id, colonne, v FROM (SELECT * EXCLUDE (row_id, entreprise, annee, maj_le) FROM data_cifen) UNPIVOT INCLUDE NULLS (v FOR colonne IN (COLUMNS(* EXCLUDE (charge_id))))),
acc AS (SELECT charge_id, colonne, count(*) AS lignes, count(v) FILTER (NOT isnan(v)) AS n, median(abs(v)) FILTER (NOT isnan(v)) AS m, 0 AS u, true AS compte FROM a GROUP BY charge_id, colonne),
k AS (SELECT charge_id, 'entreprise' AS colonne, count(*) AS lignes, count(entreprise) AS n, NULL AS m, count(DISTINCT entreprise) AS u, false AS compte FROM data_cifen GROUP BY charge_id
  UNION ALL SELECT charge_id, 'annee', count(*), count(annee), NULL, count(DISTINCT annee), false FROM data_cifen GROUP BY charge_id),
g AS (SELECT * FROM acc UNION ALL SELECT * FROM k),
p AS (SELECT n.*, o.lignes AS lignes0, o.n AS n0, o.m AS m0, o.u AS u0 FROM g n JOIN charges c USING (charge_id) JOIN g o ON o.charge_id = c.charge_prec AND o.colonne = n.colonne),
s AS (SELECT charge_id, annee, count(*) AS c, sum(count(*)) OVER (PARTITION BY charge_id) AS t FROM data_cifen WHERE annee IS NOT NULL GROUP BY charge_id, annee),
pairs AS (SELECT charge_id, charge_prec FROM charges WHERE charge_id IN (SELECT charge_id FROM s) AND charge_prec IN (SELECT charge_id FROM s)),
d AS (SELECT charge_id, sum(abs(d)) / 2 AS d FROM (SELECT charge_id, annee, sum(p) AS d FROM (
  SELECT pairs.charge_id, annee, c / t AS p FROM pairs JOIN s USING (charge_id) UNION ALL SELECT pairs.charge_id, annee, -(c / t) FROM pairs JOIN s ON s.charge_id = pairs.charge_prec) GROUP BY charge_id, annee) GROUP BY charge_id),
e AS (SELECT colonne, motif, borne_min, borne_max FROM profil_attendu),
b AS (SELECT charge_id, colonne, v FROM a WHERE NOT isnan(v) UNION ALL SELECT charge_id, 'annee', annee::DOUBLE FROM data_cifen WHERE annee IS NOT NULL)
SELECT DISTINCT charge_id, 'entreprise' AS colonne, 'motif' AS constat FROM data_cifen JOIN e ON e.colonne = 'entreprise' WHERE NOT regexp_matches(entreprise, motif)
UNION ALL SELECT DISTINCT charge_id, b.colonne, 'bornes' FROM b JOIN e USING (colonne) WHERE (NOT isnan(borne_min) AND v < borne_min) OR (NOT isnan(borne_max) AND v > borne_max)
UNION ALL SELECT charge_id, colonne, 'nuls' FROM p WHERE abs((lignes - n) / lignes - (lignes0 - n0) / lignes0) > 0.25
UNION ALL SELECT charge_id, colonne, 'distincts' FROM p WHERE NOT compte AND (u * 2 < u0 OR u > u0 * 2)
UNION ALL SELECT charge_id, colonne, 'echelle' FROM p WHERE compte AND least(n, n0) >= 10 AND (m > m0 * 30 OR m0 > m * 30)
UNION ALL SELECT charge_id, 'annee', 'repartition' FROM d WHERE d > 0.5 + 1e-12"""

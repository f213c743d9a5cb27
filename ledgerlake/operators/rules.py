"""Row checks of account tables, driven by tables of rules and evaluated in one pass over the wide rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (total, sign of the later parts, parts)
Rule = tuple[str, int, list[str]]
#: The subtotal identities of the account catalogue.
IDENTITIES: list[Rule] = [
    ("Actif_A", 1, ["Actif_A1", "Actif_A2", "Actif_A3"]),
    ("Actif_B", 1, ["Actif_B1", "Actif_B2", "Actif_B3", "Actif_B4", "Actif_B5"]),
    ("Actif_C", 1, ["Actif_C1", "Actif_C2", "Actif_C3", "Actif_C4", "Actif_C5", "Actif_C6", "Actif_C7"]),
    ("Actif_D", 1, ["Actif_D1", "Actif_D2", "Actif_D3", "Actif_D4"]),
    ("Actif_E", 1, ["Actif_E1", "Actif_E2"]),
    ("Actif_F", 1, ["Actif_F1", "Actif_F2", "Actif_F3", "Actif_F4", "Actif_F5"]),
    ("Actif_G", 1, ["Actif_G1", "Actif_G2", "Actif_G3", "Actif_G4", "Actif_G5", "Actif_G6", "Actif_G7"]),
    ("Actif_tresor", 1, ["Actif_tresor1", "Actif_tresor2", "Actif_tresor3", "Actif_tresor4"]),
    ("Actif_TOTAL_I", 1, ["Actif_A", "Actif_B", "Actif_C", "Actif_D", "Actif_E"]),
    ("Actif_TOTAL_II", 1, ["Actif_F", "Actif_G", "Actif_H", "Actif_I"]),
    ("Actif_TOTAL_GENERAL", 1, ["Actif_TOTAL_I", "Actif_TOTAL_II", "Actif_tresor"]),
    ("Passif_A", 1, ["Passif_A2", "Passif_A_nonappele", "Passif_A6", "Passif_A7", "Passif_A8", "Passif_A9", "Passif_A10", "Passif_A11", "Passif_A12"]),
    ("Passif_B", 1, ["Passif_B1", "Passif_B2"]),
    ("Passif_C", 1, ["Passif_C1", "Passif_C2"]),
    ("Passif_D", 1, ["Passif_D1", "Passif_D2"]),
    ("Passif_E", 1, ["Passif_E1", "Passif_E2"]),
    ("Passif_F", 1, ["Passif_F1", "Passif_F2", "Passif_F3", "Passif_F4", "Passif_F5", "Passif_F6", "Passif_F7", "Passif_F8"]),
    ("Passif_tresor", 1, ["Passif_tresor1", "Passif_tresor2", "Passif_tresor3"]),
    ("Passif_TOTAL_I", 1, ["Passif_A", "Passif_B", "Passif_C", "Passif_D", "Passif_E"]),
    ("Passif_TOTAL_II", 1, ["Passif_F", "Passif_G", "Passif_H"]),
    ("Passif_TOTAL_GENERAL", 1, ["Passif_TOTAL_I", "Passif_TOTAL_II", "Passif_tresor"]),
    ("CPC_II", 1, ["CPC_II_1", "CPC_II_2", "CPC_II_3", "CPC_II_4", "CPC_II_5", "CPC_II_6", "CPC_II_7"]),
    ("CPC_III", -1, ["CPC_I", "CPC_II"]),
    ("CPC_IV", 1, ["CPC_IV_1", "CPC_IV_2", "CPC_IV_3", "CPC_IV_4"]),
    ("CPC_V", 1, ["CPC_V_1", "CPC_V_2", "CPC_V_3", "CPC_V_4"]),
    ("CPC_VI", -1, ["CPC_IV", "CPC_V"]),
    ("CPC_VII", 1, ["CPC_III", "CPC_VI"]),
    ("CPC_VIII", 1, ["CPC_VIII_1", "CPC_VIII_2", "CPC_VIII_3", "CPC_VIII_4", "CPC_VIII_5"]),
    ("CPC_IX", 1, ["CPC_IX_1", "CPC_IX_2", "CPC_IX_3", "CPC_IX_4"]),
    ("CPC_X", -1, ["CPC_VIII", "CPC_IX"]),
    ("CPC_XI", 1, ["CPC_VII", "CPC_X"]),
    ("CPC_XIII", -1, ["CPC_XI", "CPC_XII"]),
    ("CPC_TOTAL_PRODUITS", 1, ["CPC_I", "CPC_IV", "CPC_VIII"]),
    ("CPC_TOTAL_CHARGES", 1, ["CPC_II", "CPC_V", "CPC_IX", "CPC_XII"]),
]
TOLERANCE = 1.0


def active_rules(rules: list[Rule], columns: list[str]) -> list[Rule]:
    """Rules whose every account is a column, whatever its case; the others are not evaluated."""
    known = {c.lower() for c in columns}
    return [r for r in rules if {r[0].lower(), *(p.lower() for p in r[2])} <= known]


def conditions(rules: list[Rule], columns: list[str], tolerance: float) -> list[tuple[str, Column, Column]]:
    """(rule, evaluable, ok) of each active rule as column expressions.

    Blank parts count as nothing; a blank total makes the rule not evaluable, and ``ok`` is then null.
    """
    out = []
    for total, sign, parts in active_rules(rules, columns):
        # SQL text: one call into the JVM for each condition instead of one for each account
        value = (" + " if sign > 0 else " - ").join(f"coalesce(`{p.lower()}`, 0D)" for p in parts)
        target = f"`{total.lower()}`"
        out.append((total, F.expr(f"{target} is not null"), F.expr(f"abs({target} - ({value})) <= {tolerance!r}D")))
    return out


def evaluated(facts: DataFrame, rules: list[Rule], tolerance: float, keys: list[str]) -> DataFrame:
    """(keys, regle, evaluable, ok): one row for each row and rule."""
    checks = [F.struct(F.lit(rule).alias("regle"), can.alias("evaluable"), ok.alias("ok")) for rule, can, ok in conditions(rules, facts.columns, tolerance)]
    if not checks:
        return facts.select(*keys, F.lit("").alias("regle"), F.lit(False).alias("evaluable"), F.lit(True).alias("ok")).where("false")
    return facts.select(*keys, F.inline(F.array(*checks)))


def rule_counts(facts: DataFrame, rules: list[Rule], tolerance: float) -> DataFrame:
    """(regle, n_total, n_evaluables, n_ok): counted in one row of conditional counts, so no row is multiplied by the rules."""
    checks = conditions(rules, facts.columns, tolerance)
    counts = [x for i, (_, can, ok) in enumerate(checks) for x in (F.count(F.when(can, 1)).alias(f"e{i}"), F.count(F.when(ok, 1)).alias(f"o{i}"))]
    one = facts.agg(F.count(F.lit(1)).alias("n_total"), *counts)
    rows = [F.struct(F.lit(rule).alias("regle"), F.col("n_total"), F.col(f"e{i}").alias("n_evaluables"), F.col(f"o{i}").alias("n_ok")) for i, (rule, _, _) in enumerate(checks)]
    return one.select(F.inline(F.array(*rows)))


def broken(facts: DataFrame, rules: list[Rule], tolerance: float, keys: list[str]) -> DataFrame:
    """(keys, regle): one row for each broken rule of a row; rows without anomaly leave the scan stage as nothing."""
    names = F.array_compact(F.array(*[F.when(~ok, F.lit(rule)) for rule, _, ok in conditions(rules, facts.columns, tolerance)]))
    return facts.select(*keys, F.explode(names).alias("regle"))


def row_counts(rules: list[Rule], columns: list[str], tolerance: float) -> tuple[Column, Column]:
    """How many rules of a row are evaluable, and how many hold."""
    checks = conditions(rules, columns, tolerance)
    total = lambda xs: F.aggregate(F.array(*[F.coalesce(x, F.lit(False)) for x in xs]), F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))
    return total([can for _, can, _ in checks]), total([ok for _, _, ok in checks])


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals, ties to even, null where ``whole`` is 0; exact on integers."""
    scaled, w = part.cast("bigint") * 10000, F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    rest = scaled % w
    exact = ((scaled - rest) / w).cast("bigint")
    up = (rest * 2 > w) | ((rest * 2 == w) & (exact % 2 == 1))
    return (exact + up.cast("bigint")) / 100.0


def stability(series: DataFrame, entity: str, year: str, value: str, ratio: float = 3.0) -> DataFrame:
    """Consecutive available years of an indicator whose ratio leaves [1/ratio, ratio]; gaps are bridged.

    A zero base is skipped; a change of sign gives a negative ratio and is flagged. Null values are no years.
    """
    order = Window.partitionBy(entity, "champ").orderBy(year)
    pairs = series.where(F.col(value).isNotNull()).select(
        entity, "champ", year, value, F.lag(value).over(order).alias("avant"), F.lag(year).over(order).alias("annee_avant")
    )
    change = F.col(value) / F.col("avant")
    return pairs.where((F.col("avant") != 0) & ((change > ratio) | (change < 1 / ratio)))


def sign_check(balance: Column, plus: Column, minus: Column, tolerance: float = 2.0) -> Column:
    """Null where the balance agrees, ERREUR where only its sign is wrong, else ALERTE; null inputs are not judged."""
    expected = plus - minus
    return F.when(F.abs(balance - expected) <= tolerance, F.lit(None)).when(F.abs(balance + expected) <= tolerance, "ERREUR").when((balance - expected).isNotNull(), "ALERTE")


#: Plausible costs of one head.
LEAST_COST, MOST_COST = 30_000, 900_000


def cost_per_head(facts: DataFrame, entity: str, year: str, costs: str, heads: str, group_heads: str) -> DataFrame:
    """(entity, year, par_tete) where costs, in millions, per head leave the plausible range.

    The heads of the group stand in only for an entity that states none of its own in any year; heads that are not
    positive are skipped.
    """
    known = facts.groupBy(entity).agg((F.count(heads) > 0).alias("propre"))
    used = F.when(F.col("propre"), F.col(heads)).otherwise(F.col(group_heads))
    each = facts.join(known, entity).withColumn("tetes", used).where("tetes > 0").select(entity, year, (F.col(costs) * 1e6 / F.col("tetes")).alias("par_tete"))
    return each.where(~F.col("par_tete").between(LEAST_COST, MOST_COST))


def few_filled(rows: DataFrame, columns: list[str], least: int) -> Column:
    """Whether a row fills fewer than ``least`` of ``columns``; a blank text fills nothing, any other does."""
    kinds = dict(rows.dtypes)
    filled = [(F.trim(c) != "") if kinds[c] == "string" else F.col(c).isNotNull() for c in columns]
    return sum((F.coalesce(f.cast("int"), F.lit(0)) for f in filled), F.lit(0)) < least

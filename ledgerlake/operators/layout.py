"""Words of a page with their boxes, to lines, columns, fields and values.

Everything but the one-to-one pairing of labels and values is windows and aggregates over (page, left, top, width,
height, text); a window's partition is a page. Words without text or box take no part.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.scores import clean_number
from ledgerlake.functions.text import norm_words

#: Indicators and the words a label of each holds; the first that fits counts.
INDICATORS = {
    "cotisations_contributions": ["cotisation"],
    "pensions_prestations": ["pension"],
    "solde_technique": ["solde"],
    "charges_de_personnel": ["charges", "personnel"],
    "charges_exploitation_hd": ["charges", "exploitat"],
    "chiffre_affaires": ["chiffre"],
    "valeur_ajoutee": ["valeur", "ajout"],
    "impot_societes": ["impot"],
    "resultat_net": ["resultat"],
    "caf": ["caf"],
    "pnb": ["pnb"],
    "total_actif": ["total", "actif"],
    "fonds_propres": ["fonds", "propres"],
    "dettes_financement": ["dettes"],
    "investissements": ["investissement"],
    "effectif": ["effectif"],
}
#: Indicators with a form of their own for groups.
GROUP_FORMS = {"effectif": "effectif_du_groupe", "resultat_net": "resultat_net_part_du_groupe"}
#: Asset labels by the beginnings of their word, the special ones first.
ASSETS = {
    "terrain_construction": ["terrain&", "terrains/"],
    "equip_mobilier_inst": ["equip"],
    "terrains": ["terrain"],
    "constructions": ["construct"],
    "installations_tech": ["installation"],
    "mobilier_mat_bureau": ["mobilier"],
    "materiel_transport": ["transport"],
    "logiciel_acquis": ["logiciel"],
}
NUMBER, YEAR = r"^-?\d[\d.,]*$", r"^(?:19|20)\d{2}$"
#: Distance between the middles of neighbouring words up to which they stand on one line.
SAME_LINE = 12.0


def placed(words: DataFrame) -> DataFrame:
    """Words with the middle of their box (cx, cy) and their right edge."""
    kept = words.na.drop(subset=["left", "top", "width", "height", "text"])
    return kept.select("page", "left", "top", "text", (F.col("left") + F.col("width")).alias("right"), (F.col("left") + F.col("width") / 2).alias("cx"), (F.col("top") + F.col("height") / 2).alias("cy"))


def with_lines(words: DataFrame, tolerance: float = SAME_LINE) -> DataFrame:
    """``placed`` words with their line, counted from the top: a line ends where the middles leave a gap."""
    down = Window.partitionBy("page").orderBy("cy", "left")
    gap = F.coalesce((F.col("cy") - F.lag("cy").over(down) >= tolerance).cast("int"), F.lit(0))
    return placed(words).withColumn("gap", gap).withColumn("ligne", F.sum("gap").over(down)).drop("gap")


def lines_of(words: DataFrame, tolerance: float = SAME_LINE) -> DataFrame:
    """(page, ligne, haut, label, numbers, years): the visual lines; ``label`` is the normalised text of words that are no
    numbers, ``numbers`` those that are, from the left."""
    number, in_order = F.col("text").rlike(NUMBER), lambda parts: F.transform(F.array_sort(parts), lambda p: p["text"])
    box = F.struct("left", "right", "cx", "text")
    lines = with_lines(words, tolerance).groupBy("page", "ligne").agg(
        F.min("top").alias("haut"), F.array_sort(F.collect_list(F.when(number, box))).alias("numbers"), in_order(F.collect_list(F.when(~number, box))).alias("rest"), F.count_if(F.col("text").rlike(YEAR)).alias("years")
    )
    return lines.select("page", "ligne", "haut", norm_words(F.array_join("rest", " ")).alias("label"), "numbers", "years")


def all_words(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [text.contains(w) for w in words])


def indicator(label: Column) -> Column:
    """Name of the indicator a normalised label means, null if none."""
    named = lambda n: F.when(label.contains("groupe"), GROUP_FORMS[n]).otherwise(n) if n in GROUP_FORMS else F.lit(n)
    return F.coalesce(*[F.when(all_words(label, words), named(n)) for n, words in INDICATORS.items()])


def columns_of(edges: DataFrame, most: int = 3) -> DataFrame:
    """(page, colonne, x): the columns that the right edges (page, x) of numbers form, cut at the ``most`` - 1 widest gaps."""
    across = Window.partitionBy("page").orderBy("x")
    gaps = edges.select("page", "x").distinct().withColumn("gap", F.col("x") - F.lag("x").over(across))
    widest = gaps.withColumn("rang", F.row_number().over(Window.partitionBy("page").orderBy(F.desc_nulls_last("gap"), "x")))
    cut = (F.col("gap").isNotNull() & (F.col("rang") < most)).cast("int")
    return widest.withColumn("colonne", F.sum(cut).over(across).cast("int")).groupBy("page", "colonne").agg(F.avg("x").alias("x"))


def indicator_table(words: DataFrame, columns: int = 3, sections: tuple[str, ...] = ()) -> DataFrame:
    """(page, champ, valeur) of pages with a table of indicators by year; ``champ`` is ``[section_]indicator_annee_n``.

    The header is the first line at least half of whose numbers are years, or that speaks of indicators. Its numbers are
    the columns if there are as many as wanted, else the right edges of the values are. A line without numbers that
    names a section opens it; a repeated indicator gets ``_dup2`` and so on; the pieces of a number are joined in the
    nearest column. A page without fields has no rows.
    """
    lines = lines_of(words, 14.0)
    size, down = F.size("numbers"), Window.partitionBy("page").orderBy("ligne")
    heading = ((size > 0) & (F.col("years") * 2 >= size)) | F.col("label").contains("indic")
    opens = F.when((size == 0) & (reduce(lambda a, b: a | b, [F.col("label").contains(s) for s in sections]) if sections else F.lit(False)), F.replace("label", F.lit(" "), F.lit("_")))
    marked = lines.withColumn("tete", F.min(F.when(heading, F.col("ligne"))).over(Window.partitionBy("page"))).withColumn("section", F.last(opens, ignorenulls=True).over(down))
    rows = marked.where((size > 0) & (F.col("tete").isNull() | (F.col("ligne") != F.col("tete")))).withColumn("nom", F.concat(F.coalesce(F.concat("section", F.lit("_")), F.lit("")), indicator(F.col("label")))).where("nom is not null")
    again = F.row_number().over(Window.partitionBy("page", "nom").orderBy("ligne"))
    rows = rows.withColumn("fois", again).withColumn("nom", F.when(F.col("fois") > 1, F.concat("nom", F.lit("_dup"), F.col("fois").cast("string"))).otherwise(F.col("nom")))
    values = rows.select("page", "ligne", "nom", F.inline("numbers"))
    headed = marked.where((F.col("ligne") == F.col("tete")) & (size == columns))
    from_header = headed.select("page", F.posexplode(F.array_sort(F.transform("numbers", lambda n: n["cx"]))).alias("colonne", "x"))
    from_values = columns_of(values.select("page", F.col("right").alias("x")), columns).join(from_header.select("page").distinct(), "page", "left_anti")
    near = values.join(from_header.unionByName(from_values.select("page", "colonne", "x")), "page")
    home = near.groupBy("page", "ligne", "nom", "left", "text").agg(F.min_by("colonne", F.struct(F.abs(F.col("x") - F.col("right")), "colonne")).alias("colonne"))
    joined = home.groupBy("page", "nom", "colonne").agg(F.array_sort(F.collect_list(F.struct("left", "text"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    champ = F.concat("nom", F.lit("_annee_"), (F.col("colonne") + 1).cast("string"))
    return joined.select("page", champ.alias("champ"), clean_number(text).alias("valeur")).where("valeur is not null")


def bands(anchors: DataFrame, widest: float = 130.0) -> DataFrame:
    """(page, nom, bas, haut): the band of each anchor (page, nom, x): half way to its neighbours, no farther than ``widest``."""
    order = Window.partitionBy("page").orderBy("x")
    low, high = ((F.lag("x").over(order) + F.col("x")) / 2, (F.lead("x").over(order) + F.col("x")) / 2)
    return anchors.select("page", "nom", F.greatest(low, F.col("x") - widest).alias("bas"), F.least(high, F.col("x") + widest).alias("haut"))


def section_anchors(words: DataFrame, wanted: dict[str, list[str]], strict: frozenset[str] = frozenset()) -> DataFrame:
    """(page, nom, haut): the first line that holds an anchor's words, all of them if it is strict or has one, else all but one."""
    text = F.concat_ws(" ", "label", F.array_join(F.transform("numbers", lambda n: n["text"]), " "))
    lines = lines_of(words).select("page", "haut", text.alias("t"))
    missing = lambda held: reduce(lambda a, b: a + b, [(~F.col("t").contains(h)).cast("int") for h in held])
    hits = [F.when(missing(held) <= (0 if nom in strict or len(held) < 2 else 1), F.lit(nom)) for nom, held in wanted.items()]
    return lines.select("page", "haut", F.explode(F.array_compact(F.array(*hits))).alias("nom")).groupBy("page", "nom").agg(F.min("haut").alias("haut"))


def best_pass(fields: DataFrame) -> DataFrame:
    """(page, passe): of several readings (page, passe, largeur, champ) of a page the one with most fields, then the narrowest."""
    sizes = fields.groupBy("page", "passe").agg(F.countDistinct("champ").alias("n"), F.min("largeur").alias("largeur"))
    return sizes.groupBy("page").agg(F.max_by("passe", F.struct("n", -F.col("largeur"))).alias("passe"))


def pairs(cost: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one pairs of rows and columns, the cheapest first; infinite costs pair nothing."""
    cost, out = cost.copy(), []
    while cost.size and np.isfinite(cost.min()):
        i, j = np.unravel_index(cost.argmin(), cost.shape)
        out.append((int(i), int(j)))
        cost[i], cost[:, j] = np.inf, np.inf
    return out


def value_grid(words: DataFrame, reach: float = 250.0) -> DataFrame:
    """(page, champ, valeur): each asset label with the number below it, at most ``reach`` down; sideways counts 0.3.

    The first word that fits names an asset; years are no values; a dot or comma before three digits groups thousands.
    """
    key = norm_words(F.col("text"))
    plain = F.lower(F.translate("text", "éèêîô", "eeeio"))
    asset = F.coalesce(*[F.when(reduce(lambda a, b: a | b, [plain.startswith(s) for s in starts]), n) for n, starts in ASSETS.items()])
    number = F.col("text").rlike(r"^-?[\d.,]*\d[\d.,]*$") & ~F.col("text").rlike(YEAR)
    kept = placed(words).select("page", "cx", "cy", asset.alias("champ"), F.when(number & (key != ""), clean_number(F.regexp_replace("text", r"[.,](\d{3})(?!\d)", "$1"))).alias("valeur")).where("champ is not null or valeur is not null")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        labels = pdf[pdf.champ.notna()].sort_values(["cy", "cx"]).drop_duplicates("champ").reset_index(drop=True)
        numbers = pdf[pdf.champ.isna()].sort_values(["cy", "cx"]).reset_index(drop=True)
        own, banner = (labels[labels.champ == n] for n in ("mobilier_mat_bureau", "equip_mobilier_inst"))
        if len(own) and len(banner) and abs(own.cy.iloc[0] - banner.cy.iloc[0]) < 20 and abs(own.cx.iloc[0] - banner.cx.iloc[0]) < 400:
            labels = labels.drop(own.index).reset_index(drop=True)  # one banner read as two labels
        down = numbers.cy.to_numpy()[:, None] - labels.cy.to_numpy()
        cost = np.where((down >= -5) & (down <= reach), down + 0.3 * np.abs(numbers.cx.to_numpy()[:, None] - labels.cx.to_numpy()), np.inf)
        found = pairs(cost)
        return pd.DataFrame({"page": [key[0]] * len(found), "champ": [labels.champ[j] for _, j in found], "valeur": [numbers.valeur[i] for i, _ in found]}).astype({"page": object, "champ": object, "valeur": float})

    return kept.groupBy("page").applyInPandas(run, "page string, champ string, valeur double")

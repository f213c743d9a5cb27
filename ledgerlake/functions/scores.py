"""Scores, classes and extractions of titles and texts, as JVM-side expressions over small tables of fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Phrases of report titles and their weights in the first collection and in the search for light reports;
#: titles are read without accents, so spellings with and without them are one phrase.
TITLE_WEIGHTS = {
    "rapport annuel": 100, "rapport financier annuel": 98, "rfa": 95, "document de reference": 92, "comptes annuels": 90, "etats financiers": 88,
    "etats de synthese": 85, "rapport de gestion": 80, "rapport consolide": 75, "annual report": 70, "resultats annuels": 65,
}
TITLE_WEIGHTS_LIGHT = {
    "rapport annuel": 100, "rapport financier annuel": 98, "rfa": 95, "document de reference": 92, "comptes annuels": 90, "etats financiers": 88,
    "etats de synthese": 85, "rapport de gestion": 80, "rapport consolide": 75, "comptes sociaux": 75, "annual report": 70, "resultats annuels": 65,
}
#: Phrases in order of preference; each place costs five points. Then the phrases of shorter periods.
TITLE_ORDER = [
    "rapport annuel", "rapport financier annuel", "rfa", "rapport integre", "rapport de gestion", "rapport d'activite", "etats financiers",
    "etats de synthese", "comptes annuels", "comptes consolides", "document de reference", "document d'enregistrement universel",
    "communication financiere annuelle", "annual report", "financial statements", "consolidated financial statements",
]
SHORT_PERIODS = {
    "rapport semestriel": 70, "rapport financier semestriel": 70, "rapport intermediaire": 70, "etats financiers semestriels": 70, "half year": 70,
    "h1": 70, "h2": 70, "s1": 70, "s2": 70, "rapport trimestriel": 50, "resultats trimestriels": 50, "q1": 50, "q2": 50, "q3": 50, "q4": 50, "t1": 50,
    "t2": 50, "t3": 50, "t4": 50, "quarterly report": 50,
}
#: Keyword weights by category, the whole lists of the table selection.
CATEGORIES = {
    "bilan_actif": {
        "actif immobilise": 18, "immobilisations en non valeur": 16, "immobilisations incorporelles": 15, "immobilisations corporelles": 15,
        "immobilisations financieres": 15, "actif circulant": 16, "creances de l actif circulant": 16, "tresorerie actif": 22, "total actif": 10,
        "total de l actif": 28, "total general de l actif": 26, "total general actif": 24, "actif net total": 14, "stocks": 8, "immobilisations": 6,
        "actif": 4, "frais preliminaires": 6, "charges a repartir sur plusieurs exercices": 6, "primes de remboursement des obligations": 6,
        "immobilisation en recherche et developpement": 6, "brevets marques droits et valeurs similaires": 6, "fonds commercial": 6,
        "autres immobilisations incorporelles": 5, "terrains": 5, "constructions": 5, "installations techniques materiel et outillage": 7,
        "materiel de transport": 5, "mobilier materiel de bureau et amenagements divers": 7, "autres immobilisations corporelles": 5,
        "immobilisations corporelles en cours": 7, "prets immobilises": 5, "autres creances financieres": 5, "titres de participation": 6,
        "autres titres immobilises": 5, "ecarts de conversion actif": 9, "diminution des creances immobilisees": 5,
        "augmentation des dettes de financement": 5, "marchandises": 5, "matieres et fournitures consommables": 6, "produits en cours": 5,
        "produits intermediaires et produits residuels": 6, "produits finis": 5, "fournisseurs debiteurs avances et acomptes": 6,
        "clients et comptes rattaches": 9, "comptes d associes": 4, "autres debiteurs": 5, "comptes de regularis actif": 6,
        "titres et valeurs de placement": 6, "ecarts de conversion actif elements circulants": 6, "cheques et valeurs a encaisser": 6,
        "banques t g et c c p": 6, "caisses regies d avances et accreditifs": 6, "personnel": 3, "etat": 3,
    },
    "bilan_passif": {
        "capitaux propres": 20, "total des capitaux propres": 22, "capitaux propres assimiles": 12, "dettes de financement": 16,
        "provisions durables pour risques et charges": 12, "passif circulant": 16, "dettes du passif circulant": 18, "tresorerie passif": 22,
        "total passif": 10, "total du passif": 28, "total general du passif": 26, "total general passif": 24, "passif": 4,
        "capital social ou personnel": 10, "primes d emission de fusion et d apport": 6, "ecarts de reevaluation": 5, "reserve legale": 6,
        "autres reserves": 5, "report a nouveau": 6, "resultats nets en instance d affectation": 6, "resultat net de l exercice": 10,
        "subventions d investissement": 6, "provisions reglementees": 5, "emprunts obligataires": 6, "autres dettes de financement": 5,
        "provisions pour risques": 6, "provisions pour charges": 6, "provisions pour risques et charges": 10, "ecarts de conversion passif": 9,
        "augmentation des creances immobilisees": 5, "diminution des dettes de financement": 5, "fournisseurs et comptes rattaches": 9,
        "clients crediteurs avances et acomptes": 6, "organismes sociaux": 6, "autres creanciers": 5, "comptes de regularisation passif": 6,
        "autres provisions pour risques et charges": 6, "ecarts de conversion passif elements circulants": 6, "credits d escompte": 6,
        "credits de tresorerie": 6, "banques soldes crediteurs": 6, "personnel": 3, "etat": 3,
    },
    "cpc": {
        "compte de produits et charges": 26, "chiffre d affaires": 20, "chiffres d affaires": 12, "produits d exploitation": 18,
        "charges d exploitation": 18, "resultat d exploitation": 18, "produits financiers": 10, "charges financieres": 10, "resultat financier": 14,
        "resultat courant": 14, "produits non courants": 10, "charges non courantes": 10, "resultat non courant": 12, "resultat avant impots": 15,
        "impots sur les resultats": 10, "resultat net": 8, "ventes de marchandises": 6, "ventes de biens et services produits": 6,
        "variation des stocks de produits": 6, "immobilisations produites par l entreprise pour elle meme": 6, "subventions d exploitation": 5,
        "autres produits d exploitation": 5, "reprises d exploitation transferts de charges": 6, "achats revendus de marchandises": 6,
        "achats consommes de matieres et fournitures": 6, "autres charges externes": 5, "impots et taxes": 5, "charges de personnel": 6,
        "autres charges d exploitation": 5, "dotations d exploitation": 6, "produits des titres de participation et autres titres immobilises": 5,
        "gains de change": 5, "interets et autres produits financiers": 5, "reprises financieres transferts de charges": 5, "charges d interets": 5,
        "pertes de change": 5, "autres charges financieres": 5, "dotations financieres": 5, "produits des cessions d immobilisations": 5,
        "subventions d equilibre": 5, "reprises sur subventions d investissement": 5, "autres produits non courants": 5,
        "reprises non courantes transferts de charges": 5, "valeurs nettes d amortissements des immobilisations cedees": 5,
        "subventions accordees": 4, "autres charges non courantes": 5, "dotations non courantes aux amortissements et aux provisions": 5,
    },
    "identification": {
        "numero de registre du commerce et code du centre de registre du commerce": 22, "code du centre de registre du commerce": 16,
        "numero de registre du commerce": 18, "registre du commerce": 16, "nom de l entreprise": 16, "identifiant commun de l entreprise": 22,
        "ice": 14, "raison sociale": 20, "denomination sociale": 18, "denomination": 9, "siege social": 18, "adresse du siege": 10,
        "forme juridique": 12, "capital social": 8, "activite principale": 10, "secteur d activite": 10, "objet social": 10,
        "date de constitution": 12, "exercice social": 6, "numero d identification fiscale": 14, "identifiant fiscal": 12, "patente": 10, "cnss": 8,
    },
}
SCORE_CAP, LEAST_SCORE, LEAST_MARGIN = 100, 32, 6
#: Markers of balances of management (off topic), of consolidated statements (strong and weak), of announcements.
ESG_MARKERS = [
    "marge brute", "valeur ajoutee", "excedent brut d exploitation", "insuffisance brute d exploitation", "capacite d autofinancement",
    "autofinancement", "etat des soldes de gestion", "production de l exercice", "consommation de l exercice", "marge brute sur ventes en l etat",
]
STRONG_MARKERS = [
    "interets minoritaires", "interet minoritaire", "ecart d acquisition", "ecarts d acquisition", "goodwill", "perimetre de consolidation",
    "methode de consolidation", "integration globale", "integration proportionnelle", "mise en equivalence", "societes consolidees",
    "etats financiers consolides", "comptes consolides", "resultat net part du groupe",
]
WEAK_MARKERS = [
    "part du groupe", "part des minoritaires", "capitaux propres attribuables aux actionnaires", "activites poursuivies", "activites abandonnees",
    "actifs non courants detenus en vue de la vente", "immobilisations en droit d usage",
]
ANNOUNCEMENTS = ["communique financier", "communique de presse", "avis de publication", "avis de reunion", "rapport annuel", "est disponible sur"]


def count_of(text: Column, phrases: list[str]) -> Column:
    """How many of the phrases the text contains, by substring."""
    total = F.lit(0)
    for p in phrases:
        total = total + text.contains(p).cast("int")
    return total


def weighted_score(text: Column, weights: dict[str, int], cap: int = SCORE_CAP) -> Column:
    """Sum of the weights of contained phrases, capped."""
    total = F.lit(0)
    for p, w in weights.items():
        total = total + F.when(text.contains(p), w).otherwise(0)
    return F.least(total, F.lit(cap))


def longest_words(phrases: list[str]) -> list[str]:
    """The longest word of each phrase, without those that hold another: a text without any of them holds no phrase."""
    words = sorted({max(p.split(), key=len) for p in phrases})
    return [w for w in words if not any(o in w for o in words if o != w)]


def matched(text: Column, weights: dict[str, int]) -> Column:
    return F.array_compact(F.array(*[F.when(text.contains(p), F.lit(p)) for p in weights]))


def title_score(text: Column) -> Column:
    """First version: the largest weight of a contained phrase, else 0."""
    return F.greatest(F.lit(0), *[F.when(text.contains(p), w).otherwise(0) for p, w in TITLE_WEIGHTS.items()])


def title_score_light(text: Column) -> Column:
    """Third version: as the first, with the phrases of the search for light reports."""
    return F.greatest(F.lit(0), *[F.when(text.contains(p), w).otherwise(0) for p, w in TITLE_WEIGHTS_LIGHT.items()])


def title_score_ordered(text: Column) -> Column:
    """Second version: 100 less five for each place in the order; shorter periods only if nothing else matched."""
    yearly = F.coalesce(*[F.when(text.contains(p), 100 - 5 * i) for i, p in enumerate(TITLE_ORDER)])
    return F.coalesce(yearly, *[F.when(text.contains(p), w) for p, w in SHORT_PERIODS.items()], F.lit(0))


def first_year(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(20\d{2})", 1), F.lit("")).cast("int")


def last_year(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(r"(20\d{2})"), F.lit(1))
    return F.get(found, F.size(found) - 1).cast("int")


def best_category(text: Column) -> tuple[Column, Column]:
    """(category, score): the best category if it reaches the least score with the least margin, else ``autre``.

    Scores cap at 100, so two full categories tie and become ``autre``; ties keep the order of the table.
    """
    ranked = F.array_sort(F.array(*[F.struct((-weighted_score(text, w)).alias("s"), F.lit(i).alias("i"), F.lit(c).alias("c")) for i, (c, w) in enumerate(CATEGORIES.items())]))
    first, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
    clear = (-first["s"] >= LEAST_SCORE) & (second["s"] - first["s"] >= LEAST_MARGIN)
    return F.when(clear, first["c"]).otherwise("autre"), -first["s"]


def series_of(text: Column) -> Column:
    """``consolide`` by one strong or two weak markers, ``social`` where the text says so, else null; consolidated wins."""
    consolidated = (count_of(text, STRONG_MARKERS) >= 1) | (count_of(text, WEAK_MARKERS) >= 2)
    return F.when(consolidated, "consolide").when(text.contains("comptes sociaux") | text.contains("exercice social"), "social")


def extract_date(text: Column) -> Column:
    """``dd/mm/yyyy`` of the first day, month and year; two digits above 30 are of the last century, three lose the lead."""
    pattern = r"(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{2,4})"
    d, m, y = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
    year = F.when(F.length(y) == 2, F.concat(F.when(y.cast("int") > 30, "19").otherwise("20"), y)).when(F.length(y) == 3, F.concat(F.lit("1"), y)).otherwise(y)
    fits = d.try_cast("int").between(1, 31) & m.try_cast("int").between(1, 12)
    return F.when(fits, F.concat_ws("/", F.lpad(d, 2, "0"), F.lpad(m, 2, "0"), year))


def glued_number(label: Column) -> tuple[Column, Column]:
    """(label, number): a number of three digits or more glued to the end of a label, apart from it."""
    pattern = r"^(.*?\p{L})\s?(\d{3,}(?:[.,]\d+)?)$"
    return F.when(label.rlike(pattern), F.regexp_extract(label, pattern, 1)).otherwise(label), F.nullif(F.regexp_extract(label, pattern, 2), F.lit(""))


def clean_number(text: Column) -> Column:
    """Strict number of the indicator tables: blanks removed, then a whole number or one decimal sign, else null."""
    flat = F.translate(text, " \u00a0", "")
    return F.when(flat.rlike(r"^-?\d+([.,]\d+)?$"), F.translate(flat, ",", ".").try_cast("double"))


def clean_number_grouped(text: Column) -> Column:
    """As ``clean_number``, where a dot or comma before exactly three digits groups thousands; dashes alone are blank."""
    flat = F.regexp_replace(F.translate(text, " \u00a0", ""), r"[.,](\d{3})(?!\d)", "$1")
    return F.when(flat.rlike(r"^-?\d+([.,]\d+)?$"), F.translate(flat, ",", ".").try_cast("double"))


def row_type(label: Column, values_blank: Column) -> Column:
    """Kind of an income-statement row: VIDE, TOTAL, RESULTAT, TITRE_SECTION or DETAIL."""
    return (
        F.when(F.trim(F.coalesce(label, F.lit(""))) == "", "VIDE")
        .when(label.startswith("total") | label.contains("cumul"), "TOTAL")
        .when(label.startswith("resultat") | label.startswith("benefice") | label.startswith("solde"), "RESULTAT")
        .when(values_blank, "TITRE_SECTION")
        .otherwise("DETAIL")
    )


def nearest_word(text: Column, vocabulary: list[str], most: float = 0.25) -> Column:
    """Nearest entry of a closed vocabulary by edit distance, if within ``most`` of the text's length, else null."""
    best = F.array_min(F.array(*[F.struct(F.levenshtein(text, F.lit(v)).alias("d"), F.lit(i).alias("i"), F.lit(v).alias("v")) for i, v in enumerate(vocabulary)]))
    return F.when(best["d"] / F.greatest(F.length(text), F.lit(1)) <= most, best["v"])


#: Phrases of the sections a complete balance sheet shows, and its total.
BALANCE_GROUPS = {"immobilise": ["actif immobilise", "immobilisations"], "circulant": ["stocks", "creances clients"], "tresorerie": ["tresorerie"]}
BALANCE_TOTAL = "total de l actif"
#: Words any page of sound text holds; fewer than three mean that letters were read wrongly.
COMMON_WORDS = ["exercice", "dirhams", "societe", "comptes", "resultat"]


def balance_complete(text: Column) -> Column:
    """The total, or every section by one of its phrases."""
    every = F.lit(True)
    for phrases in BALANCE_GROUPS.values():
        every = every & (count_of(text, phrases) >= 1)
    return text.contains(BALANCE_TOTAL) | every


def variant(text: Column) -> Column:
    """``consolide`` if it has more markers than ``social``, ``social`` if it has any, else ``indetermine``."""
    consolidated, social = count_of(text, STRONG_MARKERS + WEAK_MARKERS), count_of(text, ["comptes sociaux", "social", "sociaux"])
    return F.when(consolidated > social, "consolide").when(social > 0, "social").otherwise("indetermine")


def identifiers(text: Column) -> Column:
    """Struct of the numbers a passage states of a company: register, tax and common identifier, null where absent."""
    field = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.struct(field(r"\bRC (\d{3,8})\b").alias("rc"), field(r"\bIF (\d{3,15})\b").alias("if"), field(r"\bICE (\d{9,20})\b").alias("ice"))

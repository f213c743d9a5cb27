"""Order-dependent alignment of table lines to an expected list, one table at a time.

A group is one table of a report, some dozens of lines; it is the unit of work, whatever the number of tables.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.fuzzy import WordTable, label_key, ratio, similarity, words_of

#: Scores: certain at any place; least at the place; least lead; lines searched ahead, at first and then; unsure below.
CERTAIN, LEAST, LEAD, NEAR, FAR, UNSURE = 0.90, 0.50, 0.06, 6, 14, 0.80
#: Fused lines: entries a line may hold and its least ratio, in general; the same for income statements, entries that may
#: be missing between two lines, least score of a match, and of one that needs no flag.
FUSED, FUSED_RATIO, FUSED_CPC, AHEAD, WEAK, STRONG = 4, 0.55, 3, 12, 0.58, 0.72
#: Words of header lines, sections and money units in them, and titles inside an income statement.
HEADER_WORDS = ("brut", "net", "exercice", "operations", "designation", "nature", "totaux", "amort", "elements", "rubrique", "col")
SECTION_WORDS, UNIT_WORDS = frozenset(("actif", "passif", "bilan", "cpc")), frozenset(("kdh", "koh", "mad", "dhs", "dh"))
TITLES = frozenset(words_of(t) for t in ("Produits d'exploitation", "Charges d'exploitation", "Produits financiers", "Charges financières", "Produits non courants", "Charges non courantes"))


def align(labels: list[str], entries: list[str]) -> list[tuple[int | None, float]]:
    """(entry, score) of each label. Sure pairs first, best first, wherever they stand; then line by line within a
    window behind the last match, only where the best candidate leads clearly. Equal scores keep the order."""
    keys, known = [label_key(x) for x in labels], [label_key(x) for x in entries]
    scores = np.array([[similarity(k, e) for e in known] for k in keys]) if keys and known else np.zeros((len(keys), len(known)))
    match: list[int | None] = [None] * len(keys)
    free = np.ones(len(known), bool)
    for flat in np.argsort(-scores, axis=None, kind="stable"):
        i, j = divmod(int(flat), len(known))
        if scores[i, j] < CERTAIN:
            break
        if match[i] is None and free[j]:
            match[i], free[j] = j, False
    at = 0
    for i, key in enumerate(keys):
        if match[i] is not None:
            at = max(at, match[i] + 1)
        elif key:
            for ahead in (NEAR, FAR):
                window = [j for j in range(at, min(at + ahead, len(known))) if free[j]]
                if window:
                    break
            ranked = sorted(window, key=lambda j: -scores[i, j])
            if ranked and scores[i, ranked[0]] >= LEAST and scores[i, ranked[0]] - (scores[i, ranked[1]] if len(ranked) > 1 else 0.0) >= LEAD:
                match[i], free[ranked[0]], at = ranked[0], False, ranked[0] + 1
    best = scores.max(axis=1) if scores.size else np.zeros(len(keys))
    return [(m, round(float(scores[i, m] if m is not None else best[i]), 3)) for i, m in enumerate(match)]


def align_tables(lines: DataFrame, entries: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """(field_id, code, score, incertain): lines (table, section, rang, field_id, label) aligned within their table.

    ``entries``: section -> (code, label) in matching order. Lines of equal rank keep the order of their ids; a line
    without match has a null code; blank labels and unknown sections match nothing.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rang", "field_id"], kind="stable")
        known = entries.get(pdf["section"].iloc[0], [])
        found = align(pdf["label"].fillna("").tolist(), [label for _, label in known])
        return pd.DataFrame({
            "field_id": pdf["field_id"].to_numpy(), "code": [known[m][0] if m is not None else None for m, _ in found],
            "score": [s for _, s in found], "incertain": [m is not None and s < UNSURE for m, s in found],
        })

    return lines.groupBy("table", "section").applyInPandas(run, "field_id bigint, code string, score double, incertain boolean")


def value_columns(lines: DataFrame, normal: Column) -> DataFrame:
    """Lines (table, section, rang, label, cells) without up to two header lines, with current and previous value.

    The most frequent number of value cells, the first seen of equally frequent ones, tells the layout: four or five
    are gross, depreciation, net, net of the year before; two or three are net and the year before; else there is no
    value. ``normal`` is the word-normalised text of label and cells.
    """
    order = Window.partitionBy("table").orderBy("rang")
    words = F.split(normal, " ")
    overlap = lambda names: F.arrays_overlap(words, F.array(*map(F.lit, sorted(names))))
    named = F.lit(False)
    for w in HEADER_WORDS:
        named = named | normal.contains(w)
    title = overlap(SECTION_WORDS) & overlap(UNIT_WORDS) & ~F.exists("cells", lambda c: F.trim(c) != "")
    marked = lines.withColumn("n", F.row_number().over(order)).withColumn("h", named | title)
    # a header counts only as long as all lines before it are headers
    kept = marked.withColumn("before", F.min(F.col("h").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))).where(~((F.col("n") <= 2) & (F.col("before") == 1)))
    widths = kept.where(F.size("cells") > 0).groupBy("table", F.size("cells").alias("w")).agg(F.count(F.lit(1)).alias("c"), F.min("rang").alias("p"))
    mode = widths.groupBy("table").agg(F.max_by("w", F.struct(F.col("c"), -F.col("p"))).alias("w"))
    at = F.when(F.col("w").isin(4, 5) & (F.col("section") != "PASSIF"), 2).when(F.col("w").isin(2, 3), 0)
    placed = kept.join(mode, "table", "left").withColumn("at", at)
    return placed.select("table", "section", "rang", "label", F.get("cells", F.col("at")).alias("courant"), F.get("cells", F.col("at") + 1).alias("precedent"))


def split_fused(rows: list[tuple[str, list[str]]], expected: list[str]) -> list[tuple[str, list[str], str]]:
    """(label, values, flag): lines whose label holds several expected entries in a row, as lines of their own.

    Values stay on the first; the others are blank; every line of a split is flagged. Without a good match a line
    stays as it is. The next expected entry is the one behind the last line, matched or not.
    """
    known, out, at = [words_of(e) for e in expected], [], 0
    for label, values in rows:
        key = words_of(label)
        if not key or at >= len(known):
            out.append((label, values, ""))
            continue
        ratios = [ratio(" ".join(known[at : at + n]), key) for n in range(1, min(FUSED, len(known) - at) + 1)]
        best = max(ratios)
        n = len(ratios) - ratios[::-1].index(best)
        if n == 1 or best < FUSED_RATIO:
            out.append((label, values, ""))
            at += 1
            continue
        out += [(expected[at + k], values if k == 0 else [""] * len(values), f"LIGNE_ECLATEE n={n} confiance={best:.2f}") for k in range(n)]
        at += n
    return out


def row_kind(key: str) -> str:
    """VIDE, TOTAL, RESULTAT, TITRE_SECTION or DETAIL of a word-normalised income-statement label."""
    words = frozenset(key.split())
    marks = [("TOTAL", "total" in words), ("RESULTAT", "resultat" in words), ("TITRE_SECTION", key in TITLES), ("DETAIL", bool(words))]
    return next((kind for kind, holds in marks if holds), "VIDE")


def monotone(options: list[list[tuple[float, int, int]]], size: int, ahead: int = AHEAD) -> list[tuple[float, int, int] | None]:
    """The option (score, start, n) of each line, or none, with the largest sum of scores such that the runs
    ``start .. start + n`` of ``size`` entries follow one another, each at most ``ahead`` entries behind the last.

    Of equal sums the one that leaves entries for later lines is taken.
    """
    best = np.full(size + 1, -np.inf)
    best[0] = 0.0
    steps = []
    for choices in options:
        after, chosen = best.copy(), {}
        for score, start, n in choices:
            low = max(0, start - ahead + 1)
            j = low + int(np.argmax(best[low : start + 1]))
            if best[j] + score > after[start + n]:
                after[start + n] = best[j] + score
                chosen[start + n] = (j, (score, start, n))
        best = after
        steps.append(chosen)
    at, out = int(np.argmax(best)), []
    for chosen in reversed(steps):
        j, option = chosen.get(at, (at, None))
        out.append(option)
        at = j
    return out[::-1]


def split_income(rows: list[tuple[str, list[str]]], expected: list[str]) -> list[tuple[str, list[str], str, str]]:
    """(label, values, flag, kind): fused lines of an income statement as lines of their own.

    Every line is scored against the entries and the runs of up to three of them, and the best monotone assignment of
    the whole table is taken, so a missing line shifts nothing. Totals, results and titles hold their place but are
    never split; a run of several entries needs the strong score; a doubtful match is flagged and left alone.
    """
    runs = WordTable([words_of(e).split() for e in expected], FUSED_CPC)
    keys = [words_of(re.sub(r"[-+]?\d[\d\s,.]*", " ", label or "")) for label, _ in rows]
    kinds = [row_kind(k) for k in keys]
    scored = [runs.scores(k.split(), WEAK) if kind != "VIDE" else [] for k, kind in zip(keys, kinds)]
    allowed = [[o for o in options if o[0] >= (WEAK if o[2] == 1 else STRONG) and (o[2] == 1 or kind == "DETAIL")] for options, kind in zip(scored, kinds)]
    out = []
    for (label, values), kind, options, choice in zip(rows, kinds, scored, monotone(allowed, len(expected))):
        if kind != "DETAIL":
            out.append((label, values, "", kind))
        elif choice is None:
            score, n = max(((s, n) for s, _, n in options), default=(0.0, 0))
            out.append((label, values, f"FUSION_POSSIBLE score={score:.2f} n={n}" if n > 1 else f"NON_RECONNU score={score:.2f}", "NON_RECONNU"))
        elif choice[2] == 1:
            out.append((label, values, "" if choice[0] >= STRONG else f"CORRESPONDANCE_INCERTAINE score={choice[0]:.2f}", "DETAIL"))
        else:
            score, start, n = choice
            blank = [""] * len(values)
            out += [(entry, blank if k else values, f"LIGNE_ECLATEE n={n} confiance={score:.2f}", "DETAIL") for k, entry in enumerate(expected[start : start + n])]
    return out


def split_tables(lines: DataFrame, expected: dict[str, list[str]]) -> DataFrame:
    """(table, section, ordre, label, courant, precedent, drapeau): fused lines of every table split."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rang", "field_id"], kind="stable")
        rows = [(r.label or "", [r.courant or "", r.precedent or ""]) for r in pdf.itertuples()]
        names = expected.get(key[1], [])
        done = [x[:3] for x in split_income(rows, names)] if key[1] == "CPC" else split_fused(rows, names)
        return pd.DataFrame({"table": [key[0]] * len(done), "section": [key[1]] * len(done), "ordre": range(len(done)), "label": [d[0] for d in done], "courant": [d[1][0] for d in done], "precedent": [d[1][1] for d in done], "drapeau": [d[2] for d in done]})

    return lines.groupBy("table", "section").applyInPandas(run, "table bigint, section string, ordre int, label string, courant string, precedent string, drapeau string")


def carry_orphans(lines: DataFrame) -> DataFrame:
    """A line without label and with one value gives it to the line before, if that one's cell is blank; then it goes."""
    order = Window.partitionBy("table").orderBy("rang", "field_id")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    orphan = blank(F.col("label")) & ~blank(F.col("courant")) & blank(F.col("precedent"))
    ahead = lines.withColumn("orphelin", orphan).withColumn("apres", F.lead(F.struct("orphelin", "courant")).over(order)).withColumn("avant_vide", F.lag(blank(F.col("courant")) & ~orphan).over(order))
    taken = ahead.withColumn("courant", F.when(blank(F.col("courant")) & F.col("apres.orphelin") & ~F.col("orphelin"), F.col("apres.courant")).otherwise(F.col("courant")))
    return taken.where(~(F.col("orphelin") & F.coalesce("avant_vide", F.lit(False)))).drop("orphelin", "apres", "avant_vide")


def repair_partial(tables: list[dict], groups: dict[str, dict[str, str]], score, most: int = 3, reach: int = 6) -> list[dict]:
    """Tables of one document with partial balance sheets completed from neighbours.

    A table is a dict of id, bloc, serie, genre, texte, score. ``groups``: kind -> section -> phrase that shows it; a
    table is complete if it shows all sections or ``total general``. The best incomplete table takes, up to ``most``
    times, the nearest table of the same or unknown series that shows a missing section; what is taken becomes
    ``fusionne``. A table that stays partial keeps six tenths of its confidence.
    """
    by_id = {t["id"]: dict(t, avec=[], partiel=False, confiance=round(t["score"] / 100, 2)) for t in tables}
    for kind, phrases in groups.items():
        taken: set = set()
        lacks = lambda t: [s for s, p in phrases.items() if p not in t["texte"]] if "total general" not in t["texte"] else []  # noqa: B023, E731
        for t in sorted((t for t in by_id.values() if t["genre"] == kind), key=lambda t: (-t["score"], t["id"])):
            if t["id"] in taken or t["genre"] != kind:
                continue
            for _ in range(most):
                wanted = lacks(t)
                if not wanted:
                    break
                near = [
                    o for o in by_id.values()
                    if o["id"] != t["id"] and o["id"] not in taken and o["genre"] in (kind, "autre") and (o["serie"] == t["serie"] or o["serie"] is None)
                    and abs(o["bloc"] - t["bloc"]) <= reach and any(phrases[s] in o["texte"] for s in wanted)
                ]
                if not near:
                    break
                o = min(near, key=lambda o: (abs(o["bloc"] - t["bloc"]), o["bloc"]))
                t["texte"] += " " + o["texte"]
                t["score"] = score(t["texte"], kind)
                t["confiance"] = round(t["score"] / 100, 2)
                t["avec"].append(o["id"])
                taken.add(o["id"])
                if o["genre"] != kind:
                    o["genre"] = "fusionne"
            if lacks(t):
                t["partiel"], t["confiance"] = True, round(t["confiance"] * 0.6, 2)
    return list(by_id.values())

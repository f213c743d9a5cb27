"""The core problems on empty and on awkward tables, and against brute force."""

from __future__ import annotations

import math
import random
import re
import unicodedata

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.companies import company_key
from ledgerlake.functions.parse import ANY_DECIMALS, parse_amount, parse_year
from ledgerlake.operators import datadiff
from ledgerlake.operators import aliases
from ledgerlake.operators.aliases import alias_dictionary, weighted_distance
from ledgerlake.operators.profile import BLOCK, ks_distance, ks_distances, order_statistics, sorted_groups
from ledgerlake.plans import registry
from ledgerlake.plans import units
from tests.conftest import DATA

CORE = ["p1_found", "p1_amounts", "p3_found", "p3_differences", "p5_found", "p5_profile"]


@pytest.mark.parametrize("name", CORE)
def test_empty_tables_give_no_rows(spark, empty_tables, name):
    assert registry.queries()[name](spark, empty_tables).count() == 0


@pytest.mark.parametrize("name", CORE)
def test_awkward_tables_are_survived(spark, awkward_tables, name):
    df = registry.queries()[name](spark, awkward_tables)
    assert df.count() > 0


def test_amounts_in_all_notations(spark):
    cases = {
        "1 234,50": 1234.5, "(1 234,50)": -1234.5, "-12": -12.0, "1.234": 1234.0, "12.5": 12.5, "1.234,5": 1234.5, "1,234.5": 1234.5, "1,234": 1.234, "-": None, "": None, "1.0d": None, "abc": None,
        "62\xa0620\xa0375,61": 62620375.61, "1 000": 1000.0, "٣٤": 34.0, "1.234.567": 1234567.0, "12-": -12.0, ",5": 0.5, "1'000.25": 1000.25, "n.s.": None, "−7,5": -7.5,
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()] + [(None, None)], "t string, v double")
    rows = df.select("t", "v", parse_amount(F.col("t")).alias("x")).collect()
    assert [(r.t, r.x) for r in rows if r.x != r.v] == []


def test_years_in_all_notations(spark):
    cases = {"2016": 2016, "2O16": 2016, "2 023": 2023, " 2020 ": 2020, "31/12/2018": 2018, "2015-12-31": 2015, "2024.0": 2024, "FY2018": 2018, "déc. 2015": 2015, "Exercice 2019": 2019, "٢٠٢٢": 2022, "20018": None, "": None, "x": None}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()] + [(None, None)], "t string, v int")
    assert [(r.t, r.x) for r in df.select("t", "v", parse_year(F.col("t")).alias("x")).collect() if r.x != r.v] == []


def test_company_spellings_share_a_key(spark):
    names = ["VAVERIKA TELECOM", "vaverika  telecom", "Sté. Vaverika Telecom", "VAVÈRIKA TELECOM SA", '"VAVERIKA TELECOM"', "VAVERIKA_TELECOM", "VAVERIKA - TELECOM (SA)", "﻿VAVERIKA TELECOM", "VAVERIKA TELECOM\t", "Société VAVERIKA TELECOM", "VAVERIKA TELECOM s.a", "VAVERIKA TELECOM SOCIETE ANONYME"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(company_key(F.col("n")).alias("k"))
    assert {r.k for r in df.collect()} == {"VAVERIKA TELECOM"}
    assert spark.createDataFrame([("...",), (None,)], "n string").select(company_key(F.col("n")).alias("k")).where("k is not null").count() == 0


def entries_of(spark, spellings):
    return {r.mot: r.entree for r in alias_dictionary(spark.createDataFrame([(w,) for w in spellings], "mot string")).collect()}


def test_unit_spellings(spark):
    wanted = {
        "KDH": "KDH", "en milliers de dirhams": "KDH", "millers de dirhams": "KDH", "Millions  MAD": "MDH", "k€": "KEUR", "M$": "MUSD", "Mrd DH": "GDH", "cts": "CDH", "N/D": None, "cf. cellules": None,
        "milions de dirhams": "MDH", "euross": "EUR", "000 USD": "KUSD", "10^3 dollars": "KUSD", "milliers de dollars": "KUSD", "Mns DH": "MDH", "000 000 EUR": "MEUR", "MAD (unités)": "DH", "dirhams courants": "DH",
        "milliersdedirhams": "KDH", "société au capital": None, "mars": None, "m²": None, "milliers de titres": None, "12 MDH": None, "": None, " ": None, "md DH": None,
    }
    got = entries_of(spark, wanted)
    assert {w: got.get(w) for w in wanted} == wanted
    assert weighted_distance("kdh", "mdh") > weighted_distance("dirham", "dirhams")


def test_unit_spellings_beyond_the_words(spark):
    """Composed and misspelt spellings, none of them in the vocabulary: nearly all are understood, none wrongly."""
    r = random.Random(5)
    scales = {0: ["", "unités de "], 3: ["milliers de ", "millier de ", "mille ", "K", "k ", "000 ", "10^3 "], 6: ["millions de ", "million de ", "mns ", "mio ", "M", "m ", "000 000 "], 9: ["milliards de ", "mrd ", "mds ", "G", "g "], -2: ["centimes de ", "centime de ", "cts ", "c"]}
    currencies = {"DH": ["dirhams", "dirham", "DH", "Dhs", "MAD"], "EUR": ["euros", "euro", "EUR", "€"], "USD": ["dollars", "dollar", "USD", "$"]}
    listed = {w for w, _, _ in aliases.vocabulary()}
    spelt = {s + w: aliases.LETTERS[e] + c for e, ss in scales.items() for c, ws in currencies.items() for s in ss for w in ws if len(s) > 2 or len(w) < 4 or not s}
    plain = {t: u for t, u in spelt.items() if t.lower() not in listed}

    def misspelt(t):
        m = r.choice(list(re.finditer(r"[A-Za-z]{6,}", t)) or [None])
        if m is None:
            return "en " + t.upper()
        j = r.randrange(m.start() + 1, m.end())
        return r.choice([t[:j] + t[j + 1 :], t[:j] + t[j] + t[j:], t[:j] + r.choice("aeimnrs") + t[j + 1 :]])

    noisy = {misspelt(t): u for t, u in spelt.items()}
    for cases, least in ((plain, 1.0), (noisy, 0.9)):
        got = entries_of(spark, cases)
        assert {t: got[t] for t in got if got[t] != cases[t]} == {}
        assert len(got) >= least * len(cases) > 100


def test_caption_statements(spark):
    cases = {
        "Actif (en KDH)": [("", "KDH")], "CPC / colonne 2020 : KDH, colonne 2019 : MDH": [("2020", "KDH"), ("2019", "MDH")], "Bilan (N en k€ ; N-1 en DH)": [("exercice", "k€"), ("avant", "DH")],
        "Bilan – exercice en KUSD, exercice précédent en DH": [("exercice", "KUSD"), ("avant", "DH")], "Bilan ; capital social : 12 500 KDH": [], "Etat exprimé en 10^3 DH. Chiffres non audités": [("", "10^3 DH")], "Comptes - montants en euros": [("", "euros")],
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string").select("c", F.explode_outer(units.caption_statements(F.col("c"))).alias("s")).select("c", "s.*")
    rows = [tuple(r) for r in df.collect()]
    known = entries_of(spark, {m for _, _, m in rows if m})
    assert {c: [(role, m) for k, role, m in rows if k == c and m in known] for c in cases} == cases


def test_a_large_dictionary_gives_the_same_units(spark):
    fields = units.stated(spark, f"{DATA}/sf0.001").cache()
    small, large = (units.with_units(fields, n) for n in (20_000, 0))
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0 and small.where("k0 is not null").count() > 0


@pytest.mark.parametrize("differing", [0, 3, 400])
def test_differences_are_found_or_their_bucket_is_compared_whole(spark, differing):
    """With few differences the tables decode; with more than they can tell apart nothing is lost."""
    rows = 2000
    left = spark.range(rows).select(F.xxhash64("id").alias("k"), F.xxhash64("id", F.lit(1)).alias("h"), "id")
    right = spark.range(rows).where(F.col("id") >= differing // 3).select(F.xxhash64("id").alias("k"), F.xxhash64("id", F.when(F.col("id") < differing, 2).otherwise(1)).alias("h"), "id")
    keys = datadiff.differing_keys(left, right, rows).cache()
    buckets = (keys.select("buckets").first() or [1])[0]
    a = {r.id for r in datadiff.rows_to_compare(left, keys, buckets).collect()}
    assert set(range(differing)) <= a
    if differing <= 3:
        assert a == set(range(differing))


def test_a_bucket_beyond_its_cells_is_compared_whole(spark):
    left = spark.range(50).select(F.xxhash64("id").alias("k"), F.lit(1).cast("long").alias("h"), "id")
    right = spark.range(50).select(F.xxhash64("id").alias("k"), F.lit(2).cast("long").alias("h"), "id")
    keys = datadiff.differing_keys(left, right, 10)
    assert keys.where("k is null").count() == 1
    assert datadiff.rows_to_compare(left, keys, 1).select("id").distinct().count() == 50


def company_of(text, by_key):
    """The issuer a spelling means, by hand: marks off, letters and digits, legal forms off either end."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", (text or "").upper()) if not unicodedata.combining(c))
    words = re.sub(r"[^A-Z0-9]+", " ", plain).split()
    while len(words) > 1 and words[0] in ("STE", "SOCIETE", "SA"):
        words = words[1:]
    while len(words) > 1 and (words[-1] in ("SA", "SARL") or words[-2:] in (["S", "A"], ["SOCIETE", "ANONYME"])) and not (len(words) == 2 and words[-1] not in ("SA", "SARL")):
        words = words[: -1 if words[-1] in ("SA", "SARL") else -2]
    return by_key.get(" ".join(words))


def year_of(text):
    t = "".join(str(unicodedata.digit(c)) if c.isdigit() else c for c in text or "").replace("O", "0")
    found = re.search(r"(?<!\d)\d{4}(?!\d)", re.sub(r"(?<=\d)\s+(?=\d)", "", t))
    return int(found[0]) if found else None


def exported_amount(text):
    """An amount of the second copy by hand: a comma or a lone dot is the decimal sign there."""
    t = "".join((text or "").split()).replace(",", ".")
    if not any(map(str.isdigit, t)):
        return None
    size = float(re.sub(r"[^0-9.]", "", t))
    return -size if t[0] in "-(" else size


def brute_differences(spark, folder):
    """All cases of problem 3 by plain loops over whole tables."""
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet").collect()
    by_key = {}
    for r in read("emetteurs"):
        for t in (r.nom, r.ticker):
            by_key.setdefault(re.sub(r"[^A-Z0-9]+", " ", (t or "").upper()).strip(), r.nom)
    by_key.pop("", None)
    bounds = next(r for r in read("profil_attendu") if r.colonne == "annee")
    first, second = {}, {}
    for r in read("data_cifen"):
        nom = company_of(r.entreprise, by_key)
        if nom and r.annee is not None and bounds.borne_min <= r.annee <= bounds.borne_max:
            first[nom, r.annee] = max(first.get((nom, r.annee), (r.maj_le, r.row_id, r)), (r.maj_le, r.row_id, r), key=lambda x: x[:2])
    seen = {}
    for r in read("data_verification"):
        nom, year, code = company_of(r.entreprise, by_key), year_of(r.annee), (r.code_cifen or "").strip().lower()
        if nom and year:
            k = (nom, year, code)
            seen[k] = max(seen.get(k, (r.verifie_le, r.ver_id, r)), (r.verifie_le, r.ver_id, r), key=lambda x: x[:2])
    for (nom, year, code), (_, _, r) in seen.items():
        second.setdefault((nom, year), {})[code] = exported_amount(r.valeur_rapport_reel)
    spelt = {r.code.lower(): r.code for r in read("champs_cifen")}
    codes = {c for _, _, c in seen} & set(spelt)
    out = set()
    for k in {*first, *second}:
        if k not in first or k not in second:
            out.add((*k, "*", "absent_cifen" if k not in first else "absent_verification"))
            continue
        for c in codes:
            x, y = first[k][2][c], second[k].get(c)
            x = None if x is None or math.isnan(x) else x
            if (x is None) != (y is None) or x is not None and abs(x - y) > 0.005:
                out.add((*k, spelt[c], "ecart"))
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_differences_equal_brute_force(spark, sf):
    """Every case of the whole tables, and no other."""
    got = [tuple(r) for r in registry.queries()["p3_found"](spark, f"{DATA}/{sf}").collect()]
    want = brute_differences(spark, f"{DATA}/{sf}")
    assert len(got) == len(set(got)) and {k[3] for k in want} == {"ecart", "absent_cifen", "absent_verification"}
    assert (sorted(set(got) - want), sorted(want - set(got))) == ([], [])


def test_exported_amounts_have_any_count_of_decimals(spark):
    cases = {"490380658.6800": 490380658.68, "-120073180.1500": -120073180.15, "0.5": 0.5, "1234567.890": 1234567.89, "1.234": 1234.0, "12.345.678": 12345678.0, "1 234,5600": 1234.56, "(1.5000)": -1.5, "-": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", parse_amount(F.col("t"), ANY_DECIMALS).alias("x"))
    assert {r.t: r.x for r in df.collect()} == cases


def test_order_statistics_and_distances_over_many_partitions(spark):
    """Hot groups over several partitions, ties, single values; against numpy."""
    rng = np.random.default_rng(3)
    groups = {1: rng.integers(0, 50, 3000) / 4.0, 2: rng.normal(size=2), 3: np.full(500, 7.0), 4: rng.normal(size=700), 9: np.array([1.5])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "key bigint, v double")
    probabilities = [0.0, 0.25, 0.5, 0.9]
    got = {r.key: r for r in order_statistics(sorted_groups(df, probabilities), probabilities).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        r = got[k]
        assert (r.n, r.uniques, r.lo, r.hi) == (len(vs), len(set(vs)), vs.min(), vs.max())
        assert np.allclose(r.q, np.quantile(vs, probabilities))
    two = df.withColumn("old", F.lit(False)).unionByName(spark.createDataFrame([(1, float(v)) for v in rng.integers(10, 60, 900) / 4.0] + [(4, 0.0), (5, 1.0)], "key bigint, v double").withColumn("old", F.lit(True)))
    both = sorted_groups(two, probabilities)
    again = {r.key: r for r in order_statistics(both, probabilities).collect()}
    assert set(again) == set(groups) and all((again[k].n, again[k].uniques, again[k].lo, again[k].hi, again[k].q) == (got[k].n, got[k].uniques, got[k].lo, got[k].hi, got[k].q) for k in groups)
    ks = {r.key: r.ks for r in ks_distances(both).collect()}
    everything = two.toPandas()
    for k in (1, 4):
        x, y = (np.sort(everything[(everything.key == k) & (everything.old == o)].v) for o in (False, True))
        z = np.union1d(x, y)
        assert np.isclose(ks[k], np.abs(np.searchsorted(x, z, "right") / len(x) - np.searchsorted(y, z, "right") / len(y)).max())
    assert ks[2] is None and ks[5] is None
    assert ks_distance(np.array([1]), np.array([1]), 1, 1) == 0.0


def test_a_hot_group_streams_in_blocks(spark):
    """One group over all partitions, half of it one value: blocks of bounded size, and the same figures as numpy."""
    n = 400_000
    df = spark.range(n).select(F.lit(7).cast("long").alias("key"), F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.col("id") % 90_001).cast("double").alias("v"), (F.col("id") % 3 == 0).alias("old"))
    groups = sorted_groups(df, [0.1, 0.5, 0.9], n)
    sizes = groups.select("pid", F.size("vals").alias("s"), "n", "n_old").collect()
    assert len({r.pid for r in sizes}) > 2 and max(r.s for r in sizes) <= BLOCK
    # the frequent value is split over partitions as well
    assert max(r.n + r.n_old for r in sizes) < n / 2
    everything = df.toPandas()
    mine, other = (np.sort(everything[everything.old == o].v.to_numpy()) for o in (False, True))
    r = order_statistics(groups, [0.1, 0.5, 0.9]).first()
    assert (r.n, r.uniques, r.lo, r.hi) == (len(mine), len(set(mine)), mine.min(), mine.max()) and np.allclose(r.q, np.quantile(mine, [0.1, 0.5, 0.9]))
    z = np.union1d(mine, other)
    assert np.isclose(ks_distances(groups).first().ks, np.abs(np.searchsorted(mine, z, "right") / len(mine) - np.searchsorted(other, z, "right") / len(other)).max())


def test_findings_equal_brute_force(spark):
    folder = f"{DATA}/sf0.01"
    c = spark.read.parquet(f"{folder}/data_cifen.parquet").toPandas()
    chain = dict(spark.read.parquet(f"{folder}/charges.parquet").select("charge_id", "charge_prec").toPandas().itertuples(index=False))
    expected = spark.read.parquet(f"{folder}/profil_attendu.parquet").toPandas()
    accounts = [x for x in c.columns if x.startswith(("actif_", "passif_", "cpc_"))]
    loads, want = dict(iter(c.groupby("charge_id"))), set()
    for load, rows in loads.items():
        for r in expected.itertuples():
            x = rows[r.colonne].dropna()
            if r.motif and (~x.astype(str).str.fullmatch(r.motif.strip("^$"))).any():
                want.add((load, r.colonne, "motif"))
            if (x < r.borne_min).any() if r.motif is None else False or (x > r.borne_max).any() if r.motif is None else False:
                want.add((load, r.colonne, "bornes"))
        before = loads.get(chain.get(load))
        if before is None:
            continue
        want |= {(load, a, "nuls") for a in ["entreprise", "annee", *accounts] if abs(rows[a].isna().mean() - before[a].isna().mean()) > 0.25}
        want |= {(load, a, "distincts") for a in ("entreprise", "annee") if not before[a].nunique() / 2 <= rows[a].nunique() <= 2 * before[a].nunique()}
        for a in accounts:
            x, y = rows[a].dropna().abs(), before[a].dropna().abs()
            if min(len(x), len(y)) >= 10 and max(x.median(), y.median()) > 30 * min(x.median(), y.median()):
                want.add((load, a, "echelle"))
        if rows.annee.value_counts(normalize=True).sub(before.annee.value_counts(normalize=True), fill_value=0).abs().sum() / 2 > 0.5:
            want.add((load, "annee", "repartition"))
    got = registry.queries()["p5_found"](spark, folder).toPandas()
    assert set(map(tuple, got[["charge_id", "colonne", "constat"]].values)) == want and len(got) == len(want)


def test_units_make_tables_agree_with_the_wide_copy(spark):
    """Amounts in dirhams against the accounts of the other table: nearly all must agree, whatever unit they came in."""
    folder = f"{DATA}/sf0.01"
    amounts = registry.queries()["p1_amounts"](spark, folder).where("dirhams is not null")
    fields = spark.read.parquet(f"{folder}/extracted_fields.parquet").select("field_id", "entreprise", F.lower("code").alias("code")).where("code in ('actif_total_general', 'passif_total_general', 'cpc_i_3')")
    wide = spark.read.parquet(f"{folder}/data_cifen.parquet").selectExpr("entreprise", "annee", "stack(3, 'actif_total_general', actif_total_general, 'passif_total_general', passif_total_general, 'cpc_i_3', cpc_i_3) as (code, d)").where("d <> 0")
    near = amounts.join(fields, "field_id").join(wide, ["entreprise", "annee", "code"]).select("unite", (F.abs(F.log10(F.abs(F.col("dirhams") / F.col("d")))) < 0.3).alias("ok")).toPandas()
    assert len(near) > 100 and near.ok.mean() > 0.9
    assert near[near.unite != "DH"].ok.mean() > 0.85


def test_profile_of_every_column_equals_brute_force(spark):
    """Ranges, quartiles and violations of the columns beyond the accounts, which were blank or missing."""
    folder = f"{DATA}/sf0.01"
    c = spark.read.parquet(f"{folder}/data_cifen.parquet").toPandas()
    expected = spark.read.parquet(f"{folder}/profil_attendu.parquet").toPandas().set_index("colonne")
    got = registry.queries()["p5_profile"](spark, folder).toPandas().set_index(["charge_id", "colonne"])
    assert got.index.is_unique and set(got.index) == {(load, x) for load in c.charge_id.unique() for x in c.columns}
    c["maj_le"] = c.maj_le.astype("datetime64[us]").astype("int64") / 1e6
    for load, rows in c.groupby("charge_id"):
        for x in c.columns:
            r, v = got.loc[load, x], rows[x].dropna()
            assert (r.lignes, r.nuls, r.distincts) == (len(rows), len(rows) - len(v), v.nunique()), (load, x)
            if x in ("entreprise", "charge_id"):
                v = sorted(v, key=lambda t: t.encode())
                want = [v[max(0, math.ceil(len(v) * p) - 1)] for p in (0, 0.25, 0.5, 0.75, 1)]
                assert [r.minimum_texte, r.q25_texte, r.mediane_texte, r.q75_texte, r.maximum_texte] == want, (load, x)
            elif len(v):
                assert np.allclose([r.minimum, r.q25, r.mediane, r.q75, r.maximum], np.quantile(v, [0, 0.25, 0.5, 0.75, 1]), rtol=1e-12), (load, x)
            if x not in expected.index:
                assert np.isnan(r.hors_motif) and np.isnan(r.hors_bornes)
                continue
            e = expected.loc[x]
            if e.motif is not None:
                assert r.hors_motif == sum(re.search(e.motif, t) is None for t in v), (load, x)
            if not np.isnan(e.borne_min) or not np.isnan(e.borne_max):
                assert r.hors_bornes == ((v < e.borne_min) | (v > e.borne_max)).sum(), (load, x)
    assert got.hors_motif.sum() > 0 and got.hors_bornes.sum() > 0

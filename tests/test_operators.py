"""Small fixtures for the traps of the relational and grouped operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import fuzzy, scores
from ledgerlake.functions.text import norm_name_delete, norm_name_space
from ledgerlake.operators import align, layout, rules, select
from ledgerlake.sources import files, sinks
from ledgerlake.streaming.incremental import open_jobs, upsert_new_files


def test_rules_with_blanks(spark):
    facts = spark.createDataFrame([(1, 10.0, 4.0, None, 6.0), (2, None, 1.0, 2.0, 3.0), (3, 10.0, 4.0, 4.0, 4.0), (4, 11.0, 4.0, None, 6.0), (5, 11.01, 4.0, None, 6.0)], "id int, t double, a double, b double, c double")
    got = {r.id: (r.evaluable, r.ok) for r in rules.evaluated(facts, [("T", 1, ["A", "B", "C"])], 1.0, ["id"]).collect()}
    assert got == {1: (True, True), 2: (False, None), 3: (True, False), 4: (True, True), 5: (True, False)}
    assert rules.evaluated(facts, [("T", 1, ["A", "X"])], 1.0, ["id"]).count() == 0
    assert len(rules.IDENTITIES) == 34 and all(sign in (1, -1) and len(parts) >= 2 for _, sign, parts in rules.IDENTITIES)


def test_percent_rounds_ties_to_even(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 5), (3, 0), (1, 16), (3, 16)], "a long, b long").select("a", "b", rules.percent(F.col("a"), F.col("b")).alias("p"))
    assert [r.p for r in df.collect()] == [12.5, 33.33, 0.0, None, 6.25, 18.75]


def test_sign_flip(spark):
    df = spark.createDataFrame([(-20.0,), (20.0,), (21.9,), (-30.0,), (None,)], "s double")
    assert [r.x for r in df.select(rules.sign_check(F.col("s"), F.lit(30.0), F.lit(10.0)).alias("x")).collect()] == ["ERREUR", None, None, "ALERTE", None]


def test_stability_bridges_gaps_and_skips_zero(spark):
    rows = [("a", "x", 1, 10.0), ("a", "x", 3, 40.0), ("b", "x", 1, 0.0), ("b", "x", 2, 5.0), ("c", "x", 1, 4.0), ("c", "x", 2, -4.0), ("d", "x", 1, 4.0), ("d", "x", 2, None), ("d", "x", 3, 5.0)]
    df = spark.createDataFrame(rows, "e string, champ string, an int, v double")
    assert {(r.e, r.annee_avant, r.an) for r in rules.stability(df, "e", "an", "v").collect()} == {("a", 1, 3), ("c", 1, 2)}


def test_upsert_is_idempotent_and_compares_keys_as_text(spark):
    old = spark.createDataFrame([(1, 2020, "a"), (2, 2020, "b"), (None, 2020, "n")], "k int, an int, v string")
    new = spark.createDataFrame([("2", 2020, "B", 1), (None, 2020, "N", 1)], "k string, an int, v string, plus int")
    once = select.upsert(old.withColumn("k", F.col("k").cast("string")), new, ["k", "an"])
    assert sorted((r.k or "", r.v) for r in once.collect()) == [("", "N"), ("1", "a"), ("2", "B")]
    twice = select.upsert(once, new, ["k", "an"])
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_last_write_wins_even_if_blank(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("b", 1, 3.0)], "k string, p int, v double")
    assert {r.k: r.v for r in select.last_wins(df, ["k"], F.col("p"), ["v"]).collect()} == {"a": None, "b": 3.0}


def test_merges_keep_null_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("z", 4)], "k string, b int")
    assert {(r.k, r.a, r.b, r.origine) for r in select.full_merge(a, b, "k", "l", "r").collect()} == {("x", 1, None, "l"), (None, 2, 3, "les_deux"), ("z", None, 4, "r")}
    assert select.left_merge(a, b.withColumnRenamed("b", "a"), "k", "_immo").columns == ["k", "a", "a_immo"]


def test_majority_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([("g", "b", 1), ("g", "a", 2), ("g", "a", 3), ("g", "b", 4), ("g", None, 5)], "g string, v string, p int")
    assert select.majority(df, ["g"], "v", "p").collect()[0].v == "b"


def test_names_differ_by_normaliser(spark):
    r = spark.createDataFrame([("A.B Co",)], "n string").select(norm_name_delete(F.col("n")).alias("d"), norm_name_space(F.col("n")).alias("s")).first()
    assert (r.d, r.s) == ("ab co", "a b co")


def test_contained_names(spark):
    asked = spark.createDataFrame([("q1", "ab"), ("q2", "xx vaverika yy"), ("q3", "zzz"), ("q4", "")], "nom string, cle string")
    known = spark.createDataFrame([("K1", "cab d", 1), ("K2", "vaverika", 2)], "trouve string, cle string, ordre int")
    assert {(r.nom, r.trouve) for r in select.contained_names(asked, known).collect()} == {("q1", "K1"), ("q2", "K2")}


def test_scores_years_and_dates(spark):
    df = spark.createDataFrame([("Rapport 2019 publié 2020", "Siège 3/4/99 et", "Clients123,5", "-12,5", "1.234")], "t string, d string, l string, n string, g string")
    label, number = scores.glued_number(F.col("l"))
    r = df.select(scores.first_year(F.col("t")).alias("a"), scores.last_year(F.col("t")).alias("b"), scores.extract_date(F.col("d")).alias("c"), label.alias("e"), number.alias("f"), scores.clean_number(F.col("n")).alias("g"), scores.clean_number_grouped(F.col("g")).alias("h")).first()
    assert tuple(r) == (2019, 2020, "03/04/1999", "Clients", "123,5", -12.5, 1234.0)
    tie = spark.createDataFrame([("immobilisations corporelles total de l actif stocks tresorerie actif terrains immobilisations chiffre d affaires resultat net charges d exploitation capitaux propres total du passif endettement raison sociale siege identifiants de la societe registre du commerce",)], "n string")
    category, _ = scores.best_category(F.col("n"))
    assert tie.select(category.alias("c")).first().c in ("autre", "bilan_actif")
    assert tie.select(scores.weighted_score(F.lit("exercice"), {"ice": 14}).alias("s")).first().s == 14


def test_label_key_and_similarity():
    assert fuzzy.label_key("II. Banques T.G. et (A) C.C.P. (éléments circulants)") == "banques tg et ccp elements circulants"
    assert fuzzy.label_key(None) == "" and fuzzy.label_key("12. III") == ""
    assert fuzzy.similarity("stocks", "stocks et encours") >= 0.9 and fuzzy.similarity("", "x") == 0.0
    assert fuzzy.holds_words("le total des capitaux propre net", "capitaux propres") and not fuzzy.holds_words("a b", "c d e")
    assert fuzzy.holds_letters("xx bilan actlf yy", "bilan actif") and not fuzzy.holds_letters("xx compte courant yy", "bilan actif") and not fuzzy.holds_letters("", "abc")
    table = fuzzy.WordTable([["impots", "et", "taxes"], ["charges", "de", "personnel"]], 2)
    assert [(round(s, 2), i, n) for s, i, n in table.scores(["impots", "et", "taxes"], 0.5)] == [(1.0, 0, 1), (0.6, 0, 2)] and table.scores([], 0.1) == []
    assert fuzzy.group_thousands("capital 1 250 000 000,50 DH") == "1 250 000 000,50" and fuzzy.group_thousands("x") is None


def test_alignment_in_two_passes():
    entries = ["Capital social", "Réserve légale", "Autres réserves", "Report à nouveau", "Résultat net"]
    got = align.align(["Report à nouveau", "Capital socal", "xyz", "", "Résultat net"], entries)
    assert [m for m, _ in got] == [3, 0, None, None, 4]
    assert align.align([], entries) == [] and align.align(["a"], [])[0][0] is None


INCOME = ["Produits d'exploitation", "Ventes de marchandises", "Ventes de biens et services produits", "Variation des stocks de produits", "Subventions d'exploitation", "Autres produits d'exploitation", "Achats revendus de marchandises", "Autres charges externes", "Impôts et taxes", "Charges de personnel"]


def test_income_lines_are_split_only_on_proof():
    split = align.split_income([("Subventions d'exploitation Autres produits d'exploitation", ["1000", "500"])], INCOME)
    assert [(r[0].split()[0], r[1]) for r in split] == [("Subventions", ["1000", "500"]), ("Autres", ["", ""])]
    kept = align.split_income([("Texte aleatoire sans rapport", ["", ""])], INCOME)
    assert kept[0][0] == "Texte aleatoire sans rapport" and kept[0][2].startswith("NON_RECONNU")
    assert align.split_income([("TOTAL I", ["100", "90"])], INCOME)[0][3] == "TOTAL"
    gap = align.split_income([("Ventes de marchandises", ["10"]), ("Charges de personnel", ["50"])], INCOME)
    assert [r[3] for r in gap] == ["DETAIL", "DETAIL"] and [len(gap)] == [2]


def test_generic_split_flags_every_line():
    got = align.split_fused([("Capital social Réserve légale", ["5"]), ("Report", ["1"])], ["Capital social", "Réserve légale", "Report à nouveau"])
    assert [(g[0], g[1]) for g in got] == [("Capital social", ["5"]), ("Réserve légale", [""]), ("Report", ["1"])] and got[1][2]


def test_partial_tables_take_their_neighbours():
    groups = {"bilan": {"actif": "actif immobilise", "treso": "tresorerie"}}
    tables = [{"id": 1, "bloc": 10, "serie": "social", "genre": "bilan", "texte": "actif immobilise", "score": 50}, {"id": 2, "bloc": 13, "serie": None, "genre": "autre", "texte": "tresorerie", "score": 0}, {"id": 3, "bloc": 40, "serie": None, "genre": "autre", "texte": "tresorerie", "score": 0}]
    got = {t["id"]: t for t in align.repair_partial(tables, groups, lambda text, kind: 80)}
    assert got[1]["avec"] == [2] and got[2]["genre"] == "fusionne" and not got[1]["partiel"] and got[1]["confiance"] == 0.8
    alone = align.repair_partial(tables[:1], groups, lambda text, kind: 80)[0]
    assert alone["partiel"] and alone["confiance"] == 0.3


WORDS = "page string, text string, left double, top double, width double, height double"


def word(text, left, top, width=40, height=10, page="p1"):
    return (page, text, float(left), float(top), float(width), float(height))


def test_page_layout(spark):
    page = [word("Indicateurs", 0, 0), word("2022", 200, 0), word("2023", 300, 0), word("2024", 400, 1), word("Chiffre", 0, 30), word("12,5", 200, 31), word("13", 300, 30), word("1", 390, 30, 10), word("4", 405, 30, 10), word("Effectif", 0, 60), word("7", 215, 60, 20)]
    # a page of two sections, a repeated indicator and a header that does not name all columns
    other = [word(*w, page="p2") for w in [("Valeurs", 0, 0), ("2023", 200, 0), ("Social", 0, 20), ("CAF", 0, 40), ("5", 215, 40, 20), ("6", 315, 40, 20), ("CAF", 0, 60), ("7", 215, 60, 20), ("Consolidé", 0, 80), ("PNB", 0, 100), ("-8,5", 310, 100, 20)]]
    words = spark.createDataFrame([*page, *other, ("p3", None, None, None, None, None), word("seul", 0, 0, page="p4")], WORDS)
    got = {(r.page, r.champ): r.valeur for r in layout.indicator_table(words, sections=("social", "consolide")).collect()}
    assert got == {
        ("p1", "chiffre_affaires_annee_1"): 12.5, ("p1", "chiffre_affaires_annee_2"): 13.0, ("p1", "chiffre_affaires_annee_3"): 14.0, ("p1", "effectif_annee_1"): 7.0,
        ("p2", "social_caf_annee_1"): 5.0, ("p2", "social_caf_annee_3"): 6.0, ("p2", "social_caf_dup2_annee_1"): 7.0, ("p2", "consolide_pnb_annee_2"): -8.5,
    }
    assert [(r.ligne, r.label, len(r.numbers)) for r in layout.lines_of(words).where("page = 'p1'").orderBy("ligne").collect()] == [(0, "indicateurs", 3), (1, "chiffre", 4), (2, "effectif", 1)]
    edges = spark.createDataFrame([("p", float(x)) for x in (1, 2, 50, 52, 100)], "page string, x double")
    assert [r.x for r in layout.columns_of(edges).orderBy("colonne").collect()] == [1.5, 51.0, 100.0] and layout.columns_of(edges.limit(0)).count() == 0
    anchors = spark.createDataFrame([("p", "a", 100.0), ("p", "b", 140.0), ("p", "c", 900.0)], "page string, nom string, x double")
    assert [tuple(r)[1:] for r in layout.bands(anchors).orderBy("nom").collect()] == [("a", -30.0, 120.0), ("b", 120.0, 270.0), ("c", 770.0, 1030.0)]
    grid = spark.createDataFrame([word("Terrains", 0, 0), word("Constructions", 200, 0), word("2.576", 0, 40), word("6153", 205, 40), word("2023", 400, 40), word("9", 0, 900), word("rien", 0, 0, page="p2")], WORDS)
    assert {(r.page, r.champ): r.valeur for r in layout.value_grid(grid).collect()} == {("p1", "terrains"): 2576.0, ("p1", "constructions"): 6153.0}
    found = layout.section_anchors(words, {"t": ["chiffre"], "u": ["effectif", "groupe"], "v": ["effectif", "groupe"]}, frozenset("u"))
    assert {(r.page, r.nom): r.haut for r in found.collect()} == {("p1", "t"): 30.0, ("p1", "v"): 60.0}
    passes = spark.createDataFrame([("p", 1, 5.0, "a"), ("p", 2, 9.0, "a"), ("p", 2, 9.0, "b"), ("p", 3, 7.0, "a"), ("p", 3, 7.0, "c")], "page string, passe int, largeur double, champ string")
    assert layout.best_pass(passes).first().passe == 3
    assert layout.pairs(layout.np.array([[1.0, 2.0], [1.5, 9.0]])) == [(0, 0), (1, 1)] and layout.pairs(layout.np.zeros((0, 2))) == []


def test_the_best_assignment_is_monotone():
    options = [[(0.9, 2, 1), (0.8, 0, 1)], [(0.9, 1, 1)], [(0.7, 0, 1)]]
    assert align.monotone(options, 3) == [(0.8, 0, 1), (0.9, 1, 1), None]
    assert align.monotone([[(0.9, 20, 1)]], 25) == [None] and align.monotone([], 3) == [] and align.monotone([[]], 0) == [None]


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿nom;a ;b\nx;1,5;2\n;;\ny;1.5;NA\n", encoding="utf-8")
    t = files.read_table(spark, str(tmp_path / "t.csv"))
    assert t.columns == ["nom", "a", "b"] and t.count() == 2
    assert [(r.a, r.b) for r in files.to_numbers(t, ["nom"]).orderBy("nom").collect()] == [(None, 2.0), (1.5, None)]
    assert files.missing_to_null(t).where("b is null").count() == 1
    (tmp_path / "n.json").write_text('{"A": {"2020": {"file": "f", "pages": 12, "full_path": "p"}, "x": {"file": "g", "pages": -1, "full_path": "q"}}}')
    assert {(r.entreprise, r.annee, r.pages) for r in files.read_page_counts(spark, str(tmp_path / "n.json")).collect()} == {("A", 2020, 12), ("A", None, None)}
    (tmp_path / "l.json").write_text('{"seuil": 20, "rapports_volumineux": {"A": [{"annee": "2020", "pages": 30, "fichier": "f"}]}}')
    (tmp_path / "l2.json").write_text('{"A": [{"annee": "2021", "pages": 31, "fichier": "g"}]}')
    assert {r.annee for r in files.read_large_list(spark, str(tmp_path / "l*.json")).collect()} == {2020, 2021}
    (tmp_path / "x_content_list.json").write_text('[{"type": "table", "table_caption": ["a", "b"], "page_idx": 1}, {"type": "text", "text": "t", "table_caption": "c"}]')
    (tmp_path / "y_content_list.json").write_text('{"type": "table"}')
    assert [(r.bloc, r.type, r.table_caption) for r in files.read_blocks(spark, str(tmp_path / "*_content_list.json")).orderBy("bloc").collect()] == [(0, "table", "a b"), (1, "text", "c")]
    (tmp_path / "Co").mkdir()
    (tmp_path / "Co/2019.pdf").write_bytes(b"1")
    (tmp_path / "Co/notes.pdf").write_bytes(b"22")
    listing = files.list_files(spark, str(tmp_path), "*.pdf")
    assert {(r.dossier, r.nom, r.annee, r.octets) for r in listing.collect()} == {("Co", "2019.pdf", 2019, 1), ("Co", "notes.pdf", None, 2)}
    assert files.preferred_file(listing, ["dossier"], F.lit("NOTES.PDF")).first().chemin.endswith("notes.pdf") and files.latest_file(listing, ["dossier"]).count() == 1
    html = '<a href="/r/2019.pdf"><b>Rapport</b> 2019</a><a href="http://x/y.PDF?v=1">Y</a><a href="z.pdf"> </a><table><tr><td rowspan="2">a</td><td>b</td></tr><tr><td>c</td></tr></table>'
    r = spark.createDataFrame([(html,)], "h string").select(files.pdf_links(F.col("h"), "http://site").alias("l"), files.table_rows(F.col("h")).alias("t")).first()
    assert [tuple(x) for x in r.l] == [("http://site/r/2019.pdf", "Rapport 2019"), ("http://x/y.PDF", "Y")] and r.t == [["a", "b"], ["c"]]
    assert files.expand_grid(html) == [["a", "b"], ["a", "c"]] and files.unique_names(["x", "x", "", None]) == ["x", "x_2", "col_3", "col_4"]
    target = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.upsert_into(rows, target, ["k"])
    sinks.upsert_into(spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), target, ["k"])
    sinks.append_into(spark.createDataFrame([(3, "x"), (4, "d")], "k int, v string"), target, ["k"])
    assert {(r.k, r.v) for r in spark.read.parquet(target).collect()} == {(1, "a"), (2, "B"), (3, "c"), (4, "d")}
    parts = {f.parent.name: f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    sinks.upsert_into(spark.createDataFrame([(2, "b2")], "k int, v string"), target, ["k"])
    again = {f.parent.name: f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    assert sum(parts[p] != again[p] for p in parts) == 1 and {r.v for r in spark.read.parquet(target).where("k = 2").collect()} == {"b2"}
    sinks.upsert_into(spark.createDataFrame([], "k int, v string"), target, ["k"])
    assert spark.read.parquet(target).count() == 4
    sinks.batch_reports(spark.createDataFrame([("a", "FAILED"), ("b", "SUCCESS")], "job string, statut string"), str(tmp_path / "batch"))
    assert files.read_table(spark, str(tmp_path / "batch/echecs")).count() == 1 and files.read_table(spark, str(tmp_path / "batch/rapport")).count() == 2
    sinks.export_entities(rows, str(tmp_path / "entities"), "k")
    assert spark.read.json(str(tmp_path / "entities")).count() == 2


def test_pages_and_jobs(spark, tmp_path):
    page = "<table><tr><th>Année</th><th>Type</th><th>Lien</th></tr><tr><td>2020</td><td>RFA</td><td><a href='/a.pdf'>pdf</a></td></tr><tr><td>x</td><td>semestriel 2019</td><td><a href='b.pdf'>pdf</a></td></tr><tr><td>2018</td><td>sans lien</td><td>-</td></tr></table>"
    pages = spark.createDataFrame([("u1", page + '<a rel="next" href="u2">»</a>'), ("u2", "<table><tr><th>Nom</th></tr><tr><td>2020</td></tr></table><a href='u3' rel='next'>»</a>"), ("u3", "<a rel='next' href='u1'>»</a>"), ("v", None)], "url string, html string")
    got = pages.where("url in ('u1', 'u2', 'v')").select("url", files.statement_rows(F.col("html"), "http://s").alias("r")).collect()
    assert {r.url: r.r and [tuple(x) for x in r.r] for r in got} == {"u1": [(2020, "RFA", "http://s/a.pdf"), (2019, "semestriel 2019", "http://s/b.pdf")], "u2": None, "v": None}
    first = spark.createDataFrame([("u1",), ("v",), ("absent",)], "url string")
    assert {(r.depart, r.url, r.pas) for r in files.follow_pages(pages, first).collect()} == {("u1", "u1", 0), ("u1", "u2", 1), ("u1", "u3", 2), ("v", "v", 0)}
    new, old = (spark.createDataFrame(x, "job string, chemin string") for x in ([("a", "n/a")], [("a", "o/a"), ("b", "o/b")]))
    assert {tuple(r) for r in files.jobs_of(new, old, ["job"]).collect()} == {("a", "n/a", "nouveau"), ("b", "o/b", "ancien")}
    kept = str(tmp_path / "cache")
    assert [files.cached(spark, kept, lambda n=n: spark.range(n), force).count() for n, force in ((2, False), (3, False), (3, True))] == [2, 2, 3]


def test_few_filled_and_cost_per_head(spark):
    df = spark.createDataFrame([(1, "a", None, 2.0), (2, " ", None, None), (3, "a", "b", None)], "id int, x string, y string, z double")
    assert [r.id for r in df.where(rules.few_filled(df, ["x", "y", "z"], 2)).collect()] == [2]
    rows = [("a", 2020, 1.0, 10.0, 1.0), ("a", 2021, 1.0, None, 1.0), ("b", 2020, 1.0, None, 2.0), ("b", 2021, 90.0, None, 0.0), ("c", 2020, 1.0, None, None), ("d", 2020, 0.1, 4.0, 1.0)]
    facts = spark.createDataFrame(rows, "e string, an int, c double, t double, g double")
    assert {(r.e, r.an): r.par_tete for r in rules.cost_per_head(facts, "e", "an", "c", "t", "g").collect()} == {("d", 2020): 25000.0}


def test_incremental_runs_read_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    one = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, p int, v string")
    one.write.parquet(source)
    run = lambda: upsert_new_files(spark, source, one.schema, target, checkpoint, ["k"], "p")
    run()
    first = {(r.k, r.v) for r in spark.read.parquet(target).collect()}
    run()
    assert first == {("a", None), ("b", "y")} == {(r.k, r.v) for r in spark.read.parquet(target).collect()}
    spark.createDataFrame([("b", 5, "z")], one.schema).write.mode("append").parquet(source)
    run()
    assert {(r.k, r.v) for r in spark.read.parquet(target).collect()} == {("a", None), ("b", "z")}
    jobs, done, outputs = (spark.createDataFrame([(x,) for x in xs], "k int") for xs in ([1, 2, 3], [1, 2], [1]))
    assert {r.k for r in open_jobs(jobs, done, outputs, ["k"]).collect()} == {2, 3}


def test_header_lines_and_layouts(spark):
    rows = [(1, "ACTIF", 0, "EXERCICE", ["", ""], "exercice"), (1, "ACTIF", 1, "ACTIF / KDH", ["", ""], "actif kdh"), (1, "ACTIF", 2, "Stocks", ["5", "4"], "stocks 5 4"), (1, "ACTIF", 3, "Total", ["9", "8"], "total 9 8"), (2, "ACTIF", 0, "Stocks", ["7", "2", "5", "4"], "stocks 7 2 5 4"), (3, "ACTIF", 0, "Seul", ["1"], "seul 1")]
    df = spark.createDataFrame(rows, "table int, section string, rang int, label string, cells array<string>, normal string")
    got = {(r.table, r.rang): (r.courant, r.precedent) for r in align.value_columns(df, F.col("normal")).collect()}
    assert got == {(1, 2): ("5", "4"), (1, 3): ("9", "8"), (2, 0): ("5", "4"), (3, 0): (None, None)}


def test_orphan_values_move_up(spark):
    rows = [(1, 0, 1, "A", "", ""), (1, 1, 2, "", "12", ""), (1, 2, 3, "B", "5", ""), (1, 3, 4, "", "9", "")]
    got = [(r.label, r.courant) for r in align.carry_orphans(spark.createDataFrame(rows, "table int, rang int, field_id int, label string, courant string, precedent string")).orderBy("rang").collect()]
    assert got == [("A", "12"), ("B", "5"), ("", "9")]


@pytest.mark.parametrize("text,wanted", [("Mohamed XXXXXX abc STOP", "Mohamed"), (None, "")])
def test_noise_words(text, wanted):
    assert fuzzy.clean_tokens(text, frozenset(["stop"])) == wanted

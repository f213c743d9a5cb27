"""The corpus operators: exactness against other implementations, brute force, held-out accuracy, awkward tables."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, labels, mixing, pii, pii_examples, registry, survivor
from ledgerlake.llm.crf import CELL, Model, flat, tokens
from ledgerlake.llm.pii_examples import labelled_table
from tests.compare import normal, oracle_rows
from tests.conftest import DATA

QUERIES = sorted(registry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty_tables, name):
    assert registry.queries()[name](spark, empty_tables).count() == 0


@pytest.mark.parametrize("name", QUERIES)
def test_awkward_tables(spark, awkward_tables, name):
    assert registry.queries()[name](spark, awkward_tables).count() > 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    folder = f"{DATA}/sf0.001"
    df = registry.queries()[name](spark, folder)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(*oracle_rows(registry.oracle_sql()[name], folder))


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    with open(f"{bpe.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        raw = f.read()
    own = bpe.Encoder(raw)
    other = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks={w.encode("latin-1"): i for w, i in own.id_of.items()}, special_tokens={})
    return own, other


def test_ids_equal_another_encoder(reference):
    own, other = reference
    r = random.Random(1)
    parts = ["a", "b", "é", "  ", "\n", "the", "ing", "😀", "ß", "0", "12", "ال", "er", "-", "=", "<|endoftext|>", "n'", "'s", "\r\n", "\xa0"]
    for _ in range(1500):
        text = "".join(r.choice(parts) for _ in range(r.randint(1, 50)))
        assert list(own.text(text)) == other.encode_ordinary(text), text


def test_long_pieces_round_trip(reference):
    own, other = reference
    for text in ("a" * 50_000, " " * 20_000 + "x", "ab" * 30_000, "-" * 9_999):
        ids = own.text(text)
        assert "".join(own.word_of[i] for i in ids).encode("latin-1").decode() == text
    assert list(own.text("-" * 500)) == other.encode_ordinary("-" * 500)


def test_corpus_ids(spark, reference):
    _, other = reference
    folder = f"{DATA}/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r.ids for r in bpe.p6_ids(spark, folder).collect()}
    assert got == {i: other.encode_ordinary(t) if t else [] for i, t in texts.items()}


def test_file_names_mean_one_report(spark):
    urls = ["https://x.example/a/Banotala-Com-2022-00000241.pdf?v=2", "http://y.test/BANOTALA%20COM%202022%2000000241.PDF#toc", "https://z/banotala%2Dcom%2D2022%2D00000241.pdf", "https://z/banotala_com_2022_00000241 (2).pdf"]
    titles = ["[LOCAL] Banotala-Com-2022-00000241 - copie.pdf", "[LOCAL] banotala_com_2022_00000241 (1).pdf"]
    others = ["https://z/banotala-com-2022-00000241-v2.pdf", "https://z/banotala-com-2022-00000241-en.pdf"]
    df = spark.createDataFrame([(u, "t") for u in urls] + [(None, t) for t in titles], "u string, t string")
    assert {r.k for r in df.select(survivor.file_key(F.col("u"), F.col("t")).alias("k")).collect()} == {"banotala com 2022 00000241"}
    apart = spark.createDataFrame([(u, "t") for u in others] + [(None, None), ("", " ")], "u string, t string")
    assert [r.k for r in apart.select(survivor.file_key(F.col("u"), F.col("t")).alias("k")).collect()] == ["banotala com 2022 00000241 v2", "banotala com 2022 00000241 en", None, None]


def test_votes_summed_or_strongest(spark):
    rows = [("g", 1, 1, "2025-01-01", 2020, 0, 50), ("g", 2, 2, "2025-01-01", 2021, 7, None), ("g", 3, 2, "2025-01-01", 2021, 9, 101), ("g", 4, 2, None, 2021, 9, None), ("h", 9, 1, None, None, None, None)]
    df = spark.createDataFrame(rows, "cle string, cand_id long, rang long, d string, annee int, nb_pages int, score int").withColumn("collecte_le", F.col("d").cast("timestamp"))
    fields = list(survivor.USABLE)
    got = {r.cle: r for r in survivor.survivors(df, fields).collect()}
    assert tuple(got["g"])[:3] == (1, "g", 4) and (got["g"].annee, got["g"].annee_cand_id, got["g"].nb_pages, got["g"].nb_pages_cand_id, got["g"].score) == (2020, 1, 7, 2, 50)
    assert tuple(got["h"]) == (9, "h", 1, None, None, None, None, None, None)
    more = df.unionByName(df.where("annee = 2021").withColumn("cand_id", F.col("cand_id") + 10))
    assert {r.cle: r.annee for r in survivor.survivors(more, fields, "consensus").collect()}["g"] == 2021
    assert {r.cle: (r.annee, r.annee_cand_id, r.lignes) for r in survivor.survivors(more, fields).collect()}["g"] == (2020, 1, 7)


def test_labels_are_repaired(spark):
    entries = spark.read.parquet(f"{DATA}/sf0.001/champs_cifen.parquet").select("section", "code", "label")
    wanted = {
        ("ACTIF", "Immob. immatérielles"): "Actif_B", ("ACTIF", "Total - Fonds de commerce acqis"): "Actif_B3", ("CPC", "Dépréciationsdenaturefinancière"): "CPC_V_4", ("ACTIF", "A r t icles fab riqu és achevés"): "Actif_F5",
        ("ACTIF", "valeur de cession Actifs sans"): "Actif_A", ("PASSIF", "Capifal 1ibéré ou individucl"): "Passif_A2", ("ACTIF", "Comptes courants des …"): "Actif_G5", ("CPC", "Reprises et transferts de l'activité (1)"): "CPC_I_8",
        ("ACTIF", "Cours de l'action au 31/12"): "NON_MAPPE", ("CPC", "Taux de change de clôture"): "NON_MAPPE", ("PASSIF", "Machines, outillage et équipements d'usine"): "NON_MAPPE", ("ACTIF", "zzz qqq"): "NON_MAPPE",
    }
    asked = spark.createDataFrame([*wanted, ("ACTIF", None), (None, "Inventaires"), ("ACTIF", " ")], "section string, label string")
    got = {(r.section, r.label): r.code for r in labels.map_labels(asked, entries).collect()}
    assert got == wanted


def test_labels_on_held_out_rows(spark):
    """Damaged labels whose account is known: rows with a sound score."""
    folder = f"{DATA}/sf0.01"
    rows = spark.read.parquet(f"{folder}/extracted_fields.parquet").where("code is not null and match_score >= 0.6").selectExpr("bilan as section", "original_label as label", "code")
    mapped = labels.map_labels(rows, spark.read.parquet(f"{folder}/champs_cifen.parquet").select("section", "code", "label")).withColumnRenamed("code", "got")
    r = rows.join(mapped, ["section", "label"], "left").agg(F.avg((F.col("got") == F.col("code")).cast("double")).alias("a")).first()
    assert r.a > 0.995


def test_mix_meets_its_shares(spark):
    folder = f"{DATA}/sf0.01"
    rows = mixing.p7_mix(spark, folder).toPandas()
    mix = {r.source: r for r in spark.read.parquet(f"{folder}/mix_cibles.parquet").collect()}
    assert rows.doc_id.is_unique and set(rows.source) <= set(mix)
    for s, part in rows.groupby("source"):
        assert part.copies.max() <= mix[s].repetitions_max and part.copies.min() >= 0
    taken = (rows.jetons * rows.copies).groupby(rows.source).sum()
    longest = rows.groupby("source").jetons.max()
    weight = sum(mix[s].poids for s in taken.index if rows[rows.source == s].jetons.sum())
    total = (rows.taux * rows.jetons).sum()
    for s in taken.index:
        assert abs((rows.taux * rows.jetons)[rows.source == s].sum() - total * mix[s].poids / weight) < 1e-3 * total
        assert abs(taken[s] - total * mix[s].poids / weight) <= longest[s] + 1
    assert {r.source for r in mixing.p7_shares(spark, folder).collect()} == set(mix)


def test_mix_with_a_larger_total_leaves_small_sources_at_their_bound(spark):
    lengths = spark.createDataFrame([("a", 10, 100), ("a", 30, 50), ("b", 5, 4)], "source string, n long, c long")
    solution = mixing.solve(lengths, {"a": (0.5, 2), "b": (0.5, 3)}, total=2000.0)
    assert solution["b"][1] >= mixing.LARGEST_EXPONENT and solution["a"][1] < mixing.LARGEST_EXPONENT
    assert mixing.solve(lengths.limit(0), {"a": (1.0, 1)}) == {}



def test_viterbi_and_gradient_equal_brute_force():
    """All label paths of a short text, enumerated."""
    from itertools import product

    m = Model(["O", "B-X", "I-X"])
    rng = np.random.default_rng(0)
    m.t, m.s = rng.normal(size=(3, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32)
    emit = rng.normal(size=(4, 3)).astype(np.float32)

    def score(path):
        return m.s[path[0]] + m.bar_start[path[0]] + sum(emit[i, y] for i, y in enumerate(path)) + sum(m.t[a, b] + m.bar[a, b] for a, b in zip(path, path[1:]))

    paths = list(product(range(3), repeat=4))
    assert m.viterbi([emit, emit[:2]])[0].tolist() == list(max(paths, key=score))
    weights = np.exp([score(p) for p in paths])
    expected = sum(w * np.eye(3)[list(p)] for w, p in zip(weights / weights.sum(), paths))
    gold = np.array([[0, 1, 2, 0]])
    grad, _, _ = m.gradient(emit[None].astype(float), gold, np.array([4]))
    assert np.allclose(grad[0], np.eye(3)[gold[0]] - expected, atol=1e-5)


@pytest.fixture(scope="module")
def model():
    return pii.model_of(pii.trained())


def accuracy(model, rows):
    """(precision, recall) of each kind."""
    hit, wrong, lost = Counter(), Counter(), Counter()
    for (text, spans), found in zip(rows, pii.find(model, [t for t, _ in rows])):
        hit.update(k for _, _, k in set(spans) & set(found))
        wrong.update(k for _, _, k in set(found) - set(spans))
        lost.update(k for _, _, k in set(spans) - set(found))
    return {k: (hit[k] / max(1, hit[k] + wrong[k]), hit[k] / max(1, hit[k] + lost[k])) for k in pii.KINDS}


def test_personal_information_on_held_out_rows(model, monkeypatch):
    monkeypatch.setattr(pii_examples, "UNKNOWN", (0.0,))
    assert all(min(x) > 0.93 for x in accuracy(model, labelled_table(600, 99)).values())


def test_personal_information_in_held_out_patterns(monkeypatch):
    """A third of all patterns is kept from training; smaller than the stored model, so the bounds are lower than its figures."""
    (marked, plain), order = pii_examples.patterns(), random.Random(11)
    order.shuffle(marked)
    order.shuffle(plain)
    part = Model(pii.LABELS).fit(pii.labelled_tokens(labelled_table(6000, 7, [x for i, x in enumerate(marked) if i % 3], [x for i, x in enumerate(plain) if i % 3])), epochs=5)
    monkeypatch.setattr(pii_examples, "UNKNOWN", (0.0,))
    got = accuracy(part, labelled_table(800, 101, marked[::3], plain[::3]))
    assert all(min(x) > 0.6 for x in got.values()) and np.mean([min(x) for x in got.values()]) > 0.75, got


def test_the_bound_skips_no_piece(model):
    """Viterbi over every sentence gives the paths that the bound leaves."""
    texts = [t for t, _ in labelled_table(300, 5)] + ["", "a", "Le conseil approuve. " * 50]
    cells = [CELL.findall(flat(t)) for t in texts]
    short = model.decode(cells)
    for c, path in zip(cells, short):
        if not c:
            assert path is None
            continue
        rows = np.r_[0, 0, 0, [model.cells[x] for x in c], 0, 0, 0]
        emit = sum(model.store[i, rows[3 + o : 3 + o + len(c)]] for i, o in enumerate((-3, -2, -1, 0, 1, 2, 3)))
        flags = model.flags[rows]
        ends = [k + 1 for k in range(len(c) - 1) if flags[k + 3] & 1 and flags[k + 4] & 2 and flags[k + 2] & 4] + [len(c)]
        whole = np.concatenate([model.viterbi([emit[a:b]])[0] for a, b in zip([0, *ends], ends)])
        assert (whole == (0 if path is None else path)).all()


def test_pieces_stand_as_in_the_text(model):
    text = "Passeport R429445 présenté par Emma\nSefrotane, mandataire, demeurant 224, av. des Amandiers\n81340 BELKORA. La facture n° 685578283 reste en litige. Tél. : (+212) 500-45-15-26 ; hedv53 @ boite-mail.test"
    found = {(k, text[a:b]) for a, b, k in pii.find(model, [text])[0]}
    assert {("ID", "R429445"), ("NAME", "Emma\nSefrotane"), ("ADDRESS", "224, av. des Amandiers\n81340 BELKORA"), ("PHONE", "(+212) 500-45-15-26"), ("EMAIL", "hedv53 @ boite-mail.test")} == found
    masked = pii.masked(text, pii.find(model, [text])[0])
    assert masked.startswith("Passeport [ID] présenté par [NAME], mandataire, demeurant [ADDRESS].") and "685578283" in masked
    assert pii.find(model, [None, "", "  \n", "x"]) == [[], [], [], []] and pii.masked(None, []) is None
    assert tokens("") == ([], [], [])

"""Problem 4: labels as read, mapped to the account of their section that they mean.

Every distinct token of the labels is joined once to the vocabulary of the reference list: bigrams propose, the edit
distance decides, shortened tokens match by prefix. A label's repaired tokens then rank the entries of its section by
soft TF-IDF. Labels whose words run together or fall apart have no tokens to repair; for them, and for labels cut off
at the end, the letters without blanks are compared with the entry's, proposed by trigrams. A line that means no
account is told by the score of its best entry alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.parse import BLANK, let
from ledgerlake.functions.text import fold
from ledgerlake.session import broadcast_if_small, cut
from ledgerlake.sources.tables import table

NOT_MAPPED = "NON_MAPPE"
#: Rows below this score, or without code, are mapped; labels whose best entry scores below the second are not.
POOR, ACCEPT = 0.6, 0.68
#: Least similarity of a repaired token, similarity given to a prefix, and to the cut last word.
TOKEN_SIM, PREFIX_SIM, CUT_SIM = 0.6, 0.92, 0.85
#: Least share of an entry's trigrams that a label must hold to be compared by its letters.
LEAST_TRIGRAMS = 0.25
#: Words that carry no meaning of their own.
EMPTY_WORDS = ("des", "les", "aux", "une", "par", "sur", "dans", "pour", "the", "net")


def bare_label(label: Column) -> Column:
    """Folded lower case without what is put before or after a label: numbering, subtotals, notes, leaders."""
    flat = F.lower(F.trim(F.regexp_replace(fold(label), rf"[{BLANK}]+", " ")))
    flat = F.regexp_replace(flat, r"[‘’`´]", "'")
    head = r"^(?:[*•·\-–—+=\s]+|t?total+ ?[\-–—:] ?|total (?=\S+ \S)|s ?/ ?t\.? |s ?/ (?=\S)|sous.?t\.? |dont ?:? |(?:[ivx]{1,4}|[a-h]|\d{1,2}) ?[.)/\-–—] ?(?:/ ?)?)+"
    tail = r"(?:\s*(?:\((?:note )?[a-z0-9 ]{0,3}\)|\((?:note|notes) ?\d*\)|[*_]+|\.{3,}|[–—-] net)\s*)+$"
    once = F.regexp_replace(F.regexp_replace(flat, tail, ""), head, "")
    return F.trim(F.when(once == "", flat).otherwise(once))


def letters(text: Column) -> Column:
    """Letters and digits alone, look-alikes of scanned print made equal."""
    plain = F.translate(F.regexp_replace(text, r"[^a-z0-9]", ""), "0156389", "olsebbg")
    return F.replace(F.replace(F.replace(plain, F.lit("rn"), F.lit("m")), F.lit("cl"), F.lit("d")), F.lit("vv"), F.lit("w"))


def words(text: Column) -> Column:
    """Words of three letters or more; a word cut short by a point keeps the point."""
    found = F.regexp_extract_all(text, F.lit(r"([a-z0-9]+\.?)"), F.lit(1))
    kept = F.filter(found, lambda w: ~F.regexp_replace(w, r"\.$", "").isin(*EMPTY_WORDS) & ((F.length(w) >= 3) | w.endswith(".")))
    return F.transform(kept, lambda w: F.when(w.endswith("."), F.concat(letters(w), F.lit("."))).otherwise(letters(w)))


def ngrams(text: Column, n: int) -> Column:
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n))))


def similarity(a: Column, b: Column) -> Column:
    """One less the edits per letter; two letters that changed places are one edit."""
    sorted_letters = lambda t: F.array_sort(F.split(t, ""))
    edits = let(F.levenshtein(a, b), lambda d: F.when((d == 2) & (F.length(a) == F.length(b)) & (sorted_letters(a) == sorted_letters(b)), 1).otherwise(d))
    return 1 - edits / F.greatest(F.length(a), F.length(b), F.lit(1))


def reference(entries: DataFrame) -> DataFrame:
    """(section, eid, code, lettres, mots) of each entry."""
    bare = entries.where("label is not null and code is not null and section is not null").select("section", "code", F.lower(fold(F.col("label"))).alias("b"))
    return bare.select("section", "code", F.xxhash64("section", "code", "b").alias("eid"), letters(F.col("b")).alias("lettres"), words(F.col("b")).alias("mots")).dropDuplicates(["eid"])


def token_weights(ref: DataFrame) -> DataFrame:
    """(section, mot, eid, poids, total): postings of the vocabulary with inverse document frequency in the section."""
    rows = ref.select("section", "eid", F.explode(F.array_distinct("mots")).alias("mot"))
    size = ref.groupBy("section").agg(F.count(F.lit(1)).alias("n"))
    freq = rows.groupBy("section", "mot").agg(F.count(F.lit(1)).alias("df"))
    weighted = rows.join(freq, ["section", "mot"]).join(size, "section").select("section", "mot", "eid", F.log(1 + F.col("n") / F.col("df")).alias("poids"))
    return weighted.withColumn("total", F.sum("poids").over(Window.partitionBy("eid")))


def repaired_tokens(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(jeton, mot, sim): vocabulary words that a token may mean; ``tokens`` has distinct ``jeton``."""
    vocab = vocabulary.select("mot").distinct().withColumn("taille", F.size(ngrams(F.col("mot"), 2)))
    asked = tokens.withColumn("racine", F.regexp_replace("jeton", r"\.$", ""))
    proposed = (
        asked.select("jeton", "racine", F.explode(ngrams(F.col("racine"), 2)).alias("g"))
        .join(broadcast_if_small(cut(vocab.select("mot", "taille", F.explode(ngrams(F.col("mot"), 2)).alias("g")))), "g")
        .groupBy("jeton", "racine", "mot").agg(F.count(F.lit(1)).alias("n"), F.first("taille").alias("taille"))
    )
    near = proposed.select("jeton", "mot", F.when(F.col("racine") == F.col("mot"), 1.0).otherwise(similarity(F.col("racine"), F.col("mot")) * 0.98).alias("sim")).where(F.col("sim") >= TOKEN_SIM)
    # every beginning of a word is in the index, so a shortened token meets only words that it begins
    begun = vocab.where(F.length("mot") > 1).select("mot", F.explode(F.transform(F.sequence(F.lit(1), F.length("mot") - 1), lambda i: F.left(F.col("mot"), i))).alias("racine"))
    short = (
        asked.where(F.length("racine") >= 1).join(broadcast_if_small(cut(begun)), "racine")
        .select("jeton", "mot", F.when(F.col("jeton").endswith("."), PREFIX_SIM).otherwise(CUT_SIM).alias("sim"), (~F.col("jeton").endswith(".")).alias("cut"))
    )
    return near.withColumn("cut", F.lit(False)).unionByName(short).groupBy("jeton", "mot", "cut").agg(F.max("sim").alias("sim"))


def by_tokens(labels: DataFrame, ref: DataFrame) -> DataFrame:
    """(lid, eid, score): soft TF-IDF, twice the weight in common over the weights of both."""
    postings = broadcast_if_small(cut(token_weights(ref)))
    each = labels.select("lid", "section", F.posexplode("mots").alias("pos", "jeton"), (F.size("mots") - 1).alias("fin")).withColumn("dernier", F.col("pos") == F.col("fin"))
    repaired = cut(repaired_tokens(each.select("jeton").distinct(), postings))
    repaired = broadcast_if_small(repaired)
    meant = each.join(repaired, "jeton").where("not cut or dernier").select("lid", "section", "pos", "mot", "sim")
    hits = meant.join(postings, ["section", "mot"])
    # what a label weighs: each token as much as the heaviest word it may mean, an unknown one as much as a rare word
    rare = 4.0
    known = hits.groupBy("lid", "pos").agg(F.max(F.struct("sim", "poids")).alias("b")).groupBy("lid").agg(F.sum("b.poids").alias("k"), F.count(F.lit(1)).alias("nk"))
    shared = hits.groupBy("lid", "eid", "mot").agg(F.max(F.col("sim") * F.col("poids")).alias("s"), F.first("total").alias("total")).groupBy("lid", "eid").agg(F.sum("s").alias("s"), F.first("total").alias("total"))
    sizes = labels.select("lid", F.size("mots").alias("n"))
    scored = shared.join(known, "lid").join(sizes, "lid")
    return scored.select("lid", "eid", (2 * F.col("s") / (F.col("total") + F.col("k") + rare * F.greatest(F.col("n") - F.col("nk"), F.lit(0)))).alias("score"))


def by_letters(labels: DataFrame, ref: DataFrame) -> DataFrame:
    """(lid, eid, score): edit similarity of the letters without blanks, of the whole entry or of a label cut short."""
    index = broadcast_if_small(cut(ref.select("section", "eid", "lettres", F.explode(ngrams(F.col("lettres"), 3)).alias("g"), F.size(ngrams(F.col("lettres"), 3)).alias("taille"))))
    grams = labels.select("lid", "section", F.col("lettres").alias("l"), "coupe", F.explode(ngrams(F.col("lettres"), 3)).alias("g"))
    shared = grams.join(index, ["section", "g"]).groupBy("lid", "l", "coupe", "eid", "lettres", "taille").agg(F.count(F.lit(1)).alias("n"))
    likely = shared.where(F.col("n") >= F.least("taille", F.length("l")) * LEAST_TRIGRAMS)
    whole = similarity(F.col("l"), F.col("lettres"))
    start = F.left("lettres", F.length("l"))
    begun = F.when((F.length("l") >= 4) & (F.length("l") < F.length("lettres")), similarity(F.col("l"), start) * F.when(F.col("coupe"), 0.97).otherwise(0.85))
    return likely.select("lid", "eid", F.greatest(whole, F.coalesce(begun, F.lit(0.0))).alias("score"))


def map_labels(labels: DataFrame, entries: DataFrame) -> DataFrame:
    """(section, label, code, score): the account of each distinct (section, label), or ``NON_MAPPE``.

    A label that is null, blank or of an unknown section is not mapped. Of entries with equal scores, one with the
    smaller code is taken. ``entries`` is a reference list of (section, code, label).
    """
    ref = cut(reference(entries))
    bare = bare_label(F.col("label"))
    asked = (
        labels.where("section is not null and label is not null").select("section", "label").distinct()
        .withColumn("b", bare).withColumn("coupe", F.col("label").rlike(rf"(?:[-‐–…]|\.\.)[{BLANK}]*$"))
        .select("section", "label", "coupe", F.xxhash64("section", "label").alias("lid"), letters(F.col("b")).alias("lettres"), words(F.col("b")).alias("mots"))
    )
    asked = cut(asked.where("lettres <> ''"))
    known = broadcast_if_small(ref.groupBy("section", "lettres").agg(F.min("code").alias("code")))
    exact = asked.join(known, ["section", "lettres"]).select("section", "label", "code", F.lit(1.0).alias("score"))
    rest = cut(asked.join(known, ["section", "lettres"], "left_anti"))
    scores = by_tokens(rest, ref).unionByName(by_letters(rest, ref)).groupBy("lid", "eid").agg((F.max("score") + 0.15 * F.min("score") * (F.count(F.lit(1)) - 1)).alias("score"))
    coded = scores.join(broadcast_if_small(ref.select("eid", "code")), "eid").groupBy("lid", "code").agg(F.max("score").alias("score"))
    best = coded.groupBy("lid").agg(F.max_by(F.struct("code", "score"), F.struct("score", "code")).alias("b"))
    found = rest.join(best, "lid", "left").select(
        "section", "label", F.when(F.col("b.score") >= ACCEPT, F.col("b.code")).otherwise(NOT_MAPPED).alias("code"), F.col("b.score").alias("score")
    )
    return exact.unionByName(found)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """The account of each row without code or with a poor score; rows whose label means none give ``NON_MAPPE``."""
    rows = table(spark, folder, "extracted_fields", "field_id", F.col("bilan").alias("section"), F.col("original_label").alias("label"), "code", "match_score")
    asked = rows.where(F.col("code").isNull() | (F.col("match_score") < POOR)).select("field_id", "section", "label")
    mapped = map_labels(asked, table(spark, folder, "champs_cifen", "section", "code", "label")).select("section", "label", "code")
    return asked.join(mapped, ["section", "label"], "left").select("field_id", F.coalesce("code", F.lit(NOT_MAPPED)).alias("code"))


def p4_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary itself: every distinct label of those rows with its account and score."""
    rows = table(spark, folder, "extracted_fields", F.col("bilan").alias("section"), F.col("original_label").alias("label"), "code", "match_score")
    return map_labels(rows.where(F.col("code").isNull() | (F.col("match_score") < POOR)), table(spark, folder, "champs_cifen", "section", "code", "label"))

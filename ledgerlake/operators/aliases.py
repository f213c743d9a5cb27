"""Spellings of units to canonical units: a character n-gram index proposes, a weighted edit distance decides.

A unit is a scale and a currency. Each has a few canonical words; a spelling is cut into tokens, every distinct token is
compared once with the words of either part, apart from the other part, and a spelling's parts are put together again.
So ``000 USD`` has its scale from the numeral and its currency from the code, and neither can stand for the other.
The words are a parameter of fixed size; the spellings may be many and stay distributed.
"""

from __future__ import annotations

from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.parse import BLANK
from ledgerlake.functions.text import fold

#: Powers of ten by scale word, and the letter that stands for each before a code.
SCALES = {"unites": 0, "milliers": 3, "millions": 6, "milliards": 9, "centimes": -2, "cts": -2}
LETTERS = {0: "", 3: "K", 6: "M", 9: "G", -2: "C"}
#: Words, codes and signs of the currencies.
CURRENCIES = {"dirhams": "DH", "dh": "DH", "mad": "DH", "euros": "EUR", "eur": "EUR", "€": "EUR", "dollars": "USD", "usd": "USD", "$": "USD"}
#: Words between the parts.
FILLERS = ("de", "d", "des", "du", "en", "l", "les", "le", "of")
#: The currency of a spelling that states a scale alone.
COMMON = "DH"

#: Length of the n-grams and least share of the shorter one's n-grams that a token and a word must have in common.
GRAM, LEAST_SHARED = 2, 0.3
#: Largest weighted distance per letter of a token: abbreviations, words, codes, words run together. Least lead of the
#: best value; a token whose best two values lie closer is undecided, and so is every spelling that holds it.
ACCEPT, ACCEPT_LONG, ACCEPT_CODE, ACCEPT_GLUED, MARGIN = 0.46, 0.25, 0.2, 0.15, 0.08
#: The same where a scale stands alone and no currency vouches for it: abbreviations of three letters or more, words.
ALONE, ALONE_LONG = 0.05, 0.12
#: Weights of an edit: vowels and the plural's s, consonants, and what decides by itself: digits, signs and, in codes, the scale letters.
VOWEL, LETTER, HEAVY = 0.5, 1.0, 3.0
#: Part of its weight that a letter of a word counts which the token lacks: abbreviations drop letters, but not the first
#: and none of a code or of words run together.
DROPPED, CODE_LENGTH = 0.2, 5


def spelling_key(text: Column) -> Column:
    """Lower case without accents, single blanks."""
    return F.lower(F.trim(F.regexp_replace(fold(text), rf"[{BLANK}]+", " ")))


def grams(text: Column) -> Column:
    """Distinct padded n-grams of a short string."""
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - GRAM + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(GRAM))))


def weighted_distance(token: str, word: str, glued: bool = False) -> float:
    """Edit distance from ``word`` to ``token`` whose costs follow the characters, per letter of the token. A letter read
    twice costs little; an abbreviation keeps its first letter."""
    code = len(word) <= CODE_LENGTH
    heavy = "$€kgcm" if code else "$€"

    def weight(c: str) -> float:
        return HEAVY if c in heavy or c.isdigit() else VOWEL if c in "aeiouys" else LETTER

    lack = [weight(c) * (1.0 if code or glued or j == 0 else DROPPED) for j, c in enumerate(word)]
    first = HEAVY if len(token) < CODE_LENGTH else 0.0
    row = [0.0]
    for cost in lack:
        row.append(row[-1] + cost)
    for i, c in enumerate(token):
        more = weight(c) * (DROPPED if not code and i and token[i - 1] == c else 1.0)
        last, row = row, [row[0] + more]
        for j, d in enumerate(word):
            row.append(min(last[j + 1] + more, row[j] + lack[j], last[j] + (0.0 if c == d else max(weight(c), weight(d), 0.0 if j else first))))
    return row[-1] / max(len(token), 1)


def _distance(token: Column, word: Column, glued: Column) -> Column:
    @F.pandas_udf("double")
    def each(token: pd.Series, word: pd.Series, glued: pd.Series) -> pd.Series:
        return pd.Series([weighted_distance(a, b, g) for a, b, g in zip(token, word, glued)], dtype=float)

    return each(token, word, glued)


def vocabulary(scales: dict[str, int] = SCALES, currencies: dict[str, str] = CURRENCIES) -> list[tuple[str, str, str]]:
    """(word, part, value): scale words and letters, currency words, codes with a scale letter, words run together."""
    out = [(w, "scale", str(e)) for w, e in scales.items()] + [(letter.lower(), "scale", str(e)) for e, letter in LETTERS.items() if letter]
    out += [(w, "currency", c) for w, c in currencies.items()]
    out += [(letter.lower() + w, "both", letter + c) for (w, c), letter in product(currencies.items(), LETTERS.values()) if letter and w.isalpha() and len(w) <= 3]
    out += [(s + between + w, "both", LETTERS[e] + c) for (s, e), (w, c), between in product(scales.items(), currencies.items(), ("", "de", "d")) if w.isalpha() and len(s) > 3]
    return out


def word_table(spark: SparkSession, words: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(words, "word string, part string, value string").withColumn("size", F.size(grams(F.col("word"))))


def token_dictionary(tokens: DataFrame, words: list[tuple[str, str, str]]) -> DataFrame:
    """(token, part, value, d): what each distinct ``token`` may be of each part; the value is null where two are as near."""
    index = F.broadcast(word_table(tokens.sparkSession, words).select("*", F.explode(grams(F.col("word"))).alias("gram")))
    asked = tokens.select("token", F.size(grams(F.col("token"))).alias("length"), F.explode(grams(F.col("token"))).alias("gram"))
    shared = asked.join(index, "gram").groupBy("token", "length", "word", "part", "value", "size").agg(F.count(F.lit(1)).alias("n"))
    code, glued = F.length("word") <= CODE_LENGTH, (F.col("part") == "both") & (F.length("word") > CODE_LENGTH)
    most = F.when(code, ACCEPT_CODE).when(glued, ACCEPT_GLUED).when(F.length("token") >= 5, ACCEPT_LONG).otherwise(ACCEPT)
    near = shared.where(F.col("n") >= F.least("length", "size") * LEAST_SHARED).withColumn("d", _distance(F.col("token"), F.col("word"), glued)).where(F.col("d") <= most)
    values = near.groupBy("token", "part", "value").agg(F.min("d").alias("d"))
    # at most as many values as the vocabulary has
    ranked = values.groupBy("token", "part").agg(F.array_sort(F.collect_list(F.struct("d", "value"))).alias("r"))
    best, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    return ranked.select("token", "part", F.when((F.size("r") == 1) | (second["d"] - best["d"] >= MARGIN), best["value"]).alias("value"), best["d"].alias("d"))


def numeral(token: Column) -> Column:
    """Power of ten of ``000``, ``1000`` or ``10^3``; null for any other token."""
    power = F.when(token.startswith("10^"), F.substring_index(token, "^", -1).try_cast("int"))
    return F.coalesce(power, F.when(token.rlike("^1?0+$"), F.length(F.regexp_replace(token, "1", ""))))


def unit_of(parts: Column) -> Column:
    """The unit that a spelling's parts (pos, part, value, d, size) make, null if none.

    One token is the currency, else scale and currency in one; another one, or a numeral, is the scale. The first token
    must be known, so that prose which ends in a currency is no unit; so must every token where no currency stands.
    """
    of = lambda *names: F.filter(parts, lambda p: p["part"].isin(*names))
    main = F.array_min(F.transform(of("currency", "both"), lambda p: F.struct((p["part"] == "both").alias("both"), p["d"].alias("d"), p["pos"].alias("pos"), p["part"].alias("part"), p["value"].alias("value"))))
    first = F.array_min(F.transform(parts, lambda p: p["pos"]))
    begins = F.exists(parts, lambda p: (p["pos"] == first) & (p["part"] != "none"))

    def scaled(main: Column) -> Column:
        powers = F.transform(of("numeral"), lambda p: p["value"].cast("int"))
        scale = F.array_min(F.transform(F.filter(of("scale"), lambda p: main["pos"].isNull() | (p["pos"] != main["pos"])), lambda p: F.struct(p["d"].alias("d"), p["value"].alias("value"), p["size"].alias("size"))))
        by_numeral = F.aggregate(powers, F.lit(0), lambda a, x: a + x)
        exponent = F.when(F.size(powers) > 0, by_numeral).when(scale.isNotNull(), scale["value"].cast("int")).otherwise(0)
        letter = F.create_map(*[x for e, name in LETTERS.items() for x in (F.lit(e), F.lit(name))])[exponent]
        alone = scale.isNotNull() & (F.size(powers) == 0) & ~F.exists(parts, lambda p: p["part"] == "none") & (scale["size"] >= 3) & (scale["d"] <= F.when(scale["size"] >= 5, ALONE_LONG).otherwise(ALONE))
        return F.when(main["part"] == "both", main["value"]).when(main.isNotNull(), F.concat(letter, main["value"])).when(alone, F.concat(letter, F.lit(COMMON)))

    return F.when(begins & ~F.exists(parts, lambda p: p["part"] == "amount"), F.get(F.transform(F.array(main), scaled), F.lit(0)))


def alias_dictionary(spellings: DataFrame, words: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """(mot, entree) for each distinct non-blank ``mot`` that means a unit; the others have no row.

    A spelling that holds an amount, or whose nearest values lie too close to each other, means none.
    """
    tokens = F.regexp_extract_all(spelling_key(F.col("mot")), F.lit(r"(10\^\d+|\d+|[a-z]+|[€$])"), F.lit(1))
    each = spellings.select("mot", F.posexplode(F.filter(tokens, lambda t: ~t.isin(*FILLERS))).alias("pos", "token"))
    known = token_dictionary(each.where(~F.col("token").rlike("^[0-9]")).select("token").distinct(), vocabulary() if words is None else words)
    digits = F.col("token").rlike("^[0-9]")
    joined = each.join(known, "token", "left").select(
        "mot", "pos",
        F.when(digits, F.when(numeral(F.col("token")).isNotNull(), "numeral").otherwise("amount")).otherwise(F.coalesce("part", F.lit("none"))).alias("part"),
        F.when(digits, numeral(F.col("token")).cast("string")).otherwise(F.col("value")).alias("value"), F.coalesce("d", F.lit(0.0)).alias("d"), F.length("token").alias("size"),
    )
    # a spelling's tokens: as many as its text has
    parts = joined.groupBy("mot").agg(F.collect_list(F.struct("pos", "part", "value", "d", "size")).alias("parts"))
    return parts.select("mot", unit_of(F.col("parts")).alias("entree")).where("entree is not null")

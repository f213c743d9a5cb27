"""Text normalisers. They differ on purpose: each feeds joins that depend on its exact behaviour."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks and the plain letters they stand for, position by position.
MARKED = "àáâãäåāăąçćčďèéêëēėęěğìíîïīįıłñńňòóôõöøōőŕřśşšťùúûüūůűųýÿźżžÀÁÂÃÄÅĀĂĄÇĆČĎÈÉÊËĒĖĘĚĞÌÍÎÏĪĮİŁÑŃŇÒÓÔÕÖØŌŐŔŘŚŞŠŤÙÚÛÜŪŮŰŲÝŸŹŻŽ"
PLAIN = "aaaaaaaaacccdeeeeeeeegiiiiiiilnnnoooooooorrssstuuuuuuuuyyzzzAAAAAAAAACCCDEEEEEEEEGIIIIIIILNNNOOOOOOOORRSSSTUUUUUUUUYYZZZ"
#: The accent table of the name and title normalisers (Latin-1 letters only).
LATIN1_MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
LATIN1_PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
LEGAL_WORDS = ("SA", "SARL", "SAS", "SCA", "STE", "SOCIETE", "GROUPE", "GROUP", "HOLDING", "CIE", "COMPAGNIE")


def fold(text: Column) -> Column:
    """Letters without marks: composed ones by table, combining marks dropped, ligatures opened."""
    plain = F.translate(text, MARKED + "".join(map(chr, range(0x300, 0x370))), PLAIN)
    return F.replace(F.replace(plain, F.lit("œ"), F.lit("oe")), F.lit("Œ"), F.lit("OE"))


def unaccent(text: Column) -> Column:
    """Lower case without Latin-1 accents."""
    return F.translate(F.lower(text), LATIN1_MARKED, LATIN1_PLAIN)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


#: White space beyond ASCII as well, as the reference's patterns mean it.
UNICODE_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def plain_blanks(text: Column) -> Column:
    """Runs of white space of any kind as one blank, so that the normalisers below see no other."""
    return F.regexp_replace(text, UNICODE_BLANKS, " ")


def decomposed(text: Column) -> Column:
    """Lower case, compatibility characters opened and all marks dropped (NFKD), which no built-in function does."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c)))

    return run(text)


def norm_words(text: Column) -> Column:
    """Localisation and selection normaliser: unaccented lower-case letters and digits, single blanks."""
    return squeeze(F.regexp_replace(unaccent(text), r"[^a-z0-9\s]", " "))


def norm_keep_punctuation(text: Column) -> Column:
    """Public-body normaliser: unaccented lower case, punctuation kept."""
    return squeeze(unaccent(text))


def norm_quality(text: Column) -> Column:
    """Quality-check normaliser: unaccented lower case, blanks as they are."""
    return unaccent(text)


def norm_name_delete(text: Column) -> Column:
    """Issuer names, light-candidate search: punctuation deleted, so ``A.B Co`` equals ``AB Co``."""
    return squeeze(F.regexp_replace(unaccent(text), r"[^a-z0-9\s]", ""))


def norm_name_space(text: Column) -> Column:
    """Issuer names, second collection: apostrophes removed, other punctuation becomes a blank."""
    bare = F.regexp_replace(unaccent(text), r"['’]", "")
    return squeeze(F.regexp_replace(bare, r"[^a-z0-9\s]", " "))


def norm_issuer(text: Column) -> Column:
    """Regulator-site names: upper-case words without legal suffixes."""
    upper = F.upper(F.translate(F.translate(F.lower(text), LATIN1_MARKED, LATIN1_PLAIN), "_-", "  "))
    words = F.split(squeeze(F.regexp_replace(upper, r"[^A-Z0-9 ]", " ")), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*LEGAL_WORDS)), " ")


def html_to_text(html: Column) -> Column:
    return squeeze(F.regexp_replace(html, r"<[^>]+>", " "))


def clean_file_name(text: Column) -> Column:
    """Characters no file name may hold removed, blanks to underscores, 120 characters at most."""
    return F.substring(F.regexp_replace(F.regexp_replace(text, r'[\\/*?:"<>|]', ""), r"\s+", "_"), 1, 120)


def strip_arabic(text: Column) -> Column:
    return F.regexp_replace(text, r"[؀-ۿ]", " ")

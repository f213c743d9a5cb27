"""Years and amounts out of free text, as JVM-side expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal digits of the Arabic and the extended Arabic block, in order.
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
BLANK = r"\s\u00a0\u2000-\u200b\u202f\u2060\u3000\ufeff"
SPACES = f"[{BLANK}]"
DASH = r"\-\u2010-\u2015\u2212"


#: Characters that a number drops: blanks of all kinds and apostrophes.
_DROPPED = " \t\r\n\u00a0" + "".join(map(chr, range(0x2000, 0x200C))) + "\u202f\u2060\u3000\ufeff'\u2019"
_DASHES = "".join(map(chr, range(0x2010, 0x2016))) + "\u2212"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def latin_digits(text: Column) -> Column:
    return F.translate(text, ARABIC_DIGITS, "0123456789" * 2)


def parse_year(text: Column) -> Column:
    """The calendar year meant by ``text``: ``2O16``, ``2 023``, ``31/12/2018``, ``FY2020``, Arabic digits.

    A letter O beside a digit is a zero and blanks inside a number are dropped; then the first run of exactly four
    digits is the year. Null, or text without such a run, gives null.
    """
    digits = latin_digits(text)
    digits = F.regexp_replace(digits, r"(?<=\d)[Oo](?=[\dOo])|(?<=\d[Oo])[Oo]|(?<=\d)[Oo](?=\b)", "0")
    digits = F.regexp_replace(digits, rf"(?<=\d){SPACES}+(?=\d)", "")
    return F.nullif(F.regexp_extract(digits, r"(?<!\d)(\d{4})(?!\d)", 1), F.lit("")).cast("int")


#: A lone dot that is a decimal sign: before one or two digits, as in the read tables; or before any digits that cannot
#: be a group of thousands, as in exports of numbers with a fixed count of decimals.
SHORT_DECIMALS, ANY_DECIMALS = r"^\d*\.\d{1,2}$", r"^(?!\d{1,3}\.\d{3}$)\d*\.\d+$"


def amount_text(text: Column, decimal_dot: str = SHORT_DECIMALS) -> Column:
    """Decimal text of an amount in mixed notation, to be read with ``try_cast``; null where the cell holds no number.

    A comma is the decimal sign unless a dot follows it later in the cell; one dot that fits ``decimal_dot`` is decimal,
    any other dots group thousands; brackets or a minus at either end mean minus. Blanks of all kinds and apostrophes
    are grouping.
    """
    digits = "0123456789"
    flat = F.translate(text, ARABIC_DIGITS + _DASHES + _DROPPED, digits * 2 + "-" * len(_DASHES))

    def number(b: Column) -> Column:
        return (
            F.when(b.contains(","), F.when(b.rlike(r",.*\."), F.translate(b, ",", "")).otherwise(F.translate(b, ",.", ".")))
            .when(b.rlike(decimal_dot), b)
            .otherwise(F.translate(b, ".", ""))
        )

    def signed(f: Column) -> Column:
        minus = F.when(f.startswith("-") | f.endswith("-") | f.startswith("("), "-").otherwise("")
        return F.when(f.rlike(r"^[(+-]*[.,]?\d[\d.,]*[)-]?$"), F.concat(minus, let(F.translate(f, "(+-)", ""), number)))

    return let(flat, signed)


def parse_amount(text: Column, decimal_dot: str = SHORT_DECIMALS) -> Column:
    """``amount_text`` as a double."""
    return amount_text(text, decimal_dot).try_cast("double")

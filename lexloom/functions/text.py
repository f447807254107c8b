"""Text functions that stay inside the JVM.

The tables behind ``name_key`` are derived from the Unicode database by rule, once per process.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \s under (?U) leaves out the four separators U+001C..U+001F that Python's str.strip() takes.
WHITESPACE = r"[\s\x1c-\x1f]"
STRIP = rf"(?U)^{WHITESPACE}+|{WHITESPACE}+\z"


def strip(c: Column) -> Column:
    """Outer white space of any kind removed (``trim`` takes plain blanks only)."""
    return F.regexp_replace(c, STRIP, "")


def blank_strip_lower(c: Column) -> Column:
    return F.lower(strip(c))


#: No plane from here on has a character that is a form of a letter or digit a-z, 0-9.
END_OF_LETTERS = 0x30000


@lru_cache(maxsize=1)
def _base_letters() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition holds a-z or 0-9: those with one such letter (two aligned strings) and those with several."""
    source, target, several = [], [], {}
    for code in range(128, END_OF_LETTERS):
        if 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        kept = "".join(x for x in unicodedata.normalize("NFKD", ch).lower() if x.isascii() and x.isalnum())
        if len(kept) == 1:
            source.append(ch)
            target.append(kept)
        elif kept:
            several[ch] = kept
    return "".join(source), "".join(target), several


def unaccented(c: Column) -> Column:
    """Accented letters, and compatibility forms of one letter or digit, as their base; all other characters stay."""
    one, base, _ = _base_letters()
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.translate(c, one, base)).otherwise(c)


def name_key(c: Column) -> Column:
    """The name key: base letters of compatibility forms and accented letters, lower case, only a-z and 0-9.

    Null stays null; a value without any letter or digit gives the empty string.
    """
    one, base, several = _base_letters()
    members = "".join(several)
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    spelt_out = F.when(
        c.rlike(f"[{members}]"),
        F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""),
    ).otherwise(c)
    plain = F.when(c.rlike(r"[^\x00-\x7f]"), F.translate(spelt_out, one, base)).otherwise(c)
    return F.regexp_replace(F.lower(plain), "[^a-z0-9]+", "")


def letters_and_digits(c: Column) -> Column:
    """Only letters and digits, lower case; accents count, whether part of the letter or a mark of its own."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}]+", "")


def deletions(c: Column) -> Column:
    """All strings with one character of ``c`` left out; the empty array for the empty string."""
    return F.when(
        F.length(c) > 0,
        F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.length(c)),
            lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))),
        )),
    ).otherwise(F.array().cast("array<string>"))


def swaps_to(a: Column, b: Column) -> Column:
    """Whether swapping two neighbouring characters of ``a`` gives ``b``."""
    return (F.length(a) == F.length(b)) & (F.length(a) > 1) & F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))),
        lambda i: F.concat(
            F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.length(a))
        ) == b,
    )


def within_one_edit(a: Column, b: Column) -> Column:
    """One character inserted, dropped or replaced, or two neighbours swapped, or nothing at all."""
    return (F.levenshtein(a, b, 1) >= 0) | swaps_to(a, b)

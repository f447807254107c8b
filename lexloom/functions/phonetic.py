"""Primary Double Metaphone codes (Lawrence Philips' published rules), for distinct names through an Arrow UDF."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lexloom.session import ship

VOWELS = frozenset("AEIOUY")
#: Letters of one sound; the same letter following is part of it.
PLAIN = {"B": "P", "F": "F", "K": "K", "L": "L", "N": "N", "Q": "K", "V": "F"}


class _Word:
    def __init__(self, text: str) -> None:
        self.text, self.last = text, len(text) - 1
        self.slavic = "W" in text or "K" in text or "CZ" in text

    def at(self, i: int, *options: str) -> bool:
        return i >= 0 and any(self.text.startswith(o, i) for o in options)

    def vowel(self, i: int) -> bool:
        return 0 <= i <= self.last and self.text[i] in VOWELS

    @property
    def germanic(self) -> bool:
        return self.at(0, "VAN ", "VON ", "SCH")


def _c(w: _Word, i: int) -> tuple[str, int]:
    if i > 1 and not w.vowel(i - 2) and w.at(i - 1, "ACH") and not w.at(i + 2, "I") and (not w.at(i + 2, "E") or w.at(i - 2, "BACHER", "MACHER")):
        return "K", 2
    if i == 0 and w.at(0, "CAESAR"):
        return "S", 2
    if w.at(i, "CH"):
        return _ch(w, i), 2
    if w.at(i, "CZ") and not w.at(i - 2, "WICZ"):
        return "S", 2
    if w.at(i + 1, "CIA"):
        return "X", 3
    if w.at(i, "CC") and not (i == 1 and w.text[0] == "M"):
        if w.at(i + 2, "I", "E", "H") and not w.at(i + 2, "HU"):
            return ("KS" if (i == 1 and w.text[0] == "A") or w.at(i - 1, "UCCEE", "UCCES") else "X"), 3
        return "K", 2
    if w.at(i, "CK", "CG", "CQ"):
        return "K", 2
    if w.at(i, "CI", "CE", "CY"):
        return "S", 2
    if w.at(i + 1, " C", " Q", " G"):
        return "K", 3
    return "K", 2 if w.at(i + 1, "C", "K", "Q") and not w.at(i + 1, "CE", "CI") else 1


def _ch(w: _Word, i: int) -> str:
    if i > 0 and w.at(i, "CHAE"):
        return "K"
    if i == 0:
        if w.at(1, "HARAC", "HARIS", "HOR", "HYM", "HIA", "HEM") and not w.at(0, "CHORE"):
            return "K"
    if w.germanic or w.at(i - 2, "ORCHES", "ARCHIT", "ORCHID") or w.at(i + 2, "T", "S"):
        return "K"
    if (i == 0 or w.at(i - 1, "A", "O", "U", "E")) and (w.at(i + 2, "L", "R", "N", "M", "B", "H", "F", "V", "W", " ") or i + 1 == w.last):
        return "K"
    return "K" if i > 0 and w.at(0, "MC") else "X"


def _d(w: _Word, i: int) -> tuple[str, int]:
    if w.at(i, "DG"):
        return ("J", 3) if w.at(i + 2, "I", "E", "Y") else ("TK", 2)
    return "T", 2 if w.at(i, "DT", "DD") else 1


def _g(w: _Word, i: int) -> tuple[str, int]:
    if w.at(i + 1, "H"):
        return _gh(w, i), 2
    if w.at(i + 1, "N"):
        if i == 1 and w.vowel(0) and not w.slavic:
            return "KN", 2
        return ("N" if not w.at(i + 2, "EY") and not w.slavic else "KN"), 2
    if w.at(i + 1, "LI") and not w.slavic:
        return "KL", 2
    if i == 0 and w.at(1, "Y", "ES", "EP", "EB", "EL", "EY", "IB", "IL", "IN", "IE", "EI", "ER"):
        return "K", 2
    if w.at(i + 1, "ER", "Y") and not w.at(0, "DANGER", "RANGER", "MANGER") and not w.at(i - 1, "E", "I", "RGY", "OGY"):
        return "K", 2
    if w.at(i + 1, "E", "I", "Y") or w.at(i - 1, "AGGI", "OGGI"):
        return ("K" if w.germanic or w.at(i + 1, "ET") else "J"), 2
    return "K", 2 if w.at(i + 1, "G") else 1


def _gh(w: _Word, i: int) -> str:
    if i > 0 and not w.vowel(i - 1):
        return "K"
    if i == 0:
        return "J" if w.at(2, "I") else "K"
    if w.at(i - 2, "B", "H", "D") or w.at(i - 3, "B", "H", "D") or w.at(i - 4, "B", "H"):
        return ""
    if i > 2 and w.at(i - 1, "U") and w.at(i - 3, "C", "G", "L", "R", "T"):
        return "F"
    return "" if w.at(i - 1, "I") else "K"


def _h(w: _Word, i: int) -> tuple[str, int]:
    return ("H", 2) if (i == 0 or w.vowel(i - 1)) and w.vowel(i + 1) else ("", 1)


def _j(w: _Word, i: int) -> tuple[str, int]:
    if w.at(i, "JOSE") or w.at(0, "SAN "):
        spanish = (i == 0 and w.at(4, " ")) or len(w.text) == 4 or w.at(0, "SAN ")
        return ("H" if spanish else "J"), 1
    step = 2 if w.at(i + 1, "J") else 1
    if i == 0 or i == w.last or (w.vowel(i - 1) and not w.slavic and w.at(i + 1, "A", "O")):
        return "J", step
    return ("J" if not w.at(i + 1, "L", "T", "K", "S", "N", "M", "B", "Z") and not w.at(i - 1, "S", "K", "L") else ""), step


def _m(w: _Word, i: int) -> tuple[str, int]:
    silent_b = w.at(i - 1, "UMB") and (i + 1 == w.last or w.at(i + 2, "ER"))
    return "M", 2 if w.at(i + 1, "M") or silent_b else 1


def _p(w: _Word, i: int) -> tuple[str, int]:
    return ("F", 2) if w.at(i + 1, "H") else ("P", 2 if w.at(i + 1, "P", "B") else 1)


def _r(w: _Word, i: int) -> tuple[str, int]:
    french = i == w.last and not w.slavic and w.at(i - 2, "IE") and not w.at(i - 4, "ME", "MA")
    return ("" if french else "R"), 2 if w.at(i + 1, "R") else 1


def _s(w: _Word, i: int) -> tuple[str, int]:
    if w.at(i - 1, "ISL", "YSL"):
        return "", 1
    if i == 0 and w.at(0, "SUGAR"):
        return "X", 1
    if w.at(i, "SH"):
        return ("S" if w.at(i + 1, "HEIM", "HOEK", "HOLM", "HOLZ") else "X"), 2
    if w.at(i, "SIO", "SIA"):
        return "S", 3
    if (i == 0 and w.at(1, "M", "N", "L", "W")) or w.at(i + 1, "Z"):
        return "S", 2 if w.at(i + 1, "Z") else 1
    if w.at(i, "SC"):
        if w.at(i + 2, "H"):
            return ("SK" if w.at(i + 3, "OO", "UY", "ED", "EM") else "X"), 3
        return ("S" if w.at(i + 2, "I", "E", "Y") else "SK"), 3
    french = i == w.last and w.at(i - 2, "AI", "OI")
    return ("" if french else "S"), 2 if w.at(i + 1, "S", "Z") else 1


def _t(w: _Word, i: int) -> tuple[str, int]:
    if w.at(i, "TION", "TIA", "TCH"):
        return "X", 3
    if w.at(i, "TH", "TTH"):
        return ("T" if w.at(i + 2, "OM", "AM") or w.germanic else "0"), 2
    return "T", 2 if w.at(i + 1, "T", "D") else 1


def _w(w: _Word, i: int) -> tuple[str, int]:
    if w.at(i, "WR"):
        return "R", 2
    if i == 0 and (w.vowel(1) or w.at(0, "WH")):
        return "A", 1
    if (i == w.last and w.vowel(i - 1)) or w.at(i - 1, "EWSKI", "EWSKY", "OWSKI", "OWSKY") or w.at(0, "SCH"):
        return "", 1
    return ("TS", 4) if w.at(i, "WICZ", "WITZ") else ("", 1)


def _x(w: _Word, i: int) -> tuple[str, int]:
    if i == 0:
        return "S", 1
    silent = i == w.last and (w.at(i - 3, "IAU", "EAU") or w.at(i - 2, "AU", "OU"))
    return ("" if silent else "KS"), 2 if w.at(i + 1, "C", "X") else 1


def _z(w: _Word, i: int) -> tuple[str, int]:
    return ("J", 2) if w.at(i + 1, "H") else ("S", 2 if w.at(i + 1, "Z") else 1)


_RULES = {"C": _c, "D": _d, "G": _g, "H": _h, "J": _j, "M": _m, "P": _p, "R": _r, "S": _s, "T": _t, "W": _w, "X": _x, "Z": _z}


@lru_cache(maxsize=100_000)
def double_metaphone(text: str) -> str:
    """The primary code, of any length; empty for a text without sounds."""
    w = _Word(text.strip().upper())
    code, i = [], 1 if w.at(0, "GN", "KN", "PN", "WR", "PS") else 0
    while i <= w.last:
        ch = w.text[i]
        if ch in VOWELS:
            sound, step = ("A" if i == 0 else ""), 1
        elif ch in PLAIN:
            sound, step = PLAIN[ch], 2 if w.at(i + 1, ch) else 1
        elif ch in _RULES:
            sound, step = _RULES[ch](w, i)
        else:
            sound, step = {"Ç": "S", "Ñ": "N"}.get(ch, ""), 1
        code.append(sound)
        i += step
    return "".join(code)


def phonetic_key(c: Column) -> Column:
    """The primary code as a column; null stays null. Use it on distinct names."""

    @F.pandas_udf("string")
    def coded(names: pd.Series) -> pd.Series:
        return names.map(lambda n: None if n is None else double_metaphone(n))

    ship(SparkSession.active())
    return coded(c)

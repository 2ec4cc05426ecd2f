"""Text patterns shared by the narrative operators, in Spark (Java regex) form.

Java's ``\\s`` and ``\\d`` are ASCII-only while the reference's are Unicode,
so whitespace and digits are spelled out explicitly.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters str.isspace() accepts (split/strip whitespace).
WS_RANGES = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
             (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]


def _code_point(cp: int) -> str:
    return f"\\x{{{cp:X}}}"


def ws_class() -> str:
    f = _code_point
    return "[" + "".join(f(a) if a == b else f"{f(a)}-{f(b)}" for a, b in WS_RANGES) + "]"


WS = ws_class()
# Any character that is not such whitespace (a text has words iff it contains one).
NON_WS = "[^" + WS[1:]
# Decimal digits of other scripts and their ASCII digits, from the Unicode database, all planes.
OTHER_DIGITS = "".join(c for c in map(chr, range(128, 0x110000)) if unicodedata.category(c) == "Nd")
ASCII_DIGITS = "".join(str(unicodedata.digit(c)) for c in OTHER_DIGITS)
# Any of them (spelled out: Java's and Python's Unicode versions differ). They stand in runs from 0 to 9.
DIGIT = "[0-9" + "".join(f"{_code_point(ord(c))}-{_code_point(ord(c) + 9)}" for c, d in zip(OTHER_DIGITS, ASCII_DIGITS) if d == "0") + "]"
# Sentence boundary: after . ! or ?, whitespace, before an upper-case ASCII letter.
SENTENCE_SPLIT = f"(?<=[.!?]){WS}+(?=[A-Z])"
# Figures with an explicit unit (Cr, %, percent), case-insensitive; commas are thousands separators.
FIGURE = rf"(?i)({DIGIT}{{1,4}}(?:,{DIGIT}{{3}})*(?:\.{DIGIT}+)?){WS}*(?:Cr\b|%|percent\b)"
ELLIPSIS = "…"


def ascii_digits(c: Column) -> Column:
    """The text with digits of other scripts as ASCII digits; most texts hold none and aren't translated."""
    return F.when(c.rlike("[^\\x00-\\x7F]"), F.translate(c, OTHER_DIGITS, ASCII_DIGITS)).otherwise(c)


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``."""
    return F.regexp_replace(c, f"\\A{WS}+|{WS}+\\z", "")


def split_words(c: Column) -> Column:
    """Python ``str.split()`` (no argument): whitespace runs, no empty words."""
    s = strip_ws(c)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, f"{WS}+", -1))

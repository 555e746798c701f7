"""Name and text cleaning as native Column expressions (no UDFs).

Operators: X11 (strip + non-empty), C2 (junk-only drop), C3 (leading
punctuation), L1 (canonical name key), L10 (width limit).
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _class_escape(chars: str) -> str:
    return "".join(f"\\x{{{ord(c):X}}}" for c in chars)


# Python's str.strip() removes exactly the characters for which
# str.isspace() is true; Java's \s (even with (?U)) is a different set, so
# the class is derived from Python's rule rather than written by hand.
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WS_CLASS = "[" + _class_escape(PY_WHITESPACE) + "]"

# ---------------------------------------------------------------------------
# These patterns must equal the reference's name rules.
# (?d) makes '.' stop only at '\n'.
JUNK_PATTERN = r"(?d)[\[{]+.*[\]}]+|[({]+.*[)}]*|[({]*.*[)}]+|[,;!:()+\-/{}]+"
LEADING_PUNCT_PATTERN = r"^[,/]+"
# Column widths of the name columns (characters): actor and director names
# hold 100, distributor, production company and film titles hold 200.
NAME_WIDTH = {"actor": 100, "director": 100, "distributor": 200, "prod_co": 200, "movie": 200}
# ---------------------------------------------------------------------------


def strip_ws(c: Column) -> Column:
    """Unicode-aware strip, same character set as Python's str.strip()."""
    return F.regexp_replace(c, f"^{WS_CLASS}+|{WS_CLASS}+\\z", "")


def nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


# The junk pattern's matches, from the first character on, when they cover the
# whole value. Within a line a bracketed part reaches to the last closing
# bracket whatever stands between, so one opening and one closing character
# state it; nothing is tried twice (atomic, possessive), so the test is linear.
JUNK_ONLY = r"(?d)\A(?>[\[{].*[\]}]|[({].*|.*[)}]|[,;!:()+\-/{}]++)*+\z"


def is_junk_name(c: Column) -> Column:
    """True when nothing is left after removing bracketed parts and
    punctuation runs (the value itself is never altered by this test)."""
    return c.rlike(JUNK_ONLY)


def strip_leading_punct(c: Column) -> Column:
    """Remove a leading run of ',' and '/' only; no re-strip afterwards."""
    return F.regexp_replace(c, LEADING_PUNCT_PATTERN, "")


def _accent_table() -> tuple[str, str, str]:
    """(accented, base, combining) built by rule: every BMP letter whose
    canonical decomposition is one base character plus combining marks maps
    to that base; bare combining marks are deleted. This is what
    NFD-then-drop-marks accent stripping does."""
    src, dst = [], []
    for cp in range(0xC0, 0x3000):
        ch = chr(cp)
        decomposed = unicodedata.normalize("NFD", ch)
        base = "".join(x for x in decomposed if unicodedata.category(x) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    marks = "".join(chr(cp) for cp in range(0x300, 0x370) if unicodedata.category(chr(cp)) == "Mn")
    return "".join(src), "".join(dst), marks


_ACCENTED, _BASE, _MARKS = _accent_table()


def strip_accents(c: Column) -> Column:
    return F.translate(c, _ACCENTED + _MARKS, _BASE)


def name_key(c: Column) -> Column:
    """Canonical equality key: trailing spaces ignored, case-insensitive,
    accent-insensitive (the behaviour of the reference's default
    collation). A plain string, so it also works as streaming state key.
    ASCII text, which has as many bytes as characters, has no accents to look for."""
    key = F.lower(F.rtrim(c))
    return F.when(F.octet_length(c) == F.char_length(c), key).otherwise(strip_accents(key))


def within_width(c: Column, width: int) -> Column:
    return F.char_length(c) <= F.lit(width)

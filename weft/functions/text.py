"""Text functions as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from weft.config import LEGAL_WORDS

MARKS = ("Mn", "Mc", "Me")


@lru_cache(maxsize=1)
def accent_map() -> tuple[str, str]:
    """What `translate` needs to take off accents: characters, and what replaces the first of them; the rest are deleted marks.

    A character is decomposed, loses its marks and is composed again.
    """
    replaced, by, dropped = [], [], []
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        parts = unicodedata.normalize("NFD", c)
        if parts == c and unicodedata.category(c) not in MARKS:
            continue
        bare = unicodedata.normalize("NFC", "".join(x for x in parts if unicodedata.category(x) not in MARKS))
        if not bare:
            dropped.append(c)
        elif bare != c and len(bare) == 1:
            replaced.append(c)
            by.append(bare)
    return "".join(replaced + dropped), "".join(by)


def strip_accents(text: Column) -> Column:
    return F.translate(text, *accent_map())


def normalise(text: Column) -> Column:
    """Lower case, no accents, every run of other characters than letters and digits one space; null gives ''."""
    return F.trim(F.regexp_replace(strip_accents(F.lower(F.coalesce(text, F.lit("")))), r"[^\p{L}\p{N}]+", " "))


def without_legal(name: Column) -> Column:
    """A normalised name without legal forms, by two passes; a run of four or more of them leaves some."""
    pattern = f" ({'|'.join(LEGAL_WORDS)}) "
    padded = F.concat(F.lit(" "), name, F.lit(" "))
    return F.trim(F.regexp_replace(F.regexp_replace(padded, pattern, " "), pattern, " "))


def tokens(text: Column, least: int = 2) -> Column:
    """The different words of a normalised text with at least so many characters, in order."""
    return F.array_distinct(F.filter(F.split(text, " "), lambda t: F.length(t) >= least))


def digits(text: Column) -> Column:
    """The different runs of ASCII digits, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0)))

"""Text cleaning: accent folding, word splitting, stopword removal."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A short list of English function words; every operator takes the list as a parameter.
STOPWORDS = (
    "a about above after again all also am an and any are as at be because been before being below between both "
    "but by can cannot could did do does doing down during each few for from further had has have having he her "
    "here him his how i if in into is it its me more most my no nor not now of off on once only or other our out "
    "over own same she should so some such than that the their them then there these they this those through to "
    "too under until up very was we were what when where which while who whom why will with would you your"
).split()

# Characters that become more than one letter.
_EXPANSIONS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th", "ẞ": "SS", "Ĳ": "IJ", "ĳ": "ij",
    "\u2026": "...", "\u2014": "--",
}

# Letters and marks without a canonical decomposition into an ASCII base.
_SINGLES = {
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ł": "L", "ł": "l", "Ħ": "H", "ħ": "h", "ı": "i",
    "Ŧ": "T", "ŧ": "t", "\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"', "\u2013": "-",
    "\u00a0": " ", "\u2002": " ", "\u2003": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ",
}


def _latin_letters() -> dict[str, str]:
    """Accented Latin letters whose decomposition starts with an ASCII letter, with that letter."""
    table = {}
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and base.isalpha():
            table[chr(code)] = base
    return table


FOLD_TABLE = {k: v for k, v in {**_latin_letters(), **_SINGLES}.items() if k not in _EXPANSIONS}
FOLD_FROM = "".join(FOLD_TABLE)
FOLD_TO = "".join(FOLD_TABLE.values())
FOLD_EXPANSIONS = dict(_EXPANSIONS)


def fold_accents(text: Column) -> Column:
    """Latin text without accents: ``é`` to ``e``, ``ß`` to ``ss``, typographic quotes to plain ones."""
    folded = text
    for mark, plain in FOLD_EXPANSIONS.items():
        folded = F.replace(folded, F.lit(mark), F.lit(plain))
    folded = F.translate(folded, FOLD_FROM, FOLD_TO)
    plain_ascii = F.octet_length(text) == F.length(text)  # one byte per character: nothing to fold
    return F.when(plain_ascii, text).otherwise(folded)


def words(text: Column) -> Column:
    """Words between runs of white space, without empty ones."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def preprocess_text(text: Column, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """Folded, lower-cased text without the stopwords, one space between words. Repeated words stay."""
    stop = list(stopwords)
    kept = F.filter(F.split(F.lower(fold_accents(text)), r"\s+"), lambda w: (w != "") & ~w.isin(stop))
    return F.array_join(kept, " ")


def basic_tokens(text: Column) -> Column:
    """Folded lower-case words, the units of the corpus-built vocabulary."""
    return words(F.lower(fold_accents(text)))

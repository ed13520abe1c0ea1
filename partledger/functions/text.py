"""Text clean-up, tokens and labels as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Workshop abbreviations and the word each one stands for.
PART_SYNONYMS = {
    "assy": "assembly",
    "comp": "complete",
    "fr": "front",
    "rr": "rear",
    "l": "left",
    "lh": "left",
    "r": "right",
    "rh": "right",
    "upr": "upper",
    "lwr": "lower",
    "pnl": "panel",
    "bmp": "bumper",
    "light": "lamp",
    "wing": "fender",
    "dr": "door",
}

# The characters that count as white space at the ends of a text.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def clean_text(text: Column) -> Column:
    """Lower case, ASCII letters and digits only, single blanks; null becomes the empty string."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), F.lit(""))


def strip_space(text: Column) -> Column:
    """Drop white space of any kind at both ends (plain ``trim`` drops blanks only)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def normalise_key(key: Column) -> Column:
    return strip_space(key.cast("string"))


def tokens(text: Column) -> Column:
    """Words of two or more letters or digits, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w\w+)"), F.lit(1))


def _runs(words: Column, n: int) -> Column:
    """All runs of ``n`` consecutive words."""
    last = F.size(words) - (n - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """All runs of ``low`` to ``high`` consecutive words, joined by a blank."""
    return F.concat(*[_runs(words, n) for n in range(low, high + 1)])


def token_sort_key(text: Column) -> Column:
    """The text as sorted words: non-word characters become blanks, Latin-1 letters are dropped."""
    plain = F.regexp_replace(text, "[\u0080-ÿ]", "")
    words = F.trim(F.regexp_replace(F.lower(plain), r"(?U)[\W]+", " "))
    return F.array_join(F.array_sort(F.split(words, " ")), " ")


def canonical_parts(text: Column, synonyms: Mapping[str, str] = PART_SYNONYMS) -> Column:
    """Replace every word that has a synonym by its canonical form."""
    pairs = [F.lit(v) for item in synonyms.items() for v in item]
    lookup = F.create_map(*pairs)
    words = F.transform(F.split(text, " "), lambda w: F.coalesce(F.try_element_at(lookup, w), w))
    return F.array_join(words, " ")


def first_word_category(text: Column) -> Column:
    """First word in capitals; ``OTHER`` when there is none."""
    trimmed = strip_space(text)
    return F.when(F.length(trimmed) > 0, F.upper(F.split(trimmed, r"\s+")[0])).otherwise(F.lit("OTHER"))


def title_case(name: Column) -> Column:
    return F.initcap(F.translate(name, "_", " "))


def short_label(name: Column, length: int = 12) -> Column:
    return F.substring(name.cast("string"), 1, length)


def percent_text(share: Column, missing: str = "N/A") -> Column:
    """``0.1234`` as ``12.34%``."""
    return F.when(share.isNull(), F.lit(missing)).otherwise(F.format_string("%.2f%%", share * 100))

"""Column functions for names and cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that fold one to one, and those that fold to two.
GREEK_FROM = "ΑΆΒΓΔΕΈΖΗΉΙΊΪΚΛΜΝΞΟΌΠΡΣΤΥΎΫΦΩΏαάβγδεέζηήιίϊΐκλμνξοόπρσςτυύϋΰφωώ"
GREEK_TO = "AABGDEEZIIIIIKLMNXOOPRSTYYYFOOaabgdeeziiiiiiklmnxooprsstyyyyfoo"
LATIN_FROM = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
LATIN_TO = "AAAAAACEEEEIIIINOOOOOOUUUUYaaaaaaceeeeiiiinoooooouuuuyy"
DIGRAPHS = [("ΟΥ", "OU"), ("Ού", "Ou"), ("Ου", "Ou"), ("ού", "ou"), ("ου", "ou"), ("Θ", "Th"), ("θ", "th"), ("Χ", "Ch"), ("χ", "ch"), ("Ψ", "Ps"), ("ψ", "ps"), ("ß", "ss"), ("Æ", "AE"), ("æ", "ae"), ("œ", "oe")]


def transliterate(text: Column) -> Column:
    """Trimmed text with Greek and accented Latin letters folded to ASCII; other characters stay."""
    out = F.trim(text)
    for raw, folded in DIGRAPHS:
        out = F.replace(out, F.lit(raw), F.lit(folded))
    return F.translate(out, GREEK_FROM + LATIN_FROM, GREEK_TO + LATIN_TO)


def snake_case(name: Column) -> Column:
    return F.lower(F.regexp_replace(F.trim(name), r"[^\p{L}\p{N}]+", "_"))


def number(cell: Column) -> Column:
    """Double of a cell; null where it is none."""
    return cell.try_cast("double")


def decimal_comma(cell: Column) -> Column:
    """Double of a cell with ``.`` between thousands and ``,`` before decimals."""
    return F.regexp_replace(F.regexp_replace(cell, r"\.", ""), ",", ".").try_cast("double")


def eval_fraction(cell: Column) -> Column:
    """``=a/b`` and ``=a/b^n`` as their value in text; other cells as they are. Nothing is evaluated as code."""
    pattern = r"^=\s*(-?\d+(?:\.\d+)?)\s*/\s*(\d+(?:\.\d+)?)(?:\^(\d+))?\s*$"
    top, low, power = (F.regexp_extract(cell, pattern, k) for k in (1, 2, 3))
    below = F.pow(low.try_cast("double"), F.coalesce(power.try_cast("double"), F.lit(1.0)))
    return F.when(cell.rlike(pattern), F.try_divide(top.try_cast("double"), below).cast("string")).otherwise(cell)


def refine(name: Column) -> Column:
    """Name trimmed, blanks squeezed, brackets and dashes dropped, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(name), " +", " "), "[()-]", ""))


def character_set(name: Column) -> Column:
    return F.array_distinct(F.filter(F.split(name, ""), lambda c: c != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all characters of two character sets; two empty sets share nothing."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(shared.cast("double"), (F.size(a) + F.size(b) - shared).cast("double")), F.lit(0.0))


def camel_parts(name: Column) -> Column:
    """Parts of a name that begin at a capital after a small letter or before one."""
    cut = F.regexp_replace(name, r"(?<=[a-z])(?=[A-Z])|(?<!^)(?=[A-Z][a-z])", "\u0001")
    return F.split(cut, "\u0001")


def edit_ratio(a: Column, b: Column) -> Column:
    """100 for equal texts, 0 where every character has to change."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(100.0)).otherwise(100.0 * (longest - F.levenshtein(a, b)) / longest)

"""Column functions on text, vectors and nulls. All but ``nfkc`` and ``indel_ratio`` stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle import config


# The tests of white space name their argument once, so that expressions of several stay small, and look at a value's ends
# only. Trimming by a list of signs goes through the list at each end. In these patterns white space is Unicode's, but where
# ``space`` names other signs, as within the brackets of a regular expression.


def ustrip(c: Column, space: str = r"\s") -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_extract(c, rf"(?Us)^[{space}]*(.*[^{space}])?", 1)


def collapse(c: Column, space: str = r"\s") -> Column:
    return F.regexp_replace(c, rf"(?U)[{space}]+", " ")


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFC")


def unicode_normalize(c: Column, form: str = "NFKC") -> Column:
    """Only values with a sign outside ASCII go to Python; the rest is its own normal form."""
    fn = {"NFKC": _nfkc, "NFC": _nfc}[form]
    return F.coalesce(fn(F.when(F.octet_length(c) != F.char_length(c), c)), c)


def blank(c: Column) -> Column:
    """The mapping layer's null: none, NaN, or white space."""
    return ~F.coalesce(c.cast("string").rlike(r"(?U)^(?!NaN\z)\s*\S"), F.lit(False))


#: A word for nothing between white space, in upper or lower case, or NaN as it stands.
NULLISH = rf"(?U)^(?:\s*(?i:{'|'.join(map(re.escape, config.NULL_TOKENS))})\s*|NaN)\z"


def nullish(c: Column) -> Column:
    """The normalising layer's null: also the usual words for nothing."""
    return F.coalesce(c.cast("string").rlike(NULLISH), F.lit(True))


def missing(c: Column) -> Column:
    """The comparing layer's null: none or NaN only."""
    s = c.cast("string")
    return s.isNull() | (s == "NaN")


def number(c: Column) -> Column:
    """As a double; null where it is no finite number in plain notation."""
    value = F.regexp_extract(c.cast("string"), r"(?U)^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*\z", 1).try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def integer(c: Column) -> Column:
    """Towards zero, by way of a double."""
    return number(c).try_cast("int")


def lookup(mapping: Mapping[str, str], c: Column) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.element_at(F.create_map(*pairs), c) if pairs else F.lit(None).cast("string")


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the lower-cased words, each with two blanks before and one behind."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))

    def of(padded: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))

    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))  # once a word, not once a trigram
    return F.array_distinct(F.flatten(F.transform(padded, of)))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared of all distinct trigrams of two trigram arrays; 0 if there are none."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both.cast("double"), F.size(a) + F.size(b) - both), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def indel(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths; bit-parallel, one big integer a row."""
    if not a and not b:
        return 1.0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        hit = open_ & at.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return 2 * (len(a) - open_.bit_count()) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else indel(x, y) for x, y in zip(a, b)])

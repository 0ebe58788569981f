"""Text normalisation as column expressions. Lower-casing is Spark's; non-ASCII letters never reach a key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .lookups import ACCESS_PHRASES, ADDRESS_WORDS, PROVINCES, lookup

_SPACES = r"[\s\x{85}\x{a0}]"


def once(x: Column, f) -> Column:
    """f(x) with x evaluated one time, however often f uses it (an optimizer may else copy it into each use)."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def ustrip(c: Column) -> Column:
    """Blanks of all kinds off both ends."""
    return F.regexp_replace(c, f"(?U)^{_SPACES}+|{_SPACES}+$", "")


def nonblank(c: Column) -> Column:
    """Stripped text, or null if nothing is left."""
    s = ustrip(c)
    return F.when(s != "", s)


def key_tokens(c: Column) -> Column:
    """Runs of a-z and 0-9 with address abbreviations spelled out."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    return F.transform(found, lambda t: F.coalesce(lookup(ADDRESS_WORDS, t), t))


def key_text(c: Column) -> Column:
    """The comparison form of a text; empty if it has no Latin letter or digit."""
    return F.array_join(key_tokens(c), " ")


def address_key(c: Column) -> Column:
    """Comparison form of an address: its first two comma parts, without province names; null if blank."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda p: p != "")
    text = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, 2), " ")).otherwise(c)
    tokens = key_tokens(text)
    return F.when(nonblank(c).isNotNull() & (F.size(tokens) > 0), F.array_join(F.filter(tokens, lambda t: ~t.isin(*PROVINCES)), " "))


def place_field(c: Column) -> Column:
    """Comparison form of a place name; null for blanks and accessibility phrases."""
    s = nonblank(c)
    return F.when(s.isNotNull() & ~F.lower(s).isin(*ACCESS_PHRASES), key_text(s))


def odd_capitals(c: Column) -> Column:
    """Upper-case letters that follow a lower-case one, before a lower-case one or the end."""
    return F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?<=\p{Ll})\p{Lu}(?=$|\p{Ll})"), F.lit(0)))


def join_present(*cols: Column, sep: str = " ") -> Column:
    """Non-empty values joined."""
    return F.array_join(F.filter(F.array(*cols), lambda x: x.isNotNull() & (x != "")), sep)


def clean_name(c: Column) -> Column:
    """A name line without quotes, zero-width marks and a trailing note about the meeting."""
    s = F.translate(c, "​‌‍﻿\"“”", "")
    s = F.regexp_replace(s, r"(?i)\s*\(meeting [^)]*\)\s*$", "")
    return ustrip(F.regexp_replace(s, r"\s+", " "))


def compact(c: Column) -> Column:
    return ustrip(F.regexp_replace(c, r"\s+", " "))

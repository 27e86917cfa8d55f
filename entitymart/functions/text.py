"""Text normalisation and presence tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, as a pattern and as characters.
SPACE = r"[\s\x1c-\x1f]"
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A column expression used twice is written twice into the plan, and costly
    ones (parsing, long regular expressions) are then evaluated twice per row. A
    lambda variable is bound to the value instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settled(value: Column) -> Column:
    """The same value as a generated column, for use in ``select``.

    Filters on a plain computed column, also those the optimizer infers from the
    other side of a join, are moved below it and compute it a second time. They
    stay above a generated column.
    """
    return F.explode(F.array(value))


def match_key(c: Column) -> Column:
    """Lower-case ``[a-z0-9]`` words with single spaces; null gives ``""``.

    The outer ``coalesce`` makes the result non-null for the optimizer, which
    would otherwise add a null test, and so the expression once more, to a join.
    """
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), F.lit(""))


def match_words(c: Column) -> Column:
    """The words of ``match_key``, cut in one pass, with a ``""`` before or after them where the
    text starts or ends with something else; null gives one ``""``."""
    return F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+")


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    """Single spaces, none at the ends; null gives ``""``."""
    return F.coalesce(F.trim(F.regexp_replace(c, rf"(?U){SPACE}+", " ")), F.lit(""))


def is_present(c: Column) -> Column:
    """Neither null nor only white space."""
    return F.coalesce(strip(c) != "", F.lit(False))


def is_filled(c: Column) -> Column:
    """Neither null nor the empty string; white space counts as filled."""
    return F.coalesce(c != "", F.lit(False))


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def first_filled(*cs: Column) -> Column:
    """First value that is neither null nor empty, else null."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def words(c: Column) -> Column:
    """White-space separated words; a blank text gives an empty array."""
    return F.filter(F.split(collapse(c), " "), lambda w: w != "")


def search_keywords(title: Column, n: int = 6) -> Column:
    """The first ``n`` words of a title."""
    return F.array_join(F.slice(words(title), 1, n), " ")


def mention_text(*cs: Column) -> Column:
    """The fields searched for company names, as one text."""
    return F.concat_ws(" ", *[blank_if_null(c) for c in cs])


def record_url(source_url: Column, paper_url: Column | None = None) -> Column:
    """The record's url, else the paper's."""
    return F.coalesce(first_filled(source_url), paper_url if paper_url is not None else F.lit(""), F.lit(""))


def json_list(values: Column) -> Column:
    """JSON text of a string array as a flat table holds it, items parted by comma and space."""
    items = F.transform(values, lambda v: F.regexp_extract(F.to_json(F.array(v)), r"(?s)^\[(.*)\]$", 1))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))

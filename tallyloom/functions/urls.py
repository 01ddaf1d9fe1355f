"""Pieces of URLs, cut by plain text rules so odd inputs keep working."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_host(c: Column) -> Column:
    """Text after the last ``//`` and before the next ``/``; a port stays."""
    after = F.element_at(F.split(c, "//"), -1)
    return F.get(F.split(after, "/"), F.lit(0))


def portal_name(c: Column) -> Column:
    """Second dot-separated piece, or null."""
    return F.get(F.split(c, r"\."), F.lit(1))


def contains_any(c: Column, patterns) -> Column:
    """True where the text holds at least one of the given substrings."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.contains(c, F.lit(p))
    return hit


def normalise_url(c: Column) -> Column:
    """Address used to match a link to its page: no blanks around it, no fragment, no closing slash."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), "#.*$", ""), "/+$", "")

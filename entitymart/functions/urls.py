"""Urls, domains, logos and repository names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitymart.fixed import AVATAR, BLOCKED_DOMAINS, FAVICON, HUB, ORGANIZATION_ALIASES, REPOSITORIES, REPOSITORY_PATTERN
from entitymart.functions.text import blank_if_null, strip


def domain(url: Column) -> Column:
    """Network location in lower case, port kept, each ``www.`` removed."""
    place = F.regexp_extract(blank_if_null(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.replace(F.lower(place), F.lit("www."), F.lit(""))


def is_official_site(url: Column) -> Column:
    """Web address whose domain is not, and is not below, a blocked one."""
    d = domain(url)
    blocked = F.array(*[F.lit(b) for b in BLOCKED_DOMAINS])
    below = F.exists(blocked, lambda b: (d == b) | F.endswith(d, F.concat(F.lit("."), b)))
    return F.coalesce((d != "") & ~below & url.rlike("^https?://"), F.lit(False))


def favicon(website: Column) -> Column:
    """Icon address of a site; blank in, blank out."""
    d = domain(website)
    return F.when(d == "", F.lit("")).otherwise(F.format_string(FAVICON, d))


def avatar(organization: Column) -> Column:
    """Hub picture of an organisation; blank in, blank out."""
    org = blank_if_null(organization)
    return F.when(org == "", F.lit("")).otherwise(F.format_string(HUB + AVATAR, org))


def organization_key(name: Column) -> Column:
    """Stripped lower-case name with known aliases resolved."""
    key = F.lower(strip(blank_if_null(name)))
    aliases = F.create_map(*[F.lit(x) for pair in ORGANIZATION_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(aliases, key), key)


def model_id(organization: Column, model_name: Column) -> Column:
    """``organisation/name``, or the name alone."""
    org = blank_if_null(organization)
    return F.when(org == "", model_name).otherwise(F.concat_ws("/", org, model_name))


def model_id_from_url(url: Column) -> Column:
    """The url without the first hub address in it."""
    at = F.instr(url, HUB)
    cut = F.concat(F.substring(url, 1, at - 1), F.substring(url, at + len(HUB), F.length(url)))
    return F.when(at > 0, cut).otherwise(url)


def repository_in_text(text: Column) -> Column:
    """First ``owner/name`` of a repository url in a text, or null."""
    return F.nullif(F.regexp_extract(text, REPOSITORY_PATTERN, 1), F.lit(""))


def repository_url(repository: Column) -> Column:
    return F.concat(F.lit(REPOSITORIES), repository)


def repository_from_url(url: Column) -> Column:
    return F.replace(url, F.lit(REPOSITORIES), F.lit(""))

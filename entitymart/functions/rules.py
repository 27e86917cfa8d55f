"""Ordered keyword rules: the first rule with a needle in the text decides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitymart.functions.text import blank_if_null

Rules = list[tuple[str, list[str]]]

# Labels and needles, in rule order. Needles match inside words.
ROLE_FAMILIES: Rules = [
    ("Engineering", ["software engineer", "software developer", "developer", "backend", "frontend",
                     "full stack", "fullstack", "devops", "qa engineer"]),
    ("Data & AI", ["data scientist", "data analyst", "data engineer", "machine learning",
                   "ml engineer", "ai engineer"]),
    ("Product", ["product manager", "product owner"]),
    ("Design", ["designer", "ux", "ui"]),
    ("Marketing", ["marketing", "growth"]),
]
ROLE_FAMILIES_WIDE: Rules = [
    ("Engineering", ["software", "developer", "engineer", "backend", "frontend", "full stack",
                     "devops", "qa"]),
    ("Data & AI", ["data", "machine learning", "ai ", "artificial intelligence", "ml "]),
    ("Product", ["product manager", "product owner"]),
    ("Design", ["designer", "ux", "ui"]),
    ("Marketing", ["marketing", "growth"]),
    ("Sales", ["sales", "business development"]),
]
PRICING: Rules = [
    ("FREEMIUM", ["free trial", "freemium"]),
    ("FREE", ["free"]),
    ("ENTERPRISE", ["enterprise"]),
    ("PAID", ["pricing", "subscription"]),
]
REMOTE = ["remote", "work from home", "wfh", "distributed"]
OTHER = "Other"


def has_any(text: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in needles])


def first_rule(c: Column, rules: Rules, default: str | None = None) -> Column:
    text = F.lower(blank_if_null(c))
    out = F.lit(default).cast("string")
    for label, needles in reversed(rules):
        out = F.when(has_any(text, needles), F.lit(label)).otherwise(out)
    return out


def role_family(title: Column) -> Column:
    return first_rule(title, ROLE_FAMILIES, OTHER)


def role_family_wide(title: Column) -> Column:
    return first_rule(title, ROLE_FAMILIES_WIDE, OTHER)


def pricing_model(text: Column) -> Column:
    """Pricing label of the whole text, or null."""
    return first_rule(text, PRICING)


def is_remote(title: Column, description: Column) -> Column:
    return has_any(F.lower(F.concat_ws(" ", blank_if_null(title), blank_if_null(description))), REMOTE)

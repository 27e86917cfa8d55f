"""Descriptions from model cards, fallback sentences and prompts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.fixed import PROMPT_LONG, PROMPT_SHORT
from entitymart.functions.text import blank_if_null, collapse, let, strip

LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
SIZE = 500


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, LINE_END), strip)


def _paragraph(lines: Column, skips, ends) -> Column:
    """Kept lines from the first kept one to the first that ends the paragraph."""

    def keeps(line: Column) -> Column:
        return (line != "") & ~skips(line)

    def place(found: Column, test) -> Column:
        return F.array_position(F.transform(found, test), F.lit(True)).cast("int")

    def until_end(tail: Column) -> Column:
        body = let(place(tail, ends), lambda n: F.when(n > 0, F.slice(tail, 1, n - 1)).otherwise(tail))
        return F.filter(body, keeps)

    def from_start(found: Column) -> Column:
        none = F.array().cast("array<string>")
        tail = lambda n: let(F.slice(found, n, F.size(found)), until_end)
        return let(place(found, keeps), lambda n: F.when(n > 0, tail(n)).otherwise(none))

    return let(lines, from_start)


def card_description(readme: Column) -> Column:
    """First paragraph after the front matter, headings and images skipped."""

    def body(text: Column) -> Column:
        after = lambda parts: F.when(F.size(parts) >= 3, strip(F.get(parts, F.lit(2)))).otherwise(text)
        front = F.startswith(text, F.lit("---"))
        return F.when(front, let(F.split(text, "---", 3), after)).otherwise(text)

    lines = _paragraph(
        _lines(let(strip(blank_if_null(readme)), body)),
        skips=lambda x: F.startswith(x, F.lit("#")) | F.startswith(x, F.lit("![")),
        ends=lambda x: x == "",
    )
    return F.substring(F.array_join(lines, " "), 1, SIZE)


def card_description_plain(readme: Column) -> Column:
    """First paragraph of the whole card; a heading ends it, badges are skipped.

    Front-matter keys are text here: only the ``---`` lines are skipped.
    """
    lines = _paragraph(
        _lines(blank_if_null(readme)),
        skips=lambda x: F.startswith(x, F.lit("---")) | F.startswith(x, F.lit("#"))
        | F.startswith(x, F.lit("[![")),
        ends=lambda x: (x == "") | F.startswith(x, F.lit("#")),
    )
    joined = F.aggregate(
        lines,
        F.lit(""),
        lambda acc, x: F.when(F.length(acc) >= SIZE, acc)
        .when(acc == "", x)
        .otherwise(F.concat_ws(" ", acc, x)),
    )
    return F.substring(collapse(joined), 1, SIZE)


def fallback_description(model_name: Column, organization: Column) -> Column:
    """One sentence from name and publisher."""
    org = blank_if_null(organization)
    publisher = F.when(org == "", F.lit(fixed.NO_PUBLISHER)).otherwise(org)
    return F.format_string(fixed.PUBLISHED_AND_HOSTED, model_name, publisher)


def fallback_description_tagged(
    model_name: Column, organization: Column, pipeline_tag: Column, library_name: Column
) -> Column:
    """Sentences from name, publisher, task and library, as far as present."""
    org, task, library = (blank_if_null(c) for c in (organization, pipeline_tag, library_name))
    return collapse(
        F.concat_ws(
            " ",
            F.when(org != "", F.format_string(fixed.PUBLISHED, model_name, org))
            .otherwise(F.format_string(fixed.NOT_PUBLISHED, model_name)),
            F.when(task != "", F.format_string(fixed.TASK, task)),
            F.when(library != "", F.format_string(fixed.LIBRARY, library)),
        )
    )


def _fill(template: str) -> Column:
    """Template with each ``{column}`` replaced by the stripped column."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(
        *[strip(blank_if_null(F.col(p))) if i % 2 else F.lit(p) for i, p in enumerate(parts)]
    )


def prompt_with_source() -> Column:
    """Prompt that quotes the description found so far."""
    return _fill(PROMPT_LONG)


def prompt_from_metadata() -> Column:
    """Prompt from the metadata columns alone."""
    return _fill(PROMPT_SHORT)

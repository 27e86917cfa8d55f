"""Text out of HTML with built-in string functions.

Elements nest: a page is cut at its tags once, and one pass over the pieces keeps the
stack of open elements. An end tag closes the innermost element of its name and what
was opened in it; without one an element ends with its parent; an end tag that nothing
opened is ignored. Comments, scripts and styles end where their text says so.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitymart.functions.text import blank_if_null, collapse, let

# Elements whose content is not text, and page furniture.
NOT_TEXT = ["script", "style", "template"]
# Elements that end at the first end tag of their name.
FLAT = ["script", "style", "title", "textarea", "head"]
FURNITURE = ["script", "style", "noscript", "nav", "footer", "header", "form", "aside"]
BLOCKS = ["address", "article", "blockquote", "br", "dd", "div", "dl", "dt", "h1", "h2", "h3", "h4",
          "h5", "h6", "hr", "li", "ol", "p", "pre", "section", "table", "td", "th", "tr", "ul"]
# Elements that hold others and may be left open, besides the blocks above.
HOLDERS = ["html", "head", "body", "main", "nav", "footer", "header", "form", "aside", "noscript", "template", "figure",
           "figcaption", "details", "summary", "fieldset", "tbody", "thead", "tfoot", "caption", "span", "a", "b", "i",
           "em", "strong", "small", "font", "label", "button", "center"]
VOID = ["br", "hr"]
# The references that most pages use; all others are looked up after them.
COMMON = ["amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;", "amp", "lt", "gt", "quot", "nbsp", "copy;", "reg;", "trade;", "middot;", "bull;",
          "hellip;", "ndash;", "mdash;", "lsquo;", "rsquo;", "ldquo;", "rdquo;", "laquo;", "raquo;", "euro;", "pound;"]

# Code points that stand for Windows-1252 characters in a reference.
WINDOWS_1252 = {n: bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}

COMMENT = r"<!--.*?-->"
ANY_TAG = r"(?s)<[/!?a-zA-Z][^>]*>"


def element(name: str) -> str:
    """Pattern of one whole element."""
    return rf"<{name}(?:\s[^>]*)?>.*?</{name}\s*>"


def outline(page: Column, dropped: list[str]) -> Column:
    """A page cut at its tags: for each piece its ``text``, whether it is ``dead`` (inside one of
    the dropped elements), the open paragraphs ``ps`` by the piece that started each,
    outermost first, and whether it is inside the first ``article`` that is not dead.

    A piece starts with its tag and is inside what the tag opens, outside what it closes.
    """
    names = sorted({*HOLDERS, *BLOCKS, *dropped} - {*VOID, *FLAT})
    pieces = F.split(page, rf"(?i)(?=</?(?:{'|'.join(names)})[\s/>])")
    started = F.from_json(
        F.lit('{"names":[],"ids":[],"out":[]}'),
        "names array<string>, ids array<int>, at int, article int, "
        "out array<struct<text string, dead boolean, ps array<int>, article boolean>>",
    )
    gone = F.array(*[F.lit(n) for n in dropped])

    def opened(acc: Column, piece: Column) -> Column:
        """Names and numbers of the open elements after the piece's tag, innermost first."""
        tag = F.lower(F.regexp_extract(piece, rf"(?i)^<(/?(?:{'|'.join(names)}))[\s/>]", 1))
        at = F.coalesce(acc["at"], F.lit(0)) + 1

        def after(t: Column) -> Column:
            place = F.when(F.startswith(t, F.lit("/")), F.array_position(acc["names"], F.substring(t, 2, 20))).otherwise(F.lit(0)).cast("int")
            starts = (t != "") & ~F.startswith(t, F.lit("/")) & ~piece.rlike("^<[^>]*/>")
            closed = lambda stack: F.slice(stack, place + 1, F.greatest(F.size(stack), F.lit(1)))
            kept = lambda stack, new: F.when(starts, F.concat(F.array(new), stack)).when(place > 0, closed(stack)).otherwise(stack)
            return F.struct(kept(acc["names"], t).alias("names"), kept(acc["ids"], at).alias("ids"), at.alias("at"), t.alias("tag"), starts.alias("starts"))

        return let(tag, after)

    def step(acc: Column, piece: Column) -> Column:
        def labelled(now: Column) -> Column:
            dead = F.arrays_overlap(now["names"], gone)
            article = F.coalesce(acc["article"], F.when(now["starts"] & (now["tag"] == "article") & ~dead, now["at"]))
            ps = F.reverse(F.filter(now["ids"], lambda x, k: F.get(now["names"], k) == "p"))
            label = F.struct(
                piece.alias("text"), dead.alias("dead"), ps.alias("ps"),
                F.coalesce(F.array_contains(now["ids"], article), F.lit(False)).alias("article"),
            )
            return F.struct(now["names"].alias("names"), now["ids"].alias("ids"), now["at"].alias("at"), article.alias("article"), F.concat(acc["out"], F.array(label)).alias("out"))

        return let(opened(acc, piece), labelled)

    return F.aggregate(pieces, started, step, lambda acc: acc["out"])


def without(c: Column, names: list[str]) -> Column:
    """Remove comments and the named elements with their content."""
    raw, nested = [n for n in names if n in FLAT], [n for n in names if n not in FLAT]
    page = F.regexp_replace(c, "(?is)" + "|".join([COMMENT] + [element(n) for n in raw]), " ")
    if not nested:
        return page

    def pruned(p: Column) -> Column:
        kept = F.transform(outline(p, nested), lambda x: F.when(x["dead"], F.lit(" ")).otherwise(x["text"]))
        return F.when(p.rlike(rf"(?i)<(?:{'|'.join(nested)})[\s/>]"), F.array_join(kept, "")).otherwise(p)

    return let(page, pruned)


def content(c: Column, start: str, name: str) -> Column:
    """What is inside the first element whose start tag matches, up to the end tag that closes it.

    ``name`` is the element's; elements of that name inside it are counted. ``""`` where no
    start tag matches; without an end tag the rest.
    """
    rest = F.regexp_extract(c, rf"(?is){start}(.*)\z", 1)
    pieces = F.split(rest, rf"(?i)(?=</?{name}[\s/>])")

    def step(acc: Column, piece: Column) -> Column:
        change = F.when(piece.rlike(rf"(?i)^</{name}[\s/>]"), -1).when(piece.rlike(rf"(?i)^<{name}[\s/>]"), 1).otherwise(0)
        return let(
            F.when(acc["depth"] > 0, acc["depth"] + change).otherwise(F.lit(0)),
            lambda depth: F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out")),
        )

    return F.aggregate(pieces, F.struct(F.lit(1).alias("depth"), F.array().cast("array<string>").alias("out")), step, lambda acc: F.array_join(acc["out"], ""))


def decode_entities(c: Column) -> Column:
    """Named and numeric character references, each decoded once.

    The text is cut at ``&``; every later piece then starts with a possible
    reference, so a decoded ``&`` is never read again. Names are those of HTML 5;
    128 to 159 are read as Windows-1252; what is no reference stays as it is.
    """
    # one folded literal instead of thousands
    named = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    common = F.create_map(*[F.lit(x) for n in COMMON for x in (n, html5[n])])
    moved = F.create_map(*[F.lit(x) for pair in WINDOWS_1252.items() for x in pair])

    def character(code: Column) -> Column:
        return F.coalesce(
            F.try_element_at(moved, code),
            F.when(
                (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF),
                F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"),
            ),
        )

    def piece(p: Column) -> Column:
        number = F.regexp_extract(p, r"^#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6})(?![0-9a-fA-F])", 1)
        code = F.when(number.rlike("^[xX]"), F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).try_cast("bigint")
        name = F.regexp_extract(p, r"^[a-zA-Z][a-zA-Z0-9]*;?", 0)
        found = F.when(number != "", character(code)).otherwise(F.coalesce(F.try_element_at(common, name), F.try_element_at(named, name)))
        used = F.length(F.regexp_extract(p, r"^(?:#[xX]?[0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?", 0))
        rest = F.substring(p, used + 1, F.length(p))
        return let(found, lambda f: F.when(f.isNotNull(), F.concat(f, rest)).otherwise(F.concat(F.lit("&"), p)))

    def joined(pieces: Column) -> Column:
        tail = F.transform(pieces, lambda p, n: F.when(n == 0, p).otherwise(piece(p)))
        return F.array_join(tail, "")

    return let(c, lambda t: F.when(F.contains(t, F.lit("&")), joined(F.split(t, "&"))).otherwise(t))


def fragment_text(c: Column) -> Column:
    """HTML fragment to text: tags out, entities decoded, white space collapsed."""
    bare = F.regexp_replace(without(blank_if_null(c), NOT_TEXT), ANY_TAG, " ")
    return collapse(decode_entities(bare))


def article_text(html: Column) -> Column:
    """Text of the first article of a page, else of its paragraphs.

    A paragraph inside another is read with it and once more by itself.
    """

    def chosen(pieces: Column) -> Column:
        alive = F.filter(pieces, lambda x: ~x["dead"])
        text = lambda xs: F.array_join(F.transform(xs, lambda x: x["text"]), "")
        inside = lambda xs: F.filter(xs, lambda x: F.size(x["ps"]) > 0)

        def paragraphs(xs: Column) -> Column:
            starts = F.array_distinct(F.flatten(F.transform(xs, lambda x: x["ps"])))
            each = F.transform(F.array_sort(starts), lambda s: text(F.filter(xs, lambda x: F.array_contains(x["ps"], s))))
            return F.when(F.exists(xs, lambda x: F.size(x["ps"]) > 1), F.array_join(each, " ")).otherwise(text(xs))

        return F.when(F.exists(alive, lambda x: x["article"]), text(F.filter(alive, lambda x: x["article"]))).otherwise(let(inside(alive), paragraphs))

    raw, nested = [n for n in FURNITURE if n in FLAT], [n for n in FURNITURE if n not in FLAT]
    first = fragment_text(let(outline(without(blank_if_null(html), raw), nested), chosen))
    # the text is read as HTML a second time, so doubly escaped markup goes as well
    return let(first, lambda t: F.when(t.rlike("[<&]"), fragment_text(t)).otherwise(t))


def visible_text(html: Column) -> Column:
    """Text a reader sees: block tags part words, inline tags do not."""
    page = without(blank_if_null(html), NOT_TEXT + ["noscript", "head", "title"])
    parted = F.regexp_replace(page, rf"(?i)</?(?:{'|'.join(BLOCKS)})(?:\s[^>]*)?/?>", " ")
    return collapse(decode_entities(F.regexp_replace(parted, ANY_TAG, "")))

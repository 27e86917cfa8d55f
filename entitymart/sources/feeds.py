"""News items from landed RSS and Atom feeds.

A feed table has ``source_name``, ``payload`` (the XML text) and ``_ord``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions.dates import instant, is_fresh, parse_date
from entitymart.functions.html import article_text, fragment_text
from entitymart.functions.text import blank_if_null, first_filled, is_present, let, strip
from entitymart.operators import dedup
from entitymart.operators.ordering import ORD
from entitymart.session import materialise

ITEM = """struct<title: string, link: string, description: string, pubDate: string,
                 `atom:link`: array<struct<_href: string>>>"""
RSS = f"item array<{ITEM}>, channel array<struct<item: array<{ITEM}>>>, _corrupt_record string"
ATOM = """entry array<struct<title: string, link: array<struct<_href: string>>, summary: string,
                             published: string, updated: string>>"""
ATOM_NAMESPACE = "http://www.w3.org/2005/Atom"


def items_at_any_depth(payload: Column) -> Column:
    """A document whose root holds every ``item`` element of another, wherever it stands, in its order.

    The text is cut into tags, comments, CDATA sections and text once; one pass over these
    keeps the open items. An item inside an item is listed with it and by itself. Name
    spaces are declared at the root, each prefix as it was first.
    """
    tokens = F.regexp_extract_all(payload, F.lit(r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<[^>]*>|[^<]+"), F.lit(0))
    declared = F.regexp_extract_all(payload, F.lit(r"""(?s)\sxmlns:[^\s=]+\s*=\s*(?:"[^"]*"|'[^']*')"""), F.lit(0))
    prefix = lambda x: F.regexp_extract(x, r"xmlns:([^\s=]+)", 1)
    spaces = let(declared, lambda d: F.filter(d, lambda x, k: F.array_position(F.transform(d, prefix), prefix(x)) == k + 1))
    started = F.from_json(F.lit('{"at":0,"open":[],"spans":[]}'), "at int, open array<int>, spans array<struct<first int, size int>>")

    def step(acc: Column, token: Column) -> Column:
        at, opened = acc["at"] + 1, acc["open"]
        starts, empty, ends = token.rlike(r"^<item[\s>]"), token.rlike(r"(?s)^<item(?:\s.*)?/>$"), token.rlike(r"^</item\s*>") & (F.size(opened) > 0)
        span = lambda first: F.concat(acc["spans"], F.array(F.struct(first.alias("first"), (at - first + 1).alias("size"))))
        return F.struct(
            at.alias("at"),
            F.when(empty, opened).when(starts, F.concat(F.array(at), opened)).when(ends, F.slice(opened, 2, F.size(opened))).otherwise(opened).alias("open"),
            F.when(empty, span(at)).when(ends, span(F.get(opened, F.lit(0)))).otherwise(acc["spans"]).alias("spans"),
        )

    def items(found: Column) -> Column:
        spans = F.array_sort(F.aggregate(found, started, step, lambda acc: acc["spans"]))
        return F.array_join(F.transform(spans, lambda x: F.array_join(F.slice(found, x["first"], x["size"]), "")), "")

    return F.concat(F.lit("<rss"), F.array_join(spaces, ""), F.lit(">"), let(tokens, items), F.lit("</rss>"))


def feed_items(feeds: DataFrame, as_of: datetime | None) -> DataFrame:
    """Items of each feed: RSS items at any depth, or Atom entries where a feed has no RSS item.

    XML that does not parse gives no rows. Items under the root and its channels are read
    in one parse; a feed that has more is rewritten and parsed again. Without ``as_of``
    relative dates count from the query's, or a micro-batch's, start. ``feeds`` may be a stream.
    """
    none = F.from_json(F.lit("[]"), f"array<{ITEM}>")

    def items_of(rss: Column) -> Column:
        channels = F.flatten(F.transform(rss["channel"], lambda c: F.coalesce(c["item"], none)))
        near = F.concat(F.coalesce(rss["item"], none), F.coalesce(channels, none))
        more = F.regexp_count("payload", F.lit(r"<item[\s/>]")) > F.size(near)
        deep = F.coalesce(F.from_xml(items_at_any_depth(F.col("payload")), RSS)["item"], none)
        return F.when(rss["_corrupt_record"].isNull() & more, deep).otherwise(near)

    def as_item(x: Column) -> Column:
        link = F.coalesce(first_filled(x["link"]), F.get(x["atom:link"], F.lit(0))["_href"])
        return _item(x["title"], link, x["description"], x["pubDate"], as_of)

    def as_entry(x: Column) -> Column:
        link, date = F.get(x["link"], F.lit(0))["_href"], F.coalesce(x["published"], x["updated"])
        return _item(x["title"], link, x["summary"], date, as_of)

    entries = F.transform(F.from_xml("payload", ATOM, {"ignoreNamespace": "true"})["entry"], as_entry)
    is_atom = F.contains("payload", F.lit(ATOM_NAMESPACE))
    chosen = let(
        F.transform(let(F.from_xml("payload", RSS), items_of), as_item),
        lambda items: F.when(F.size(items) > 0, items).when(is_atom, entries),
    )
    return feeds.select(
        "source_name", F.col(ORD).alias("_feed"), F.posexplode(chosen).alias("_pos", "item")
    ).select(
        F.struct("_feed", "_pos").alias(ORD),
        "source_name",
        fragment_text(F.col("item.title")).alias("title"),
        strip(blank_if_null(F.col("item.url"))).alias("url"),
        fragment_text(F.col("item.description")).alias("description"),
        F.col("item.published").alias("published"),
    )


def _item(title: Column, url: Column, description: Column, date: Column, as_of: datetime | None) -> Column:
    return F.struct(
        title.alias("title"),
        url.alias("url"),
        description.alias("description"),
        parse_date(date, _now(as_of)).alias("published"),
    )


def _now(as_of: datetime | None) -> Column:
    return instant(as_of) if as_of else F.current_timestamp()


def article_texts(pages: DataFrame, items: DataFrame) -> DataFrame:
    """Article text per url, for the urls of ``items`` only.

    The items' distinct urls are the small side, so pages nobody asks for are
    not parsed. Of several copies of a page the last counts; texts, not pages,
    are ranked for that.
    """
    wanted = items.select("url").distinct()
    found = pages.select(ORD, "url", "html").join(wanted, "url", "left_semi")
    texts = found.select(ORD, "url", article_text(F.col("html")).alias("article"))
    return dedup.keep_one(texts, ["url"], "last").select("url", "article")


def news(items: DataFrame, pages: DataFrame, as_of: datetime) -> DataFrame:
    """News records of fresh items; the content is the page's article, else the
    feed's description.

    Freshness is tested before the pages are joined. What is left is a day's
    items; they are written to the shared folder once, so that the feeds are not
    parsed again for the size check and for either side of the join.
    """
    fresh = materialise(fresh_items(items, as_of), "fresh-items")
    # both sides can be large and the texts are wide: a plain join, in which
    # adaptive execution broadcasts texts that turn out small and splits hot urls
    return records(fresh.join(article_texts(pages, fresh), "url", "left"), as_of)


def fresh_items(items: DataFrame, as_of: datetime | None) -> DataFrame:
    """Items with a title and a url, published within the window."""
    return items.filter(is_fresh(F.col("published"), as_of) & is_present(F.col("title")) & is_present(F.col("url")))


def records(items: DataFrame, as_of: datetime | None) -> DataFrame:
    """News records of items that have an ``article``, null or blank where none was found."""
    return items.select(
        ORD,
        F.lit(fixed.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit("NEWS").alias("recordType"),
        "source_name",
        F.col("url").alias("source_url"),
        strip(F.col("title")).alias("title"),
        F.col("published").alias("publishedAt"),
        F.coalesce(first_filled(F.col("article")), F.col("description")).alias("content"),
        _now(as_of).alias("collectedAt"),
    )


def unique_news(records: DataFrame) -> DataFrame:
    """Last article per url."""
    return dedup.by_source_url(records)

"""Inputs of the operators, derived from the whole test tables by Spark."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.operators.ordering import ORD
from entitymart.sources.tables import read_parquet

JOBS_AS_OF = datetime(1998, 10, 3, tzinfo=timezone.utc)
NEWS_AS_OF = datetime(2024, 1, 30, tzinfo=timezone.utc)

TITLES = [
    "Software Developer", "Data Engineer", "Product Owner", "UX Researcher", "Growth Lead",
    "Recruiter", "Sales Executive", "Accountant",
]
AGAIN, NAMELESS, PASSAGES = 1_000_000_000, 500_000_000, 2_000_000_000
ORGANIZATIONS = [*fixed.KNOWN_SITES, *fixed.ORGANIZATION_ALIASES, "unknown lab"]
CONFIDENCES = ["0.5", " 1 ", "1.5", "-0.1", "abc", "", "NaN", "0.2_5", "1_0", "0.5d", "inf", "1e-3"]

text = F.concat
lit = F.lit


def pad(c: Column) -> Column:
    return F.lpad(c.cast("string"), 9, "0")


def nth(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[lit(v) for v in values]), (n % len(values) + 1).cast("int"))


def xml(c: Column) -> Column:
    """Text escaped for XML."""
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, lit(raw), lit(escaped))
    return c


def bundle(df: DataFrame, key: str, bits: int, piece: Column, head: Column, tail: str, sep: str = "") -> DataFrame:
    """Payloads of at most ``2**bits`` pieces with neighbouring keys, in key order."""
    grouped = df.groupBy(F.shiftright(key, bits).alias(ORD)).agg(
        F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), piece.alias("p")))).alias("ps")
    )
    body = F.array_join(F.transform("ps", lambda x: x["p"]), sep)
    return grouped.select(ORD, F.concat(head, body, lit(tail)).alias("payload"))


class Inputs:
    """The derived tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def startups(self) -> DataFrame:
        """Suppliers twice (the second time in capitals), rows without a name,
        and the opening words of the benchmark passages."""
        s, r, b = self.table("supplier"), self.table("region"), self.table("benchmark")

        def part(df, order, name, slug):
            return df.select(
                order.cast("bigint").alias(ORD),
                name.alias("entityName"),
                text(lit("https://dir.example/companies/"), slug.cast("string")).alias("source_url"),
            )

        opening = F.array_join(F.slice(F.split(F.col("text"), r"\s+"), 1, 3), " ")
        key = F.col("s_suppkey")
        return (
            part(s, key, F.col("s_name"), key)
            .unionByName(part(r, F.col("r_regionkey") + NAMELESS, lit("  "), text(lit("r-"), F.col("r_regionkey"))))
            .unionByName(part(s, key + AGAIN, F.upper("s_name"), text(lit("again-"), key)))
            .unionByName(part(b, F.col("item_id") + PASSAGES, opening, text(lit("b-"), F.col("item_id"))))
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias(ORD),
            text(lit("part "), F.col("l_partkey")).alias("productName"),
            text(lit("SUPPLIER "), pad(F.col("l_suppkey") + F.col("l_linenumber"))).alias("startupName"),
            F.concat_ws("/", lit("https://dir.example/products"), "l_partkey", "l_suppkey").alias("source_url"),
        )

    @cached_property
    def jobs(self) -> DataFrame:
        """Orders as postings; cheap ones have no url, low-priority ones another spelling of it."""
        status = F.when(F.col("o_orderpriority") == "5-LOW", F.lower("o_orderstatus")).otherwise(
            F.col("o_orderstatus")
        )
        url = F.concat_ws("/", lit("https://jobs.example"), F.col("o_custkey").cast("string"), status)
        return self.table("orders").select(
            F.col("o_orderkey").alias(ORD),
            text(lit("supplier-"), pad(F.col("o_custkey"))).alias("company"),
            nth(TITLES, F.col("o_orderkey")).alias("title"),
            F.col("o_orderdate").alias("date"),
            F.when(F.col("o_totalprice") < 2000, "").otherwise(url).alias("source_url"),
            F.col("o_orderpriority").alias("priority"),
        )

    @cached_property
    def news(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").alias(ORD),
            F.split_part("text", lit("\n"), lit(1)).alias("title"),
            F.col("text").alias("content"),
            F.concat_ws("/", lit("https://news.example"), "source", "lang", F.col("n_chars").cast("string"))
            .alias("source_url"),
            (lit(NEWS_AS_OF) - F.make_interval(mins=(F.col("doc_id") * 7).cast("int"))).alias("publishedAt"),
        )

    @cached_property
    def papers(self) -> DataFrame:
        """Documents as papers; German ones have no source url."""
        return self.table("documents").select(
            F.col("doc_id").alias(ORD),
            F.col("text").alias("title"),
            F.to_json(F.array("lang", "source")).alias("authors"),
            F.when(F.col("lang") == "de", "")
            .otherwise(text(lit("https://papers.example/src/"), F.col("doc_id")))
            .alias("source_url"),
            text(lit("https://papers.example/abs/"), F.col("doc_id")).alias("paper_url"),
            F.date_format(
                lit(NEWS_AS_OF) - F.make_interval(mins=(F.col("doc_id") * 7).cast("int")),
                "yyyy-MM-dd'T'HH:mm:ss'Z'",
            ).alias("published_date"),
            text(F.col("text"), lit(" https://github.com/"), F.col("source"), lit("/"), F.col("lang"), lit("."))
            .alias("summary"),
        )

    @cached_property
    def models(self) -> DataFrame:
        """Parts as models; economy ones in capitals, the smallest without organisation."""
        brand = (
            F.when(F.col("p_size") <= 2, "")
            .when(F.col("p_type") == "ECONOMY", F.upper("p_brand"))
            .otherwise(F.col("p_brand"))
        )
        return self.table("part").select(
            F.col("p_partkey").alias(ORD),
            F.col("p_name").alias("model_name"),
            brand.alias("organization"),
            F.concat_ws("/", lit("https://huggingface.co"), brand, F.col("p_name")).alias("source_url"),
            F.col("p_size").cast("bigint").alias("downloads"),
            (F.col("p_partkey") % 100).alias("likes"),
            F.lower("p_type").alias("pipeline_tag"),
            F.when(F.col("p_retailprice") < 950, "").otherwise("spark").alias("library_name"),
        )

    @cached_property
    def raw_models(self) -> DataFrame:
        """The models as the hub lists them."""
        m = self.models
        path = F.regexp_replace("source_url", "^https://huggingface.co/+", "")
        return m.select(
            ORD, text(lit(" "), path).alias("id"), "downloads", "likes", "pipeline_tag", "library_name"
        )

    @cached_property
    def card_models(self) -> DataFrame:
        """Documents as models with cards."""
        return self.table("documents").select(
            F.col("doc_id").alias(ORD),
            text(F.col("lang"), lit("-"), F.col("doc_id")).alias("model_name"),
            F.when(F.col("lang") == "es", "").otherwise(F.col("source")).alias("organization"),
            F.concat_ws(
                "/", lit("https://huggingface.co"), F.when(F.col("lang") != "es", F.col("source")),
                text(F.col("lang"), lit("-"), F.col("doc_id")),
            ).alias("source_url"),
            F.col("n_chars").alias("downloads"),
            F.col("n_chars").alias("likes"),
            F.when(F.col("n_chars") > 1000, "summarization").otherwise("").alias("pipeline_tag"),
            F.when(F.col("n_chars") > 2000, "").otherwise("spark").alias("library_name"),
        )

    @cached_property
    def all_cards(self) -> DataFrame:
        """Cards of all documents: front matter, heading, image, the text, and a heading after it."""
        name = text(F.col("lang"), lit("-"), F.col("doc_id"))
        return self.table("documents").select(
            F.col("doc_id").alias(ORD),
            "lang",
            F.concat_ws("/", F.when(F.col("lang") != "es", F.col("source")), name).alias("model_id"),
            text(
                F.when(F.col("lang") == "fr", "").otherwise("---\nlicense: mit\n---\n"),
                lit("# Card\n\n![logo](x.png)\n[![badge](y)]\n"),
                F.col("text"),
                lit("\n## More\nEnd."),
            ).alias("readme"),
        )

    @cached_property
    def cards(self) -> DataFrame:
        """Cards without the German ones, so that some models have none."""
        return self.all_cards.filter("lang <> 'de'").drop("lang")

    @cached_property
    def organization_models(self) -> DataFrame:
        """Parts as models of well-known organisations, some with a url elsewhere."""
        name = nth(ORGANIZATIONS, F.col("p_partkey"))
        host = F.when(F.col("p_type") == "PROMO", "https://models.example/").otherwise(fixed.HUB)
        return self.table("part").select(
            F.col("p_partkey").alias(ORD),
            F.when(F.col("p_size") > 25, F.upper(name)).otherwise(name).alias("organization"),
            text(host, F.col("p_name")).alias("source_url"),
        )

    @cached_property
    def progress(self) -> DataFrame:
        """Finished descriptions of larger models, blank ones for medium sizes."""
        m = self.models
        return m.filter("downloads > 10").select(
            ORD,
            "source_url",
            F.when(F.col("downloads") < 20, " ").otherwise(text(lit("done "), "model_name", lit(" "), F.col(ORD)))
            .alias("description"),
        )

    @cached_property
    def enriched(self) -> DataFrame:
        """Models as the description step reads them."""
        return self.models.withColumns(
            {
                "official_website": F.col("source_url"),
                "logo_url": lit(""),
                "description": text(lit("about "), "model_name"),
            }
        )

    @cached_property
    def relationship_rows(self) -> DataFrame:
        """Events as relationships read from text, with good and bad values."""
        kind = F.upper("event_type")
        return self.table("events").select(
            F.col("event_id").alias(ORD),
            F.when(F.col("event_type") == "error", " ")
            .otherwise(F.format_string(" STARTUP-%04d", F.col("user_id")))
            .alias("entityId"),
            text(lit("user "), F.col("user_id"), lit(" "), kind).alias("entityName"),
            nth([*_KINDS, "HAS_OTHER", ""], F.col("event_id")).alias("relationshipType"),
            F.when(F.col("event_type") == "view", "NEWS").otherwise("JOB").alias("recordType"),
            text(lit("https://x.example/"), F.col("user_id") % 7).alias("source_url"),
            nth(CONFIDENCES, F.col("event_id")).alias("confidence"),
        )

    # landed payloads

    @cached_property
    def board_1(self) -> DataFrame:
        """Postings as one array; dates as text or seconds, elements that are no objects."""
        seconds = F.col("priority").isin("1-URGENT", "2-HIGH")
        item = F.to_json(
            F.struct(
                F.col("title").alias("position"),
                "company",
                F.when(F.col("priority") == "3-MEDIUM", F.replace("source_url", lit("https://jobs.example"), lit("/jobs")))
                .otherwise(F.col("source_url"))
                .alias("url"),
                F.when(~seconds, F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("date"),
                F.when(seconds, F.unix_timestamp("date")).alias("epoch"),
            )
        )
        return bundle(self.jobs, ORD, 5, item, lit('["legal",7,'), "]", ",")

    @cached_property
    def board_2(self) -> DataFrame:
        """Postings as an object; the date under either name."""
        low = F.col("priority") == "5-LOW"
        date = F.date_format("date", "EEE, dd MMM yyyy HH:mm:ss")
        item = F.to_json(
            F.struct(
                F.col("title").alias("jobTitle"),
                F.col("company").alias("companyName"),
                F.col("source_url").alias("url"),
                F.when(~low, F.concat(date, lit(" GMT"))).otherwise("").alias("pubDate"),
                F.when(low, F.concat(date, lit(" +0000"))).alias("date"),
            )
        )
        return bundle(self.jobs, ORD, 5, item, lit('{"jobs":["legal",'), "]}", ",")

    @cached_property
    def board_3(self) -> DataFrame:
        item = F.to_json(
            F.struct(
                F.concat(lit(" "), "title").alias("title"),
                F.concat("company", lit(" ")).alias("company_name"),
                F.concat("source_url", lit(" ")).alias("url"),
                F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss").alias("publication_date"),
                F.when(F.col("priority") != "5-LOW", F.col("priority")).alias("category"),
                lit("full_time").alias("job_type"),
                F.lower("priority").alias("candidate_required_location"),
            )
        )
        return bundle(self.jobs, ORD, 5, item, lit('{"jobs":['), "]}", ",")

    def _feed(self, rows: DataFrame, key: str, item: Column, head: str, tail: str) -> DataFrame:
        feeds = bundle(rows, key, 4, item, lit(head), tail)
        return feeds.withColumn("source_name", F.concat(lit("feed "), F.col(ORD).cast("string")))

    @cached_property
    def rss(self) -> DataFrame:
        """Documents as RSS items; Spanish ones carry an Atom link."""
        url = xml(F.col("source_url"))
        link = F.when(
            F.col("lang") == "es", F.concat(lit('<atom:link href="'), url, lit('"/>'))
        ).otherwise(F.concat(lit("<link> "), url, lit(" </link>")))
        item = F.concat(
            lit("<item><title>"), xml(F.col("title")), lit("</title>"), link,
            lit("<description>"), xml(F.concat(lit("<p>"), "content", lit("</p>"))), lit("</description><pubDate>"),
            F.date_format("publishedAt", "EEE, dd MMM yyyy HH:mm:ss"), lit(" GMT</pubDate></item>"),
        )
        rows = self.news.join(self.table("documents").select(F.col("doc_id").alias(ORD), "lang"), ORD)
        head = '<rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>feed</title>'
        return self._feed(rows, ORD, item, head, "</channel></rss>")

    @cached_property
    def page_rss(self) -> DataFrame:
        """The web pages as RSS items of a feed."""
        item = F.concat(
            lit("<item><title>Page "), F.col("page_id").cast("string"), lit("</title><link>"),
            xml(F.col("url")), lit("</link><description>about "), F.col("page_id").cast("string"),
            lit("</description><pubDate>5 hours ago</pubDate></item>"),
        )
        rows = self.table("pages")
        return self._feed(rows, "page_id", item, "<rss><channel>", "</channel></rss>")

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages").withColumn(ORD, F.col("page_id"))

    @cached_property
    def atom(self) -> DataFrame:
        """Documents as Atom entries; French ones are dated by their update."""
        tag = F.when(F.col("lang") == "fr", "updated").otherwise("published")
        entry = F.concat(
            lit("<entry><title>"), xml(F.col("title")), lit('</title><link href="'), xml(F.col("source_url")),
            lit('"/><link href="other"/><summary>'), xml(F.col("content")), lit("</summary><"), tag, lit(">"),
            F.date_format("publishedAt", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), lit("</"), tag, lit("></entry>"),
        )
        rows = self.news.join(self.table("documents").select(F.col("doc_id").alias(ORD), "lang"), ORD)
        return self._feed(rows, ORD, entry, '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")

    @cached_property
    def paper_feeds(self) -> DataFrame:
        """Papers as Atom entries; German ones lack the abstract link."""
        d = self.papers.withColumn("no_abstract", F.col("source_url") == "")
        authors = F.array_join(
            F.transform(
                F.from_json("authors", "array<string>"),
                lambda a: F.concat(lit("<author><name> "), a, lit("</name></author>")),
            ),
            "",
        )
        link = F.when(F.col("no_abstract"), "").otherwise(
            F.concat(lit('<link href="'), F.col("paper_url"), lit('"/>'))
        )
        entry = F.concat(
            lit("<entry><id> "), F.col("paper_url"), lit(" </id><title>"), xml(F.col("title")),
            lit("</title><summary>"), xml(F.col("summary")), lit("</summary><published>"),
            F.col("published_date"), lit("</published>"), authors,
            lit('<link href="https://papers.example/pdf/x"/>'), link, lit("</entry>"),
        )
        return self._feed(d, ORD, entry, '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")

    @cached_property
    def directory(self) -> DataFrame:
        """The web pages with their links moved under the company directory."""
        html = F.replace("html", lit('href="/'), lit('href="/companies/'))
        html = F.replace(html, lit('href="/companies/to"'), lit('href="/companies/to/?page=1"'))
        return self.pages.withColumn("html", html)

    @cached_property
    def listings(self) -> DataFrame:
        """Documents as listing pages of up to eight papers."""
        item = F.concat(
            lit('<dt><a href="/abs/'), F.col("doc_id").cast("string"),
            lit('" title="Abstract">x</a></dt>\n<dd><div class="list-title mathjax"><span>Title:</span>\n'),
            xml(F.split_part("text", lit("\n"), lit(1))),
            lit('</div><div class="list-authors"><a href="#">'), F.col("lang"), lit("</a>, <a href='#'>"),
            F.col("source"), lit("</a></div></dd>"),
        )
        pages = bundle(self.table("documents"), "doc_id", 3, item, lit("<html><dl id='articles'>"), "</dl></html>")
        return pages.withColumnRenamed("payload", "html")

    @cached_property
    def search_results(self) -> DataFrame:
        """Repositories found per keyword text: a document's six first words."""
        words = F.filter(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " "), lambda w: w != "")
        return self.table("documents").select(
            F.col("doc_id").alias(ORD),
            F.array_join(F.slice(words, 1, 6), " ").alias("keywords"),
            F.concat_ws("/", lit("https://github.com"), "source", F.col("doc_id").cast("string")).alias("html_url"),
            F.when(F.col("lang") != "fr", F.col("n_chars")).alias("stargazers_count"),
        )

    @cached_property
    def repositories(self) -> DataFrame:
        """One repository per source and language, where ``owner/name`` ends in a dot."""
        return (
            self.table("documents")
            .groupBy(F.concat("source", lit("/"), "lang", lit(".")).alias("full_name"))
            .agg(F.sum("n_chars").alias("stargazers_count"))
            .filter("full_name not like '%/es.'")
        )


_KINDS = [fixed.HAS_PRODUCT, fixed.HAS_JOB, fixed.MENTIONED_IN_RESEARCH, fixed.MENTIONED_IN_NEWS]

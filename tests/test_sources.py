import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from entitymart import schemas
from entitymart.operators.ordering import ORD
from entitymart.session import scratch_path
from entitymart.functions import text
from entitymart.sources import feeds, jobs, models, pages, papers, tables

AS_OF = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)
NOW = int(AS_OF.timestamp())


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def payloads(table, *texts):
    return table("payload string, source_name string", [(t, f"s{i}") for i, t in enumerate(texts)])


def test_board_1(table):
    job = lambda **kw: {"position": "Dev", "company": "C", "url": "/j", "date": "2024-01-30T00:00:00Z", **kw}
    items = [
        "legal", 5, None, ["x"], {"legal": "terms"},
        job(url="/a"), job(url="http://b"), job(url="/c", date=NOW - 10), job(url="/d", date="", epoch=NOW - 86400),
        job(url="/e", date=None, epoch=NOW - 86401), job(url="/f", date=0, epoch=str(NOW)), job(url=""), job(position=""),
        job(url="/g", date="2 hours ago"), job(url="/h", date=NOW + 1), job(url="/i", position=" "), job(url="/k", date=NOW + 0.5 - 1),
    ]
    got = jobs.board_1_jobs(payloads(table, json.dumps(items), '{"jobs": []}', "[broken", None), AS_OF)
    site = "https://remoteok.com"
    assert values(got, "source_url") == sorted(
        [(site + "/a",), ("http://b",), (site + "/c",), (site + "/d",), (site + "/g",), (site + "/i",), (site + "/k",)]
    )
    assert got.drop(ORD).columns == schemas.columns(schemas.JOBS)


def test_board_2_and_union(table):
    job = lambda **kw: {"jobTitle": "UX", "companyName": "C", "url": "u", "pubDate": "Tue, 30 Jan 2024 01:00:00 GMT", **kw}
    text = json.dumps({"jobs": [job(), job(url="v", pubDate="", date="2024-01-30"), job(url="w", pubDate="soon"), 7, job(jobTitle="Last")]})
    got = jobs.board_2_jobs(payloads(table, text, "[]", '{"other": 1}'), AS_OF)
    assert values(got, "source_url", "title") == [("u", "Last"), ("u", "UX"), ("v", "UX")]
    first = jobs.board_1_jobs(payloads(table, json.dumps([{"position": "P", "url": "http://1", "date": "2024-01-30"},
                                                          {"position": "P", "url": "httpu", "date": "2024-01-30"}])), AS_OF)
    second = got.withColumn("source_url", F.concat(F.lit("http"), "source_url"))
    unique = jobs.unique_jobs([first, second])
    assert values(unique, "source_url", "title", "source_name") == [
        ("http://1", "P", "Remote OK"), ("httpu", "Last", "Jobicy"), ("httpv", "UX", "Jobicy")]


def test_board_3(table):
    job = lambda **kw: {"title": " Engineer ", "company_name": None, "url": " U ", "publication_date": "2024-01-30T10:00:00", **kw}
    text = json.dumps({"jobs": [job(), job(url="u", title="again"), job(url="x", publication_date="1 hour ago"), job(url=None), job(url="z", category="c", job_type="j")]})
    got = jobs.board_3_jobs(payloads(table, text), AS_OF)
    assert values(got, "source_url", "content.company", "content.title", "content.category", "content.job_type") == [
        ("U", "", "Engineer", "", None), ("z", "", "Engineer", "c", "j")]
    assert tables.flat_job(got).columns == schemas.columns(schemas.JOBS_DETAILED)


RSS = """<?xml version="1.0"?><rss xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>t</title>
<item><title>A &amp;amp; <![CDATA[<b>B</b>]]></title><link> http://a </link><description>&lt;p&gt;x&lt;/p&gt;</description>
<pubDate>Tue, 30 Jan 2024 03:00:00 GMT</pubDate></item>
<item><title>C</title><atom:link href="http://c"/><pubDate>3 hours ago</pubDate></item>
<item><title>D</title></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>
<entry><title type="html">E1</title><link href="u1"/><link href="u2"/><summary>s</summary><updated>2024-01-30T01:00:00Z</updated></entry>
<entry><title>E2</title><link href="u3"/><published></published><updated>2024-01-30T01:00:00Z</updated></entry></feed>"""


def test_feed_items(table):
    rss = feeds.feed_items(payloads(table, RSS, "<rss><channel><item><title>broken", "", None), AS_OF)
    got = values(rss, "title", "url", "description", "published")
    assert [g[:3] for g in got] == [("A & B", "http://a", "x"), ("C", "http://c", ""), ("D", "", "")]
    assert got[0][3] == datetime(2024, 1, 30, 3) and got[1][3] == datetime(2024, 1, 30, 9) and got[2][3] is None
    atom = feeds.feed_items(payloads(table, ATOM), AS_OF)
    assert values(atom, "title", "url", "description")[0] == ("E1", "u1", "s")
    assert values(atom.filter("title = 'E1'"), "published") == [(datetime(2024, 1, 30, 1),)]
    # no name space, no Atom
    assert feeds.feed_items(payloads(table, ATOM.replace(' xmlns="http://www.w3.org/2005/Atom"', "")), AS_OF).count() == 0


def test_items_at_any_depth(table):
    """As ``.//item`` of a parsed tree finds them: in document order, an item inside an item as well."""
    one = "<item><title>{0}</title><link>{0}</link></item>"
    got = lambda *docs: [(r["title"], r["url"]) for r in feeds.feed_items(payloads(table, *docs), AS_OF).orderBy(ORD).collect()]
    assert got(f"<feed><a><b>{one.format('x')}</b></a>{one.format('y')}</feed>") == [("x", "x"), ("y", "y")]
    nested = "<rss><channel><item><title>out</title><part><item><title>in</title></item></part><link>o</link></item></channel></rss>"
    assert got(nested) == [("out", "o"), ("in", "")]
    three = "<r><item><title>1</title><g><item><title>2</title><g><item><title>3</title></item></g></item></g></item><g><item/></g></r>"
    assert got(three) == [("1", ""), ("2", ""), ("3", ""), ("", "")]
    hidden = f"<r><g><!-- {one.format('no')} --><t><![CDATA[{one.format('no')}]]></t>{one.format('yes')}</g></r>"
    assert got(hidden) == [("yes", "yes")]
    spaced = '<r xmlns:a="http://www.w3.org/2005/Atom" xmlns:atom="http://www.w3.org/2005/Atom"><g xmlns:a="z"><item><title>t</title><atom:link href="h"/></item></g></r>'
    assert got(spaced) == [("t", "h")]
    assert got(f"<r><g>{one.format('x')}</g>", f"<r><items>{one.format('z')}</items></r>", "<r><itemx><title>q</title></itemx></r>") == [("z", "z")]


def test_news_takes_article_or_description(table):
    items = feeds.feed_items(payloads(table, RSS), AS_OF)
    site = table("url string, html string", [("http://a", "<p>old</p>"), ("http://a", "<p>new</p>"), ("http://c", "<nav>n</nav>"), ("http://z", "")])
    got = feeds.news(items, site, AS_OF)
    assert values(got, "source_url", "content") == [("http://a", "new"), ("http://c", "")]
    assert got.drop(ORD).columns == schemas.columns(schemas.NEWS)


PAPERS = """<feed xmlns="http://www.w3.org/2005/Atom">
<entry><id> i1 </id><title>On
  things</title><summary>see https://github.com/a/b. End</summary><published>2024-01-02T00:00:00Z</published>
<author><name> A </name></author><author><name></name></author><author><name>B</name></author>
<link href="http://x/pdf/1"/><link href="http://x/abs/1"/><link href="http://x/abs/2"/></entry>
<entry><id>i2</id><title>No link</title><published>2024-01-03T00:00:00Z</published></entry></feed>"""


def test_papers(table):
    got = papers.papers(payloads(table, PAPERS), AS_OF)
    row = got.first()
    assert got.count() == 1
    assert (row.title, row.authors, row.paper_url) == ("On things", ["A", "B"], "http://x/abs/1")
    assert (row.github_url, row.updated_date, row.published_date) == ("https://github.com/a/b.", "", "2024-01-02T00:00:00Z")
    stars = table("full_name string, stargazers_count bigint", [("a/b.", 7)])
    assert values(papers.with_stars(got, stars), "github_stars") == [(7,)]
    by_id = papers.papers_by_id(payloads(table, PAPERS))
    assert values(by_id, "paper_url", "authors", "updated_date") == [("i1", "A, , B", None), ("i2", "", None)]
    results = table("keywords string, html_url string, stargazers_count bigint", [("No link", "h1", 1), ("No link", "h2", 5), ("No link", "h3", 5)])
    found = papers.searched_papers(by_id, results, AS_OF)
    assert values(found, "paper_url", "github_url", "github_stars") == [("i1", None, None), ("i2", "h2", 5)]
    assert found.drop(ORD).columns == schemas.columns(schemas.PAPERS_SEARCHED)


def test_newest_papers(table):
    rows = table("paper_url string, published_date string", [("a", "2024-01-01"), ("a", "2024-01-09"), ("b", "2024-01-03"), ("c", "2024-01-03"), ("", "2024-01-10")])
    assert [r.paper_url for r in papers.newest_papers(rows, 2).collect()] == ["b", "c"]


def test_json_list(spark):
    df = spark.createDataFrame([(['é"x', "b, c"],), ([],)], "authors array<string>")
    got = [r[0] for r in df.select(text.json_list(F.col("authors"))).collect()]
    assert got == [json.dumps(['é"x', "b, c"], ensure_ascii=False), "[]"]


def test_listed_papers(table):
    item = '<dt><a href="/abs/{0}" title="Abstract">x</a></dt><dd><div class="list-title mathjax"><span>Title:</span> T{0}</div><div class="list-authors"><a>A</a>, <a>B</a></div></dd>'
    page = "<dl id='other'>" + item.format(99) + "</dl><dl id='articles'>" + "".join(item.format(n) for n in range(7)) + "</dl>"
    got = papers.listed_papers(table("html string", [(page,), ("",)]))
    assert values(got, "paper_url", "title", "authors") == [(f"https://arxiv.org/abs/{n}", f"T{n}", ["A", "B"]) for n in range(5)]


def test_startups_from_pages(table):
    link = lambda href, name: f'<a class="c" href="{href}">{name}</a>'
    html = "".join([
        link("/companies/acme/?x=1", "<b>Acme</b>  Inc"), link("/companies/acme", "Acme<br>Two"), link("/companies/", "Companies"),
        link("/companies/jobs", "JOBS"), link("/other/x", "no"), link("/companies/e", " "), link("/companies?q=1", "q"),
    ])
    links = pages.company_links(table("html string", [(html,)]))
    assert links.count() == 6 - 1
    assert values(pages.startups(links, AS_OF), "source_url", "entityName") == [("https://www.ycombinator.com/companies/acme", "Acme Two")]
    plain = pages.startups_plain(links, AS_OF)
    assert values(plain, "source_url", "entityName") == [
        ("https://www.ycombinator.com/companies/acme", "Acme Two"), ("https://www.ycombinator.com/companies/acme/", "Acme Inc"),
        ("https://www.ycombinator.com/companies/jobs", "JOBS")]
    assert plain.drop(ORD).columns == schemas.columns(schemas.STARTUPS)


def test_products(table):
    rows = table("source_url string, entityName string", [("u1", "A"), ("u2", "B"), ("u3", "C")])
    site = table("url string, html string", [("u1", "<body>" + "x" * 1200 + " enterprise</body>"), ("u2", "<script>1</script>"), ("u3", "<p>free</p>")])
    got = pages.products(rows, site, AS_OF, n=2)
    flat = tables.flat_product(got)
    assert flat.columns == schemas.columns(schemas.PRODUCTS)
    row = flat.first()
    assert flat.count() == 1 and len(row.productDescription) == 1000 and row.pricingModel == "ENTERPRISE"


def test_models(table):
    raw = table("id string, downloads bigint, likes bigint, pipeline_tag string, library_name string",
                [(" a/b/c ", 1, None, "t", None), ("solo", None, 2, None, "l"), (" ", 1, 1, "", ""), ("a/d", 9, 1, "", "")])
    got = values(models.models(raw), "organization", "model_name", "source_url", "downloads", "pipeline_tag")
    assert got == [("", "solo", "https://huggingface.co/solo", 0, ""), ("a", "c", "https://huggingface.co/a/b/c", 1, "t"), ("a", "d", "https://huggingface.co/a/d", 9, "")]
    assert [r.id for r in models.most_downloaded(raw, 2).collect()] == ["a/d", " a/b/c "]


ODD = [(' lead "q", x', "a\nb\r\nc", None), ("", "ünï", "\ttab ")]


def test_csv_round_trip(spark, table, tmp_path):
    ddl = "a string, b string, c string, absent string"
    path = scratch_path(spark, "odd")
    tables.write_csv(table("a string, b string, c string", ODD), path, ddl)
    back = tables.read_csv(spark, path, ddl)
    assert values(back.na.fill(""), "a", "b", "c", "absent") == sorted((a, b, c or "", "") for a, b, c in ODD)
    with pytest.raises(AnalysisException):
        tables.read_csv(spark, path + "-none", ddl).count()
    assert tables.read_csv_or_empty(spark, path + "-none", ddl).columns == back.columns


def test_json_and_csv_sinks(spark, table):
    path = scratch_path(spark, "papers")
    rows = papers.papers(payloads(table, PAPERS), AS_OF)
    tables.write_json_and_csv(rows, path, schemas.PAPERS_CSV, tables.flat_paper)
    assert values(tables.read_json(spark, f"{path}/json", schemas.PAPERS), "authors") == [(["A", "B"],)]
    assert values(tables.read_csv(spark, f"{path}/csv", schemas.PAPERS_CSV), "authors") == [('["A", "B"]',)]
    wrote = []
    assert tables.write_if_any(rows, wrote.append) and not tables.write_if_any(rows.filter("false"), wrote.append)
    assert len(wrote) == 1


def test_conform_adds_columns(table):
    got = schemas.conform(table("b string", [("2",)]), "a string, b bigint")
    assert got.columns == ["a", "b"] and tuple(got.first()) == (None, 2)

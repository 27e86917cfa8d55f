from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from entitymart.functions import cards, dates, html, rules, text, urls

AS_OF = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "raw, key",
    [(None, ""), ("", ""), ("  ", ""), ("A.I.—Labs, Inc.", "a i labs inc"), ("漢字", ""), (" X9  y ", "x9 y")],
)
def test_match_key(one, raw, key):
    assert one(text.match_key, raw) == key


def test_python_white_space(one):
    assert one(text.strip, "\xa0\t a b  \x1f") == "a b"
    assert one(text.collapse, "\xa0a\x1c\x1d b　") == "a b"
    assert one(text.is_present, "\xa0\t") is False
    assert one(text.is_present, None) is False
    assert one(text.is_filled, " ") is True


def test_search_keywords(one):
    assert one(text.search_keywords, " a  b\nc d e f g") == "a b c d e f"
    assert one(text.search_keywords, "  ") == ""


def utc(*parts):
    return datetime(*parts)


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2024-01-02T03:04:05Z", utc(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05+02:30", utc(2024, 1, 2, 0, 34, 5)),
        ("2024-01-02T03:04:05+0230", utc(2024, 1, 2, 0, 34, 5)),
        (" 2024-01-02 03:04:05 ", utc(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05.250", utc(2024, 1, 2, 3, 4, 5, 250000)),
        ("2024-01-02T03:04:05,250", utc(2024, 1, 2, 3, 4, 5, 250000)),
        ("2024-01-02", utc(2024, 1, 2)),
        ("2024-01-02T03", utc(2024, 1, 2, 3)),
        ("20240102", utc(2024, 1, 2)),
        ("20240102T030405", utc(2024, 1, 2, 3, 4, 5)),
        ("2024", None),
        ("2024-13-01", None),
        ("Tue, 02 Jan 2024 03:04:05 +0000", utc(2024, 1, 2, 3, 4, 5)),
        ("Tue, 02 Jan 2024 03:04:05 GMT", utc(2024, 1, 2, 3, 4, 5)),
        ("2 Jan 2024 03:04 EST", utc(2024, 1, 2, 8, 4)),
        ("02 Jan 2024 03:04:05", utc(2024, 1, 2, 3, 4, 5)),
        ("posted 3 hrs ago", utc(2024, 1, 30, 9)),
        ("2 days ago, 5 minutes ago", utc(2024, 1, 30, 11, 55)),
        ("None", None),
        ("rubbish", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(one, raw, want):
    got = one(lambda c: dates.parse_date(c, dates.instant(AS_OF)), raw)
    assert got == want


def test_parse_date_ignores_session_zone(spark, one):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        fn = lambda c: F.unix_timestamp(dates.parse_date(c, dates.instant(AS_OF)))
        assert one(fn, "2024-01-02T03:04:05") == 1704164645
        assert one(fn, "Tue, 02 Jan 2024 03:04:05 GMT") == 1704164645
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "age, fresh",
    [
        (timedelta(0), True),
        (timedelta(seconds=86400), True),
        (timedelta(seconds=86400, microseconds=1), False),
        (timedelta(seconds=-1), False),
        (None, False),
    ],
)
def test_freshness_bounds(spark, age, fresh):
    ts = None if age is None else AS_OF - age
    df = spark.createDataFrame([(ts,)], "t timestamp")
    assert df.filter(dates.is_fresh(F.col("t"), AS_OF)).count() == int(fresh)


@pytest.mark.parametrize(
    "title, narrow, wide",
    [
        ("Data Engineer", "Data & AI", "Engineering"),
        ("Recruiter", "Design", "Design"),
        ("Machine Learning Developer", "Engineering", "Engineering"),
        ("Sales Lead", "Other", "Sales"),
        ("Head of AI Research", "Other", "Data & AI"),
        ("AI", "Other", "Other"),
        ("Accountant", "Other", "Other"),
    ],
)
def test_role_families(one, title, narrow, wide):
    assert one(rules.role_family, title) == narrow
    assert one(rules.role_family_wide, title) == wide


@pytest.mark.parametrize(
    "raw, label",
    [
        ("Free trial, enterprise", "FREEMIUM"), ("carefree", "FREE"), ("Enterprise pricing", "ENTERPRISE"),
        ("subscription", "PAID"), ("none", None), (None, None),
    ],
)
def test_pricing(one, raw, label):
    assert one(rules.pricing_model, raw) == label


def test_is_remote(one):
    fn = lambda c: rules.is_remote(F.lit("Dev"), c)
    assert one(fn, "Distributed team") is True
    assert one(fn, None) is False


@pytest.mark.parametrize(
    "raw, want",
    [
        ("<p>a <b>b</b>c</p>", "a b c"),
        ("x<!-- <p>no</p> -->y", "x y"),
        ("<script>var t='</p>';</script>t", "t"),
        ("a &amp;lt; b", "a &lt; b"),
        ("&eacute;&#8217;&#x1F600;&copy 1", "é’😀© 1"),
        ("AT&T & &foo; R&D", "AT&T & &foo; R&D"),
        ("1 < 2", "1 < 2"),
        (None, ""),
    ],
)
def test_fragment_text(one, raw, want):
    assert one(html.fragment_text, raw) == want


def test_article_text(one):
    page = "<header>h</header><nav>n</nav>{}<form>f</form><aside>s</aside><footer>z</footer>"
    assert one(html.article_text, page.format("<article>one</article><article>two</article>")) == "one"
    assert one(html.article_text, page.format("<p>a</p><div>x</div><p>b</p>")) == "a b"
    assert one(html.article_text, "<head><title>t</title></head><p>kept</p>") == "kept"
    # read twice as HTML: escaped markup disappears
    assert one(html.article_text, "<article>a &lt;b&gt;bold&lt;/b&gt;</article>") == "a bold"


def test_visible_text(one):
    assert one(html.visible_text, "<div>a<b>b</b></div><p>c</p><style>x</style>") == "ab c"


@pytest.mark.parametrize(
    "url, domain, official",
    [
        ("https://WWW.Example.com:8080/a", "example.com:8080", True),
        ("https://a.www.b.org/?x", "a.b.org", True),
        ("ftp://example.com", "example.com", False),
        ("https://google.com/", "google.com", False),
        ("https://sub.google.com/", "sub.google.com", False),
        ("https://notgoogle.com/", "notgoogle.com", True),
        ("example.com/x", "", False),
        ("", "", False),
        (None, "", False),
    ],
)
def test_domains(one, url, domain, official):
    assert one(urls.domain, url) == domain
    assert one(urls.is_official_site, url) is official


def test_logos(one):
    assert one(urls.favicon, "") == ""
    assert one(urls.favicon, "https://www.a.b/") == "https://www.google.com/s2/favicons?domain=a.b&sz=128"
    assert one(urls.avatar, "") == ""


def test_model_ids(one):
    assert one(lambda c: urls.model_id(F.lit(""), c), "m") == "m"
    assert one(lambda c: urls.model_id(F.lit("o"), c), "m") == "o/m"
    hub = "https://huggingface.co/"
    assert one(urls.model_id_from_url, f"{hub}o/{hub}m") == f"o/{hub}m"
    assert one(urls.model_id_from_url, "elsewhere/m") == "elsewhere/m"


@pytest.mark.parametrize(
    "raw, repo",
    [
        ("see https://github.com/a/b.", "a/b."), ("http://github.com/a/b?x=1", "a/b"),
        ("https://github.com/a/b#y", "a/b"), ("https://github.com/a/b/tree https://github.com/c/d", "a/b"),
        ("none", None), (None, None),
    ],
)
def test_repository(one, raw, repo):
    assert one(urls.repository_in_text, raw) == repo


def test_card_descriptions(one):
    card = "---\nlicense: mit\n---\n\n# T\n![i](x)\nfirst\n# skipped\nsecond\n\nthird"
    assert one(cards.card_description, card) == "first second"
    # the plain form keeps front-matter keys and ends at the first heading after text
    assert one(cards.card_description_plain, card) == "license: mit"
    assert one(cards.card_description_plain, "# T\n[![b](x)]\n a  b \n# end\nc") == "a b"
    assert one(cards.card_description, "# only\n\n![x]") == ""
    assert one(cards.card_description, None) == ""
    assert one(cards.card_description, "x" * 300 + "\n" + "y" * 300) == "x" * 300 + " " + "y" * 199


def test_fallbacks(one):
    assert one(lambda c: cards.fallback_description(c, F.lit("")), "m") == (
        "m is an AI model published by an AI model publisher and hosted on Hugging Face."
    )
    tagged = lambda c: cards.fallback_description_tagged(c, F.lit(""), F.lit("t"), F.lit(None))
    assert one(tagged, "m") == "m is an AI model. It is listed for the t task."


def test_prompt_does_not_fill_values_again(spark):
    df = spark.createDataFrame([("{organization}", "o", "t", None, " d ")],
                               "model_name string, organization string, pipeline_tag string, library_name string, description string")
    prompt = df.select(cards.prompt_with_source().alias("p")).first()["p"]
    assert "Model name: {organization}\nOrganization: o\n" in prompt
    assert "Library/framework: \n" in prompt and "description:\nd\n" in prompt


@pytest.mark.parametrize(
    "raw, want",
    [("it&apos;s", "it's"), ("don&#146;t", "don\u2019t"), ("a &hellip; b", "a \u2026 b"), ("x &NotEqualTilde; y", "x \u2242\u0338 y"),
     ("R&D and &unknown; stay", "R&D and &unknown; stay"), ("&amp;lt;", "&lt;"), ("&#x92;&#128;", "\u2019\u20ac"), ("&#39s", "'s"), ("&#99999999;", "&#99999999;")],
)
def test_character_references(one, raw, want):
    assert one(html.fragment_text, raw) == want


@pytest.mark.parametrize("raw", ["2147483647 days ago", "99999999 days ago", "99999999999 minutes ago", "20000000 hours ago"])
def test_huge_ages_are_no_dates(one, raw):
    from pyspark.sql import functions as F

    assert one(lambda c: dates.parse_date(c, F.lit("2024-01-30 00:00:00").cast("timestamp")), raw) is None


@pytest.mark.parametrize(
    "page, want",
    [
        # two and three levels of one element
        ("<article>a<article>b</article>c</article><p>d</p>", "a b c"),
        ("<article>a<article>b<article>c</article>d</article>e</article>f", "a b c d e"),
        ("<div><article><div>a</div><p>b</p></article></div><article>z</article>", "a b"),
        ("<nav>x<nav>y<nav>z</nav>y</nav>x</nav><p>kept</p>", "kept"),
        ("<header>h<div><nav>n</nav></div><header>i</header>j</header><p>kept</p>", "kept"),
        # an article inside what is dropped is none
        ("<aside><article>no</article></aside><article>yes</article>", "yes"),
        # an element without an end tag ends with its parent, an end tag alone ends nothing
        ("<div><nav>x</div><p>kept</p></nav>", "kept"),
        ("</article></nav><article>a</nav>b</article>c", "a b"),
        ("<article>open <b>to</b> the end", "open to the end"),
        ("<p>one</p></p><p>two</p>", "one two"),
        # a paragraph inside another is read with it and again by itself
        ("<body><p>one<p>two</p><p>three</p></body>", "one two three two three"),
        ("<div><p>one</div><p>two</p>", "one two"),
        # tags in scripts and comments, and names that only start alike
        ("<script>'</article><nav>'</script><article>a<!-- </article> -->b</article>", "a b"),
        ("<articles>no</articles><navy>x</navy><p>kept</p>", "kept"),
        ("<ARTICLE class=x>A<Article>B</ARTICLE>C</article>", "A B C"),
        ("<article/>x<p>y</p>", "y"),
        ("", ""),
        (None, ""),
    ],
)
def test_elements_nest(one, page, want):
    assert one(html.article_text, page) == want


def test_dropped_elements_nest_in_visible_text(one):
    assert one(html.visible_text, "<template>a<template>b</template>c</template><p>d<noscript>e<noscript>f</noscript>g</noscript></p>") == "d"
    assert one(html.visible_text, "<head><title>t</title></head><body><div>x<div>y</div>z</div>") == "x y z"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div id=a>1<div>2<div>3</div>4</div>5</div>6", "1<div>2<div>3</div>4</div>5"),
        ("<div id=a>1<divs></div>2", "1<divs>"),
        ("<div id=a>1<div>2", "1<div>2"),
        ("<div>1</div>", ""),
    ],
)
def test_content_of_an_element(one, page, want):
    assert one(lambda c: html.content(c, "<div id=a>", "div"), page) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        # as datetime.fromisoformat reads them
        ("2024-W05-2", "2024-01-30 00:00:00"), ("2024W052", "2024-01-30 00:00:00"), ("2024-W05", "2024-01-29 00:00:00"),
        ("2024W05", "2024-01-29 00:00:00"), ("2024-W05-2T03:04:05Z", "2024-01-30 03:04:05"), ("2024W052T030405+0100", "2024-01-30 02:04:05"),
        ("2020-W53-7", "2021-01-03 00:00:00"), ("2021-W01-1", "2021-01-04 00:00:00"), ("2026-W01-1", "2025-12-29 00:00:00"),
        ("2015-W53-4 10:00", "2015-12-31 10:00:00"),
        ("2024-W53-1", None), ("2024-W00-1", None), ("2024-W05-8", None), ("2024-W05-0", None), ("2024-W052", None), ("2024W05-2", None), ("2024-W5-2", None),
        # as email.utils.parsedate_to_datetime reads them
        ("Tue, 02 Jan 24 03:04:05 GMT", "2024-01-02 03:04:05"), ("02 Jan 68 03:04 +0100", "2068-01-02 02:04:00"),
        ("02 Jan 69 03:04:05", "1969-01-02 03:04:05"), ("2 Feb 99 00:00:00 EST", "1999-02-02 05:00:00"), ("Tue, 02 Jan 2024 03:04:05 GMT", "2024-01-02 03:04:05"),
        ("02 Jan 124 03:04:05", None),
    ],
)
def test_week_dates_and_short_years(one, raw, want):
    from pyspark.sql import functions as F

    at = F.lit("2024-01-30 00:00:00").cast("timestamp")
    assert one(lambda c: F.date_format(dates.parse_date(c, at), "yyyy-MM-dd HH:mm:ss"), raw) == want


@pytest.mark.parametrize(
    ("text", "iso"),
    [
        ("2024-01-02T03:04:05", "2024-01-02 03:04:05"), ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
        ("2024-01-02T03:04:05+05:30", "2024-01-01 21:34:05"), ("2024-01-02T03:04:05.25Z", "2024-01-02 03:04:05.25"),
        ("2024-02-30T03:04:05Z", None), ("2024-01-02T03:04:05+19:00", None), ("2024-01-02T25:04:05", None),
        ("Tue, 02  Jan 24 3:04 +0530 (IST)", "2024-01-01 21:34:00"), ("2 Jan 1969 03:04:05 EST", "1969-01-02 08:04:05"),
        ("Tue, 02 Jan 2024 03:04:05 XYZ", "2024-01-02 03:04:05"), ("Tue, 02 Jan 2024 03:04:05", "2024-01-02 03:04:05"),
        ("Tue, 02 Jan 2024 03:04:05 GMT | more", "2024-01-02 03:04:05"), ("02 Foo 2024 03:04:05 GMT", None),
    ],
)
def test_dates_in_their_usual_forms(one, text, iso):
    assert one(lambda c: dates.parse_date(c, F.lit("2024-01-30").cast("timestamp")).cast("string"), text) == iso


def test_a_mail_date_is_matched_once(spark):
    """One match to know it and one that finds all its parts."""
    plan = spark.createDataFrame([("x",)], "c string").select(dates.parse_mail(F.col("c")).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(\\d{4}|\\d{2})") <= 2

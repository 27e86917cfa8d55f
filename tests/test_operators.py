import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.operators import analytics, dedup, descriptions, entities, lookup, mentions, organizations, quality
from entitymart.operators.ordering import ORD, first_rows, with_position
from entitymart.plans import company, models as model_plan

AS_OF = datetime(2024, 1, 30, tzinfo=timezone.utc)


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("one_task_rows", [0, 1000])
def test_positions_follow_the_order(spark, one_task_rows):
    """Bucketed numbering equals one global numbering, whatever the gaps."""
    rng = random.Random(3)
    ords = sorted({rng.randrange(1 << e) for e in (10, 22, 30, 41, 50) for _ in range(40)})
    df = spark.createDataFrame([(o,) for o in ords], "_ord bigint").repartition(7)
    got = values(with_position(df, one_task_rows=one_task_rows), ORD, "position")
    assert got == [(o, i + 1) for i, o in enumerate(ords)]


def test_positions_of_file_order(spark, tmp_path):
    from entitymart.sources.tables import read_csv

    for part in range(3):
        (tmp_path / f"p{part}.csv").write_text("entityName\n" + "".join(f"n{part}{i}\n" for i in range(5)))
    df = read_csv(spark, str(tmp_path), "entityName string")
    got = values(with_position(df, one_task_rows=0), "position", "entityName")
    assert got == [(part * 5 + i + 1, f"n{part}{i}") for part in range(3) for i in range(5)]


@pytest.mark.parametrize("one_task_rows", [0, 1000])
def test_positions_of_links_in_pages_of_files(spark, one_task_rows):
    """The order of a link: its page's order, itself a struct, and its place in the page."""
    order = "struct<_page: struct<file: string, block: bigint, row: bigint>, _pos: int>"
    rows = [(((f"f{k % 3}", 10 * (k % 2), k), k % 5), k) for k in range(200)]
    df = spark.createDataFrame(rows, f"_ord {order}, k bigint").repartition(5)
    got = values(with_position(df, one_task_rows=one_task_rows), "position", "k")
    assert [k for _, k in got] == [k for _, k in sorted(rows)] and [p for p, _ in got] == list(range(1, 201))


def test_papers_with_author_lists_link_like_their_json_text(table):
    from pyspark.sql import functions as F

    names = mentions.searched_names(entities.canonical_entities(startups(table)))
    lists = table("title string, authors array<string>, source_url string, paper_url string",
                  [("On things", ["Acmeo Robotics"], "", "p0"), ("acmeo", [], "s1", "p1"), ("x", None, "s2", "")])
    flat = lists.withColumn("authors", F.to_json("authors"))
    got = [values(mentions.link_papers(p, names, AS_OF), "source_url", "entityId") for p in (lists, flat)]
    assert got[0] == got[1] == [("p0", "STARTUP-0003"), ("s1", "STARTUP-0001")]


def test_descriptions_survive_a_generator_that_stops(spark, table, tmp_path):
    from entitymart.plans import models as plan
    from entitymart.schemas import MODELS_ENRICHED, columns

    names = columns(MODELS_ENRICHED)
    rows = [tuple(f"{c}{k}" if c not in ("downloads", "likes") else k for c in names) for k in range(40)]
    models = table(MODELS_ENRICHED, rows)
    progress = table("source_url string, description string", [("source_url0", "known")])
    path = str(tmp_path / "progress")

    def broken(prompts):
        if any("model_name17" in p for p in prompts):
            raise RuntimeError("stopped")
        return ["text " + p[:5] for p in prompts]

    with pytest.raises(Exception, match="stopped"):
        plan.describe_in_chunks(models, progress, broken, path, chunks=8)
    kept = {r["source_url"] for r in plan.committed(spark, progress, path).collect()}
    assert 1 < len(kept) < 40
    again = plan.describe_in_chunks(models, progress, lambda prompts: ["again"] * len(prompts), path, chunks=8).collect()
    found = {r["source_url"]: r["description"] for r in again}
    assert len(found) == 40 and found["source_url0"] == "known" and found["source_url17"] == "again"
    assert all(found[u] != "again" for u in kept)


def startups(table):
    return table(
        "entityName string, source_url string",
        [("Acmeo", "u1"), ("  ", "u2"), ("Acmeo Robotics", "u3"), ("ACMEO!", "u4"), ("abcd", "u5"), ("abcde", "u6"),
         ("a b", "u7"), (None, "u8"), ("Same Len 1", "u9"), ("Same Len 2", "u10"), ("漢字", "u11")],
    )


def test_entities(table):
    rows = values(entities.canonical_entities(startups(table)), "entityId", "normalizedName")
    assert rows[:3] == [("STARTUP-0001", "acmeo"), ("STARTUP-0003", "acmeo robotics"), ("STARTUP-0004", "acmeo")]
    assert ("STARTUP-0011", "") in rows and len(rows) == 9


def test_entity_id_widens(spark):
    ids = spark.createDataFrame([(7,), (9999,), (12345,)], "p bigint").select(entities.entity_id(F.col("p")).alias("e"))
    assert [r.e for r in ids.collect()] == ["STARTUP-0007", "STARTUP-9999", "STARTUP-12345"]


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_exact_links(table, limit):
    """Same links when the names are broadcast and when they are salted."""
    names = entities.exact_names(entities.canonical_entities(startups(table)), limit)
    assert names.small == (limit > 0)
    products = table(
        "startupName string, source_url string",
        [("acmeo", "p1"), ("Acmeo, ", "p1"), ("", "p2"), (None, "p3"), ("nobody", "p4"), ("漢", "p5")]
        + [("Acmeo Robotics", f"q{i}") for i in range(200)],
    )
    got = values(entities.link_products(products, names, AS_OF), "entityId", "source_url")
    want = [("STARTUP-0004", "p1")] * 2 + [("STARTUP-0003", f"q{i}") for i in range(200)]
    assert got == sorted(want)
    unique = entities.link_products(products, names, AS_OF, unique=True)
    assert values(unique, "entityId", "source_url") == sorted(set(want))


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_mentions(table, limit):
    names = mentions.searched_names(entities.canonical_entities(startups(table)), limit)
    news = table(
        "title string, content string, source_url string",
        [
            ("Acmeo", "meets ACMEO-Robotics", "n0"),  # longest wins
            ("acmeoish", "abcdef", "n1"),  # no whole word
            ("abcd", "", "n2"),  # too short to be searched for
            ("x", "so abcde.", "n3"),
            ("see a", "b", "n4"),  # two words of any length, across the fields
            ("same len 2", "same len 1", "n5"),  # equal length: the earlier entity
            (None, None, "n6"),
            ("big acmeo", None, None),  # equal names: the first entity
        ],
    )
    got = values(mentions.link_news(news, names, AS_OF), "source_url", "entityId", "confidence")
    assert got == sorted([
        ("n0", "STARTUP-0003", 0.85), ("n3", "STARTUP-0006", 0.85), ("n4", "STARTUP-0007", 0.85),
        ("n5", "STARTUP-0009", 0.85), ("", "STARTUP-0001", 0.85),
    ])


@pytest.mark.parametrize("limit", [1 << 20, 1024, -1])  # names and starts fit a broadcast, only the starts, neither
def test_mentions_equal_search_by_pattern(table, limit):
    """Every name searched for in every text, one by one, on random word salad."""
    rng = random.Random(7)
    vocabulary = ["ab", "abc", "x1", "zen", "aster", "nova", "labs"]
    phrase = lambda lo, hi: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(lo, hi)))
    companies = [phrase(1, 4) for _ in range(40)]
    texts = [phrase(0, 12) for _ in range(300)]
    names = mentions.searched_names(entities.canonical_entities(table("entityName string, source_url string", [(n, "") for n in companies])), limit)
    assert (names.small, names.starts is not None) == (limit > 1024, limit > 0)
    hits = mentions.longest_mentions(table("text string", [(t,) for t in texts]), names)
    want = []
    ranked = sorted(enumerate(companies, 1), key=lambda e: -len(e[1]))
    for i, t in enumerate(texts):
        for place, name in ranked:
            if (" " in name or len(name) >= 5) and re.search(rf"\b{re.escape(name)}\b", t):
                want.append((i, f"STARTUP-{place:04d}"))
                break
    assert values(hits, ORD, "entityId") == sorted(want) and len(want) > 100


@pytest.mark.parametrize("limit", [1 << 20, -1])
@pytest.mark.parametrize("run", [8, 500])  # long names are looked for by their heads, or all runs are long
@pytest.mark.parametrize("bits", [1 << 20, 64])  # the bitmap tells starts apart, or lets nearly all through
def test_mentions_of_a_very_long_name(table, monkeypatch, limit, run, bits):
    monkeypatch.setattr(mentions, "RUN_WORDS", run)
    monkeypatch.setattr(mentions, "MOST_BITS", bits)
    long = " ".join(f"word{k}" for k in range(400))
    companies = [long, "word3 word4", " ".join(long.split()[5:14])]
    names = mentions.searched_names(entities.canonical_entities(table("entityName string, source_url string", [(n, "") for n in companies])), limit)
    assert len(names.marks) * 64 <= bits and any(names.heads) == (run == 8)
    texts = ["so " + long + " it is", long[:-1], " ".join(long.split()[:12]), " ".join(long.split()[4:30]), "word4 word3"]
    hits = mentions.longest_mentions(table("text string", [(t,) for t in texts]), names)
    assert values(hits, ORD, "entityId") == [(0, "STARTUP-0001"), (1, "STARTUP-0003"), (2, "STARTUP-0002"), (3, "STARTUP-0003")]


def test_papers_use_paper_url(table):
    names = mentions.searched_names(entities.canonical_entities(startups(table)))
    papers = table("title string, authors string, source_url string, paper_url string",
                   [("On things", '["Acmeo Robotics"]', "", "p0"), ("acmeo", "[]", "s1", "p1")])
    got = values(mentions.link_papers(papers, names, AS_OF), "source_url", "entityId")
    assert got == [("p0", "STARTUP-0003"), ("s1", "STARTUP-0001")]


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, how):
    """One key holds most rows; both ways of joining give the same rows."""
    facts = spark.range(2000).select(
        F.col("id").alias(ORD), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    names = spark.range(900).select(F.when(F.col("id") == 0, "hot").otherwise((F.col("id") * 2).cast("string")).alias("k"), F.col("id").alias("v"))
    joined = [lookup.lookup_join(facts, names, ["k"], [ORD], how=how, limit=limit) for limit in (1 << 20, -1)]
    a, b = [sorted(map(str, j.collect())) for j in joined]
    assert a == b and len(a) > 0
    sizes = joined[1].select(F.spark_partition_id().alias("p")).groupBy("p").count().collect() if how == "inner" else []
    assert all(r["count"] < 1200 for r in sizes)


ROWS = [("a", "x", 1), ("a", "x", 2), ("", "x", 3), (None, "x", 4), ("B", "y", 5), ("b", "y", 6)]


@pytest.mark.parametrize(
    "which, blank, want", [("first", "drop", [1, 5, 6]), ("last", "drop", [2, 5, 6]), ("last", "keep", [2, 4, 5, 6]), ("first", "keep", [1, 3, 5, 6])]
)
@pytest.mark.parametrize("shuffled", [False, True])
def test_keep_one(spark, which, blank, want, shuffled):
    rows = [(v, k, o) for o, (k, _, v) in enumerate(ROWS)]
    if shuffled:
        random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "v int, k string, _ord bigint").repartition(4)
    kept = dedup.keep_one(df, ["k"], which, blank)
    assert values(kept, "v") == [(w,) for w in want]
    assert values(dedup.keep_one(kept, ["k"], which, blank), "v") == [(w,) for w in want]


def test_jobs_and_models_ignore_case(table):
    jobs = table("source_url string, v int", [("http://A", 1), ("http://a", 2), ("", 3)])
    assert values(dedup.jobs_by_lower_url(jobs), "v") == [(1,)]
    assert values(dedup.by_source_url(jobs), "v") == [(1,), (2,)]
    models = table("organization string, model_name string, v int", [("", "M", 1), ("", "m", 2), ("O", "m", 3), ("o", "M", 4)])
    assert values(dedup.models(models), "v") == [(1,), (3,)]


def test_analytics(table):
    rows = table(
        "entityId string, entityName string, relationshipType string",
        [(" E1", "old", "HAS_PRODUCT"), ("E1", "mid", "HAS_JOB"), ("E1 ", " ", "HAS_JOB"), ("", "no", "HAS_JOB"),
         (None, "no", "HAS_JOB"), ("E2", "two", "HAS_OTHER"), ("E3", "n", "MENTIONED_IN_NEWS")],
    )
    got = values(analytics.entity_analytics(rows), "entityId", "entityName", *analytics.COUNTS, "totalRelationships")
    assert got == [("E1", "", 1, 2, 0, 0, 3), ("E2", "two", 0, 0, 0, 0, 0), ("E3", "n", 0, 0, 0, 1, 1)]
    counts = [tuple(r) for r in analytics.relationship_counts(rows).collect()]
    assert counts == [("HAS_JOB", 4), ("HAS_OTHER", 1), ("HAS_PRODUCT", 1), ("MENTIONED_IN_NEWS", 1)]


def test_quality(table):
    rule = quality.Rule("T", ("name", "gone"), "name")
    df = table("name string", [("A",), (" a\xa0",), ("\xa0",), (None,), ("b",)])
    assert tuple(quality.dataset_report(df, rule).first()) == ("T", 5, 7, 1, "CHECK", "CHECK")
    empty = quality.dataset_report(df.filter("false"), rule).first()
    assert tuple(empty) == ("T", 0, None, None, None, None)
    clean = quality.dataset_report(df.filter("name in ('A', 'b')"), quality.Rule("T", ("name",), "name")).first()
    assert tuple(clean) == ("T", 2, 0, 0, "PASS", "PASS")


@pytest.mark.parametrize(
    "raw, invalid",
    [("0.5", False), (" 1 ", False), ("1.5", True), ("-0.1", True), ("abc", True), ("", True), (None, True), ("NaN", False),
     ("-nan", False), ("inf", True), ("-Infinity", True), ("0.2_5", False), ("1_0", True), ("0.5d", True), ("0x1p-3", True), ("1e-3", False),
     (".5", False), ("1.", False), ("_1", True), ("-0", False)],
)
def test_confidence_reads_as_python_floats(one, raw, invalid):
    assert one(quality.is_invalid_confidence, raw) is invalid
    if raw is not None:
        try:
            assert invalid == (float(raw) < 0 or float(raw) > 1)
        except ValueError:
            assert invalid


def test_relationship_report(table):
    rows = table("relationshipType string, confidence string", [("HAS_JOB", "1"), ("", "2")])
    assert tuple(quality.relationship_report(rows).first()) == (2, 1, "CHECK")
    assert tuple(quality.relationship_report(rows.filter("false")).first()) == (0, None, None)


def test_organization_sources(table):
    hub = "https://huggingface.co/"
    rows = table(
        "organization string, source_url string",
        [("google", hub + "g/m"), ("Meta AI", "x"), ("meta", "later"), (" lab ", "see " + hub + "x"), ("none", "http://e"), (" ", hub)],
    )
    found = {r.organization: r for r in organizations.organization_sources(organizations.organizations(rows)).collect()}
    # a known site on a blocked domain is not verified
    assert (found["google"].verification_status, found["google"].official_website) == (fixed.PRIMARY, hub + "g/m")
    assert (found["Meta AI"].verification_status, found["Meta AI"].official_website) == (fixed.VERIFIED, "https://about.meta.com/")
    assert found["lab"].logo_url == fixed.HUB_LOGO
    assert tuple(found["none"])[2:] == ("", "", fixed.UNVERIFIED, "")
    assert "meta" not in found and len(found) == 4


def test_organization_counts_keep_first_spelling(table):
    rows = table("organization string", [("b",), ("A  x",), ("a X",), (" ",), ("c",), ("B",)])
    got = [tuple(r)[:2] for r in organizations.organization_counts(rows).collect()]
    assert got == [("b", 2), ("A x", 2), ("c", 1)]
    assert [tuple(r) for r in organizations.top_organizations(rows, 2).collect()] == [("b", 1), ("A  x", 1)]
    assert organizations.distinct_organizations(rows).first()[0] == 5


MODEL = "model_name string, organization string, source_url string, official_website string, logo_url string, description string, downloads bigint, likes bigint, pipeline_tag string, library_name string"


def model(name, url):
    return (name, "o", url, "", "", "", 0, 0, "", "")


def test_description_run(spark, table):
    """As one loop over the models would do it, including repeated urls."""
    rows = [model("done", "u1"), model("ok", "u2"), model("bad", "u3"), model("bad", "u4"), model("ok", "u4"), model("bad", "u4"), model("ok", " u2 ")]
    progress = table("source_url string, description string", [("u1", "old"), ("u1", " new "), ("u3", "  "), ("", "x"), ("stale", "s")])

    def generator(prompts):
        return ["" if "Model name: bad\n" in p else " made " for p in prompts]

    out = model_plan.describe(table(MODEL, rows), progress, generator)
    assert values(out.progress, "source_url", "description") == [("stale", "s"), ("u1", "new"), ("u2", "made"), ("u4", "made")]
    assert values(out.failed, ORD, "source_url") == [(2, "u3"), (3, "u4")]
    assert tuple(out.summary.first()) == (7, 4, 3, False)
    assert values(out.final, ORD, "description") == [(0, "new"), (1, "made"), (2, ""), (3, "made"), (4, "made"), (5, "made"), (6, "made")]


def test_run(table):
    inputs = company.Inputs(
        startups=startups(table),
        products=table("productName string, startupName string, source_url string", [("p", "Acmeo", "p1"), ("p", "acmeo", "p1")]),
        papers=table("title string, authors string, source_url string, paper_url string", [("acmeo", "[]", "s", "p")]),
        news=table("title string, content string, source_url string", [("a b", "", "n")]),
        jobs=table("company string, title string, source_url string", [("ABCDE", "t", "j")]),
    )
    out = company.run(inputs, AS_OF)
    assert out.mapped.count() == 5 and out.relationships.count() == 4
    assert values(out.relationship_counts, "count") == [(1,)] * 4
    assert values(out.analytics, "entityId", "totalRelationships") == [
        ("STARTUP-0001", 1), ("STARTUP-0004", 1), ("STARTUP-0006", 1), ("STARTUP-0007", 1)]
    assert out.relationship_quality.first()["confidence_status"] == "PASS"
    assert {r.dataset: r.duplicates for r in out.quality.collect()}["PRODUCTS"] == 1


def test_run_with_intake_and_csv(spark, table):
    import json

    from entitymart import schemas
    from entitymart.session import scratch_path
    from entitymart.sources.tables import read_csv

    inputs = company.Inputs(
        startups=startups(table),
        products=table("productName string, startupName string, source_url string", [("p", "Acmeo", "p1")]),
        papers=table("title string, authors string, source_url string, paper_url string", [("x", "[]", "s", "p")]),
        news=table("title string, content string, source_url string", [("y", "", "n")]),
        jobs=table("company string, title string, source_url string", [("ABCDE", "t", "stale")]),
    )
    job = lambda url, name: {"position": "Dev", "company": name, "url": url, "date": "2024-01-30"}
    board_1 = table("payload string", [(json.dumps([job("http://j", "abcde"), job("http://k", "a b")]),)])
    board_2 = table("payload string", [('{"jobs": []}',)])
    out = company.run_with_intake(board_1, board_2, inputs, AS_OF)
    path = scratch_path(spark, "out")
    company.write(out, path)
    links = read_csv(spark, f"{path}/entity_relationships", schemas.RELATIONSHIPS)
    assert values(links, "relationshipType", "source_url") == [("HAS_JOB", "http://j"), ("HAS_JOB", "http://k"), ("HAS_PRODUCT", "p1")]
    assert values(links, "mappedAt", "confidence")[0] == ("2024-01-30T00:00:00.000000+00:00", "1.0")
    counts = read_csv(spark, f"{path}/entity_analytics", schemas.ANALYTICS)
    assert values(counts, "entityId", "jobCount") == [("STARTUP-0004", "0"), ("STARTUP-0006", "1"), ("STARTUP-0007", "1")]


def test_final_models_wait_for_all(spark, table):
    from entitymart.session import scratch_path

    rows = table(MODEL, [model("a", "u1"), model("b", "u2")])
    some, all_ = (descriptions.finished(table("source_url string, description string", p)) for p in ([("u1", "x")], [("u1", "x"), ("u2", "y")]))
    path = scratch_path(spark, "final")
    assert not model_plan.write_final(rows, some, path)
    assert model_plan.write_final(rows, some, path, always=True)
    assert model_plan.write_final(rows, all_, path)


def test_observed_rows(table):
    df, seen = analytics.observed(startups(table), "startups")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 11


def test_first_rows(table):
    assert values(first_rows(startups(table), 2), "source_url") == [("u1",), ("u2",)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_latest_does_not_depend_on_arrival_or_restarts(spark, tmp_path, seed):
    """Files in any order, the query stopped and started again in between, a batch run twice."""
    from entitymart.streaming import intake

    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "b", "c", "d", "hot", "hot", "hot", "", None]), f"v{k}") for k in range(90)]
    rng.shuffle(rows)
    where, table, state = (str(tmp_path / x) for x in ("in", "table", "state"))
    schema = f"{ORD} bigint, source_url string, value string"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(where)
    for part in (rows[:40], rows[40:60], rows[60:]):
        for at in range(0, len(part), 10):
            spark.createDataFrame(part[at : at + 10], schema).coalesce(1).write.mode("append").parquet(where)
        intake.keep_latest(stream, table, state).awaitTermination()
    last = {}
    for k, url, value in sorted(rows):
        if url:
            last[url] = (url, k, value)
    assert values(intake.latest(spark, table), "source_url", ORD, "value") == sorted(last.values())
    # the last batch once more, as after a failure before its commit
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink(missing_ok=True)
    intake.keep_latest(stream, table, state).awaitTermination()
    assert values(intake.latest(spark, table), "source_url", ORD, "value") == sorted(last.values())


def test_news_stream_equals_batch(spark, table, tmp_path):
    from datetime import datetime, timezone

    from entitymart.sources import feeds
    from entitymart.streaming import intake

    at = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)
    item = "<item><title>{0}</title><link>{1}</link><description>{0} text</description><pubDate>{2}</pubDate></item>"
    rows = [[(f"t{f}{k}", f"u{(f + k) % 5}", "2 hours ago" if k else "3 days ago") for k in range(4)] for f in range(6)]
    landed = table("payload string, source_name string", [("<rss><channel>" + "".join(item.format(*r) for r in rs) + "</channel></rss>", f"f{n}") for n, rs in enumerate(rows)])
    landed.repartition(4).write.parquet(str(tmp_path / "in"))
    articles = spark.createDataFrame([("u1", "page"), ("u2", " ")], "url string, article string")
    stream = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    intake.keep_latest(intake.fresh_news(stream, at, articles), str(tmp_path / "t"), str(tmp_path / "s")).awaitTermination()
    batch = feeds.unique_news(feeds.records(feeds.fresh_items(feeds.feed_items(landed, at), at).join(articles, "url", "left"), at))
    names = ["source_url", "title", "content", "publishedAt"]
    got = values(intake.latest(spark, str(tmp_path / "t")), *names)
    assert got == values(batch, *names) and len(got) == 5 and ("u1", "page") in [(r[0], r[2]) for r in got]


def test_words_are_searched_without_lambdas(table):
    """A word costs a row of generated code, not calls of an interpreted function."""
    companies = table("entityName string, source_url string", [("Acme Labs", ""), ("Zeta", ""), ("Größe Labs Inc", "")])
    names = mentions.searched_names(entities.canonical_entities(companies))
    texts = ["--acme LABS--", "acme", None, "", "?!", "the gr e labs inc, acme labs", "acme  labs\n", "acmelabs acme lab", "KELVIN acme\tlabs"]
    hits = mentions.longest_mentions(table("text string", [(t,) for t in texts]), names)
    assert sorted((r["_ord"], r["entityName"]) for r in hits.collect()) == [(0, "Acme Labs"), (5, "Größe Labs Inc"), (6, "Acme Labs"), (8, "Acme Labs")]
    assert "lambda" not in hits._jdf.queryExecution().optimizedPlan().toString()


def test_counts_strip_each_spelling_once(table):
    """Names are stripped after the rows are counted; spellings of one name are one entity."""
    rows = [(" E1", "A ", "HAS_JOB"), ("E1", "A", " HAS_JOB "), ("E1", "A", "HAS_PRODUCT"), (None, "B", "HAS_JOB"), ("E2", None, "OTHER"), ("E1", "A", None)]
    counts = analytics.linked_analytics(table("entityId string, entityName string, relationshipType string", rows).drop(ORD))
    assert values(counts, "entityId", "entityName", "jobCount", "productCount", "totalRelationships") == [("E1", "A", 2, 1, 3), ("E2", "", 0, 0, 0)]
    plan = counts._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum("Aggregate [" in line for line in plan) == 2

"""Models, organisations and description runs."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from entitymart import fixed
from entitymart.functions import cards, urls
from entitymart.operators import dedup, descriptions, models, organizations
from entitymart.operators.ordering import ORD
from entitymart.plans import models as model_plan
from entitymart.session import scratch_path
from entitymart.sources import models as landed
from workload.registry import query
from workload.sqlkit import collapse, domain, org_key, q, sql, strip

MODEL = ["model_name", "organization", "source_url", "downloads", "likes", "pipeline_tag", "library_name"]
COLS = ", ".join(MODEL)


def hub_models(i):
    return landed.models(i.raw_models)


@query("prj9_models", sql(f"SELECT {COLS} FROM hub_models"))
def prj9(i):
    return hub_models(i).drop(ORD)


@query("src5_models_json", sql("SELECT trim(id) AS id, downloads, likes, pipeline_tag, library_name FROM (SELECT *, regexp_replace(source_url, '^https://huggingface.co/+', '') AS id FROM models)"))
def src5(i):
    path = scratch_path(i.spark, "models")
    i.raw_models.drop(ORD).write.json(path)
    return landed.read_models(i.spark, path).drop(ORD).withColumn("id", F.trim("id"))


@query("top4_most_downloaded", sql("SELECT _ord AS id, downloads FROM models ORDER BY downloads DESC, _ord LIMIT 700"))
def top4(i):
    return landed.most_downloaded(i.raw_models, 700).select(F.col(ORD).alias("id"), "downloads")


FIRST_MODEL = (
    f"SELECT _ord, {COLS} FROM hub_models "
    "QUALIFY row_number() OVER (PARTITION BY lower(organization), lower(model_name) ORDER BY _ord) = 1"
)


@query("dd6_first_model", sql(f"SELECT {COLS} FROM ({FIRST_MODEL})"))
def dd6(i):
    return dedup.models(hub_models(i)).drop(ORD)


CLEAN = (
    f"SELECT _ord, {collapse('model_name')} AS model_name, organization, source_url, downloads, likes, pipeline_tag, "
    "library_name FROM models"
)


@query("prj10_cleaned_models", sql(f"SELECT {COLS} FROM ({CLEAN})"))
def prj10(i):
    rough = i.models.withColumn("model_name", F.concat(F.lit("\t "), F.replace("model_name", F.lit(" "), F.lit("  \n"))))
    return landed.cleaned_models(rough).drop(ORD)


# cards

def lines_sql(text: str) -> str:
    return f"list_transform(string_split_regex({text}, '\\r\\n|[\\n\\r\\x0b\\x0c]'), lambda x: {strip('x')})"


def paragraph_sql(lines: str, skip: str, end: str) -> str:
    """First paragraph of a list of lines."""
    keeps = f"(x <> '' AND NOT ({skip}))"
    start = f"list_position(list_transform(l, lambda x: {keeps}), true)"
    stop = f"list_position(list_transform(t, lambda x: {end}), true)"
    return (
        f"(SELECT substr(trim(array_to_string(list_filter(CASE WHEN {stop} > 0 THEN t[1:{stop} - 1] ELSE t END, "
        f"lambda x: {keeps}), ' ')), 1, 500) FROM (SELECT CASE WHEN {start} > 0 THEN l[{start}:] ELSE [] END AS t "
        f"FROM (SELECT {lines} AS l)))"
    )


BODY = (
    "CASE WHEN starts_with(readme, '---') THEN "
    f"{strip('regexp_extract(readme, ' + q('(?s)^---.*?---(.*)$') + ', 1)')} ELSE {strip('readme')} END"
)
CARD_A = paragraph_sql(lines_sql(BODY), "starts_with(x, '#') OR starts_with(x, '![')", "x = ''")
CARD_B = paragraph_sql(
    lines_sql("readme"),
    "starts_with(x, '---') OR starts_with(x, '#') OR starts_with(x, '[![')",
    "x = '' OR starts_with(x, '#')",
)


@query("fn10_card_description", sql(f"SELECT _ord AS id, {CARD_A} AS description FROM all_cards"))
def fn10(i):
    return i.all_cards.select(F.col(ORD).alias("id"), cards.card_description(F.col("readme")).alias("description"))


@query("fn11_card_description_plain", sql(f"SELECT _ord AS id, {CARD_B} AS description FROM all_cards"))
def fn11(i):
    return i.all_cards.select(F.col(ORD).alias("id"), cards.card_description_plain(F.col("readme")).alias("description"))


PUBLISHER = "CASE WHEN organization = '' THEN 'an AI model publisher' ELSE organization END"
FALLBACK_A = f"model_name || ' is an AI model published by ' || {PUBLISHER} || ' and hosted on Hugging Face.'"
FALLBACK_B = (
    "model_name || ' is an AI model' || CASE WHEN organization <> '' THEN ' published by ' || organization ELSE '' END || '.' "
    "|| CASE WHEN pipeline_tag <> '' THEN ' It is listed for the ' || pipeline_tag || ' task.' ELSE '' END "
    "|| CASE WHEN library_name <> '' THEN ' It is available through the ' || library_name || ' library.' ELSE '' END"
)


@query("fn12_fallback_description", sql(f"SELECT _ord AS id, {FALLBACK_A} AS description FROM models"))
def fn12(i):
    text = cards.fallback_description(F.col("model_name"), F.col("organization"))
    return i.models.select(F.col(ORD).alias("id"), text.alias("description"))


@query("fn13_fallback_tagged", sql(f"SELECT _ord AS id, {FALLBACK_B} AS description FROM models"))
def fn13(i):
    text = cards.fallback_description_tagged(*[F.col(c) for c in ("model_name", "organization", "pipeline_tag", "library_name")])
    return i.models.select(F.col(ORD).alias("id"), text.alias("description"))


AVATAR = "CASE WHEN organization = '' THEN '' ELSE 'https://huggingface.co/api/organizations/' || organization || '/avatar' END"
ENRICHED_A = (
    f"SELECT m._ord, model_name, organization, source_url, source_url AS official_website, {AVATAR} AS logo_url, "
    f"coalesce(nullif(c.d, ''), {FALLBACK_A}) AS description, coalesce(c.d, '') <> '' AS from_card, downloads, likes, "
    "pipeline_tag, library_name FROM card_models m LEFT JOIN "
    f"(SELECT model_id, {CARD_A} AS d FROM cards) c ON replace(m.source_url, 'https://huggingface.co/', '') = c.model_id"
)
ENRICHED_B = ENRICHED_A.replace(CARD_A, CARD_B).replace(FALLBACK_A, FALLBACK_B).replace(AVATAR, "''").replace(
    "source_url AS official_website", "'' AS official_website"
)


@query("prj15_enriched_models", sql(f"SELECT * EXCLUDE (_ord) FROM ({ENRICHED_A})"))
def prj15(i):
    return models.enriched_models(i.card_models, i.cards).drop(ORD)


@query("jn9_card_descriptions", sql(f"SELECT * EXCLUDE (_ord) FROM ({ENRICHED_B})"))
def jn9(i):
    return models.enriched_models_plain(landed.cleaned_models(i.card_models), i.cards).drop(ORD)


@query(
    "ag7_description_coverage",
    sql(
        "SELECT count(*) AS models, count(*) FILTER (trim(description) <> '') AS present, "
        "count(*) FILTER (trim(description) = '') AS missing, count(*) FILTER (from_card) AS from_card, "
        f"count(*) FILTER (NOT from_card) AS fallback FROM ({ENRICHED_B})"
    ),
)
def ag7(i):
    return models.description_coverage(models.enriched_models_plain(landed.cleaned_models(i.card_models), i.cards))


@query(
    "fn20_model_ids",
    sql(
        "SELECT _ord AS id, CASE WHEN organization = '' THEN model_name ELSE organization || '/' || model_name END AS made, "
        "replace(source_url, 'https://huggingface.co/', '') AS cut FROM card_models"
    ),
)
def fn20(i):
    return i.card_models.select(
        F.col(ORD).alias("id"),
        urls.model_id(F.col("organization"), F.col("model_name")).alias("made"),
        urls.model_id_from_url(F.col("source_url")).alias("cut"),
    )


# organisations

@query(
    "ag3_organization_counts",
    sql(
        "SELECT arg_min(organization, _ord) AS organization, count(*) AS model_count, '' AS official_website, '' AS logo_url "
        "FROM models WHERE organization <> '' GROUP BY lower(organization)"
    ),
)
def ag3(i):
    return organizations.organization_counts(i.models)


@query(
    "srt2_organization_order",
    sql(
        "SELECT organization, row_number() OVER (ORDER BY model_count DESC, seen) AS place FROM "
        "(SELECT arg_min(organization, _ord) AS organization, count(*) AS model_count, min(_ord) AS seen "
        "FROM models WHERE organization <> '' GROUP BY lower(organization))"
    ),
)
def srt2(i):
    """The place is read off the sorted result, whose parts follow one another."""
    from entitymart.operators.ordering import with_position

    ordered = organizations.organization_counts(i.models)
    placed = ordered.select("organization", F.monotonically_increasing_id().alias(ORD))
    return with_position(placed, "place").drop(ORD)


@query("ag4_exact_organization_counts", sql("SELECT organization, count(*) AS model_count FROM models WHERE organization <> '' GROUP BY 1"))
def ag4(i):
    return organizations.exact_organization_counts(i.models).drop("seen")


@query("ag5_distinct_organizations", sql("SELECT count(DISTINCT organization) AS organizations FROM models WHERE organization <> ''"))
def ag5(i):
    return organizations.distinct_organizations(i.models)


@query(
    "top1_top_organizations",
    sql(
        "SELECT organization, count(*) AS model_count FROM models WHERE organization <> '' GROUP BY 1 "
        "ORDER BY count(*) DESC, min(_ord) LIMIT 30"
    ),
)
def top1(i):
    return organizations.top_organizations(i.models)


@query("fn18_organization_key", sql(f"SELECT _ord AS id, {org_key('organization')} AS key FROM organization_models"))
def fn18(i):
    return i.organization_models.select(F.col(ORD).alias("id"), urls.organization_key(F.col("organization")).alias("key"))


@query(
    "fn19_logo_urls",
    sql(
        f"SELECT _ord AS id, 'https://huggingface.co/api/organizations/' || organization || '/avatar' AS avatar, "
        f"'https://www.google.com/s2/favicons?domain=' || {domain('source_url')} || '&sz=128' AS favicon "
        "FROM organization_models"
    ),
)
def fn19(i):
    return i.organization_models.select(
        F.col(ORD).alias("id"),
        urls.avatar(F.col("organization")).alias("avatar"),
        urls.favicon(F.col("source_url")).alias("favicon"),
    )


@query("dd7_first_per_organization", sql("SELECT organization, model_url, key FROM organizations"))
def dd7(i):
    return organizations.organizations(i.organization_models).drop(ORD)


@query("prj11_organization_records", sql("SELECT organization, model_url FROM organizations"))
def prj11(i):
    return organizations.organizations(i.organization_models).select("organization", "model_url")


def sources(i):
    return organizations.organization_sources(organizations.organizations(i.organization_models))


@query("org1_organization_sources", sql("SELECT * FROM organization_sources"))
def org1(i):
    return sources(i).drop(ORD)


@query("jn6_known_sites", sql("SELECT organization, official_website FROM organization_sources WHERE verification_status = 'verified_official'"))
def jn6(i):
    found = sources(i).filter(F.col("verification_status") == fixed.VERIFIED)
    return found.select("organization", "official_website")


@query("prj18_organization_source_records", sql("SELECT organization, official_website, logo_url, verification_status, source_type FROM organization_sources"))
def prj18(i):
    return model_plan.organization_sources(i.organization_models).drop(ORD)


@query(
    "ag6_verification_counts",
    sql(
        "SELECT count(*) AS organizations, count(*) FILTER (verification_status = 'verified_official') AS verified, "
        "count(*) FILTER (verification_status = 'primary_model_source') AS \"primary\", "
        "count(*) FILTER (verification_status = 'unverified') AS unverified FROM organization_sources"
    ),
)
def ag6(i):
    return organizations.verification_counts(sources(i))


# descriptions

PENDING = "SELECT * FROM models m WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.source_url = m.source_url)"


def done(i):
    return descriptions.finished(i.progress)


@query("dd9_finished", sql("SELECT source_url, description FROM done"))
def dd9(i):
    return done(i).drop(ORD)


@query("jn4_pending", sql(f"SELECT _ord AS id, model_name, source_url FROM ({PENDING})"))
def jn4(i):
    return descriptions.pending(i.enriched, done(i)).select(F.col(ORD).alias("id"), "model_name", "source_url")


FINAL = (
    "SELECT m.model_name, m.organization, m.source_url, m.source_url AS official_website, '' AS logo_url, "
    "coalesce(d.description, '') AS description, m.downloads, m.likes, m.pipeline_tag, m.library_name "
    "FROM models m LEFT JOIN done d ON m.source_url = d.source_url"
)


@query("jn5_described_models", sql(f"SELECT source_url, description, model_name FROM ({FINAL})"))
def jn5(i):
    return descriptions.final_models(i.enriched, done(i)).select("source_url", "description", "model_name")


@query("prj12_final_models", sql(FINAL))
def prj12(i):
    return descriptions.final_models(i.enriched, done(i)).drop(ORD)


def prompt_sql(template: str) -> str:
    out = q(template)
    for name in ("model_name", "organization", "pipeline_tag", "library_name"):
        out = f"replace({out}, '{{{name}}}', {name})"
    return f"replace({out}, '{{description}}', 'about ' || model_name)"


@query("fn22_prompts", sql(f"SELECT _ord AS id, {prompt_sql(fixed.PROMPT_LONG)} AS long, {prompt_sql(fixed.PROMPT_SHORT)} AS short FROM models"))
def fn22(i):
    return i.enriched.select(
        F.col(ORD).alias("id"), cards.prompt_with_source().alias("long"), cards.prompt_from_metadata().alias("short")
    )


@query("en1_work_list", sql(f"SELECT _ord AS id, {prompt_sql(fixed.PROMPT_LONG)} AS prompt FROM ({PENDING})"))
def en1(i):
    work = descriptions.with_prompt(descriptions.pending(i.enriched, done(i)), cards.prompt_with_source())
    return work.select(F.col(ORD).alias("id"), "prompt")


def stand_in(prompts):
    """A generator without a model: a digest of the prompt, nothing for some prompts."""
    for p in prompts:
        digest = hashlib.md5(p.encode()).hexdigest()
        yield "" if digest[0] in "01234567" else f" made {digest} "


MADE = f"md5({prompt_sql(fixed.PROMPT_LONG)})"
RESULTS = (
    f"SELECT *, CASE WHEN substr(m, 1, 1) IN ('0','1','2','3','4','5','6','7') THEN '' ELSE 'made ' || m END AS generated "
    f"FROM (SELECT *, {MADE} AS m FROM ({PENDING}))"
)
NEW = (
    f"SELECT _ord, source_url, generated AS description FROM ({RESULTS}) WHERE generated <> '' "
    "QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY _ord) = 1"
)
MERGED = f"SELECT source_url, description FROM done UNION ALL SELECT source_url, description FROM ({NEW})"


def results(i):
    work = descriptions.with_prompt(descriptions.pending(i.enriched, done(i)), cards.prompt_with_source())
    return descriptions.generate(work, stand_in)


@query("en2_generated", sql(f"SELECT _ord AS id, source_url, generated FROM ({RESULTS})"))
def en2(i):
    return results(i).select(F.col(ORD).alias("id"), "source_url", "generated")


def described(i):
    return model_plan.describe(i.enriched, i.progress, stand_in)


@query("en3_merged_progress", sql(MERGED))
def en3(i):
    return described(i).progress


@query(
    "en4_failed",
    sql(
        f"SELECT r._ord AS id, r.model_name, r.source_url FROM ({RESULTS}) r LEFT JOIN ({NEW}) n ON r.source_url = n.source_url "
        "WHERE r.generated = '' AND (n._ord IS NULL OR r._ord < n._ord)"
    ),
)
def en4(i):
    return described(i).failed.select(F.col(ORD).alias("id"), "model_name", "source_url")


SUMMARY = "SELECT total, done, total - done AS remaining, total = done AS complete FROM (SELECT (SELECT count(*) FROM models) AS total, (SELECT count(*) FROM ({})) AS done)"


@query("en5_completion_gate", sql(SUMMARY.format(MERGED)))
def en5(i):
    return described(i).summary


@query("en6_progress_summary", sql(SUMMARY.format("SELECT * FROM done")))
def en6(i):
    return descriptions.progress_summary(i.enriched, done(i))

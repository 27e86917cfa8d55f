"""SQL of the derived inputs and of shared expressions, for the oracle."""

from __future__ import annotations

import re

from entitymart import fixed
from entitymart.functions import html as html_fn
from workload.inputs import AGAIN, CONFIDENCES, NAMELESS, ORGANIZATIONS, PASSAGES, TITLES, _KINDS

JOBS_AS_OF = "TIMESTAMP '1998-10-03 00:00:00'"
NEWS_AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def strs(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def key(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^{SPACES}+|{SPACES}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{SPACES}+', ' ', 'g'))"


def nth(values, n: str) -> str:
    return f"list_extract({strs(values)}, CAST(({n}) % {len(values)} + 1 AS INTEGER))"


def pad(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 9, '0')"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def drop_all(x: str, patterns: list[str], by: str = " ") -> str:
    """Leftmost match of any pattern replaced, as one alternation."""
    return f"regexp_replace({x}, {q('(?is)' + '|'.join(patterns))}, {q(by)}, 'g')"


def decode(x: str) -> str:
    """Character references of the test pages; HTML lets the semicolon be left out."""
    for name, raw in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("copy", "\u00a9"),
                      ("middot", "\u00b7"), ("nbsp", "\u00a0"), ("amp", "&")):
        x = f"regexp_replace({x}, {q('&' + name + chr(92) + 'b;?')}, {q(raw)}, 'g')"
    return x


def fragment(x: str) -> str:
    """HTML fragment to text."""
    blocks = [html_fn.COMMENT, *[html_fn.element(n) for n in html_fn.NOT_TEXT]]
    return collapse(decode(drop_all(drop_all(f"coalesce({x}, '')", blocks), ["<[/!?a-zA-Z][^>]*>"])))


def visible(x: str) -> str:
    blocks = [html_fn.COMMENT, *[html_fn.element(n) for n in (*html_fn.NOT_TEXT, "noscript", "head", "title")]]
    part = [rf"</?(?:{'|'.join(html_fn.BLOCKS)})(?:\s[^>]*)?/?>"]
    bare = drop_all(drop_all(f"coalesce({x}, '')", blocks), part)
    return collapse(decode(drop_all(bare, ["<[/!?a-zA-Z][^>]*>"], "")))


def article(x: str) -> str:
    page = drop_all(f"coalesce({x}, '')", [html_fn.COMMENT, *[html_fn.element(n) for n in html_fn.FURNITURE]])
    one = r"(?is)<article(?:\s[^>]*)?>(.*?)(?:</article\s*>|\z)"
    inner = f"regexp_extract({page}, {q(one)}, 1)"
    ps = rf"(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>"
    joined = f"array_to_string(regexp_extract_all({page}, {q(ps)}, 1), ' ')"
    chosen = f"CASE WHEN regexp_matches({page}, '(?i)<article') THEN {inner} ELSE {joined} END"
    return fragment(fragment(chosen))


def rules(x: str, table, default: str = "NULL") -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({x}), {q(n)})" for n in needles) + f" THEN {q(label)}"
        for label, needles in table
    )
    return f"CASE {cases} ELSE {default} END"


def domain(x: str) -> str:
    place = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
    return f"replace(lower(regexp_extract(coalesce({x}, ''), {q(place)}, 1)), 'www.', '')"


def official(x: str) -> str:
    d = domain(x)
    below = " OR ".join(f"{d} = {q(b)} OR {d} LIKE {q('%.' + b)}" for b in fixed.BLOCKED_DOMAINS)
    return f"coalesce({d} <> '' AND NOT ({below}) AND regexp_matches({x}, '^https?://'), false)"


def org_key(x: str) -> str:
    cases = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in fixed.ORGANIZATION_ALIASES.items())
    k = f"lower({strip(x)})"
    return f"CASE {k} {cases} ELSE {k} END"


KNOWN_VALUES = ", ".join(f"({q(k)}, {q(v)})" for k, v in fixed.KNOWN_SITES.items())

FRESH_JOB = f"date BETWEEN {JOBS_AS_OF} - INTERVAL 24 HOUR AND {JOBS_AS_OF}"
URL_1 = (
    "CASE WHEN source_url = '' THEN '' WHEN priority = '3-MEDIUM' "
    "THEN replace(source_url, 'https://jobs.example', 'https://remoteok.com/jobs') ELSE source_url END"
)


def job_links_of(table: str) -> str:
    return f"""
        SELECT e."entityId", e."entityName", e."entityType", 'JOB' AS "recordType",
            'HAS_JOB' AS "relationshipType", r.source_url, 1.0::DOUBLE AS confidence
        FROM (SELECT *, {key("company")} AS k FROM {table}) r
        JOIN name_lookup e ON r.k = e."normalizedName" """


def paper_links_of(table: str) -> str:
    return """
        SELECT e."entityId", e."entityName", e."entityType", 'RESEARCH_PAPER' AS "recordType",
            'MENTIONED_IN_RESEARCH' AS "relationshipType",
            CASE WHEN r.source_url <> '' THEN r.source_url ELSE r.paper_url END AS source_url,
            0.85::DOUBLE AS confidence
        FROM (SELECT *, """ + key("title || ' ' || authors") + """ AS k FROM """ + table + """) r
        JOIN mention_names e ON contains(' ' || r.k || ' ', ' ' || e."normalizedName" || ' ')
        QUALIFY row_number() OVER (PARTITION BY r._ord ORDER BY length(e."normalizedName") DESC, e.position) = 1"""


def news_links_of(table: str) -> str:
    return """
        SELECT e."entityId", e."entityName", e."entityType", 'NEWS' AS "recordType",
            'MENTIONED_IN_NEWS' AS "relationshipType", r.source_url, 0.85::DOUBLE AS confidence
        FROM (SELECT *, """ + key("title || ' ' || content") + """ AS k FROM """ + table + """) r
        JOIN mention_names e ON contains(' ' || r.k || ' ', ' ' || e."normalizedName" || ' ')
        QUALIFY row_number() OVER (PARTITION BY r._ord ORDER BY length(e."normalizedName") DESC, e.position) = 1"""


CTE = {
    "startups": f"""
        SELECT s_suppkey AS _ord, s_name AS "entityName", 'https://dir.example/companies/' || s_suppkey AS source_url
        FROM supplier
        UNION ALL SELECT r_regionkey + {NAMELESS}, '  ', 'https://dir.example/companies/r-' || r_regionkey FROM region
        UNION ALL SELECT s_suppkey + {AGAIN}, upper(s_name), 'https://dir.example/companies/again-' || s_suppkey
        FROM supplier
        UNION ALL SELECT item_id + {PASSAGES},
            array_to_string(list_slice(string_split_regex(text, '\\s+'), 1, 3), ' '),
            'https://dir.example/companies/b-' || item_id
        FROM benchmark""",
    "positions": "SELECT *, row_number() OVER (ORDER BY _ord) AS position FROM startups",
    "entities": f"""
        SELECT printf('STARTUP-%04d', position) AS "entityId", {strip('"entityName"')} AS "entityName",
            {key('"entityName"')} AS "normalizedName", 'STARTUP' AS "entityType", source_url AS "startupUrl", position
        FROM positions WHERE {strip('"entityName"')} <> ''""",
    "name_lookup": """
        SELECT * FROM entities WHERE "normalizedName" <> ''
        QUALIFY row_number() OVER (PARTITION BY "normalizedName" ORDER BY position DESC) = 1""",
    "mention_names": """
        SELECT * FROM entities
        WHERE contains("normalizedName", ' ') OR length("normalizedName") >= 5
        QUALIFY row_number() OVER (PARTITION BY "normalizedName" ORDER BY position) = 1""",
    "products": f"""
        SELECT l_orderkey * 8 + l_linenumber AS _ord, 'part ' || l_partkey AS "productName",
            'SUPPLIER ' || {pad('l_suppkey + l_linenumber')} AS "startupName",
            'https://dir.example/products/' || l_partkey || '/' || l_suppkey AS source_url
        FROM lineitem""",
    "jobs": f"""
        SELECT o_orderkey AS _ord, 'supplier-' || {pad('o_custkey')} AS company, {nth(TITLES, 'o_orderkey')} AS title,
            o_orderdate AS date,
            CASE WHEN o_totalprice < 2000 THEN '' ELSE 'https://jobs.example/' || o_custkey || '/' ||
                CASE WHEN o_orderpriority = '5-LOW' THEN lower(o_orderstatus) ELSE o_orderstatus END END AS source_url,
            o_orderpriority AS priority
        FROM orders""",
    "news": f"""
        SELECT doc_id AS _ord, split_part(text, chr(10), 1) AS title, text AS content, lang,
            'https://news.example/' || source || '/' || lang || '/' || n_chars AS source_url,
            {NEWS_AS_OF} - to_minutes(CAST(doc_id * 7 AS INTEGER)) AS "publishedAt"
        FROM documents""",
    "papers": f"""
        SELECT doc_id AS _ord, text AS title, '["' || lang || '","' || source || '"]' AS authors, lang, source,
            CASE WHEN lang = 'de' THEN '' ELSE 'https://papers.example/src/' || doc_id END AS source_url,
            'https://papers.example/abs/' || doc_id AS paper_url,
            strftime({NEWS_AS_OF} - to_minutes(CAST(doc_id * 7 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS published_date,
            text || ' https://github.com/' || source || '/' || lang || '.' AS summary
        FROM documents""",
    "models": """
        SELECT p_partkey AS _ord, p_name AS model_name, brand AS organization,
            'https://huggingface.co/' || brand || '/' || p_name AS source_url,
            CAST(p_size AS BIGINT) AS downloads, p_partkey % 100 AS likes, lower(p_type) AS pipeline_tag,
            CASE WHEN p_retailprice < 950 THEN '' ELSE 'spark' END AS library_name
        FROM (SELECT *, CASE WHEN p_size <= 2 THEN '' WHEN p_type = 'ECONOMY' THEN upper(p_brand) ELSE p_brand END
            AS brand FROM part)""",
    "hub_models": f"""
        SELECT _ord, split_part(id, '/', -1) AS model_name,
            CASE WHEN contains(id, '/') THEN split_part(id, '/', 1) ELSE '' END AS organization,
            'https://huggingface.co/' || id AS source_url, downloads, likes, pipeline_tag, library_name
        FROM (SELECT *, regexp_replace(source_url, '^https://huggingface.co/+', '') AS id FROM models)""",
    "card_models": """
        SELECT doc_id AS _ord, lang || '-' || doc_id AS model_name,
            CASE WHEN lang = 'es' THEN '' ELSE source END AS organization,
            'https://huggingface.co/' || CASE WHEN lang = 'es' THEN '' ELSE source || '/' END || lang || '-' || doc_id
                AS source_url,
            n_chars AS downloads, n_chars AS likes,
            CASE WHEN n_chars > 1000 THEN 'summarization' ELSE '' END AS pipeline_tag,
            CASE WHEN n_chars > 2000 THEN '' ELSE 'spark' END AS library_name
        FROM documents""",
    "all_cards": """
        SELECT doc_id AS _ord, lang,
            CASE WHEN lang = 'es' THEN '' ELSE source || '/' END || lang || '-' || doc_id AS model_id,
            CASE WHEN lang = 'fr' THEN '' ELSE '---' || chr(10) || 'license: mit' || chr(10) || '---' || chr(10) END
            || '# Card' || chr(10) || chr(10) || '![logo](x.png)' || chr(10) || '[![badge](y)]' || chr(10) || text
            || chr(10) || '## More' || chr(10) || 'End.' AS readme
        FROM documents""",
    "cards": "SELECT * EXCLUDE (lang) FROM all_cards WHERE lang <> 'de'",
    "organization_models": f"""
        SELECT p_partkey AS _ord,
            CASE WHEN p_size > 25 THEN upper({nth(ORGANIZATIONS, 'p_partkey')})
                ELSE {nth(ORGANIZATIONS, 'p_partkey')} END AS organization,
            CASE WHEN p_type = 'PROMO' THEN 'https://models.example/' ELSE 'https://huggingface.co/' END || p_name
                AS source_url
        FROM part""",
    "organizations": f"""
        SELECT * FROM (SELECT _ord, {strip('organization')} AS organization, {strip('source_url')} AS model_url,
            {org_key('organization')} AS key FROM organization_models)
        WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY _ord) = 1""",
    "organization_sources": f"""
        SELECT organization,
            CASE WHEN ok THEN site WHEN hub THEN model_url ELSE '' END AS official_website,
            CASE WHEN ok THEN 'https://www.google.com/s2/favicons?domain=' || {domain('site')} || '&sz=128'
                WHEN hub THEN {q(fixed.HUB_LOGO)} ELSE '' END AS logo_url,
            CASE WHEN ok THEN 'verified_official' WHEN hub THEN 'primary_model_source' ELSE 'unverified' END
                AS verification_status,
            CASE WHEN ok THEN 'known_official_mapping' WHEN hub THEN 'Hugging Face model page' ELSE '' END
                AS source_type
        FROM (SELECT o.*, k.site, {official('k.site')} AS ok, contains(model_url, 'huggingface.co/') AS hub
            FROM organizations o LEFT JOIN (VALUES {KNOWN_VALUES}) AS k(key, site) ON o.key = k.key)""",
    "progress": """
        SELECT _ord, source_url,
            CASE WHEN downloads < 20 THEN ' ' ELSE 'done ' || model_name || ' ' || _ord END AS description
        FROM models WHERE downloads > 10""",
    "done": """
        SELECT source_url, description FROM progress WHERE trim(description) <> ''
        QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY _ord DESC) = 1""",
    "relationship_rows": f"""
        SELECT event_id AS _ord,
            CASE WHEN event_type = 'error' THEN ' ' ELSE printf(' STARTUP-%04d', user_id) END AS "entityId",
            'user ' || user_id || ' ' || upper(event_type) AS "entityName",
            {nth([*_KINDS, 'HAS_OTHER', ''], 'event_id')} AS "relationshipType",
            CASE WHEN event_type = 'view' THEN 'NEWS' ELSE 'JOB' END AS "recordType",
            'https://x.example/' || (user_id % 7) AS source_url, {nth(CONFIDENCES, 'event_id')} AS confidence
        FROM events""",
    "product_links": """
        SELECT e."entityId", e."entityName", e."entityType", 'PRODUCT' AS "recordType",
            'HAS_PRODUCT' AS "relationshipType", r.source_url, 1.0::DOUBLE AS confidence
        FROM (SELECT *, """ + key('"startupName"') + """ AS k FROM products) r
        JOIN name_lookup e ON r.k = e."normalizedName" """,
    "job_links": job_links_of("jobs"),
    "paper_links": paper_links_of("papers"),
    "news_links": news_links_of("news"),
    "mapped": """
        SELECT * FROM product_links UNION ALL SELECT * FROM job_links
        UNION ALL SELECT * FROM paper_links UNION ALL SELECT * FROM news_links""",
    "relationships": "SELECT DISTINCT * FROM mapped",
}


def sql(body: str) -> str:
    """``body`` with the derived inputs it names, and those they name."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTE:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(CTE[name])
                order.append(name)

    visit(body)
    if not order:
        return body
    return "WITH " + ", ".join(f"{n} AS ({CTE[n]})" for n in order) + "\n" + body

"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitymart.llm import collocations, embedding_dedup, infill, jaccard, language, line_quality, mixing, packing, repeats, ring, secret_scan, tokens, warc
from entitymart.llm.common import Scratch

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: A parameter of the token queries; the file is never copied.
TOKENIZER = "word_bpe_49k.json"
MIX_SEED = 11


def query(name: str, table: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(read(spark, sf_dir, table))
        if sql:
            SQL[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query(
    "op1_embedding_near_duplicates",
    "embeddings",
    """
    WITH RECURSIVE e AS (
      SELECT row_number() OVER () AS r, vec_id, label, [x::DOUBLE for x in embedding] AS v FROM embeddings),
    sound AS (
      SELECT *, sqrt(list_sum([x * x for x in v])) AS norm FROM e
      WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
        AND len([x for x in v if x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x for x in v if x <> 0]) > 0),
    links AS (
      SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
      WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
    copies AS (SELECT a.r, count(*) AS n FROM sound a JOIN sound b ON a.label = b.label AND a.v = b.v GROUP BY a.r),
    least AS (SELECT reach.a, min(e.vec_id) AS m FROM reach JOIN e ON e.r = reach.b GROUP BY reach.a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
           vec_id = least(vec_id, coalesce(m, vec_id)) AS kept, coalesce(copies.n, 1) AS n_copies
    FROM e LEFT JOIN counts ON counts.a = e.r LEFT JOIN least ON least.a = e.r LEFT JOIN copies ON copies.r = e.r
    """,
)
def op1(embeddings: DataFrame) -> DataFrame:
    return embedding_dedup.near_duplicates(embeddings, 0.93)


@query("op2_suffix_dedup", "documents")
def op2(documents: DataFrame) -> DataFrame:
    return repeats.remove_repeats(documents, 100)


@query("op3_language_id", "documents")
def op3(documents: DataFrame) -> DataFrame:
    model = language.fit(documents)
    found = language.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out(found["doc_id"]).alias("held_out"), found["lid_lang"].alias("lang_pred"), found["lid_score"].alias("score"))


@query(
    "op4_quality_rules",
    "documents",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
      FROM documents),
    windows AS (
      SELECT r, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1),
    covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
    line AS (
      SELECT r, doc_id, host, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) AS l
      FROM (SELECT r, doc_id, host, unnest(lines) AS l FROM d)),
    hosts AS (SELECT host, count(DISTINCT coalesce(doc_id, -1)) AS n FROM d GROUP BY host),
    common AS (
      SELECT host, l FROM line JOIN hosts USING (host) GROUP BY host, l, hosts.n
      HAVING count(DISTINCT coalesce(doc_id, -1)) > 10
         AND (count(DISTINCT coalesce(doc_id, -1)) > 0.02 * hosts.n OR count(DISTINCT coalesce(doc_id, -1)) > 1000)),
    taken AS (SELECT r, count(*) AS n, sum(len(string_split(l, ' '))) AS words FROM line JOIN common USING (host, l) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
           len(w) < 10 OR 100 * coalesce(covered.n, 0) > 20 * len(w) AS base_failed,
           NOT (len(w) < 10 OR 100 * coalesce(covered.n, 0) > 20 * len(w))
             AND len(w) - coalesce(taken.words, 0) >= 10 AND len(w) - coalesce(taken.words, 0) >= 0.5 * len(w) AS kept,
           coalesce(taken.n, 0)::BIGINT AS n_common_lines, coalesce(taken.words, 0)::BIGINT AS n_common_words
    FROM d LEFT JOIN covered USING (r) LEFT JOIN taken USING (r)
    """,
)
def op4(documents: DataFrame) -> DataFrame:
    return line_quality.judge(documents)


@query(
    "op5_source_mixing",
    "documents",
    f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, coalesce(source, '') AS source, coalesce(strlen(text), 0) + 1 AS size,
             (('0x' || md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
      FROM documents),
    s AS (SELECT source, sum(size)::DOUBLE AS size FROM d GROUP BY source),
    rate AS (SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM s)::DOUBLE * (SELECT sum(size) FROM s) / size AS rate FROM s),
    steps(source, rate, k, l, c) AS (
      SELECT source, rate, 0, -rate, exp(-rate) FROM rate
      UNION ALL
      SELECT source, rate, k + 1, l + ln(rate / (k + 1)), c + exp(l + ln(rate / (k + 1))) FROM steps
      WHERE k + 1 <= ceil(rate + 12 * sqrt(rate) + 20)),
    drawn AS (SELECT row_number() OVER () AS r, * FROM d),
    n AS (SELECT r, any_value(drawn.doc_id) AS doc_id, any_value(drawn.source) AS source, any_value(rate) AS rate,
                 count(*) FILTER (c < u) AS n FROM drawn JOIN steps USING (source) GROUP BY r),
    copies AS (SELECT doc_id, source, rate, unnest(range(1, n + 1)) AS copy FROM n WHERE n > 0)
    SELECT doc_id, source, copy::INT AS copy, round(rate, 9) AS rate,
           md5('{MIX_SEED}/order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS shuffle_key FROM copies
    """,
)
def op5(documents: DataFrame) -> DataFrame:
    mixed = mixing.mix(documents, None, MIX_SEED)
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return mixed.select("doc_id", source.alias("source"), F.col("mix_copy").alias("copy"), F.round("mix_rate", 9).alias("rate"), F.col("mix_key").alias("shuffle_key"))


@query("op6_secret_scan", "documents")
def op6(documents: DataFrame) -> DataFrame:
    found = secret_scan.scan(documents.select("doc_id", "text"))
    return found.selectExpr("doc_id", "sec_assign AS n_assign", "sec_access AS n_access", "sec_hex AS n_hex", "sec_base_sha256 AS base_sha256", "sec_spans AS spans", "sec_literal AS n_literal")


@query(
    "op7_shingle_jaccard",
    "documents",
    r"""
    WITH RECURSIVE d AS (
      SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    one AS (SELECT DISTINCT r, list_aggregate(w[i:i + 3], 'string_agg', ' ') AS g
            FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
    size AS (SELECT r, count(*) AS n FROM one GROUP BY r),
    links AS (
      SELECT a.r AS a, b.r AS b FROM one a JOIN one b ON a.g = b.g AND a.r <> b.r JOIN size x ON x.r = a.r JOIN size y ON y.r = b.r
      GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT reach.a, min(d.doc_id) AS m FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a),
    counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, coalesce(n_links, 0) AS n_links
    FROM d LEFT JOIN size USING (r) LEFT JOIN least ON least.a = d.r LEFT JOIN counts ON counts.a = d.r
    """,
)
def op7(documents: DataFrame) -> DataFrame:
    return jaccard.near_duplicates(documents, 4, 85).select("doc_id", "n_shingles", "component_id", "n_links")


@query("op8_best_fit_packing", "documents")
def op8(documents: DataFrame) -> DataFrame:
    return packing.pack(documents, public_tokenizers.path(TOKENIZER), 4096)


@query("op9_token_histogram", "documents")
def op9(documents: DataFrame) -> DataFrame:
    return tokens.length_histogram(tokens.encoded_lengths(documents, public_tokenizers.path(TOKENIZER)))


@query("op10_ring_shards", "documents")
def op10(documents: DataFrame) -> DataFrame:
    return ring.shard(documents, 8)


@query(
    "op11_phrase_collocations",
    "documents",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    piece AS (SELECT r, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
    w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
    total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
    place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
    gram AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k FROM place, (VALUES (1), (2), (3), (4)) AS s(k) WHERE i + k - 1 <= len(w)),
    f AS (SELECT lang, phrase, k, count(*) AS f FROM gram GROUP BY lang, phrase, k HAVING count(*) >= 30),
    candidate AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
    cut AS (SELECT *, unnest(range(1, k)) AS c FROM candidate),
    part AS (SELECT lang, phrase, k, a, c, array_to_string(w[1:c], ' ') AS one, array_to_string(w[c + 1:], ' ') AS two FROM cut),
    score AS (
      SELECT part.lang, part.phrase, part.k, a, c, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f)::HUGEINT)::BIGINT AS score
      FROM part JOIN f x ON x.lang = part.lang AND x.phrase = one JOIN f y ON y.lang = part.lang AND y.phrase = two),
    best AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
    inside AS (
      SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
      FROM candidate, (VALUES (2), (3)) AS s(m), (VALUES (1), (2), (3)) AS o(i) WHERE m < k AND i + m - 1 <= k),
    most AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase),
    ranked AS (
      SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, encode(best.phrase)) AS rank
      FROM best LEFT JOIN most ON most.lang = best.lang AND most.phrase = best.phrase WHERE most IS NULL OR 100 * most < 80 * a)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
)
def op11(documents: DataFrame) -> DataFrame:
    return collocations.mine(documents, 30, 80, 2000)


@query(
    "op12_fill_in_middle",
    "documents",
    """
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
             sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    drawn AS (
      SELECT doc_id, t, w, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS y,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                  WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    cut AS (
      SELECT *, array_to_string(w[1:least(x, y)], '') AS prefix, array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS middle,
             array_to_string(w[greatest(x, y) + 1:], '') AS suffix FROM drawn)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM cut
    """,
)
def op12(documents: DataFrame) -> DataFrame:
    out = infill.rearrange(documents.select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.col("fim_units").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("fim_form"), F.col("fim_text")).cast("binary"), 256).alias("restored_sha256"),
    )


@query(
    "op13_warc_archive",
    "pages",
    """
    WITH p AS (
      SELECT row_number() OVER () AS r, page_id, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS digest,
             octet_length(encode(coalesce(html, ''))) AS size FROM pages),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY digest ORDER BY page_id NULLS LAST, r) AS place,
             first_value(page_id) OVER (PARTITION BY digest ORDER BY page_id NULLS LAST, r) AS least FROM p)
    SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
           CASE WHEN size >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN size >= 100 AND place > 1 THEN least END AS refers_to, true AS digest_agrees
    FROM ranked
    """,
)
def op13(pages: DataFrame) -> DataFrame:
    path = Scratch(pages.sparkSession, "archives").root
    warc.archive(pages, path)
    return warc.crawl(warc.read(pages.sparkSession, path, ["record_type", "payload_digest", "headers", "http_length", "payload"]))

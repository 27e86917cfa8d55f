"""Model enrichment from landed model cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymart.functions import cards, urls
from entitymart.functions.text import blank_if_null, first_filled, is_filled, is_present, strip
from entitymart.operators import dedup
from entitymart.operators.ordering import ORD
from entitymart.schemas import MODELS_ENRICHED, columns


def _described(models: DataFrame, card_rows: DataFrame, model_id: Column, extract) -> DataFrame:
    """Models with ``found``, the description of their card or null.

    Cards are the wide table: only those of listed models are read further, and
    each is cut to its description before the last of a model's cards is chosen.
    """
    keyed = models.withColumn("model_id", model_id)
    wanted = keyed.select("model_id").distinct()
    read = card_rows.select(ORD, "model_id", "readme").join(wanted, "model_id", "left_semi")
    texts = read.select(ORD, "model_id", extract(F.col("readme")).alias("found"))
    found = dedup.keep_one(texts, ["model_id"], "last").select("model_id", "found")
    # one description per model at most, so both sides are as large as the models:
    # a plain join, in which adaptive execution broadcasts or splits as it measures
    return keyed.join(found, "model_id", "left")


def enriched_models(models: DataFrame, card_rows: DataFrame) -> DataFrame:
    """Description from the card's text, else one sentence; the hub page is the
    website and the hub picture the logo."""
    trimmed = models.withColumns(
        {c: strip(blank_if_null(F.col(c))) for c in ("model_name", "organization", "source_url")}
    )
    rows = _described(
        trimmed, card_rows, urls.model_id(F.col("organization"), F.col("model_name")),
        cards.card_description,
    )
    fallback = cards.fallback_description(F.col("model_name"), F.col("organization"))
    return rows.withColumns(
        {
            "official_website": F.col("source_url"),
            "logo_url": urls.avatar(F.col("organization")),
            "description": F.coalesce(first_filled(F.col("found")), fallback),
            "from_card": is_filled(F.col("found")),
        }
    ).select(ORD, *columns(MODELS_ENRICHED), "from_card")


def enriched_models_plain(cleaned: DataFrame, card_rows: DataFrame) -> DataFrame:
    """First model per name, description from the whole card, else sentences
    from the metadata; website and logo stay blank."""
    rows = _described(
        dedup.models(cleaned), card_rows, urls.model_id_from_url(F.col("source_url")),
        cards.card_description_plain,
    )
    fallback = cards.fallback_description_tagged(
        F.col("model_name"), F.col("organization"), F.col("pipeline_tag"), F.col("library_name")
    )
    return rows.withColumns(
        {
            "official_website": F.lit(""),
            "logo_url": F.lit(""),
            "description": F.coalesce(first_filled(F.col("found")), fallback),
            "from_card": is_filled(F.col("found")),
        }
    ).select(ORD, *columns(MODELS_ENRICHED), "from_card")


def description_coverage(enriched: DataFrame) -> DataFrame:
    """One row: models, descriptions present and missing, from cards and fallbacks."""
    present = is_present(F.col("description"))
    return enriched.agg(
        F.count(F.lit(1)).alias("models"),
        F.count_if(present).alias("present"),
        F.count_if(~present).alias("missing"),
        F.count_if(F.col("from_card")).alias("from_card"),
        F.count_if(~F.col("from_card")).alias("fallback"),
    )

"""Queries of the training-data problems, with their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import materialise
from ..sources.tables import table
from .canonical import map_to_reference
from .linkage import item_groups, same_item_pairs, same_items
from .leakage import leaked_items
from .mixing import SEED, actual_shares, chosen_repeats, distinct_texts, emitted, source_rates
from .mojibake import garbled_documents
from .topn import top_items


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_item_pairs(materialise(same_items(table(spark, folder, "products")), "items"))


def p1_items(spark: SparkSession, folder: str) -> DataFrame:
    """Each listing with the smallest id of its product, and that product's number of listings and links."""
    items = materialise(same_items(table(spark, folder, "products")), "items")
    return items.join(item_groups(items), "item").select("id", F.col("representative").alias("item_id"), "listings", "links")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    top_group = ["window_hours", "scope_type", "city", "chain_id", "store_id"]
    top = table(spark, folder, "top_promotions_cache", *top_group, "item_code", "smart_score", "promotion_id")
    store_group = ["store_db_id", "time_window", "promo_type", "sort_metric"]
    stores = table(spark, folder, "store_promotions_cache", *store_group, "item_code", "discount_percent", "discount_amount", "promotion_id")
    metric = F.when(F.col("sort_metric") == "percent", F.col("discount_percent")).when(F.col("sort_metric") == "savings", F.col("discount_amount"))
    return top_items(top, "top_promotions_cache", top_group, "item_code", "smart_score", "promotion_id", 25).unionByName(
        top_items(stores.withColumn("own_metric", metric), "store_promotions_cache", store_group, "item_code", "own_metric", "promotion_id", 10)
    )


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for column, refs, name in (("city", "ref_cities", "city_name"), ("chain_name", "ref_chains", "chain_name")):
        stores = table(spark, folder, "stores", "id", column)
        mapped = map_to_reference(stores, "id", column, table(spark, folder, refs), "ref_id", [name, f"{name}_latin"])
        parts.append(mapped.select("id", F.lit(column).alias("field_name"), "ref_id"))
    return parts[0].unionByName(parts[1])


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    return leaked_items(documents, "doc_id", "text", table(spark, folder, "eval_items", "item_id", "text"), "item_id", "text")


def _mixture(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, folder, "mix_targets")
    texts = materialise(distinct_texts(table(spark, folder, "documents", "doc_id", "text", "source"), targets), "texts")
    rates = source_rates(texts, targets)
    return rates, chosen_repeats(texts, rates)


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The mixture: each chosen text as often as it is used."""
    return emitted(table(spark, folder, "documents", "doc_id", "text"), _mixture(spark, folder)[1])


def p9_by_characters(spark: SparkSession, folder: str) -> DataFrame:
    """The chosen texts and their copies when texts are measured by their characters, as SQL can do it."""
    targets = table(spark, folder, "mix_targets")
    texts = distinct_texts(table(spark, folder, "documents", "doc_id", "text", "source"), targets, size=F.length("text").cast("bigint"))
    return chosen_repeats(texts, source_rates(texts, targets)).select("doc_id", "source_name", F.col("tokens").alias("characters"), "copies")


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of each source."""
    return actual_shares(*_mixture(spark, folder))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return garbled_documents(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p1_items, p3_found, p4_found, p8_found, p9_mixture, p9_by_characters, p9_shares, p10_found)}

SQL = {
    "p9_by_characters": rf"""
        WITH goals AS (SELECT lower(trim(source)) AS source_name, sum(target_share) AS target_share, min(max_repeats) AS max_repeats FROM mix_targets WHERE source IS NOT NULL GROUP BY ALL),
        rows AS (SELECT doc_id, md5(text) AS h, lower(regexp_replace(source, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')) AS source_name, length(text) AS characters FROM documents WHERE regexp_matches(text, '[^\s\x{{a0}}]')),
        texts AS (SELECT min(doc_id) AS doc_id, arg_min(source_name, doc_id) AS source_name, arg_min(characters, doc_id) AS characters FROM rows WHERE source_name IN (SELECT source_name FROM goals) GROUP BY h),
        sizes AS (SELECT source_name, sum(characters)::DOUBLE AS available FROM texts GROUP BY ALL),
        usable AS (SELECT source_name, target_share, max_repeats, available FROM goals JOIN sizes USING (source_name) WHERE available > 0 AND target_share > 0),
        whole AS (SELECT sum(target_share) AS shares, min(max_repeats * available / target_share) AS feasible FROM usable),
        rates AS (SELECT source_name, least(target_share / shares * (feasible * shares) / available, max_repeats::DOUBLE) AS rate FROM usable, whole),
        drawn AS (SELECT t.*, rate, CAST('0x' || substring(md5('{SEED}:' || doc_id), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496 AS draw FROM texts t JOIN rates USING (source_name))
        SELECT doc_id, source_name, characters, CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies FROM drawn WHERE floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END > 0""",
    "p4_found": """
        WITH candidates AS (
            SELECT 'top_promotions_cache' AS cache_table, concat_ws('|', window_hours, scope_type, city, chain_id, store_id) AS group_key,
                item_code, smart_score AS score, promotion_id, 25 AS most FROM top_promotions_cache
            UNION ALL SELECT 'store_promotions_cache', concat_ws('|', store_db_id, time_window, promo_type, sort_metric), item_code,
                CASE sort_metric WHEN 'percent' THEN discount_percent WHEN 'savings' THEN discount_amount END, promotion_id, 10 FROM store_promotions_cache),
        best AS (
            SELECT * FROM candidates WHERE score IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY cache_table, group_key, item_code ORDER BY score DESC, promotion_id) = 1),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY cache_table, group_key ORDER BY score DESC, item_code) AS place FROM best)
        SELECT cache_table, group_key, CAST(place AS BIGINT) AS rank_no, item_code, promotion_id FROM ranked WHERE place <= most""",
}

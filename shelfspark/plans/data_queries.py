"""Queries of the general data problems: 2, 5, 6 and 7."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import materialise
from ..operators.history import OPEN, history, merge_history
from ..operators.orphans import Reference, orphan_references, parent_intervals
from ..operators.shred import child_rows
from ..operators.units import UNITS, normalise_quantities, quantity_misses
from ..sources.tables import table, unix_micro, unix_second


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "updated_at")
    alerts = table(spark, folder, "observations", "product_id", "created_at")
    parents = parent_intervals(
        {
            "products": (table(spark, folder, "products", "id", "created_at"), "id", "created_at"),
            "stores": (table(spark, folder, "stores", "id", "created_at"), "id", "created_at"),
        },
        table(spark, folder, "removed_keys"),
    )
    references = [
        Reference("product_prices", "product_id", "products", prices, F.col("updated_at")),
        Reference("product_prices", "store_id", "stores", prices, F.col("updated_at")),
        Reference("observations", "product_id", "products", alerts, F.col("created_at")),
    ]
    return orphan_references(references, parents)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "price", "promo_price", "updated_at")
    versions = history(prices, ["product_id", "store_id"], unix_micro(prices, "updated_at"), ["price", "promo_price"])
    second = lambda c: F.expr(f"({c} - pmod({c}, 1000000)) div 1000000")
    return versions.select("product_id", "store_id", second("valid_from").alias("valid_from"), F.when(F.col("valid_to") == OPEN, OPEN).otherwise(second("valid_to")).cast("bigint").alias("valid_to"))


def history_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Versions with their attributes, built from the snapshots before a cut, then carried on with all later ones."""
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "price", "promo_price", "updated_at")
    rows = prices.withColumn("at", unix_micro(prices, "updated_at"))
    keys, attributes, cut = ["product_id", "store_id"], ["price", "promo_price"], F.lit(1_743_465_600_000_000)  # 2025-04-01
    begun = materialise(history(rows.filter(F.col("at") < cut), keys, F.col("at"), attributes), "history")
    merged = merge_history(begun, rows.filter(F.col("at") >= cut), keys, F.col("at"), attributes)
    e4 = lambda c: (F.col(c) * 10000).cast("bigint").alias(f"{c}_e4")
    return merged.select(*keys, e4("price"), e4("promo_price"), "valid_from", "valid_to")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "updated_at", "unit_qty", "unit_of_measure", "b_is_weighted")
    rows = prices.withColumn("at_second", unix_second(prices, "updated_at")).drop("updated_at")
    return normalise_quantities(rows, ["product_id", "store_id", "at_second"])


def p6_misses(spark: SparkSession, folder: str) -> DataFrame:
    """How many distinct quantities as written can't be read, by reason."""
    rows = table(spark, folder, "product_prices", "unit_qty", "unit_of_measure", "b_is_weighted")
    return quantity_misses(rows, []).groupBy("reason").agg(F.count(F.lit(1)).alias("notations"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return child_rows(table(spark, folder, "promotions", "chain_id", "promotion_id", "items", "available_in_store_ids"))


QUERIES = {f.__name__: f for f in (p2_found, p5_found, history_merged, p6_found, p6_misses, p7_found)}

# SQL's own reading of the notations: spellings from the longest on, then patterns.
_SPELLINGS = sorted(((s, unit, base, int(Decimal(factor) * 10**6)) for unit, base, factor, spellings in UNITS for s in spellings), key=lambda s: -len(s[0]))
_ALTERNATIVES = "|".join(re.escape(s[0]).replace("'", "''") for s in _SPELLINGS)
_UNIT_ROWS = ", ".join(f"('{s.replace(chr(39), chr(39) * 2)}', '{unit}', '{base}', {factor})" for s, unit, base, factor in _SPELLINGS)
_SPELLING_PATTERN = rf'''(?:^|[^\p{{L}}])({_ALTERNATIVES})(?:$|[^\p{{L}}"''])'''
_PLAIN = r"""trim(regexp_replace(replace(translate(lower({0}), '״”“׳’‘`', repeat('"', 3) || repeat(chr(39), 4)), chr(39) || chr(39), '"'), '[\s\x{{a0}}]+', ' ', 'g'))"""
_NUMBER_E4 = r"CAST(CAST(CASE WHEN regexp_full_match({0}, '[0-9]{{1,3}}(,[0-9]{{3}})+(\.[0-9]+)?') THEN replace({0}, ',', '') ELSE replace({0}, ',', '.') END AS DECIMAL(30,4)) * 10000 AS HUGEINT)"

SQL = {
    "p6_found": rf"""
        WITH spellings(spelling, unit, base, factor) AS (VALUES {_UNIT_ROWS}),
        texts AS (
            SELECT DISTINCT unit_qty, unit_of_measure, coalesce(b_is_weighted, FALSE) AS weighted, {_PLAIN.format("unit_qty")} AS t, {_PLAIN.format("coalesce(unit_of_measure, '')")} AS m FROM product_prices
            WHERE unit_qty IS NOT NULL AND NOT coalesce(regexp_full_match(unit_qty, '[0-9]+') AND unit_of_measure IN ('גרם', 'מ"ל', 'יחידה'), FALSE)),
        parts AS (
            SELECT *, regexp_extract(t, '{_SPELLING_PATTERN}', 1) AS in_text, regexp_extract(m, '{_SPELLING_PATTERN}', 1) AS in_measure,
                regexp_extract(t, '([0-9]+(?:[.,][0-9]+)*)\s*[x×*]\s*([0-9]+(?:[.,][0-9]+)*)', ['a', 'b']) AS pack, regexp_extract(t, '(?:([0-9]+) )?([0-9]+)/([0-9]+)', ['w', 'n', 'd']) AS fraction,
                regexp_extract(t, '([0-9]*)½', ['w']) AS half, regexp_extract(t, '[0-9]+(?:[.,][0-9]+)*') AS number FROM texts),
        amounts AS (
            SELECT *, CASE WHEN pack.a <> '' THEN {_NUMBER_E4.format("pack.a")} * {_NUMBER_E4.format("pack.b")} WHEN fraction.d <> '' THEN CAST(CASE fraction.w WHEN '' THEN '0' ELSE fraction.w END AS HUGEINT) * CAST(fraction.d AS HUGEINT) + CAST(fraction.n AS HUGEINT)
                    WHEN contains(t, '½') THEN 2 * CAST(CASE half.w WHEN '' THEN '0' ELSE half.w END AS HUGEINT) + 1 WHEN number <> '' THEN {_NUMBER_E4.format("number")} WHEN contains(t, 'חצי') OR contains(t, 'רבע') OR in_text IN ('תריסר', 'dozen') THEN 1 END AS n,
                CASE WHEN pack.a <> '' THEN 100000000 WHEN fraction.d <> '' THEN CAST(fraction.d AS HUGEINT) WHEN contains(t, '½') THEN 2 WHEN number <> '' THEN 10000 WHEN contains(t, 'חצי') THEN 2 WHEN contains(t, 'רבע') THEN 4 ELSE 1 END AS d,
                CASE WHEN in_text <> '' THEN in_text WHEN in_measure <> '' THEN in_measure WHEN weighted THEN 'kg' END AS spelling FROM parts),
        read AS (SELECT unit_qty, unit_of_measure, weighted, base, CAST((2 * n * factor + d * 1000000) // (2 * d * 1000000) AS BIGINT) AS milli FROM amounts JOIN spellings USING (spelling) WHERE n > 0)
        SELECT product_id, store_id, CAST(floor(epoch(updated_at)) AS BIGINT) AS at_second, min((base, milli))[1] AS base_unit, min((base, milli))[2] AS amount_milli
        FROM product_prices p JOIN read r ON r.unit_qty = p.unit_qty AND r.unit_of_measure IS NOT DISTINCT FROM p.unit_of_measure AND r.weighted = coalesce(p.b_is_weighted, FALSE) GROUP BY ALL""",
    "p2_found": """
        WITH parents AS (
            SELECT 'products' AS target, id AS key, min(created_at) AS created_at FROM products GROUP BY ALL
            UNION ALL SELECT 'stores', id, min(created_at) FROM stores GROUP BY ALL),
        refs AS (
            SELECT 'product_prices' AS from_table, 'product_id' AS from_column, 'products' AS target, product_id AS key, updated_at AS ts FROM product_prices
            UNION ALL SELECT 'product_prices', 'store_id', 'stores', store_id, updated_at FROM product_prices
            UNION ALL SELECT 'observations', 'product_id', 'products', product_id, created_at FROM observations),
        judged AS (
            SELECT from_table, from_column, strftime(ts AT TIME ZONE 'UTC', '%Y-%m') AS month_key, r.key AS key_id,
                CASE WHEN p.key IS NOT NULL THEN CASE WHEN p.created_at > r.ts THEN 'late' END
                     WHEN EXISTS (SELECT 1 FROM removed_keys k WHERE k.target_table = r.target AND k.key_id = r.key) THEN 'removed'
                     ELSE 'missing' END AS reason
            FROM refs r LEFT JOIN parents p ON p.target = r.target AND p.key = r.key WHERE r.key IS NOT NULL)
        SELECT DISTINCT from_table, from_column, month_key, key_id, reason FROM judged WHERE reason IS NOT NULL""",
    "p5_found": """
        WITH rows AS (SELECT DISTINCT product_id, store_id, updated_at, price, promo_price FROM product_prices WHERE updated_at IS NOT NULL),
        compared AS (
            SELECT *, row_number() OVER w = 1 OR price IS DISTINCT FROM lag(price) OVER w OR promo_price IS DISTINCT FROM lag(promo_price) OVER w AS begins
            FROM rows WINDOW w AS (PARTITION BY product_id, store_id ORDER BY updated_at)),
        begun AS (SELECT product_id, store_id, CAST(floor(epoch(updated_at)) AS BIGINT) AS valid_from FROM compared WHERE begins)
        SELECT product_id, store_id, valid_from,
            CAST(coalesce(lead(valid_from) OVER (PARTITION BY product_id, store_id ORDER BY valid_from), -1) AS BIGINT) AS valid_to
        FROM begun""",
    "history_merged": """
        WITH rows AS (SELECT DISTINCT product_id, store_id, updated_at, price, promo_price FROM product_prices WHERE updated_at IS NOT NULL),
        compared AS (
            SELECT *, row_number() OVER w = 1 OR price IS DISTINCT FROM lag(price) OVER w OR promo_price IS DISTINCT FROM lag(promo_price) OVER w AS begins
            FROM rows WINDOW w AS (PARTITION BY product_id, store_id ORDER BY updated_at))
        SELECT product_id, store_id, CAST(price * 10000 AS BIGINT) AS price_e4, CAST(promo_price * 10000 AS BIGINT) AS promo_price_e4, epoch_us(updated_at) AS valid_from,
            coalesce(lead(epoch_us(updated_at)) OVER (PARTITION BY product_id, store_id ORDER BY updated_at), -1) AS valid_to
        FROM compared WHERE begins""",
    "p7_found": r"""
        WITH RECURSIVE texts AS (
            SELECT chain_id, promotion_id, row_number() OVER () AS row_no, trim(ltrim(trim(items, E' \t\r\n'), chr(65279)), E' \t\r\n') AS t FROM promotions),
        parsed AS (
            SELECT chain_id, promotion_id, row_no, CASE WHEN starts_with(t, '"') THEN CAST(t AS JSON) ->> '$' ELSE t END AS j FROM texts WHERE json_valid(t)),
        nodes AS (
            SELECT row_no, n.id, n.parent, lower(replace(n.key, '_', '')) AS k, trim(n.atom ->> '$', E' \t\r\n') AS v FROM parsed, json_tree(CAST(j AS JSON)) n WHERE json_valid(j)),
        named AS (SELECT row_no, parent AS owner, k, min(v) AS v FROM nodes WHERE k IN ('itemcode', 'groupid') AND v <> '' GROUP BY ALL),
        climb AS (
            SELECT row_no, owner, owner AS above, 0 AS steps FROM named WHERE k = 'itemcode'
            UNION ALL SELECT c.row_no, c.owner, n.parent, c.steps + 1 FROM climb c JOIN nodes n ON n.row_no = c.row_no AND n.id = c.above WHERE n.parent IS NOT NULL),
        found AS (
            SELECT c.row_no, c.owner, arg_min(g.v, c.steps) FILTER (g.k = 'groupid') AS group_no, arg_min(g.v, c.steps) FILTER (g.k = 'itemcode' AND c.steps > 0) AS parent_code
            FROM climb c LEFT JOIN named g ON g.row_no = c.row_no AND g.owner = c.above GROUP BY ALL)
        SELECT DISTINCT p.chain_id, p.promotion_id, 'item' AS child_kind, coalesce(f.group_no, '') AS group_no, coalesce(f.parent_code, '') AS parent_code, n.v AS child_key
        FROM found f JOIN named n ON n.row_no = f.row_no AND n.owner = f.owner AND n.k = 'itemcode' JOIN parsed p ON p.row_no = f.row_no
        UNION SELECT chain_id, promotion_id, 'store', '', '', s FROM (SELECT chain_id, promotion_id, trim(unnest(available_in_store_ids), E' \t\r\n') AS s FROM promotions) WHERE s <> ''""",
}

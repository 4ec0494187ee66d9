"""Queries of the relational core: filters, joins, aggregates, windows, sorting, sets and merges, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import merge, ranking, relational
from ..sources.tables import table, utc

AS_OF = "2025-04-15"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query("SELECT id, chain_name, city FROM stores WHERE lower(city) LIKE 'רמת%'")
def filter_optional_params(spark, folder):
    stores = table(spark, folder, "stores", "id", "chain_name", "city", "chain_id")
    return relational.optional_filters(stores, equal={"chain_id": None}, prefix={"city": "רמת"}).drop("chain_id")


@query(f"""SELECT DISTINCT chain_id, promotion_id FROM promotions
    WHERE (promotion_start_date IS NULL OR promotion_start_date <= DATE '{AS_OF}') AND (promotion_end_date IS NULL OR promotion_end_date >= DATE '{AS_OF}')""")
def filter_active_window(spark, folder):
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "promotion_start_date", "promotion_end_date")
    return rows.filter(relational.valid_at("promotion_start_date", "promotion_end_date", AS_OF)).select("chain_id", "promotion_id").distinct()


@query("SELECT id, item_code FROM products WHERE regexp_full_match(item_code, '[0-9]{8,14}') AND trim(coalesce(item_name, '')) <> ''")
def filter_barcode(spark, folder):
    rows = table(spark, folder, "products", "id", "item_code", "item_name")
    return rows.filter(F.col("item_code").rlike("^[0-9]{8,14}$") & (F.trim(F.coalesce("item_name", F.lit(""))) != "")).select("id", "item_code")


@query("SELECT id FROM products WHERE NOT (lower(coalesce(item_name, '')) LIKE '%מבצע%' OR lower(coalesce(item_name, '')) LIKE '%premium%' OR lower(coalesce(item_name, '')) LIKE '%חדש%')")
def filter_keyword_none(spark, folder):
    return table(spark, folder, "products", "id", "item_name").filter(relational.matches_none("item_name", ["מבצע", "Premium", "חדש"])).select("id")


@query("SELECT id FROM products WHERE regexp_matches(item_name, '(^|[^א-ת])דק([^א-ת]|$)')")
def filter_word_boundary(spark, folder):
    return table(spark, folder, "products", "id", "item_name").filter(relational.has_word("item_name", "דק", "א-ת")).select("id")


@query("SELECT id, has_image IS TRUE AS is_true, has_image IS DISTINCT FROM FALSE AS not_false FROM products WHERE has_image IS DISTINCT FROM TRUE")
def filter_is_distinct(spark, folder):
    flag = F.col("has_image")
    rows = table(spark, folder, "products", "id", "has_image").filter(~flag.eqNullSafe(True))
    return rows.select("id", flag.eqNullSafe(True).alias("is_true"), (~flag.eqNullSafe(False)).alias("not_false"))


@query("""SELECT o.id, o.user_id FROM observations o WHERE (o.product_id, o.city) IN (
    SELECT p.product_id, s.city FROM product_prices p JOIN stores s ON s.id = p.store_id WHERE p.promo_price < p.price)""")
def filter_in_pairs(spark, folder):
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "price", "promo_price").filter("promo_price < price")
    pairs = prices.join(table(spark, folder, "stores", F.col("id").alias("store_id"), "city"), "store_id").select("product_id", "city").distinct()
    return table(spark, folder, "observations", "id", "user_id", "product_id", "city").join(pairs, ["product_id", "city"], "left_semi").select("id", "user_id")


@query(r"""SELECT chain_id, promotion_id, epoch_us(updated_at) AS at_us FROM promotions
    WHERE list_contains(list_transform(regexp_extract_all(replace(promotion_description, ',', '.'), '([0-9]+(?:\.[0-9]+)?)', 1), lambda x: CAST(x AS DECIMAL(18,4))),
        CASE WHEN regexp_full_match(discounted_price, '\s*-?[0-9]+(\.[0-9]+)?\s*') THEN TRY_CAST(trim(discounted_price) AS DECIMAL(18,4)) END)""")
def filter_number_in_text(spark, folder):
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at", "promotion_description", "discounted_price")
    numbers = F.regexp_extract_all(F.replace("promotion_description", F.lit(","), F.lit(".")), F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    price = clean.guarded_number("discounted_price")
    return rows.filter(F.exists(numbers, lambda x: x.try_cast("decimal(18,4)") == price)).select("chain_id", "promotion_id", F.unix_micros("updated_at").alias("at_us"))


@query("""SELECT p.product_id, s.chain_id, count(*) AS snapshots, CAST(round(min(p.price) * 100) AS BIGINT) AS least_cents
    FROM product_prices p JOIN products q ON q.id = p.product_id JOIN stores s ON s.id = p.store_id GROUP BY ALL""")
def join_price_chain(spark, folder):
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "price")
    products = table(spark, folder, "products", F.col("id").alias("product_id"))
    stores = table(spark, folder, "stores", F.col("id").alias("store_id"), "chain_id")
    by_store = prices.groupBy("product_id", "store_id").agg(F.count(F.lit(1)).alias("n"), F.min("price").alias("least"))
    joined = by_store.join(stores, "store_id").join(products, "product_id", "left_semi")
    return joined.groupBy("product_id", "chain_id").agg(F.sum("n").alias("snapshots"), F.round(F.min("least") * 100).cast("bigint").alias("least_cents"))


@query("""SELECT q.id, CAST(min(p.promo_price) * 10000 AS BIGINT) AS best_promo_e4, count(p.promo_price) AS offers
    FROM products q LEFT JOIN product_prices p ON p.product_id = q.id AND p.promo_price > 0 AND p.promo_price < p.price GROUP BY q.id""")
def join_best_offer(spark, folder):
    offers = table(spark, folder, "product_prices", "product_id", "price", "promo_price").filter("promo_price > 0 AND promo_price < price")
    best = offers.groupBy("product_id").agg((F.min("promo_price") * 10000).cast("bigint").alias("best_promo_e4"), F.count("promo_price").alias("offers"))
    products = table(spark, folder, "products", "id")
    return products.join(best, products["id"] == best["product_id"], "left").select("id", "best_promo_e4", F.coalesce("offers", F.lit(0)).alias("offers"))


@query("""WITH listed AS (SELECT DISTINCT chain_id, promotion_id, TRY_CAST(trim(s) AS BIGINT) AS number FROM (SELECT chain_id, promotion_id, unnest(available_in_store_ids) AS s FROM promotions)),
    numbered AS (SELECT chain_id, id, TRY_CAST(regexp_extract(store_id, '^\\s*0*([0-9]{1,9})(\\.0)?\\s*$', 1) AS BIGINT) AS number FROM stores)
    SELECT l.chain_id, l.promotion_id, n.id AS store FROM listed l JOIN numbered n ON n.chain_id = l.chain_id AND n.number = l.number""".replace("\\\\", "\\"))
def join_array_stores(spark, folder):
    listed = table(spark, folder, "promotions", "chain_id", "promotion_id", "available_in_store_ids").select("chain_id", "promotion_id", F.explode("available_in_store_ids").alias("s"))
    listed = listed.select("chain_id", "promotion_id", F.trim("s").try_cast("bigint").alias("number")).distinct()
    digits = F.regexp_extract("store_id", r"^\s*0*([0-9]{1,9})(\.0)?\s*$", 1)
    stores = table(spark, folder, "stores", "chain_id", F.col("id").alias("store"), digits.try_cast("bigint").alias("number"))
    return listed.join(stores, ["chain_id", "number"]).select("chain_id", "promotion_id", "store")


@query("SELECT id, item_code FROM products q WHERE NOT EXISTS (SELECT 1 FROM product_prices p WHERE p.product_id = q.id AND p.price IS NOT NULL)")
def join_anti_unpriced(spark, folder):
    priced = table(spark, folder, "product_prices", "product_id", "price").filter("price IS NOT NULL").select(F.col("product_id").alias("id")).distinct()
    return table(spark, folder, "products", "id", "item_code").join(priced, "id", "left_anti")


@query("""SELECT o.city, count(*) AS alerts, count(q.id) AS resolved, count(*) - count(q.id) AS missed
    FROM observations o LEFT JOIN (SELECT item_code, min(id) AS id FROM products GROUP BY item_code) q ON q.item_code = o.item_code GROUP BY o.city""")
def join_dimension_lookup(spark, folder):
    alerts = table(spark, folder, "observations", "city", "item_code")
    products = table(spark, folder, "products", "item_code", "id").groupBy("item_code").agg(F.min("id").alias("product"))
    resolved, missed = merge.split_by_lookup(alerts, products, ["item_code"], "product")
    both = resolved.select("city", F.lit(1).alias("hit")).unionByName(missed.select("city", F.lit(0).alias("hit")))
    return both.groupBy("city").agg(F.count(F.lit(1)).alias("alerts"), F.sum("hit").cast("bigint").alias("resolved"), F.sum(1 - F.col("hit")).cast("bigint").alias("missed"))


@query("""SELECT o.id, o.user_id, epoch_us(o.created_at) AS created_us, epoch_us(min(p.updated_at)) AS next_us
    FROM (SELECT DISTINCT id, user_id, product_id, created_at FROM observations) o LEFT JOIN product_prices p ON p.product_id = o.product_id AND p.updated_at >= o.created_at GROUP BY o.id, o.user_id, o.product_id, o.created_at""")
def join_asof_next(spark, folder):
    alerts = table(spark, folder, "observations", "id", "user_id", "product_id", "created_at").distinct()
    prices = table(spark, folder, "product_prices", "product_id", "updated_at")
    found = relational.next_after(alerts, prices, ["product_id"], "created_at", "updated_at", "next_at")
    return found.select("id", "user_id", F.unix_micros("created_at").alias("created_us"), F.unix_micros("next_at").alias("next_us"))


@query("""SELECT DISTINCT m.chain_id, m.promotion_id, m.store_no, s.id AS store FROM
    (SELECT chain_id, promotion_id, unnest(map_keys(store_promotions)) AS store_no FROM promotions) m JOIN stores s ON s.chain_id = m.chain_id AND s.store_id = m.store_no""")
def join_map_explode(spark, folder):
    entries = table(spark, folder, "promotions", "chain_id", "promotion_id", "store_promotions").select("chain_id", "promotion_id", F.explode("store_promotions").alias("store_no", "value"))
    stores = table(spark, folder, "stores", "chain_id", F.col("store_id").alias("store_no"), F.col("id").alias("store"))
    return entries.join(stores, ["chain_id", "store_no"]).select("chain_id", "promotion_id", "store_no", "store").distinct()


@query("SELECT product_id, count(DISTINCT s.chain_id) AS chain_count, epoch_us(max(p.updated_at)) AS last_us FROM product_prices p JOIN stores s ON s.id = p.store_id WHERE p.price IS NOT NULL GROUP BY product_id")
def agg_chain_count(spark, folder):
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "price", "updated_at").filter("price IS NOT NULL")
    by_store = prices.groupBy("product_id", "store_id").agg(F.max("updated_at").alias("last_at"))
    joined = by_store.join(table(spark, folder, "stores", F.col("id").alias("store_id"), "chain_id"), "store_id")
    return joined.groupBy("product_id").agg(F.countDistinct("chain_id").alias("chain_count"), F.unix_micros(F.max("last_at")).alias("last_us"))


@query("""SELECT product_id, CAST(min(CASE WHEN promo_price > 0 AND promo_price < price THEN promo_price ELSE price END) * 10000 AS BIGINT) AS effective_e4,
    bool_or(promo_price < price) AS any_promo FROM product_prices GROUP BY product_id""")
def agg_min_case(spark, folder):
    effective = F.when((F.col("promo_price") > 0) & (F.col("promo_price") < F.col("price")), F.col("promo_price")).otherwise(F.col("price"))
    prices = table(spark, folder, "product_prices", "product_id", "price", "promo_price")
    return prices.groupBy("product_id").agg((F.min(effective) * 10000).cast("bigint").alias("effective_e4"), F.bool_or(F.col("promo_price") < F.col("price")).alias("any_promo"))


@query("""WITH by_chain AS (SELECT p.product_id, s.chain_id, min(p.price) AS least, count(DISTINCT s.id) AS stores FROM product_prices p JOIN stores s ON s.id = p.store_id WHERE p.price IS NOT NULL GROUP BY ALL)
    SELECT product_id, CAST(min(least) * 10000 AS BIGINT) AS least_e4, CAST(sum(stores) AS BIGINT) AS stores, string_agg(chain_id, ',' ORDER BY chain_id) FILTER (stores > 1) AS chains FROM by_chain GROUP BY product_id""")
def agg_two_level(spark, folder):
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "price").filter("price IS NOT NULL")
    by_store = prices.groupBy("product_id", "store_id").agg(F.min("price").alias("least"))
    by_chain = by_store.join(table(spark, folder, "stores", F.col("id").alias("store_id"), "chain_id"), "store_id").groupBy("product_id", "chain_id").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("stores"))
    listed = F.array_join(F.array_sort(F.collect_list(F.when(F.col("stores") > 1, F.col("chain_id")))), ",")
    return by_chain.groupBy("product_id").agg((F.min("least") * 10000).cast("bigint").alias("least_e4"), F.sum("stores").alias("stores"), F.nullif(listed, F.lit("")).alias("chains"))


@query("""SELECT chain_id, count(*) AS promotions, count(*) FILTER (is_weighted_promo) AS weighted,
    floor(100.0::DOUBLE * count(*) FILTER (is_weighted_promo) / count(*) * 100 + 0.5) / 100 AS weighted_percent FROM promotions GROUP BY chain_id""")
def agg_filter_ratio(spark, folder):
    counts = table(spark, folder, "promotions", "chain_id", "is_weighted_promo").groupBy("chain_id").agg(F.count(F.lit(1)).alias("promotions"), F.count_if("is_weighted_promo").alias("weighted"))
    return counts.withColumn("weighted_percent", clean.half_up(F.lit(100.0) * F.col("weighted") / F.col("promotions")))


@query("""SELECT store_id, count(*) FILTER (updated_at >= TIMESTAMPTZ '2025-04-14 00:00:00+00') AS last_24h, count(*) FILTER (updated_at >= TIMESTAMPTZ '2025-04-08 00:00:00+00') AS last_168h,
    count(*) FILTER (updated_at >= TIMESTAMPTZ '2025-03-16 00:00:00+00') AS last_720h FROM product_prices WHERE updated_at < TIMESTAMPTZ '2025-04-15 00:00:00+00' GROUP BY store_id""")
def agg_recency_buckets(spark, folder):
    rows = table(spark, folder, "product_prices", "store_id", "updated_at")
    rows = rows.withColumn("at", utc(rows, "updated_at")).filter(F.col("at") < F.lit(f"{AS_OF} 00:00:00").cast("timestamp"))
    hours = lambda n: F.count_if(F.col("at") >= F.expr(f"timestamp'{AS_OF} 00:00:00' - INTERVAL {n} HOURS")).alias(f"last_{n}h")
    return rows.groupBy("store_id").agg(hours(24), hours(168), hours(720))


@query("""SELECT scope_type, chain_id, count(*) AS row_count, CAST(min(smart_score) * 10000 AS BIGINT) AS least_e4, CAST(max(smart_score) * 10000 AS BIGINT) AS most_e4, count(DISTINCT store_id) AS stores FROM top_promotions_cache GROUP BY ALL""")
def agg_scope_minmax(spark, folder):
    rows = table(spark, folder, "top_promotions_cache", "scope_type", "chain_id", "smart_score", "store_id")
    e4 = lambda c: (c * 10000).cast("bigint")
    return rows.groupBy("scope_type", "chain_id").agg(F.count(F.lit(1)).alias("row_count"), e4(F.min("smart_score")).alias("least_e4"), e4(F.max("smart_score")).alias("most_e4"), F.countDistinct("store_id").alias("stores"))


@query("""SELECT coalesce(nullif(lower(trim(source)), ''), 'unknown') AS source_name, coalesce(nullif(lower(trim(lang)), ''), 'unknown') AS lang_name, count(*) AS texts, CAST(sum(n_chars) AS BIGINT) AS characters, epoch_us(max(published_at)) AS last_us
    FROM documents GROUP BY ALL""")
def agg_ledger_rollup(spark, folder):
    named = lambda c: F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("unknown"))
    rows = table(spark, folder, "documents", "source", "lang", "n_chars", "published_at")
    return rows.groupBy(named("source").alias("source_name"), named("lang").alias("lang_name")).agg(F.count(F.lit(1)).alias("texts"), F.sum("n_chars").alias("characters"), F.unix_micros(F.max("published_at")).alias("last_us"))


@query("""SELECT count(*) AS events, count(DISTINCT user_id) AS users, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'view') AS views,
    count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (event_type = 'signup') AS signups, count(*) FILTER (event_type = 'error') AS errors FROM events""")
def agg_event_metrics(spark, folder):
    of = lambda name: F.count_if(F.col("event_type") == name)
    rows = table(spark, folder, "events", "user_id", "event_type")
    return rows.agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"), of("click").alias("clicks"), of("view").alias("views"), of("purchase").alias("purchases"), of("signup").alias("signups"), of("error").alias("errors"))


@query("SELECT user_id, event_type, count(*) AS events FROM events GROUP BY ALL ORDER BY events DESC, user_id, event_type LIMIT 25")
def agg_top_events(spark, folder):
    counts = table(spark, folder, "events", "user_id", "event_type").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("events"))
    return counts.orderBy(F.desc("events"), "user_id", "event_type").limit(25)


@query("SELECT strftime(date_trunc('week', updated_at AT TIME ZONE 'UTC'), '%Y-%m-%d') AS week, count(*) AS snapshots, count(DISTINCT product_id) AS products FROM product_prices GROUP BY ALL")
def agg_week_histogram(spark, folder):
    rows = table(spark, folder, "product_prices", "updated_at", "product_id")
    return rows.groupBy(F.date_format(F.date_trunc("week", utc(rows, "updated_at")), "yyyy-MM-dd").alias("week")).agg(F.count(F.lit(1)).alias("snapshots"), F.countDistinct("product_id").alias("products"))


@query("""SELECT chain_id, count(*) FILTER (time_window = '24h') AS w_24h, count(*) FILTER (time_window = '7days') AS w_7days, count(*) FILTER (time_window = '30days') AS w_30days FROM store_promotions_cache GROUP BY chain_id""")
def agg_pivot(spark, folder):
    rows = table(spark, folder, "store_promotions_cache", "chain_id", "time_window").withColumn("window_name", F.concat(F.lit("w_"), "time_window"))
    return rows.groupBy("chain_id").pivot("window_name", ["w_24h", "w_7days", "w_30days"]).agg(F.count(F.lit(1))).fillna(0)


@query("""WITH ranked AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS n, count(*) OVER (PARTITION BY event_type) AS total FROM events WHERE value IS NOT NULL)
    SELECT event_type, max(value) FILTER (n = floor((total - 1) * 50 / 100.0::DOUBLE + 0.5) + 1) AS p50, max(value) FILTER (n = floor((total - 1) * 95 / 100.0::DOUBLE + 0.5) + 1) AS p95, max(value) AS greatest FROM ranked GROUP BY event_type""")
def agg_nearest_rank(spark, folder):
    rows = table(spark, folder, "events", "event_type", "value").filter("value IS NOT NULL")
    return relational.nearest_ranks(rows, ["event_type"], "value", {"p50": 50, "p95": 95}).select("event_type", "p50", "p95", "greatest")


@query("""SELECT item_code, count(*) AS listed, arg_min(item_name, id) FILTER (trim(item_name) <> '') AS first_name, arg_min(manufacturer_name, id) FILTER (trim(manufacturer_name) <> '') AS first_maker,
    coalesce(bool_or(has_image), FALSE) AS any_image FROM products GROUP BY item_code""")
def agg_first_filled(spark, folder):
    rows = table(spark, folder, "products", "item_code", "id", "item_name", "manufacturer_name", "has_image")
    return rows.groupBy("item_code").agg(F.count(F.lit(1)).alias("listed"), relational.first_filled_in_order("item_name", "id").alias("first_name"), relational.first_filled_in_order("manufacturer_name", "id").alias("first_maker"), F.coalesce(F.bool_or("has_image"), F.lit(False)).alias("any_image"))


@query("""WITH a AS (SELECT DISTINCT product_id AS k FROM product_prices), b AS (SELECT DISTINCT product_id AS k FROM observations)
    SELECT count(*) AS seen, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS in_both, count(*) FILTER (b.k IS NULL) AS left_only, count(*) FILTER (a.k IS NULL) AS right_only FROM a FULL JOIN b ON a.k = b.k""")
def agg_set_reconciliation(spark, folder):
    a = table(spark, folder, "product_prices", F.col("product_id").alias("k")).select("k", F.lit(1).alias("l"), F.lit(0).alias("r"))
    b = table(spark, folder, "observations", F.col("product_id").alias("k")).select("k", F.lit(0).alias("l"), F.lit(1).alias("r"))
    keys = a.unionByName(b).groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return keys.agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("l") + F.col("r") == 2).alias("in_both"), F.count_if(F.col("r") == 0).alias("left_only"), F.count_if(F.col("l") == 0).alias("right_only"))


@query("SELECT store_id, epoch_us(max(updated_at)) AS latest_us, date_diff('second', max(updated_at), TIMESTAMPTZ '2025-12-31 00:00:00+00') AS age_seconds FROM product_prices GROUP BY store_id")
def agg_freshness(spark, folder):
    rows = table(spark, folder, "product_prices", "store_id", "updated_at").groupBy("store_id").agg(F.max("updated_at").alias("latest_at"))
    return rows.select("store_id", F.unix_micros("latest_at").alias("latest_us"), (F.lit(1767139200) - F.unix_seconds("latest_at")).alias("age_seconds"))


@query("""SELECT store_id, product_id, rank_no, price_e4 FROM (SELECT store_id, product_id, CAST(price * 10000 AS BIGINT) AS price_e4,
    row_number() OVER (PARTITION BY store_id ORDER BY price DESC, product_id) AS rank_no FROM (SELECT store_id, product_id, max(price) AS price FROM product_prices WHERE price IS NOT NULL GROUP BY ALL)) WHERE rank_no <= 10""")
def win_rank_store(spark, folder):
    best = table(spark, folder, "product_prices", "store_id", "product_id", "price").filter("price IS NOT NULL").groupBy("store_id", "product_id").agg(F.max("price").alias("price"))
    return relational.top_per_key(best, ["store_id"], [F.desc("price"), F.col("product_id")], 10).select("store_id", "product_id", "rank_no", (F.col("price") * 10000).cast("bigint").alias("price_e4"))


@query("""SELECT DISTINCT ON (product_id, store_id) product_id, store_id, epoch_us(updated_at) AS at_us, CAST(price * 10000 AS BIGINT) AS price_e4 FROM product_prices
    ORDER BY product_id, store_id, updated_at DESC, price DESC NULLS LAST""")
def win_latest_per_key(spark, folder):
    rows = table(spark, folder, "product_prices", "product_id", "store_id", "updated_at", "price")
    latest = relational.best_per_key(rows, ["product_id", "store_id"], [F.desc("updated_at"), F.desc_nulls_last("price")])
    return latest.select("product_id", "store_id", F.unix_micros("updated_at").alias("at_us"), (F.col("price") * 10000).cast("bigint").alias("price_e4"))


@query("""WITH best AS (SELECT city, chain_id, item_code, max(smart_score) AS score FROM top_promotions_cache WHERE smart_score IS NOT NULL GROUP BY ALL),
    cities AS (SELECT 'city' AS scope, city, '' AS chain_id, item_code, row_number() OVER (PARTITION BY city ORDER BY max(score) DESC, item_code) AS rank_no FROM best GROUP BY city, item_code),
    chains AS (SELECT 'chain' AS scope, city, chain_id, item_code, row_number() OVER (PARTITION BY city, chain_id ORDER BY score DESC, item_code) AS rank_no FROM best)
    SELECT * FROM cities WHERE rank_no <= 5 UNION ALL SELECT * FROM chains WHERE rank_no <= 5""")
def win_multi_scope(spark, folder):
    rows = table(spark, folder, "top_promotions_cache", "city", "chain_id", "item_code", "smart_score").filter("smart_score IS NOT NULL")
    best = rows.groupBy("city", "chain_id", "item_code").agg(F.max("smart_score").alias("score"))
    order = [F.desc("score"), F.col("item_code")]
    cities = relational.top_per_key(best.groupBy("city", "item_code").agg(F.max("score").alias("score")), ["city"], order, 5)
    chains = relational.top_per_key(best, ["city", "chain_id"], order, 5)
    columns = ["scope", "city", "chain_id", "item_code", "rank_no"]
    return cities.withColumns({"scope": F.lit("city"), "chain_id": F.lit("")}).select(columns).unionByName(chains.withColumn("scope", F.lit("chain")).select(columns))


@query("""WITH bucketed AS (SELECT store_id, item_code, CASE WHEN coalesce(is_conditional_promo, FALSE) THEN 'conditional' ELSE 'standard' END AS bucket, max(smart_score) AS score FROM top_promotions_cache WHERE smart_score IS NOT NULL GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY store_id, bucket ORDER BY score DESC, item_code) AS rank_no FROM bucketed)
    SELECT store_id, bucket, item_code, rank_no FROM ranked WHERE rank_no <= CASE bucket WHEN 'standard' THEN 6 ELSE 3 END""")
def win_bucket_quota(spark, folder):
    rows = table(spark, folder, "top_promotions_cache", "store_id", "item_code", "is_conditional_promo", "smart_score").filter("smart_score IS NOT NULL")
    bucket = F.when(F.coalesce("is_conditional_promo", F.lit(False)), "conditional").otherwise("standard")
    best = rows.groupBy("store_id", "item_code", bucket.alias("bucket")).agg(F.max("smart_score").alias("score"))
    ranked = relational.top_per_key(best, ["store_id", "bucket"], [F.desc("score"), F.col("item_code")], 6)
    return ranked.filter("rank_no <= CASE bucket WHEN 'standard' THEN 6 ELSE 3 END").select("store_id", "bucket", "item_code", "rank_no")


@query("""SELECT product_id, store_id, epoch_us(updated_at) AS at_us, bool_or(coalesce(b_is_weighted, FALSE)) OVER (PARTITION BY product_id, store_id) AS ever_weighted FROM (SELECT DISTINCT product_id, store_id, updated_at, b_is_weighted FROM product_prices)""")
def win_bool_or(spark, folder):
    rows = table(spark, folder, "product_prices", "product_id", "store_id", "updated_at", "b_is_weighted").distinct()
    ever = rows.groupBy("product_id", "store_id").agg(F.bool_or(F.coalesce("b_is_weighted", F.lit(False))).alias("ever_weighted"))
    return rows.join(ever, ["product_id", "store_id"]).select("product_id", "store_id", F.unix_micros("updated_at").alias("at_us"), "ever_weighted")


@query("""WITH best AS (SELECT store_db_id, item_code, max(discount_percent) AS pct, max(discount_amount) AS amt FROM store_promotions_cache GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY store_db_id ORDER BY pct DESC, item_code) AS by_percent, row_number() OVER (PARTITION BY store_db_id ORDER BY amt DESC, item_code) AS by_amount FROM best)
    SELECT store_db_id, item_code, by_percent, by_amount FROM ranked WHERE by_percent <= 5 OR by_amount <= 5""")
def win_dual_rank(spark, folder):
    rows = table(spark, folder, "store_promotions_cache", "store_db_id", "item_code", "discount_percent", "discount_amount")
    best = rows.groupBy("store_db_id", "item_code").agg(F.max("discount_percent").alias("pct"), F.max("discount_amount").alias("amt"))
    placed = best
    for column, name in (("pct", "by_percent"), ("amt", "by_amount")):
        placed = ranking.rank_all(placed, ["store_db_id"], [F.desc(column), F.col("item_code")], name)
    return placed.filter("by_percent <= 5 OR by_amount <= 5").select("store_db_id", "item_code", "by_percent", "by_amount")


@query("""SELECT store_id, item_code, row_number() OVER (PARTITION BY store_id ORDER BY image DESC, score DESC, item_code) AS new_rank FROM
    (SELECT store_id, item_code, max(CASE WHEN has_image THEN 1 ELSE 0 END) AS image, max(smart_score) AS score FROM top_promotions_cache WHERE smart_score IS NOT NULL GROUP BY ALL)""")
def win_rerank_flag(spark, folder):
    rows = table(spark, folder, "top_promotions_cache", "store_id", "item_code", "has_image", "smart_score").filter("smart_score IS NOT NULL")
    best = rows.groupBy("store_id", "item_code").agg(F.max(F.when(F.col("has_image"), 1).otherwise(0)).alias("image"), F.max("smart_score").alias("score"))
    return ranking.rank_all(best, ["store_id"], [F.desc("image"), F.desc("score"), F.col("item_code")], "new_rank").select("store_id", "item_code", "new_rank")


@query("""SELECT product_id, store_id, epoch_us(updated_at) AS at_us, CAST(last_value(price IGNORE NULLS) OVER (PARTITION BY product_id, store_id ORDER BY updated_at, price NULLS FIRST ROWS UNBOUNDED PRECEDING) * 10000 AS BIGINT) AS filled_e4
    FROM (SELECT DISTINCT product_id, store_id, updated_at, price FROM product_prices)""")
def win_forward_fill(spark, folder):
    rows = table(spark, folder, "product_prices", "product_id", "store_id", "updated_at", "price").distinct()
    filled = relational.forward_fill(rows.withColumn("filled", F.col("price")), ["filled"], ["updated_at", "price"], ["product_id", "store_id"])
    return filled.select("product_id", "store_id", F.unix_micros("updated_at").alias("at_us"), (F.col("filled") * 10000).cast("bigint").alias("filled_e4"))


@query("SELECT id, item_code, item_name FROM products ORDER BY item_name NULLS LAST, id OFFSET 40 LIMIT 20")
def page_cursor(spark, folder):
    return relational.page(table(spark, folder, "products", "id", "item_code", "item_name"), [F.asc_nulls_last("item_name"), F.col("id")], 40, 20)


@query("SELECT chain_id, promotion_id, epoch_us(updated_at) AS at_us FROM (SELECT *, row_number() OVER (PARTITION BY chain_id, promotion_id ORDER BY updated_at) AS n FROM (SELECT DISTINCT chain_id, promotion_id, updated_at FROM promotions)) WHERE n = 1")
def first_wins(spark, folder):
    return table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at").groupBy("chain_id", "promotion_id").agg(F.unix_micros(F.min("updated_at")).alias("at_us"))


@query("""SELECT chain_id, promotion_id, epoch_us(updated_at) AS at_us, promotion_description AS last_description FROM promotions
    QUALIFY row_number() OVER (PARTITION BY chain_id, promotion_id ORDER BY updated_at DESC NULLS LAST, promotion_description DESC NULLS LAST) = 1""")
def last_wins(spark, folder):
    """The last version of each promotion; of versions at one time the one with the greatest description."""
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at", "promotion_description")
    last = relational.best_per_key(rows, ["chain_id", "promotion_id"], [F.desc_nulls_last("updated_at"), F.desc_nulls_last("promotion_description")])
    return last.select("chain_id", "promotion_id", F.unix_micros("updated_at").alias("at_us"), F.col("promotion_description").alias("last_description"))


@query("""SELECT 'price' AS kind, store_id AS place, count(*) AS row_count FROM product_prices GROUP BY store_id UNION ALL SELECT 'cache', store_db_id, count(*) FROM store_promotions_cache GROUP BY store_db_id""")
def union_scopes(spark, folder):
    a = table(spark, folder, "product_prices", "store_id").groupBy(F.col("store_id").alias("place")).agg(F.count(F.lit(1)).alias("row_count")).withColumn("kind", F.lit("price"))
    b = table(spark, folder, "store_promotions_cache", "store_db_id").groupBy(F.col("store_db_id").alias("place")).agg(F.count(F.lit(1)).alias("row_count")).withColumn("kind", F.lit("cache"))
    return a.unionByName(b).select("kind", "place", "row_count")


@query("SELECT DISTINCT product_id FROM observations EXCEPT SELECT product_id FROM product_prices")
def set_difference(spark, folder):
    return table(spark, folder, "observations", "product_id").distinct().join(table(spark, folder, "product_prices", "product_id").distinct(), "product_id", "left_anti")


@query("""SELECT chain_id, promotion_id, string_agg(s, ',' ORDER BY s) AS stores FROM (SELECT DISTINCT chain_id, promotion_id, trim(unnest(available_in_store_ids)) AS s FROM promotions) WHERE s <> '' GROUP BY ALL""")
def array_union_distinct(spark, folder):
    stores = table(spark, folder, "promotions", "chain_id", "promotion_id", "available_in_store_ids").select("chain_id", "promotion_id", F.explode("available_in_store_ids").alias("s"))
    stores = stores.select("chain_id", "promotion_id", F.trim("s").alias("s")).filter("s <> ''").distinct()
    return stores.groupBy("chain_id", "promotion_id").agg(F.array_join(F.array_sort(F.collect_list("s")), ",").alias("stores"))


@query("""WITH incoming AS (SELECT product_id, store_id, max(updated_at) AS updated_at, CAST(arg_max(price, updated_at) * 10000 AS BIGINT) AS price_e4 FROM product_prices WHERE updated_at >= TIMESTAMPTZ '2025-04-01 00:00:00+00' AND price IS NOT NULL GROUP BY ALL),
    held AS (SELECT product_id, store_id, max(updated_at) AS updated_at, CAST(arg_max(price, updated_at) * 10000 AS BIGINT) AS price_e4, min(updated_at) AS created_at FROM product_prices WHERE updated_at < TIMESTAMPTZ '2025-04-01 00:00:00+00' AND price IS NOT NULL GROUP BY ALL)
    SELECT coalesce(i.product_id, h.product_id) AS product_id, coalesce(i.store_id, h.store_id) AS store_id, epoch_us(coalesce(i.updated_at, h.updated_at)) AS at_us, coalesce(i.price_e4, h.price_e4) AS price_e4, epoch_us(coalesce(h.created_at, i.updated_at)) AS created_us
    FROM held h FULL JOIN incoming i ON i.product_id = h.product_id AND i.store_id = h.store_id""")
def upsert_merge(spark, folder):
    rows = table(spark, folder, "product_prices", "product_id", "store_id", "updated_at", "price").filter("price IS NOT NULL")
    rows = rows.withColumn("at", utc(rows, "updated_at"))
    cut = F.lit("2025-04-01 00:00:00").cast("timestamp")
    fold = lambda df, born: df.groupBy("product_id", "store_id").agg(F.max("updated_at").alias("updated_at"), (F.max_by("price", "updated_at") * 10000).cast("bigint").alias("price_e4"), born("updated_at").alias("created_at"))
    merged = merge.upsert(fold(rows.filter(F.col("at") < cut), F.min), fold(rows.filter(F.col("at") >= cut), F.max), ["product_id", "store_id"])
    return merged.select("product_id", "store_id", F.unix_micros("updated_at").alias("at_us"), "price_e4", F.unix_micros("created_at").alias("created_us"))


@query("""SELECT id, 1 AS origin FROM stores WHERE id IN (SELECT DISTINCT store_id FROM product_prices) UNION ALL
    SELECT DISTINCT store_db_id, 2 FROM store_promotions_cache WHERE store_db_id NOT IN (SELECT id FROM stores WHERE id IN (SELECT DISTINCT store_id FROM product_prices))""")
def insert_ignore(spark, folder):
    used = table(spark, folder, "product_prices", F.col("store_id").alias("id")).distinct()
    held = table(spark, folder, "stores", "id").join(used, "id", "left_semi").withColumn("origin", F.lit(1))
    new = table(spark, folder, "store_promotions_cache", F.col("store_db_id").alias("id")).withColumn("origin", F.lit(2))
    return merge.insert_ignore(held, new, ["id"])


@query("""SELECT p.id, CASE WHEN c.flag IS NOT NULL THEN c.flag ELSE p.has_image END AS has_image, c.flag IS NOT NULL AND c.flag IS DISTINCT FROM p.has_image AS was_changed
    FROM products p LEFT JOIN (SELECT item_code, bool_or(has_image) AS flag FROM top_promotions_cache GROUP BY item_code HAVING bool_or(has_image) IS NOT NULL) c ON c.item_code = p.item_code""")
def update_where_distinct(spark, folder):
    products = table(spark, folder, "products", "id", "item_code", "has_image").withColumn("was_changed", F.lit(False))
    flags = table(spark, folder, "top_promotions_cache", "item_code", "has_image").groupBy("item_code").agg(F.bool_or("has_image").alias("has_image")).filter("has_image IS NOT NULL")
    return merge.update_where_distinct(products, flags, ["item_code"], "has_image", F.lit(True), "was_changed").select("id", "has_image", "was_changed")


@query("""SELECT 'observations' AS table_name, count(*) FILTER (expires_at < TIMESTAMPTZ '2025-08-15 00:00:00+00') AS goes, count(*) FILTER (expires_at IS NULL OR expires_at >= TIMESTAMPTZ '2025-08-15 00:00:00+00') AS stays FROM observations
    UNION ALL SELECT 'promotions', count(*) FILTER (promotion_end_date < DATE '2025-04-15'), count(*) FILTER (promotion_end_date IS NULL OR promotion_end_date >= DATE '2025-04-15') FROM promotions""")
def retention_counts(spark, folder):
    alerts = table(spark, folder, "observations", "expires_at")
    old = {"observations": (alerts, utc(alerts, "expires_at") < F.lit("2025-08-15 00:00:00").cast("timestamp")), "promotions": (table(spark, folder, "promotions", "promotion_end_date"), F.col("promotion_end_date") < F.lit(AS_OF).cast("date"))}
    parts = []
    for name, (df, condition) in old.items():
        goes = F.coalesce(condition, F.lit(False))
        parts.append(df.agg(F.count_if(goes).alias("goes"), F.count_if(~goes).alias("stays")).select(F.lit(name).alias("table_name"), "goes", "stays"))
    return parts[0].unionByName(parts[1])


@query("""SELECT DISTINCT p.store_id AS id, CAST(NULL AS VARCHAR) AS chain_id FROM product_prices p WHERE p.store_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stores s WHERE s.id = p.store_id)
    UNION ALL SELECT id, chain_id FROM stores""")
def insert_missing_parents(spark, folder):
    stores = table(spark, folder, "stores", "id", "chain_id")
    return merge.with_missing_parents(stores, table(spark, folder, "product_prices", F.col("store_id").alias("id")), ["id"])


@query("""SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS quantity, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY ALL""")
def pricing_summary(spark, folder):
    rows = table(spark, folder, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_shipdate").filter("l_shipdate <= timestamp'1998-09-02 00:00:00'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.round("l_quantity").cast("bigint")).alias("quantity"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"))


@query("""SELECT n.n_name AS nation, r.r_name AS region, count(*) AS orders, CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY ALL""")
def nation_rollup(spark, folder):
    orders = table(spark, folder, "orders", F.col("o_custkey").alias("c_custkey"), "o_totalprice").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    customers = table(spark, folder, "customer", "c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, folder, "nation", "n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey")).join(table(spark, folder, "region", "r_regionkey", "r_name"), "r_regionkey")
    joined = orders.join(customers, "c_custkey").groupBy("n_nationkey").agg(F.sum("n").alias("orders"), F.sum("cents").alias("cents")).join(nations, "n_nationkey")
    return joined.select(F.col("n_name").alias("nation"), F.col("r_name").alias("region"), "orders", "cents")


@query("""SELECT DISTINCT ON (chain_id) chain_id, coalesce(nullif(trim(chain_name), ''), chain_id) AS shown_name, count(*) OVER (PARTITION BY chain_id) AS stores FROM stores
    ORDER BY chain_id, (trim(coalesce(chain_name, '')) = ''), updated_at DESC NULLS LAST, id""")
def chain_list(spark, folder):
    rows = table(spark, folder, "stores", "id", "chain_id", "chain_name", "updated_at")
    order = F.struct((F.trim(F.coalesce("chain_name", F.lit(""))) == "").alias("blank"), F.coalesce(-F.unix_micros("updated_at"), F.lit(1)).alias("newest"), "id")
    best = rows.groupBy("chain_id").agg(F.min_by("chain_name", order).alias("chain_name"), F.count(F.lit(1)).alias("stores"))
    return best.select("chain_id", F.coalesce(F.nullif(F.trim("chain_name"), F.lit("")), "chain_id").alias("shown_name"), "stores")


@query("""WITH offers AS (SELECT s.city, s.chain_id, p.product_id, s.id AS store, min(p.price) AS least, bool_or(p.promo_price < p.price) AS promo FROM product_prices p JOIN stores s ON s.id = p.store_id WHERE p.price > 0 AND trim(s.city) <> '' GROUP BY ALL),
    chains AS (SELECT city, chain_id, product_id, min(least) AS least, count(*) AS stores, bool_or(promo) AS promo FROM offers GROUP BY ALL)
    SELECT city, product_id, count(*) AS chain_count, CAST(sum(stores) AS BIGINT) AS store_count, CAST(min(least) * 10000 AS BIGINT) AS least_e4, bool_or(promo) AS any_promo, string_agg(chain_id, ',' ORDER BY chain_id) AS chains FROM chains GROUP BY ALL""")
def city_availability(spark, folder):
    prices = table(spark, folder, "product_prices", "product_id", "store_id", "price", "promo_price").filter("price > 0")
    by_store = prices.groupBy("product_id", "store_id").agg(F.min("price").alias("least"), F.bool_or(F.col("promo_price") < F.col("price")).alias("promo"))
    stores = table(spark, folder, "stores", F.col("id").alias("store_id"), "city", "chain_id").filter("trim(city) <> ''")
    chains = by_store.join(stores, "store_id").groupBy("city", "chain_id", "product_id").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("stores"), F.bool_or("promo").alias("promo"))
    return chains.groupBy("city", "product_id").agg(
        F.count(F.lit(1)).alias("chain_count"), F.sum("stores").alias("store_count"), (F.min("least") * 10000).cast("bigint").alias("least_e4"), F.bool_or("promo").alias("any_promo"), F.array_join(F.array_sort(F.collect_list("chain_id")), ",").alias("chains")
    )


@query("""WITH stages AS (SELECT item_code, 'listed' AS stage FROM products UNION ALL SELECT q.item_code, 'priced' FROM product_prices p JOIN products q ON q.id = p.product_id
    UNION ALL SELECT item_code, 'watched' FROM observations UNION ALL SELECT item_code, 'top' FROM top_promotions_cache UNION ALL SELECT item_code, 'store' FROM store_promotions_cache)
    SELECT item_code, count(*) FILTER (stage = 'listed') AS listed, count(*) FILTER (stage = 'priced') AS priced, count(*) FILTER (stage = 'watched') AS watched, count(*) FILTER (stage = 'top') AS top_rows, count(*) FILTER (stage = 'store') AS store_rows,
        CASE WHEN count(*) FILTER (stage = 'listed') = 0 THEN 'unlisted' WHEN count(*) FILTER (stage = 'priced') = 0 THEN 'unpriced' WHEN count(*) FILTER (stage IN ('top', 'store')) = 0 THEN 'uncached' ELSE 'complete' END AS first_gap
    FROM stages WHERE item_code IS NOT NULL GROUP BY item_code""")
def code_lineage(spark, folder):
    """How often each item code occurs at each stage, and the first stage where it is missing."""
    count = lambda df, stage: df.filter("item_code IS NOT NULL").groupBy("item_code").agg(F.count(F.lit(1)).alias(stage))
    products = table(spark, folder, "products", "id", "item_code")
    priced = table(spark, folder, "product_prices", F.col("product_id").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")).join(products, "id")
    parts = {
        "listed": count(products, "listed"), "priced": priced.filter("item_code IS NOT NULL").groupBy("item_code").agg(F.sum("n").alias("priced")), "watched": count(table(spark, folder, "observations", "item_code"), "watched"),
        "top_rows": count(table(spark, folder, "top_promotions_cache", "item_code"), "top_rows"), "store_rows": count(table(spark, folder, "store_promotions_cache", "item_code"), "store_rows"),
    }
    union = None
    for df in parts.values():
        union = df if union is None else union.unionByName(df, allowMissingColumns=True)
    sums = union.groupBy("item_code").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts])
    gap = F.when(F.col("listed") == 0, "unlisted").when(F.col("priced") == 0, "unpriced").when(F.col("top_rows") + F.col("store_rows") == 0, "uncached").otherwise("complete")
    return sums.withColumn("first_gap", gap)


@query("""WITH steps AS (SELECT chain_id, updated_at, row_number() OVER (PARTITION BY chain_id ORDER BY updated_at, promotion_id, promotion_description) AS n FROM promotions)
    SELECT chain_id, CAST(max(n) AS BIGINT) AS sent, epoch_us(min(updated_at)) AS first_us, epoch_us(max(updated_at)) AS last_us, CAST(floor(date_diff('second', min(updated_at), max(updated_at)) / 86400) AS BIGINT) AS days FROM steps GROUP BY chain_id""")
def send_ledger(spark, folder):
    rows = table(spark, folder, "promotions", "chain_id", "updated_at").groupBy("chain_id").agg(F.count(F.lit(1)).alias("sent"), F.min("updated_at").alias("a"), F.max("updated_at").alias("b"))
    return rows.select("chain_id", "sent", F.unix_micros("a").alias("first_us"), F.unix_micros("b").alias("last_us"), F.floor((F.unix_seconds("b") - F.unix_seconds("a")) / 86400).alias("days"))

"""Queries of offers, search results, paging, deletion and reports, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import clean, text
from ..operators import folding, merge, ranking, relational
from ..sources import feeds
from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


LATEST = """(SELECT product_id, store_id, price, promo_price FROM product_prices WHERE price IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY product_id, store_id ORDER BY updated_at DESC NULLS LAST, price DESC, promo_price DESC NULLS LAST) = 1)"""
WORDS = r"list_filter(string_split_regex(lower(coalesce(item_name, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '')"


def _e4(column: str, name: str):
    return (F.col(column) * 10000).cast("bigint").alias(name)


def _latest(prices: DataFrame) -> DataFrame:
    """The last offer of each product in each store."""
    order = [F.desc_nulls_last("updated_at"), F.desc("price"), F.desc_nulls_last("promo_price")]
    return relational.best_per_key(prices.filter("price IS NOT NULL"), ["product_id", "store_id"], order)


def _prices(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "product_prices", "product_id", "store_id", "price", "promo_price", "updated_at")


def _stores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "stores", F.col("id").alias("store_id"), "city", "chain_id")


@query(f"""SELECT q.item_code, s.id AS store, s.city, s.chain_id, CAST(l.price * 10000 AS BIGINT) AS price_e4, CAST(l.promo_price * 10000 AS BIGINT) AS promo_e4
    FROM products q JOIN {LATEST} l ON l.product_id = q.id JOIN stores s ON s.id = l.store_id
    WHERE q.item_code = (SELECT min(item_code) FROM products WHERE id IN (SELECT product_id FROM product_prices)) ORDER BY least(l.price, l.promo_price), s.id, q.id LIMIT 50""")
def offers_for_item(spark, folder):
    """One page of the offers of one item, the cheapest first."""
    products = table(spark, folder, "products", F.col("id").alias("product_id"), "item_code")
    sold = products.join(table(spark, folder, "product_prices", "product_id").distinct(), "product_id", "left_semi")
    wanted = products.filter(F.col("item_code") == sold.select(F.min("item_code")).scalar())
    offers = _latest(_prices(spark, folder).join(wanted, "product_id")).join(_stores(spark, folder), "store_id")
    shown = relational.page(offers, [F.least("price", "promo_price"), F.col("store_id"), F.col("product_id")], 0, 50)
    return shown.select("item_code", F.col("store_id").alias("store"), "city", "chain_id", _e4("price", "price_e4"), _e4("promo_price", "promo_e4"))


@query(f"""WITH popular AS (SELECT product_id, count(DISTINCT s.chain_id) AS chains FROM product_prices p JOIN stores s ON s.id = p.store_id WHERE p.price IS NOT NULL GROUP BY product_id),
    ranked AS (SELECT q.id, row_number() OVER (ORDER BY coalesce(chains, 0) DESC, q.item_code, q.id) AS rank_no FROM products q LEFT JOIN popular ON product_id = q.id WHERE list_contains({WORDS}, 'חלב'))
    SELECT r.id, r.rank_no, s.id AS store, s.city, CAST(l.price * 10000 AS BIGINT) AS price_e4 FROM ranked r JOIN {LATEST} l ON l.product_id = r.id JOIN stores s ON s.id = l.store_id WHERE r.rank_no <= 20 AND starts_with(s.city, 'ר')""")
def city_offers_for_search(spark, folder):
    """The best products of a search, then all their offers in the stores of some cities."""
    stores = _stores(spark, folder)
    priced = table(spark, folder, "product_prices", F.col("product_id").alias("id"), "store_id", "price").filter("price IS NOT NULL").select("id", "store_id").distinct()
    hits = table(spark, folder, "products", "id", "item_code", "item_name").filter(text.matches_all(text.tokens("item_name"), "חלב")).select("id", "item_code")
    chains = priced.join(hits.select("id"), "id", "left_semi").join(stores, "store_id").groupBy("id").agg(F.countDistinct("chain_id").alias("chains"))
    best = hits.join(chains, "id", "left").select("id", "item_code", F.coalesce("chains", F.lit(0)).alias("chains")).orderBy(F.desc("chains"), "item_code", "id").limit(20)
    ranked = best.withColumn("rank_no", F.row_number().over(Window.orderBy(F.desc("chains"), "item_code", "id")).cast("bigint"))  # twenty rows
    offers = _prices(spark, folder).join(ranked.select(F.col("id").alias("product_id"), "rank_no"), "product_id").join(stores.filter(F.startswith("city", F.lit("ר"))), "store_id")
    return _latest(offers).select(F.col("product_id").alias("id"), "rank_no", F.col("store_id").alias("store"), "city", _e4("price", "price_e4"))


@query(f"""SELECT c.store_db_id, c.item_code, c.promotion_id, s.city, CAST(l.price * 10000 AS BIGINT) AS price_e4, p.promotion_id IS NOT NULL AS is_listed
    FROM (SELECT DISTINCT store_db_id, chain_id, item_code, promotion_id FROM store_promotions_cache) c JOIN stores s ON s.id = c.store_db_id JOIN (SELECT item_code, min(id) AS id FROM products GROUP BY item_code) q ON q.item_code = c.item_code
    JOIN {LATEST} l ON l.product_id = q.id AND l.store_id = s.id LEFT JOIN (SELECT DISTINCT chain_id, promotion_id FROM promotions) p ON p.chain_id = c.chain_id AND p.promotion_id = c.promotion_id""")
def join_five_tables(spark, folder):
    cached = table(spark, folder, "store_promotions_cache", F.col("store_db_id").alias("store_id"), "chain_id", "item_code", "promotion_id").distinct()
    products = table(spark, folder, "products", "item_code", "id").groupBy("item_code").agg(F.min("id").alias("product_id"))
    wanted = cached.join(_stores(spark, folder).drop("chain_id"), "store_id").join(products, "item_code")
    listed = table(spark, folder, "promotions", "chain_id", "promotion_id").distinct().withColumn("is_listed", F.lit(True))
    priced = wanted.join(_latest(_prices(spark, folder)), ["product_id", "store_id"]).join(listed, ["chain_id", "promotion_id"], "left")
    return priced.select(F.col("store_id").alias("store_db_id"), "item_code", "promotion_id", "city", _e4("price", "price_e4"), F.coalesce("is_listed", F.lit(False)).alias("is_listed"))


@query("""WITH moments AS (SELECT DISTINCT product_id AS k, created_at AS t, 1 AS step FROM observations WHERE product_id IS NOT NULL AND created_at IS NOT NULL
        UNION ALL SELECT DISTINCT product_id, updated_at, -1 FROM product_prices WHERE product_id IN (SELECT product_id FROM observations) AND updated_at IS NOT NULL),
    walked AS (SELECT *, sum(step) OVER w AS waiting, count(*) FILTER (step = 1) OVER w AS lefts, count(*) FILTER (step = -1) OVER w AS rights FROM moments WINDOW w AS (PARTITION BY k ORDER BY t, step DESC ROWS UNBOUNDED PRECEDING)),
    wasted AS (SELECT *, least(min(waiting) OVER (PARTITION BY k ORDER BY t, step DESC ROWS UNBOUNDED PRECEDING), 0) AS low FROM walked),
    used AS (SELECT k, rights + low AS place, min(t) AS t FROM wasted WHERE step = -1 AND rights + low > 0 GROUP BY ALL)
    SELECT a.k AS product_id, epoch_us(a.t) AS at_us, epoch_us(u.t) AS match_us FROM wasted a LEFT JOIN used u ON u.k = a.k AND u.place = a.lefts WHERE a.step = 1""")
def join_asof_exclusive(spark, folder):
    """Each alert with the next price change of its product that no earlier alert took."""
    alerts = table(spark, folder, "observations", "product_id", "created_at").filter("product_id IS NOT NULL").distinct()
    changes = table(spark, folder, "product_prices", "product_id", "updated_at").join(alerts.select("product_id").distinct(), "product_id", "left_semi").distinct()
    found = relational.match_exclusive(alerts, changes, "product_id", "created_at", "updated_at")
    return found.select("product_id", F.unix_micros("created_at").alias("at_us"), F.unix_micros("updated_at").alias("match_us"))


@query("""SELECT choice, id, place FROM (SELECT choice, id, row_number() OVER (PARTITION BY choice ORDER BY CASE choice WHEN 'newest' THEN epoch_us(updated_at) END DESC NULLS LAST, CASE choice WHEN 'name' THEN store_name END NULLS LAST, id) AS place
    FROM stores, (VALUES ('newest'), ('name'), ('other')) c(choice)) WHERE place <= 30""")
def order_by_parameter(spark, folder):
    stores = table(spark, folder, "stores", "id", "store_name", "updated_at")
    orders = {"newest": [F.desc_nulls_last("updated_at"), F.col("id")], "name": [F.asc_nulls_last("store_name"), F.col("id")]}
    parts = []
    for choice in ("newest", "name", "other"):
        order = relational.chosen_order(choice, orders, [F.col("id")])
        first = stores.orderBy(*order).limit(30)
        parts.append(first.select(F.lit(choice).alias("choice"), "id", F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("place")))  # thirty rows
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT id, item_name, total, 60 < total AS has_more, CASE WHEN 60 < total THEN 60 END AS next_offset, 20 AS previous_offset FROM (SELECT *, count(*) OVER () AS total FROM products) ORDER BY item_name NULLS LAST, id OFFSET 40 LIMIT 20""")
def page_with_totals(spark, folder):
    return relational.page_info(table(spark, folder, "products", "id", "item_name"), [F.asc_nulls_last("item_name"), F.col("id")], 40, 20)


@query("SELECT product_id, store_id, CAST(price * 10000 AS BIGINT) AS price_e4, epoch_us(updated_at) AS at_us FROM product_prices ORDER BY product_id NULLS FIRST, store_id NULLS FIRST, updated_at, price NULLS FIRST OFFSET 500 LIMIT 500")
def scan_paged(spark, folder):
    """The second page of a whole table in a total order."""
    rows = relational.page(_prices(spark, folder), [F.asc_nulls_first(c) for c in ("product_id", "store_id", "updated_at", "price")], 500, 500, 500)
    return rows.select("product_id", "store_id", _e4("price", "price_e4"), F.unix_micros("updated_at").alias("at_us"))


@query("SELECT store_id, count(*) AS row_count FROM product_prices, (SELECT max(updated_at) - INTERVAL 30 DAY AS since FROM product_prices) WHERE updated_at >= since GROUP BY store_id")
def filter_since_latest(spark, folder):
    """Rows of the last thirty days before the newest one: a parameter of one row, as a scalar subquery."""
    rows = table(spark, folder, "product_prices", "store_id", "updated_at")
    since = table(spark, folder, "product_prices", "updated_at").select(F.max("updated_at") - F.expr("INTERVAL 30 DAYS")).scalar()
    return rows.filter(F.col("updated_at") >= since).groupBy("store_id").agg(F.count(F.lit(1)).alias("row_count"))


@query("""SELECT o.id, o.user_id, count(*) AS offers, CAST(min(p.price) * 10000 AS BIGINT) AS least_e4 FROM (SELECT DISTINCT id, user_id, product_id, city FROM observations) o JOIN stores s ON s.city = o.city
    JOIN (SELECT product_id, store_id, min(price) AS price FROM product_prices WHERE price IS NOT NULL GROUP BY ALL) p ON p.product_id = o.product_id AND p.store_id = s.id GROUP BY o.id, o.user_id, o.product_id, o.city""")
def join_city_stores(spark, folder):
    """Offers of a watched product in all stores of its city; prices are summed up by city first."""
    prices = _prices(spark, folder).filter("price IS NOT NULL").groupBy("product_id", "store_id").agg(F.min("price").alias("price"))
    by_city = prices.join(_stores(spark, folder), "store_id").groupBy("product_id", "city").agg(F.count(F.lit(1)).alias("offers"), F.min("price").alias("least"))
    alerts = table(spark, folder, "observations", "id", "user_id", "product_id", "city").distinct()
    return alerts.join(by_city, ["product_id", "city"]).select("id", "user_id", "offers", _e4("least", "least_e4"))


@query("SELECT event_type AS feature, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS used_count FROM events GROUP BY event_type")
def agg_feature_use(spark, folder):
    return table(spark, folder, "events", "event_type", "props").groupBy(F.col("event_type").alias("feature")).agg(F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("used_count"))


@query("SELECT id FROM products WHERE item_name SIMILAR TO '.*(חלב|שוקולד|milk).*'")
def filter_similar_to(spark, folder):
    return table(spark, folder, "products", "id", "item_name").filter(F.col("item_name").rlike("^(?:.*(חלב|שוקולד|milk).*)$")).select("id")


@query("""SELECT regexp_replace(file_name, '-[^-]*$', '') AS feed, max(file_name) AS latest FROM (SELECT DISTINCT 'price-' || store_id || '-' || strftime(updated_at AT TIME ZONE 'UTC', '%Y%m%d') || '.gz' AS file_name FROM product_prices WHERE store_id IS NOT NULL)
    WHERE contains(file_name, '-1') GROUP BY feed""")
def latest_files(spark, folder):
    rows = table(spark, folder, "product_prices", "store_id", "updated_at").filter("store_id IS NOT NULL")
    names = rows.select(F.concat(F.lit("price-"), "store_id", F.lit("-"), F.date_format("updated_at", "yyyyMMdd"), F.lit(".gz")).alias("file_name")).distinct()
    return feeds.latest_files(names, "-1")


@query("""SELECT coalesce(json_kind, 'no json') AS json_kind, count(*) AS row_count FROM (SELECT CASE json_type(CASE WHEN json_valid(items) THEN items END) WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' ELSE CASE WHEN json_valid(items) AND NOT contains(lower(items), 'nan') THEN 'number' END END AS json_kind FROM promotions) GROUP BY ALL""")
def json_kinds(spark, folder):
    rows = table(spark, folder, "promotions", "items")
    return rows.groupBy(F.coalesce(clean.json_kind("items"), F.lit("no json")).alias("json_kind")).agg(F.count(F.lit(1)).alias("row_count"))


ITEM_FIELDS = ["item_code", "item_name", "manufacturer_name", "unit_of_measure", "unit_qty", "promotion_id", "min_qty", "promo_kind", "promo_label", "chain_id"]
_FIELD_SQL = ", ".join(f"CASE WHEN trim({f}) <> '' THEN '\"{f.replace('_', '')}\":' || to_json(trim({f})) END" for f in ITEM_FIELDS)


@query(f"""SELECT item, count(*) AS row_count FROM (SELECT '{{' || array_to_string(list_filter([{_FIELD_SQL}], lambda x: x IS NOT NULL), ',') || '}}' AS item FROM top_promotions_cache) GROUP BY item""")
def item_from_row(spark, folder):
    """Items as JSON from flat rows, without empty fields."""
    rows = table(spark, folder, "top_promotions_cache", *ITEM_FIELDS)
    return rows.groupBy(folding.item_of({f.replace("_", ""): F.col(f) for f in ITEM_FIELDS}).alias("item")).agg(F.count(F.lit(1)).alias("row_count"))


@query()
def items_append_unique(spark, folder):
    """Items of each promotion's first version, and those of its last that are new."""
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at", "items")
    keys = ["chain_id", "promotion_id"]
    first = relational.best_per_key(rows, keys, [F.asc("updated_at"), F.col("items")])
    last = relational.best_per_key(rows, keys, [F.desc("updated_at"), F.col("items")])
    return folding.append_unique(first, last, keys)


@query(rf"""WITH words AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '') AS w FROM documents),
    counted AS (SELECT doc_id, len(list_filter(w, lambda t: t = 'price')) AS a, len(list_filter(w, lambda t: t = 'milk')) AS b FROM words)
    SELECT doc_id, CAST(floor((coalesce(list_sum(list_transform(range(1, a + 1), lambda i: CAST(1 AS DOUBLE) / (i * i))), 0) + coalesce(list_sum(list_transform(range(1, b + 1), lambda i: CAST(1 AS DOUBLE) / (i * i))), 0))
        * CAST(0.1 AS DOUBLE) / CAST(1.64493406685 AS DOUBLE) / 2 * 10000 + 0.5) AS BIGINT) AS rank_e4 FROM counted WHERE a + b > 0""")
def search_frequency_rank(spark, folder):
    """Documents with any of two words, by how often they occur."""
    words = text.tokens("text")
    rows = table(spark, folder, "documents", "doc_id", "text").withColumn("rank", text.frequency_rank(words, "price milk"))
    return rows.filter("rank > 0").select("doc_id", F.floor(F.col("rank") * 10000 + 0.5).alias("rank_e4"))


_GRAMS = "flatten(list_transform({0}, lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3))))"


@query(f"""WITH asked AS (SELECT list_distinct({_GRAMS.format("['shampoo', 'lavender']")}) AS q), names AS (SELECT id, {_GRAMS.format(WORDS)} AS g FROM products),
    stretches AS (SELECT id, list_distinct(g[a:b]) AS s FROM (SELECT id, g, unnest(range(1, len(g) + 1)) AS a FROM names), range(1, 400) r(b) WHERE b >= a AND b <= len(g)),
    scored AS (SELECT id, len(list_intersect(s, q))::DOUBLE / (len(s) + len(q) - len(list_intersect(s, q))) AS similarity FROM stretches, asked)
    SELECT id, CAST(floor(max(similarity) * 10000 + 0.5) AS BIGINT) AS similarity_e4 FROM scored GROUP BY id HAVING max(similarity) >= 0.4""")
def search_word_similarity(spark, folder):
    """Products of whose names some stretch is like the query."""
    rows = table(spark, folder, "products", "id", "item_name").withColumn("similarity", text.word_similarity("item_name", "shampoo lavender"))
    return rows.filter("similarity >= 0.4").select("id", F.floor(F.col("similarity") * 10000 + 0.5).alias("similarity_e4"))


@query(f"""SELECT q.id, count(*) AS stores, count(DISTINCT s.chain_id) AS chains, count(DISTINCT s.city) AS cities, CAST(min(l.price) * 10000 AS BIGINT) AS least_e4 FROM products q JOIN {LATEST} l ON l.product_id = q.id JOIN stores s ON s.id = l.store_id
    WHERE list_contains({WORDS}, 'שוקולד') GROUP BY q.id""")
def search_availability(spark, folder):
    """Where the products that a search finds are sold."""
    hits = table(spark, folder, "products", F.col("id").alias("product_id"), "item_name").filter(text.matches_all(text.tokens("item_name"), "שוקולד")).select("product_id")
    offers = _latest(_prices(spark, folder).join(hits, "product_id", "left_semi")).join(_stores(spark, folder), "store_id")
    found = offers.groupBy("product_id").agg(F.count(F.lit(1)).alias("stores"), F.countDistinct("chain_id").alias("chains"), F.countDistinct("city").alias("cities"), F.min("price").alias("least"))
    return found.select(F.col("product_id").alias("id"), "stores", "chains", "cities", _e4("least", "least_e4"))


@query("SELECT id, row_number() OVER (ORDER BY item_name NULLS LAST, item_code, id) AS place FROM products")
def win_number_all(spark, folder):
    """Every row's place in one order, numbered by as many tasks as there are range partitions."""
    rows = table(spark, folder, "products", "id", "item_name", "item_code")
    return ranking.rank_all(rows, [], [F.asc_nulls_last("item_name"), F.col("item_code"), F.col("id")], "place").select("id", "place")


@query("""SELECT store_id, item_code, promotion_id, CAST(smart_score * 10000 AS BIGINT) AS score_e4 FROM top_promotions_cache
    QUALIFY row_number() OVER (PARTITION BY store_id, item_code ORDER BY coalesce(is_conditional_promo, FALSE), smart_score DESC NULLS LAST, promotion_id NULLS FIRST) = 1""")
def win_prefer_unconditional(spark, folder):
    rows = table(spark, folder, "top_promotions_cache", "store_id", "item_code", "promotion_id", "smart_score", "is_conditional_promo")
    best = relational.best_per_key(rows, ["store_id", "item_code"], [F.coalesce("is_conditional_promo", F.lit(False)), F.desc_nulls_last("smart_score"), F.asc_nulls_first("promotion_id")])
    return best.select("store_id", "item_code", "promotion_id", _e4("smart_score", "score_e4"))


@query(f"""SELECT product_id, chain_id, store_id, CAST(price * 10000 AS BIGINT) AS price_e4 FROM {LATEST} JOIN stores ON id = product_prices.store_id QUALIFY row_number() OVER (PARTITION BY product_id, chain_id ORDER BY price, id) = 1""".replace("JOIN stores ON id = product_prices.store_id", "l JOIN (SELECT id, chain_id FROM stores) s ON s.id = l.store_id"))
def agg_best_store_per_chain(spark, folder):
    offers = _latest(_prices(spark, folder)).join(_stores(spark, folder), "store_id")
    best = offers.groupBy("product_id", "chain_id").agg(F.min(F.struct("price", "store_id")).alias("b"))
    return best.select("product_id", "chain_id", "b.store_id", _e4("b.price", "price_e4"))


@query("SELECT 'promotions' AS entity, count(DISTINCT promotion_id) AS distinct_count FROM store_promotions_cache UNION ALL SELECT 'items', count(DISTINCT item_code) FROM store_promotions_cache UNION ALL SELECT 'stores', count(DISTINCT store_db_id) FROM store_promotions_cache")
def agg_distinct_entities(spark, folder):
    """Distinct values of three columns from one pass over the table."""
    rows = table(spark, folder, "store_promotions_cache", "promotion_id", "item_code", F.col("store_db_id").cast("string").alias("store"))
    columns = {"promotions": "promotion_id", "items": "item_code", "stores": "store"}
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(n).alias("entity"), F.col(c).alias("v")) for n, c in columns.items()])).alias("x")).select("x.entity", "x.v")
    return long.distinct().groupBy("entity").agg(F.count("v").alias("distinct_count"))


@query("SELECT chain_id, count(*) AS row_count, count(DISTINCT store_db_id) AS stores, string_agg(DISTINCT promo_kind, ',' ORDER BY promo_kind) AS kinds FROM store_promotions_cache GROUP BY chain_id")
def agg_description_rollup(spark, folder):
    rows = table(spark, folder, "store_promotions_cache", "chain_id", "store_db_id", "promo_kind")
    some = rows.groupBy("chain_id", "store_db_id", "promo_kind").agg(F.count(F.lit(1)).alias("n"))
    return some.groupBy("chain_id").agg(F.sum("n").alias("row_count"), F.countDistinct("store_db_id").alias("stores"), F.nullif(F.array_join(F.array_sort(F.collect_set("promo_kind")), ","), F.lit("")).alias("kinds"))


@query("""SELECT s.id, coalesce(p.n, 0) AS prices, coalesce(c.n, 0) AS cached, p.n IS NULL AND c.n IS NULL AS is_idle FROM stores s LEFT JOIN (SELECT store_id, count(*) AS n FROM product_prices GROUP BY store_id) p ON p.store_id = s.id
    LEFT JOIN (SELECT store_db_id, count(*) AS n FROM store_promotions_cache GROUP BY store_db_id) c ON c.store_db_id = s.id""")
def join_store_counts(spark, folder):
    prices = table(spark, folder, "product_prices", F.col("store_id").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("prices"))
    cached = table(spark, folder, "store_promotions_cache", F.col("store_db_id").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("cached"))
    joined = table(spark, folder, "stores", "id").join(prices, "id", "left").join(cached, "id", "left")
    return joined.select("id", F.coalesce("prices", F.lit(0)).alias("prices"), F.coalesce("cached", F.lit(0)).alias("cached"), (F.col("prices").isNull() & F.col("cached").isNull()).alias("is_idle"))


@query("""SELECT band, count(*) AS row_count, CAST(sum(gap) * 10000 AS BIGINT) AS gap_e4, CAST(max(higher) * 10000 AS BIGINT) AS most_e4 FROM (SELECT abs(price - promo_price) AS gap, greatest(price, promo_price) AS higher, least(price, promo_price) AS lower FROM product_prices) x,
    LATERAL (SELECT CASE WHEN x.gap IS NULL THEN 'none' WHEN x.gap < 5 THEN 'small' ELSE 'large' END AS band) GROUP BY band""")
def join_computed_columns(spark, folder):
    """Columns computed from columns computed before, then grouped by."""
    rows = table(spark, folder, "product_prices", "price", "promo_price")
    rows = rows.select(F.abs(F.col("price") - F.col("promo_price")).alias("gap"), F.greatest("price", "promo_price").alias("higher"))
    band = clean.first_rule([(F.col("gap").isNull(), "none"), (F.col("gap") < 5, "small")], "large")
    return rows.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("row_count"), (F.sum("gap") * 10000).cast("bigint").alias("gap_e4"), (F.max("higher") * 10000).cast("bigint").alias("most_e4"))


@query("""SELECT id, CASE WHEN lower(trim(store_type)) IN ('1', 'online') THEN 'online' WHEN trim(store_type) = '' OR store_type IS NULL THEN 'unknown' WHEN regexp_matches(store_type, '[0-9]') THEN 'numbered' ELSE lower(trim(store_type)) END AS label FROM stores""")
def update_relabel(spark, folder):
    kind = F.lower(F.trim("store_type"))
    rules = [(kind.isin("1", "online"), "online"), ((kind == "") | kind.isNull(), "unknown"), (F.col("store_type").rlike("[0-9]"), "numbered")]
    return table(spark, folder, "stores", "id", "store_type").select("id", clean.first_rule(rules, kind).alias("label"))


@query("""WITH best AS (SELECT store_db_id, item_code, max(discount_amount) AS amount FROM store_promotions_cache WHERE discount_amount IS NOT NULL GROUP BY ALL),
    keepers AS (SELECT store_db_id, item_code FROM best QUALIFY row_number() OVER (PARTITION BY store_db_id ORDER BY amount DESC, item_code) <= 3)
    SELECT c.store_db_id, count(*) AS goes FROM store_promotions_cache c WHERE NOT EXISTS (SELECT 1 FROM keepers k WHERE k.store_db_id = c.store_db_id AND k.item_code = c.item_code) GROUP BY c.store_db_id""")
def delete_but_keepers(spark, folder):
    """How many rows go when only the items of the greatest savings of each store are kept."""
    rows = table(spark, folder, "store_promotions_cache", "store_db_id", "item_code", "discount_amount")
    best = rows.filter("discount_amount IS NOT NULL").groupBy("store_db_id", "item_code").agg(F.max("discount_amount").alias("amount"))
    keepers = relational.top_per_key(best, ["store_db_id"], [F.desc("amount"), F.col("item_code")], 3)
    _, goes = merge.delete_but(rows, keepers, ["store_db_id", "item_code"])
    return goes.groupBy("store_db_id").agg(F.count(F.lit(1)).alias("goes"))


@query("SELECT id, item_code FROM products WHERE (id, has_image) NOT IN (VALUES (1, TRUE), (2, FALSE), (4, TRUE)) OR has_image IS NULL")
def delete_listed(spark, folder):
    """Rows without those that a list given as JSON names."""
    listed = feeds.array_argument(spark, '[{"id": 1, "has_image": true}, {"id": 2, "has_image": false}, {"id": 4, "has_image": true}]', "id bigint, has_image boolean")
    stays, _ = merge.delete_listed(table(spark, folder, "products", "id", "item_code", "has_image"), listed, ["id", "has_image"])
    return stays.select("id", "item_code")


@query("""SELECT 'stores' AS table_name, count(*) FILTER (chain_name IS NULL) AS goes, count(*) FILTER (chain_name IS NOT NULL) AS stays FROM stores
    UNION ALL SELECT 'top_promotions_cache', count(*) FILTER (scope_type <> 'city' OR window_hours <> 24), count(*) FILTER (NOT coalesce(scope_type <> 'city' OR window_hours <> 24, FALSE)) FROM top_promotions_cache""")
def delete_where_counts(spark, folder):
    """Rows without a chain, and cache rows of other scopes or windows."""
    cache = (F.col("scope_type") != "city") | (F.col("window_hours") != 24)
    parts = []
    for name, df, condition in (("stores", table(spark, folder, "stores", "chain_name"), F.col("chain_name").isNull()), ("top_promotions_cache", table(spark, folder, "top_promotions_cache", "scope_type", "window_hours"), cache)):
        stays, goes = merge.delete_where(df, condition)
        parts.append(goes.agg(F.count(F.lit(1)).alias("goes"), F.lit(0).cast("bigint").alias("stays")).unionByName(stays.agg(F.lit(0).cast("bigint").alias("goes"), F.count(F.lit(1)).alias("stays"))).withColumn("table_name", F.lit(name)))
    return parts[0].unionByName(parts[1]).groupBy("table_name").agg(F.sum("goes").alias("goes"), F.sum("stays").alias("stays"))


@query("""SELECT strftime(updated_at AT TIME ZONE 'UTC', '%Y-%m') AS month_key, count(*) AS row_count, count(DISTINCT product_id) AS products, count(DISTINCT store_id) AS stores, count(*) FILTER (price IS NULL) AS without_price, count(*) FILTER (promo_price < price) AS promoted,
    epoch_us(max(updated_at)) AS latest_us FROM product_prices GROUP BY month_key""")
def ingest_report(spark, folder):
    """What came in each month. Rows are counted by month, product and store first, so no key is counted in one task."""
    rows = _prices(spark, folder).withColumn("month_key", F.date_format("updated_at", "yyyy-MM"))
    some = rows.groupBy("month_key", "product_id", "store_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("price").isNull()).alias("without_price"), F.count_if(F.col("promo_price") < F.col("price")).alias("promoted"), F.max("updated_at").alias("latest"))
    return some.groupBy("month_key").agg(
        F.sum("n").alias("row_count"), F.countDistinct("product_id").alias("products"), F.countDistinct("store_id").alias("stores"), F.sum("without_price").alias("without_price"), F.sum("promoted").alias("promoted"), F.unix_micros(F.max("latest")).alias("latest_us")
    )


@query(r"SELECT doc_id FROM documents WHERE contains(regexp_replace(lower(source), '[^\p{L}\p{N}]', '', 'g'), 'pricereports')")
def filter_normalised_substring(spark, folder):
    """Rows whose source holds a name, compared by letters and digits alone."""
    return table(spark, folder, "documents", "doc_id", "source").filter(F.contains(clean.letters_and_digits("source"), F.lit("pricereports"))).select("doc_id")


@query("""WITH rows AS (SELECT product_id, price, promo_price, updated_at >= TIMESTAMPTZ '2025-04-01 00:00:00+00' AS is_new FROM product_prices WHERE price IS NOT NULL AND product_id IS NOT NULL AND updated_at IS NOT NULL),
    sides AS (SELECT product_id, is_new, CAST(CASE WHEN is_new THEN max(price) ELSE min(price) END * 10000 AS BIGINT) AS price_e4, bool_or(is_new AND coalesce(promo_price < price, FALSE)) AS is_promoted FROM rows GROUP BY product_id, is_new)
    SELECT product_id, price_e4, is_promoted FROM sides QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY is_new DESC) = 1""")
def upsert_json_prices(spark, folder):
    """Prices sent as JSON text, with decimal commas and words for flags, read with guards and merged into those held."""
    rows = _prices(spark, folder).filter("price IS NOT NULL AND product_id IS NOT NULL AND updated_at IS NOT NULL")
    is_new = F.unix_micros("updated_at") >= 1_743_465_600_000_000  # 2025-04-01
    held = rows.filter(~is_new).groupBy("product_id").agg(F.min("price").alias("price")).withColumn("is_promoted", F.lit(False))
    sent = rows.filter(is_new).groupBy("product_id").agg(F.max("price").alias("price"), F.bool_or(F.coalesce(F.col("promo_price") < F.col("price"), F.lit(False))).alias("promoted"))
    comma = F.replace(F.col("price").cast("string"), F.lit("."), F.lit(","))
    texts = sent.select(F.to_json(F.struct(F.col("product_id").cast("string").alias("id"), comma.alias("price"), F.when(F.col("promoted"), "Yes").otherwise("no").alias("flag"))).alias("value"))
    part = lambda k: F.get_json_object("value", f"$.{k}")
    incoming = texts.select(clean.clean_id(part("id")).try_cast("bigint").alias("product_id"), clean.parse_number(part("price")).alias("price"), clean.parse_bool(part("flag"), False).alias("is_promoted"))
    return merge.upsert(held, incoming.filter("product_id IS NOT NULL"), ["product_id"]).select("product_id", _e4("price", "price_e4"), "is_promoted")

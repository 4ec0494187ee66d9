"""Queries of value cleaning, nested values, text search and streams, with SQL where SQL has the operation."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import checkpoint_root
from ..functions import clean, text
from ..operators import folding, relational, search, shred
from ..sources import feeds
from ..sources.tables import table
from ..streaming import feeds as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _chain_counts(spark: SparkSession, folder: str) -> DataFrame:
    prices = table(spark, folder, "product_prices", F.col("product_id").alias("id"), "store_id", "price").filter("price IS NOT NULL").select("id", "store_id").distinct()
    stores = table(spark, folder, "stores", F.col("id").alias("store_id"), "chain_id")
    return prices.join(stores, "store_id").groupBy("id").agg(F.countDistinct("chain_id").alias("chain_count"))


@query(r"""SELECT id, regexp_replace(trim(coalesce(item_code, ''), E' \t\r\n'), '\.0$', '') AS cleaned, CASE WHEN regexp_full_match(trim(item_code, E' \t\r\n'), '[0-9]+') THEN coalesce(nullif(ltrim(trim(item_code, E' \t\r\n'), '0'), ''), '0') ELSE trim(item_code, E' \t\r\n') END AS plain FROM products""")
def clean_ids(spark, folder):
    return table(spark, folder, "products", "id", "item_code").select("id", clean.clean_id("item_code").alias("cleaned"), clean.plain_digits("item_code").alias("plain"))


@query(r"""SELECT chain_id, promotion_id, epoch_us(updated_at) AS at_us,
    CAST(CASE WHEN regexp_full_match(replace(trim(discounted_price), ',', '.'), '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(replace(trim(discounted_price), ',', '.') AS DECIMAL(18,4)) END * 10000 AS BIGINT) AS price_e4,
    CAST(CASE WHEN regexp_full_match(min_qty, '\s*-?[0-9]+(\.[0-9]+)?\s*') THEN TRY_CAST(trim(min_qty) AS DECIMAL(18,4)) END * 10000 AS BIGINT) AS qty_e4 FROM promotions""")
def parse_numbers(spark, folder):
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at", "discounted_price", "min_qty")
    e4 = lambda c: (c * 10000).cast("bigint")
    return rows.select("chain_id", "promotion_id", F.unix_micros("updated_at").alias("at_us"), e4(clean.parse_number("discounted_price")).alias("price_e4"), e4(clean.guarded_number("min_qty")).alias("qty_e4"))


@query("""SELECT lower(trim(additional_is_coupon)) AS written, CASE WHEN lower(trim(additional_is_coupon)) IN ('1', 'true', 't', 'yes', 'y') THEN TRUE WHEN lower(trim(additional_is_coupon)) IN ('0', 'false', 'f', 'no', 'n') THEN FALSE END AS read_as, count(*) AS row_count FROM promotions GROUP BY ALL""")
def parse_bools(spark, folder):
    rows = table(spark, folder, "promotions", "additional_is_coupon")
    return rows.groupBy(F.lower(clean.trimmed("additional_is_coupon")).alias("written"), clean.parse_bool("additional_is_coupon").alias("read_as")).agg(F.count(F.lit(1)).alias("row_count"))


@query("""SELECT form, count(*) AS row_count, count(DISTINCT day) AS days, strftime(min(day), '%Y-%m-%d') AS first_day FROM (
    SELECT form, CAST(promotion_start_date AS DATE) AS day FROM promotions, (VALUES ('iso'), ('slashes'), ('digits'), ('dots')) f(form)) GROUP BY form""")
def parse_dates(spark, folder):
    day = F.col("promotion_start_date")
    forms = {"iso": "yyyy-MM-dd", "slashes": "dd/MM/yyyy", "digits": "yyyyMMdd", "dots": "dd.MM.yyyy"}
    written = table(spark, folder, "promotions", "promotion_start_date").select(F.explode(F.map_from_arrays(F.array(*map(F.lit, forms)), F.array(*[F.date_format(day, p) for p in forms.values()]))).alias("form", "written"))
    return written.groupBy("form").agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(clean.parse_date("written")).alias("days"), F.date_format(F.min(clean.parse_date("written")), "yyyy-MM-dd").alias("first_day"))


@query("""SELECT s_suppkey, upper(regexp_replace(regexp_replace(camel, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS snake
    FROM (SELECT s_suppkey, replace(s_name, '#', 'FileNo') AS camel FROM supplier)""".replace("\\\\", "\\"))
def camel_to_snake(spark, folder):
    return table(spark, folder, "supplier", "s_suppkey", "s_name").select("s_suppkey", clean.upper_snake(F.replace("s_name", F.lit("#"), F.lit("FileNo"))).alias("snake"))


@query("""SELECT doc_id, regexp_replace(lower(coalesce(source, '')), '[^a-z0-9א-ת]', '', 'g') AS source_key, substring(sha256(coalesce(item_code, '')), 1, 12) AS code_hash,
    replace(replace(replace(replace(replace(substring(chain_id || '<' || coalesce(source, '') || '>', 1, 80), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped FROM documents""")
def text_keys(spark, folder):
    rows = table(spark, folder, "documents", "doc_id", "source", "item_code", "chain_id")
    source = F.coalesce("source", F.lit(""))
    shown = F.concat("chain_id", F.lit("<"), source, F.lit(">"))
    return rows.select("doc_id", F.regexp_replace(F.lower(source), "[^a-z0-9א-ת]", "").alias("source_key"), F.substring(F.sha2(F.coalesce("item_code", F.lit("")), 256), 1, 12).alias("code_hash"), clean.html_escaped(shown).alias("escaped"))


@query("""SELECT id, coalesce(nullif(trim(chain_name), ''), chain_id) AS shown_name, coalesce(nullif(trim(city), ''), 'Online') AS shown_city FROM stores""")
def name_fallback(spark, folder):
    rows = table(spark, folder, "stores", "id", "chain_name", "chain_id", "city")
    return rows.select("id", F.coalesce(F.nullif(F.trim("chain_name"), F.lit("")), "chain_id").alias("shown_name"), F.coalesce(F.nullif(F.trim("city"), F.lit("")), F.lit("Online")).alias("shown_city"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS missing FROM events""")
def json_extract(spark, folder):
    rows = table(spark, folder, "events", "event_id", "props")
    return rows.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.get_json_object("props", "$.none").alias("missing"))


@query("""SELECT chain_id, promotion_id, n AS store_place, trim(available_in_store_ids[n]) AS store_no FROM (SELECT chain_id, promotion_id, available_in_store_ids, unnest(range(1, len(available_in_store_ids) + 1)) AS n FROM promotions)
    WHERE trim(available_in_store_ids[n]) <> ''""")
def array_with_places(spark, folder):
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "available_in_store_ids")
    return rows.select("chain_id", "promotion_id", F.posexplode("available_in_store_ids").alias("p", "s")).filter("trim(s) <> ''").select("chain_id", "promotion_id", (F.col("p") + 1).cast("bigint").alias("store_place"), F.trim("s").alias("store_no"))


@query("""WITH entries AS (SELECT chain_id, promotion_id, updated_at, unnest(map_entries(store_promotions), recursive := true) FROM promotions)
    SELECT chain_id, promotion_id, key AS store_no, value AS latest_value FROM entries WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chain_id, promotion_id, key ORDER BY updated_at DESC NULLS LAST, value DESC) = 1""")
def map_merge(spark, folder):
    """Map entries over all versions: the latest value of each key, of values at one time the greatest."""
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at", "store_promotions")
    entries = rows.select("chain_id", "promotion_id", "updated_at", F.explode("store_promotions").alias("store_no", "value")).filter("value IS NOT NULL")
    return entries.groupBy("chain_id", "promotion_id", "store_no").agg(F.max(F.struct("updated_at", "value"))["value"].alias("latest_value"))


_CODE_SQL = ", ".join(f"nullif(trim(item ->> '{k}'), '')" for k in folding.CODE_KEYS)


@query(f"""WITH versions AS (SELECT *, row_number() OVER (PARTITION BY chain_id, promotion_id ORDER BY updated_at NULLS FIRST, items NULLS FIRST) AS a, row_number() OVER (PARTITION BY chain_id, promotion_id ORDER BY updated_at DESC NULLS LAST, items NULLS FIRST) AS b FROM promotions),
    sides AS (SELECT chain_id, promotion_id, 0 AS side, items FROM versions WHERE a = 1 UNION ALL SELECT chain_id, promotion_id, 1, items FROM versions WHERE b = 1),
    lists AS (SELECT chain_id, promotion_id, side, from_json(CASE WHEN json_valid(items) THEN CASE WHEN json_type(items) = 'ARRAY' THEN items END END, '["JSON"]') AS listed FROM sides),
    entries AS (SELECT chain_id, promotion_id, side, unnest(listed) AS item, unnest(range(len(listed))) AS place FROM lists),
    coded AS (SELECT *, coalesce({_CODE_SQL}) AS code, coalesce({_CODE_SQL}, CAST(item AS VARCHAR)) AS item_key FROM entries WHERE json_type(item) <> 'NULL'),
    kept AS (SELECT * FROM coded QUALIFY row_number() OVER (PARTITION BY chain_id, promotion_id, item_key ORDER BY side DESC, place) = 1),
    merged AS (SELECT chain_id, promotion_id, count(*) AS item_count, string_agg(coalesce(code, '?'), ',' ORDER BY side, place) AS codes FROM kept GROUP BY ALL)
    SELECT k.chain_id, k.promotion_id, coalesce(item_count, 0) AS item_count, coalesce(codes, '') AS codes FROM (SELECT DISTINCT chain_id, promotion_id FROM promotions) k LEFT JOIN merged m ON m.chain_id = k.chain_id AND m.promotion_id = k.promotion_id""")
def items_merge(spark, folder):
    """Items of each promotion's first version merged with those of its last, shown by their codes."""
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at", "items")
    keys = ["chain_id", "promotion_id"]
    first = relational.best_per_key(rows, keys, [F.asc("updated_at"), F.col("items")])
    last = relational.best_per_key(rows, keys, [F.desc("updated_at"), F.col("items")])
    merged = folding.merge_items(first, last, keys).withColumn("listed", F.from_json("items", "array<string>"))
    code = F.transform("listed", lambda i: F.coalesce(folding.item_code(i), F.lit("?")))
    return merged.select(*keys, F.size("listed").cast("bigint").alias("item_count"), F.array_join(code, ",").alias("codes"))


@query("""WITH turns AS (SELECT *, row_number() OVER (PARTITION BY chain_id, promotion_id ORDER BY updated_at NULLS FIRST, promotion_description NULLS FIRST, min_qty NULLS FIRST) AS turn FROM promotions),
    scalars AS (SELECT chain_id, promotion_id, arg_min(promotion_description, turn) FILTER (trim(promotion_description) <> '') AS promotion_description, arg_min(min_qty, turn) FILTER (trim(min_qty) <> '') AS min_qty, coalesce(bool_or(is_weighted_promo), FALSE) AS is_weighted_promo, count(*) AS folded_rows FROM turns GROUP BY ALL),
    entries AS (SELECT chain_id, promotion_id, turn, unnest(map_entries(store_promotions), recursive := true) FROM turns),
    maps AS (SELECT chain_id, promotion_id, string_agg(key || '=' || coalesce(v, ''), ',' ORDER BY key) AS map_text FROM (SELECT chain_id, promotion_id, key, last(value ORDER BY turn) AS v FROM entries GROUP BY ALL) GROUP BY ALL),
    stores AS (SELECT chain_id, promotion_id, string_agg(s, ',' ORDER BY s) AS store_text FROM (SELECT DISTINCT chain_id, promotion_id, unnest(available_in_store_ids) AS s FROM promotions) WHERE s IS NOT NULL GROUP BY ALL)
    SELECT * FROM scalars LEFT JOIN maps USING (chain_id, promotion_id) LEFT JOIN stores USING (chain_id, promotion_id)""")
def promotion_fold(spark, folder):
    """All versions of a promotion folded into one row; maps and arrays shown as text."""
    columns = ["chain_id", "promotion_id", "updated_at", "promotion_description", "min_qty", "is_weighted_promo", "store_promotions", "available_in_store_ids"]
    rows = table(spark, folder, "promotions", *columns).withColumn("turn", F.struct("updated_at", "promotion_description", "min_qty"))
    folded = folding.fold_rows(rows, ["chain_id", "promotion_id"], "turn", ["promotion_description", "min_qty"], ["is_weighted_promo"], ["store_promotions"], ["available_in_store_ids"])
    pairs = F.transform(F.map_entries("store_promotions"), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return folded.select("chain_id", "promotion_id", "promotion_description", "min_qty", "is_weighted_promo", "folded_rows", F.array_join(F.nullif(pairs, F.array().cast("array<string>")), ",").alias("map_text"), F.array_join("available_in_store_ids", ",").alias("store_text"))


@query()
def json_level_columns(spark, folder):
    """Every leaf of the nested items with its repetition and definition levels."""
    return shred.level_columns(table(spark, folder, "promotions", "chain_id", "promotion_id", "items"), ["chain_id", "promotion_id"], "items")


@query(r"""WITH words AS (SELECT id, item_code, list_filter(string_split_regex(lower(coalesce(item_name, '') || ' ' || coalesce(manufacturer_name, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM products),
    popular AS (SELECT product_id, count(DISTINCT s.chain_id) AS chains FROM product_prices p JOIN stores s ON s.id = p.store_id WHERE p.price IS NOT NULL GROUP BY product_id)
    SELECT q.id, q.item_code, coalesce(chains, 0) AS chains FROM words q LEFT JOIN popular ON product_id = q.id WHERE list_contains(w, 'חלב') AND list_contains(w, 'מעדן')
    ORDER BY chains DESC, q.item_code, q.id LIMIT 50""")
def search_match(spark, folder):
    words = text.tokens(F.concat_ws(" ", F.coalesce("item_name", F.lit("")), F.coalesce("manufacturer_name", F.lit(""))))
    hits = table(spark, folder, "products", "id", "item_code", "item_name", "manufacturer_name").filter(text.matches_all(words, "מעדן חלב")).select("id", "item_code")
    chains = _chain_counts(spark, folder).withColumnRenamed("chain_count", "chains")
    ranked = hits.join(chains, "id", "left").select("id", "item_code", F.coalesce("chains", F.lit(0)).alias("chains"))
    return ranked.orderBy(F.desc("chains"), "item_code", "id").limit(50)


@query(r"""WITH words AS (SELECT id, item_code, coalesce(item_name, '') AS n, coalesce(manufacturer_name, '') AS m, list_filter(string_split_regex(lower(coalesce(item_name, '') || ' ' || coalesce(manufacturer_name, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM products),
    popular AS (SELECT product_id, count(DISTINCT s.chain_id) AS chains FROM product_prices p JOIN stores s ON s.id = p.store_id WHERE p.price IS NOT NULL GROUP BY product_id)
    SELECT q.id, coalesce(chains, 0) AS chain_count, CAST(floor((len(list_filter(w, lambda t: t = 'שוקולד')) * CAST(0.1 AS DOUBLE) + ln(1 + coalesce(chains, 0)) * CAST(0.2 AS DOUBLE) + least(coalesce(chains, 0), 20) * CAST(0.03 AS DOUBLE)) * 1000 + 0.5) AS BIGINT) AS rank_e3
    FROM words q LEFT JOIN popular ON product_id = q.id WHERE list_contains(w, 'שוקולד') OR contains(lower(n), 'שוקולד') OR contains(lower(m), 'שוקולד')""")
def search_ranked(spark, folder):
    products = table(spark, folder, "products", "id", "item_code", "item_name", "manufacturer_name")
    found = search.search_ranked(products, _chain_counts(spark, folder), "שוקולד")
    return found.select("id", "chain_count", F.floor(F.col("search_rank") * 1000 + 0.5).alias("rank_e3"))


@query(r"""WITH words AS (SELECT id, item_name, coalesce(item_name, '') AS n, coalesce(manufacturer_name, '') AS m, list_filter(string_split_regex(lower(coalesce(item_name, '') || ' ' || coalesce(manufacturer_name, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w,
        list_filter(string_split_regex(lower(coalesce(item_name, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS nw FROM products),
    popular AS (SELECT product_id, count(DISTINCT s.chain_id) AS chains FROM product_prices p JOIN stores s ON s.id = p.store_id WHERE p.price IS NOT NULL GROUP BY product_id),
    first_stage AS (SELECT id, len(list_filter(w, lambda t: t = 'שוקלד')) * CAST(0.1 AS DOUBLE) AS density FROM words WHERE list_contains(w, 'שוקלד') OR contains(lower(n), 'שוקלד') OR contains(lower(m), 'שוקלד')),
    grams AS (SELECT DISTINCT id, substring('  ' || t || ' ', i, 3) AS g FROM (SELECT id, unnest(nw) AS t FROM words) x, range(1, 40) r(i) WHERE i <= length(t) + 1),
    asked AS (SELECT DISTINCT substring('  ' || t || ' ', i, 3) AS g FROM (VALUES ('שוקלד')) q(t), range(1, 40) r(i) WHERE i <= length(t) + 1),
    shared AS (SELECT id, count(*) FILTER (g IN (SELECT g FROM asked))::DOUBLE / (count(*) + (SELECT count(*) FROM asked) - count(*) FILTER (g IN (SELECT g FROM asked))) AS density FROM grams GROUP BY id),
    second_stage AS (SELECT id, density FROM shared WHERE density >= 0.2 AND id NOT IN (SELECT id FROM first_stage) AND (SELECT count(*) FROM first_stage) < 5),
    found AS (SELECT id, 'words' AS stage, density FROM first_stage UNION ALL SELECT id, 'similar', density FROM second_stage)
    SELECT f.id, f.stage, coalesce(chains, 0) AS chain_count, CAST(floor((f.density + ln(1 + coalesce(chains, 0)) * CAST(0.2 AS DOUBLE) + least(coalesce(chains, 0), 20) * CAST(0.03 AS DOUBLE)) * 1000 + 0.5) AS BIGINT) AS rank_e3 FROM found f LEFT JOIN popular ON product_id = f.id""")
def search_two_stage(spark, folder):
    """A misspelt query: too few hits by words, so similar names follow."""
    products = table(spark, folder, "products", "id", "item_code", "item_name", "manufacturer_name")
    found = search.two_stage_search(products, _chain_counts(spark, folder), "שוקלד", 5, 0.2)
    return found.select("id", "stage", "chain_count", F.floor(F.col("search_rank") * 1000 + 0.5).alias("rank_e3"))


@query(r"""WITH words AS (SELECT id, list_filter(string_split_regex(lower(coalesce(item_name, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM products)
    SELECT id FROM words WHERE (list_contains(w, 'שוקולד') OR list_contains(w, 'chocolate')) AND NOT list_contains(w, 'מריר')""")
def search_web(spark, folder):
    return table(spark, folder, "products", "id", "item_name").filter(text.matches_web(text.tokens("item_name"), "שוקולד OR chocolate -מריר")).select("id")


@query(r"""WITH words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM documents)),
    steps AS (SELECT doc_id, i, word, lag(word) OVER w AS before, lag(i) OVER w AS prev FROM words WHERE word IN ('price', 'lists') WINDOW w AS (PARTITION BY doc_id ORDER BY i))
    SELECT doc_id, CAST(floor(sum(CAST(0.1 AS DOUBLE) / (1 + (i - prev - 1))) * 10000 + 0.5) AS BIGINT) AS density_e4 FROM steps WHERE before <> word GROUP BY doc_id""")
def search_cover_density(spark, folder):
    """Documents that hold both words, by cover density."""
    words = text.tokens("text")
    hits = table(spark, folder, "documents", "doc_id", "text").filter(text.matches_all(words, "price lists"))
    return hits.select("doc_id", F.floor(text.cover_density(words, "price lists").cast("double") * 10000 + 0.5).alias("density_e4"))


@query(r"""WITH words AS (SELECT id, list_filter(string_split_regex(lower(coalesce(item_name, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM products),
    grams AS (SELECT DISTINCT id, substring('  ' || t || ' ', i, 3) AS g FROM (SELECT id, unnest(w) AS t FROM words) x, range(1, 40) r(i) WHERE i <= length(t) + 1),
    asked AS (SELECT DISTINCT substring('  ' || t || ' ', i, 3) AS g FROM (VALUES ('chocolate'), ('dark')) q(t), range(1, 40) r(i) WHERE i <= length(t) + 1),
    shared AS (SELECT id, count(*) AS n, count(*) FILTER (g IN (SELECT g FROM asked)) AS common FROM grams GROUP BY id)
    SELECT id, floor(common::DOUBLE / (n + (SELECT count(*) FROM asked) - common) * 10000 + 0.5) / 10000 AS similarity FROM shared WHERE common::DOUBLE / (n + (SELECT count(*) FROM asked) - common) >= 0.15""")
def search_similar(spark, folder):
    rows = table(spark, folder, "products", "id", "item_name").withColumn("s", text.trigram_similarity("item_name", F.lit("chocolate dark")))
    return rows.filter("s >= 0.15").select("id", clean.half_up("s", 4).alias("similarity"))


@query("""SELECT 'products' AS table_name, count(*) AS row_count, epoch_us(min(created_at)) AS first_us, epoch_us(max(created_at)) AS last_us FROM products
    UNION ALL SELECT 'stores', count(*), epoch_us(min(created_at)), epoch_us(max(created_at)) FROM stores UNION ALL SELECT 'product_prices', count(*), epoch_us(min(updated_at)), epoch_us(max(updated_at)) FROM product_prices
    UNION ALL SELECT 'documents', count(*), epoch_us(min(published_at)), epoch_us(max(published_at)) FROM documents""")
def table_profile(spark, folder):
    at = {"products": "created_at", "stores": "created_at", "product_prices": "updated_at", "documents": "published_at"}
    profile = feeds.table_profile({n: table(spark, folder, n, c) for n, c in at.items()}, at)
    return profile.select("table_name", "row_count", F.unix_micros("first_at").alias("first_us"), F.unix_micros("last_at").alias("last_us"))


def _us(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in columns})


def _event_files(spark: SparkSession, folder: str, files: int = 40) -> DataFrame:
    """The events as a stream of that many files, of which a trigger takes seven."""
    rows = table(spark, folder, "events", "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    path = f"{checkpoint_root(spark)}/events-{uuid.uuid4().hex}"
    rows.repartition(files, "event_id").write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 7).parquet(path)


def _closed(spark: SparkSession, events: DataFrame, windows: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """All windows of a stream in append mode: a last record far ahead moves the watermark, so each window closes and its state goes."""
    path = f"{checkpoint_root(spark)}/last-{uuid.uuid4().hex}"
    last = spark.createDataFrame([(-1, -1, "last")], "event_id long, user_id long, event_type string").withColumn("ts", F.lit("2100-01-01").cast("timestamp")).select(*events.columns)
    last.limit(0).write.parquet(path)
    both = events.unionByName(spark.readStream.schema(last.schema).parquet(path))
    closed = streams.run_to_end(windows(both), name, "append", lambda: last.write.mode("append").parquet(path))
    return _us(closed.filter("window_end < timestamp'2099-01-01'"), "window_start", "window_end")


@query("""SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS window_start, epoch_us(time_bucket(INTERVAL 1 DAY, ts)) + 86400000000 AS window_end, event_type, count(*) AS events FROM events GROUP BY ALL""")
def stream_tumbling(spark, folder):
    return _closed(spark, _event_files(spark, folder), lambda e: streams.window_counts(e, "ts", ["event_type"], "1 day", late="40 days"), "tumbling")


@query("""SELECT epoch_us(s) AS window_start, epoch_us(s) + 172800000000 AS window_end, count(*) AS events FROM (SELECT unnest([time_bucket(INTERVAL 1 DAY, ts), time_bucket(INTERVAL 1 DAY, ts) - INTERVAL 1 DAY]) AS s FROM events) GROUP BY ALL""")
def stream_sliding(spark, folder):
    return _closed(spark, _event_files(spark, folder), lambda e: streams.window_counts(e, "ts", [], "2 days", "1 day", late="40 days"), "sliding")


@query("""WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS begins FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT user_id, ts, sum(begins) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM marked)
    SELECT epoch_us(min(ts)) AS window_start, epoch_us(max(ts)) + 21600000000 AS window_end, user_id, count(*) AS events FROM numbered GROUP BY user_id, n""")
def stream_session(spark, folder):
    return _closed(spark, _event_files(spark, folder), lambda e: streams.session_counts(e, "ts", ["user_id"], "6 hours", late="40 days"), "session")


@query("SELECT user_id, event_type FROM events GROUP BY ALL")
def stream_dedupe(spark, folder):
    """Each pair of user and kind once; what was seen is kept for forty days of event time."""
    rows = streams.without_repeats(_event_files(spark, folder).select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "40 days")
    return streams.run_to_end(rows, "dedupe", "append").select("user_id", "event_type")


@query("SELECT event_type AS file_name, count(*) AS total_records, FALSE AS late FROM events GROUP BY ALL")
def stream_file_counts(spark, folder):
    data = _event_files(spark, folder).select(F.col("event_type").alias("file_name"), F.lit(False).alias("is_end"))
    batch = table(spark, folder, "events", F.col("event_type").alias("file_name")).distinct().withColumn("is_end", F.lit(True))
    ends = f"{checkpoint_root(spark)}/ends-{uuid.uuid4().hex}"
    batch.limit(0).write.parquet(ends)
    marks = spark.readStream.schema(batch.schema).parquet(ends)
    send = lambda: batch.write.mode("append").parquet(ends)  # noqa: E731  # a file's mark comes after all its rows
    return streams.run_to_end(streams.file_counts(data.unionByName(marks), "file_name", "is_end"), "file_counts", "append", send)

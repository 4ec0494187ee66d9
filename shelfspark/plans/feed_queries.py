"""Queries of readers and sinks: feeds are written from the tables into the shared folder and read again, with SQL over the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import checkpoint_root, materialise
from ..functions import clean
from ..operators import folding, merge
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


def _path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def _csv_feed(spark: SparkSession, folder: str) -> str:
    """Stores as sixteen CSV files, sorted by id, blanks as nothing."""
    stores = table(spark, folder, "stores", "id", "chain_id", "store_id", "store_name", "chain_name", "city")
    blank = lambda c: F.nullif(F.trim(c), F.lit("")).alias(c)
    part = F.pmod(F.col("id"), F.lit(16))
    rows = stores.select(part.alias("part"), "id", F.lit("in").alias("found_folder"), F.concat(F.lit("stores-"), part, F.lit(".csv")).alias("file_name"), F.col("chain_id").alias("ChainId"), blank("store_id").alias("StoreId"), blank("store_name").alias("StoreName"), blank("chain_name").alias("ChainName"), blank("city"))
    path = _path(spark, "csv")
    rows.repartition(16, "part").sortWithinPartitions("part", "id").drop("part").withColumn("part", F.pmod(F.col("id"), F.lit(16))).write.option("header", True).partitionBy("part").csv(path)
    return f"{path}/part=*"


_FEED = """SELECT id, id % 16 AS part, 'stores-' || (id % 16) || '.csv' AS file_name, nullif(trim(city), '') AS city, nullif(trim(chain_name), '') AS chain_name, nullif(trim(store_id), '') AS store_id, nullif(trim(store_name), '') AS store_name, chain_id,
    row_number() OVER (PARTITION BY id % 16 ORDER BY id) - 1 AS row_index FROM stores"""


@query(f"""WITH feed AS ({_FEED}) SELECT file_name, row_index, CAST(id AS VARCHAR) AS id, last_value(city IGNORE NULLS) OVER w AS city, nullif(last_value(chain_name IGNORE NULLS) OVER w, 'nan') AS chain_name FROM feed WINDOW w AS (PARTITION BY part ORDER BY id ROWS UNBOUNDED PRECEDING)""")
def feed_rows(spark, folder):
    """A feed of several files: numbered rows as maps, with sparse cells filled from the row before."""
    rows = feeds.read_feed(spark, _csv_feed(spark, folder))
    return rows.select("file_name", "row_index", clean.ci_element("content", "ID").alias("id"), F.col("content")["city"].alias("city"), clean.ci_element("content", "chainname").alias("chain_name"))


@query(f"""WITH feed AS ({_FEED}) SELECT file_name, count(*) AS row_count, min(row_index) AS first_row FROM feed WHERE row_index > 9 GROUP BY file_name""")
def feed_resumed(spark, folder):
    """Only what comes after the last row that was read before."""
    return feeds.read_feed(spark, _csv_feed(spark, folder), after_row=9).groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count"), F.min("row_index").alias("first_row"))


@query(f"""WITH feed AS ({_FEED}) SELECT file_name, count(*) AS total_expected_records, arg_min(chain_id, row_index) AS chainid, arg_min(chain_name, row_index) FILTER (chain_name IS NOT NULL) AS chainname, TRUE AS file_complete FROM feed GROUP BY file_name""")
def feed_markers(spark, folder):
    """One end-of-file marker per file."""
    return feeds.end_of_file_markers(feeds.read_feed(spark, _csv_feed(spark, folder)), ("chainid", "chainname"))


@query(f"""WITH feed AS ({_FEED}), files AS (SELECT file_name, count(*) AS record_count, arg_min(chain_id, row_index) AS chain_id, arg_min(store_id, row_index) FILTER (store_id IS NOT NULL) AS store_id FROM feed GROUP BY file_name),
    names AS (SELECT chain_id, store_id, min(store_name) AS store_name FROM stores GROUP BY ALL)
    SELECT f.file_name, f.record_count, f.chain_id, n.store_name FROM files f LEFT JOIN names n ON n.chain_id = f.chain_id AND n.store_id = f.store_id""")
def feed_ledger(spark, folder):
    """The ledger of processed files from their markers, with the store's name looked up."""
    markers = feeds.end_of_file_markers(feeds.read_feed(spark, _csv_feed(spark, folder)), ("chainid", "storeid"))
    files = markers.select("file_name", F.col("total_expected_records").alias("record_count"), F.col("chainid").alias("chain_id"), F.col("storeid").alias("store_id"))
    names = table(spark, folder, "stores", "chain_id", "store_id", "store_name").groupBy("chain_id", "store_id").agg(F.min("store_name").alias("store_name"))
    return files.join(names, ["chain_id", "store_id"], "left").select("file_name", "record_count", "chain_id", "store_name")


def _json_files(rows: DataFrame, label: str) -> str:
    """One text file for each value of ``file`` with the text of ``value``."""
    path = _path(rows.sparkSession, label)
    rows.select("value", "file").write.partitionBy("file").text(path)
    return f"{path}/file=*"


@query("SELECT chain_id, promotion_id, epoch_us(updated_at) // 1000000 AS at_second, coalesce(len(available_in_store_ids), 0) AS listed FROM promotions WHERE updated_at IS NOT NULL AND chain_id IS NOT NULL")
def status_list(spark, folder):
    """JSON arrays of status objects, one file per chain, one row per object."""
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at", "available_in_store_ids").filter("updated_at IS NOT NULL AND chain_id IS NOT NULL")
    object_ = F.struct("chain_id", "promotion_id", F.unix_seconds("updated_at").alias("at_second"), F.struct(F.coalesce("available_in_store_ids", F.array()).alias("files_to_process")).alias("response"))
    path = _json_files(rows.groupBy(F.col("chain_id").alias("file")).agg(F.to_json(F.collect_list(object_)).alias("value")), "status")
    read = feeds.read_status_list(spark, path, "chain_id string, promotion_id string, at_second bigint, response struct<files_to_process: array<string>>")
    return read.select("chain_id", "promotion_id", "at_second", F.size("response.files_to_process").alias("listed"))


@query("SELECT strftime(updated_at AT TIME ZONE 'UTC', '%Y%m%d%H%M%S') AS at_text, CAST(floor(epoch(updated_at)) AS BIGINT) AS at_second, count(*) AS entries FROM promotions WHERE updated_at IS NOT NULL AND chain_id IS NOT NULL AND epoch_us(updated_at) >= 1743465600000000 GROUP BY ALL")
def status_log(spark, folder):
    """JSON objects of times to lists of statuses; a key that is no time and times read before are skipped."""
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at").filter("updated_at IS NOT NULL AND chain_id IS NOT NULL")
    text = F.date_format("updated_at", "yyyyMMddHHmmss")
    listed = rows.groupBy("chain_id", text.alias("at_text")).agg(F.collect_list(F.struct(F.lit("saved").alias("status"), F.col("promotion_id").alias("when"))).alias("statuses"))
    entries = F.concat(F.collect_list(F.struct("at_text", "statuses")), F.array(F.struct(F.lit("verified_downloads").alias("at_text"), F.array(F.struct(F.lit("x").alias("status"), F.lit("y").alias("when"))).alias("statuses"))))
    path = _json_files(listed.groupBy(F.col("chain_id").alias("file")).agg(F.to_json(F.map_from_entries(entries)).alias("value")), "log")
    seen = [r[0] for r in listed.filter("at_text < '20250401'").select("at_text").distinct().limit(10_000).collect()]  # as many as a ledger of runs holds
    log = feeds.read_status_log(spark, path, seen=seen)
    return log.filter("at_text >= '20250401'").groupBy("at_text", F.unix_seconds("at").alias("at_second")).agg(F.count(F.lit(1)).alias("entries"))


@query("""WITH files AS (SELECT 'store-' || lower(replace(r_name, ' ', '_')) || '.csv' AS file_name FROM region UNION ALL SELECT 'price-' || lower(replace(r_name, ' ', '_')) || '.csv' FROM region)
    SELECT file_name, row_number() OVER (ORDER BY NOT contains(file_name, 'store'), file_name) AS place, 'a' AS first_cell FROM files""")
def file_listing(spark, folder):
    """Files of a folder, store files first, and the first cell of each as read by its ending."""
    path = _path(spark, "files")
    for r in table(spark, folder, "region", "r_name").collect():  # five regions
        for kind in ("store", "price"):
            merge._write_text(spark, f"{path}/{kind}-{r['r_name'].lower().replace(' ', '_')}.csv", "cell,other\na,b\n")
    listed = feeds.list_files(spark, path, "*.csv")
    cells = feeds.read_by_ending(spark, f"{path}/*.csv").select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file_name"), F.col("cell").alias("first_cell"))
    placed = listed.select("file_name", (F.monotonically_increasing_id() + 1).alias("place")).coalesce(1)
    return placed.join(cells, "file_name").select("file_name", "place", "first_cell")


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'he' AND regexp_matches(source, '^(?:.*(price|promo).*)')")
def find_documents(spark, folder):
    return feeds.find_documents(table(spark, folder, "documents", "doc_id", "lang", "source"), {"lang": "he", "source": {"$regex": ".*(price|promo).*"}})


@query("SELECT DISTINCT 'price-' || store_id || '.gz' AS file_name FROM product_prices WHERE store_id IS NOT NULL AND store_id NOT IN (SELECT store_db_id FROM store_promotions_cache WHERE store_db_id IS NOT NULL)")
def unseen_files(spark, folder):
    """Files that no ledger lists; the ledger's table stands in for a cache that isn't there yet."""
    name = lambda c: F.concat(F.lit("price-"), F.col(c), F.lit(".gz")).alias("file_name")
    done = table(spark, folder, "store_promotions_cache", "store_db_id").filter("store_db_id IS NOT NULL").select(name("store_db_id")).distinct()
    ledger = feeds.ledger_or(spark, _path(spark, "no-cache"), done)
    return feeds.unseen_files(table(spark, folder, "product_prices", "store_id").filter("store_id IS NOT NULL").select(name("store_id")).distinct(), ledger)


@query("""SELECT r.ref_id, r.city_name, v.label FROM (VALUES (1, 'north'), (7, 'south'), (-1, 'none')) v(ref_id, label) JOIN ref_cities r ON r.ref_id = v.ref_id""")
def array_argument(spark, folder):
    """A JSON array given as an argument, joined as a table."""
    labels = feeds.array_argument(spark, '[{"ref_id": 1, "label": "north"}, {"ref_id": 7, "label": "south"}, {"ref_id": -1, "label": "none"}]', "ref_id bigint, label string")
    return table(spark, folder, "ref_cities", "ref_id", "city_name").join(labels, "ref_id").select("ref_id", "city_name", "label")


@query("""SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY user_id, event_type ORDER BY 1 LIMIT 1000""")
def bounded_records(spark, folder):
    """The first thousand messages of a topic, without control records and repeated contents."""
    events = table(spark, folder, "events", "event_id", "user_id", "event_type")
    messages = events.select(F.col("event_id").alias("offset"), F.to_json(F.struct("user_id", "event_type")).alias("value"))
    control = messages.select("offset", F.lit('{"type": "flush"}').alias("value")).filter("offset % 100 = 0")
    read = streams.bounded_records(messages.unionByName(control), "offset", 1_000)
    return read.select(F.col("offset").alias("event_id"), F.get_json_object("value", "$.user_id").cast("bigint").alias("user_id"), F.get_json_object("value", "$.event_type").alias("event_type"))


@query("""SELECT event_type AS file_name, count(*) AS records, 1 AS flushes FROM events GROUP BY event_type""")
def flush_records(spark, folder):
    """Messages keyed by file with one flush record each."""
    messages = streams.with_flush_records(table(spark, folder, "events", "event_id", F.col("event_type").alias("file_name")))
    is_flush = F.coalesce(F.get_json_object("value", "$.type") == "flush", F.lit(False))
    return messages.groupBy(F.col("key").alias("file_name")).agg(F.count_if(~is_flush).alias("records"), F.count_if(is_flush).alias("flushes"))


@query("""SELECT CASE WHEN starts_with(lower(city), 'ר') THEN 'r' WHEN starts_with(lower(city), 'ת') THEN 't' ELSE '' END AS destination, count(*) AS row_count FROM stores GROUP BY ALL""")
def route_rows(spark, folder):
    """Rows by the destination that the beginning of a value names."""
    parts = [df.select(F.lit(d).alias("destination")) for d, df in merge.route(table(spark, folder, "stores", "city"), "city", {"ר": "r", "ת": "t"}).items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("destination").agg(F.count(F.lit(1)).alias("row_count"))


@query("""SELECT id, event_type, CASE WHEN event_type IN ('click', 'view') THEN 'new' ELSE 'old' END AS origin FROM (SELECT event_id AS id, event_type FROM events) WHERE event_type NOT IN ('click', 'view') OR id % 2 = 0""")
def replace_partitions(spark, folder):
    """A partitioned table of which only the partitions that come again are replaced."""
    rows = table(spark, folder, "events", F.col("event_id").alias("id"), "event_type")
    path = _path(spark, "partitioned")
    merge.replace_partitions(rows.withColumn("origin", F.lit("old")), path, ["event_type"])
    merge.replace_partitions(rows.filter("event_type IN ('click', 'view') AND id % 2 = 0").withColumn("origin", F.lit("new")), path, ["event_type"])
    return spark.read.parquet(path).select("id", "event_type", "origin")


@query("SELECT 2 AS version, id, chain_id FROM stores WHERE city IS NOT NULL UNION ALL SELECT 1, id, chain_id FROM stores")
def snapshot_versions(spark, folder):
    """Two published versions of a data set: the latest, and the first by its number."""
    stores = table(spark, folder, "stores", "id", "chain_id", "city")
    root = _path(spark, "snapshots")
    merge.publish_snapshot(stores.select("id", "chain_id"), root, "2025-04-01")
    version = merge.publish_snapshot(stores.filter("city IS NOT NULL").select("id", "chain_id"), root, "2025-04-02")
    return merge.read_snapshot(spark, root).withColumn("version", F.lit(version)).unionByName(merge.read_snapshot(spark, root, 1).withColumn("version", F.lit(1)))


@query("SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def refresh_touched(spark, folder):
    """A rollup kept up by the keys that each batch of a stream touches."""
    rows = table(spark, folder, "events", "event_type", "user_id")
    base = _path(spark, "rollup")

    def refresh(keys: DataFrame, number: int) -> None:
        touched = rows.join(keys, "event_type", "left_semi").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
        merge.replace_partitions(touched.groupBy("event_type").agg(F.sum("n").alias("events"), F.count("user_id").alias("users")), f"{base}/table", ["event_type"])

    streams.refresh_touched(streams.read_table_stream(spark, folder, "events", table(spark, folder, "events").schema), ["event_type"], refresh, f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/table").select("event_type", "events", "users")


@query("SELECT id, item_code AS code, coalesce(nullif(trim(item_name), ''), nullif(trim(manufacturer_name), ''), '-') AS shown FROM products")
def lookup_any_case(spark, folder):
    """Values of maps whose keys are in any case; the first of several that is filled."""
    rows = table(spark, folder, "products", "id", "item_code", "item_name", "manufacturer_name")
    content = F.create_map(F.lit("ItemCODE"), "item_code", F.lit("itemName"), "item_name", F.lit("Maker"), "manufacturer_name")
    held = rows.select("id", content.alias("content"))
    first = F.coalesce(*[F.nullif(F.trim(clean.ci_element("content", k)), F.lit("")) for k in ("ITEMNAME", "maker")], F.lit("-"))
    return held.select("id", clean.ci_element("content", "itemcode").alias("code"), first.alias("shown"))


@query("""SELECT id, lower(chain_id) || '@' || lower('StoreFull') AS index_name, lower(chain_id) AS kind, 'storefull' AS owner, 'storefull' || chain_id || '-' || store_id AS bare_name FROM stores WHERE store_id NOT LIKE '%.%'""")
def file_names(spark, folder):
    """Names of indexes composed and taken apart, and file names without their endings."""
    rows = table(spark, folder, "stores", "id", "chain_id", "store_id").filter("NOT store_id LIKE '%.%'")
    named = rows.withColumn("index_name", clean.index_of("chain_id", F.lit("StoreFull"))).withColumn("file", F.concat(F.lit("storefull"), "chain_id", F.lit("-"), "store_id", F.lit(".aspx.xml.gz")))
    kind, owner = clean.index_parts("index_name")
    return named.select("id", "index_name", kind.alias("kind"), owner.alias("owner"), clean.without_endings("file").alias("bare_name"))


@query("""SELECT form, count(*) AS row_count, count(DISTINCT date_trunc('minute', ts)) AS moments FROM events, (VALUES ('compact'), ('iso'), ('slashes'), ('dots'), ('zone')) f(form) GROUP BY form""")
def parse_times(spark, folder):
    """Times written in several forms, read again; the count of minutes tells whether all were read."""
    forms = {"compact": "yyyyMMddHHmm", "iso": "yyyy-MM-dd'T'HH:mm:ss", "slashes": "dd/MM/yyyy HH:mm", "dots": "dd.MM.yyyy HH:mm:ss", "zone": "yyyy-MM-dd HH:mm:ss'+00:00'"}
    at = F.col("ts").cast("timestamp")
    texts = [F.concat(F.date_format(at, p), F.lit("00")) if n == "compact" else F.date_format(at, p) for n, p in forms.items()]
    written = table(spark, folder, "events", "ts").select(F.explode(F.map_from_arrays(F.array(*map(F.lit, forms)), F.array(*texts))).alias("form", "written"))
    return written.groupBy("form").agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(F.date_trunc("minute", clean.parse_time("written"))).alias("moments"))


@query("""WITH versions AS (SELECT chain_id, promotion_id, store_promotions, row_number() OVER w AS n, row_number() OVER (PARTITION BY chain_id, promotion_id ORDER BY updated_at DESC NULLS LAST, promotion_description DESC NULLS LAST) AS m FROM promotions
        WINDOW w AS (PARTITION BY chain_id, promotion_id ORDER BY updated_at NULLS FIRST, promotion_description NULLS FIRST)),
    entries AS (SELECT chain_id, promotion_id, 0 AS side, unnest(map_entries(store_promotions), recursive := true) FROM versions WHERE n = 1 UNION ALL SELECT chain_id, promotion_id, 1, unnest(map_entries(store_promotions), recursive := true) FROM versions WHERE m = 1)
    SELECT chain_id, promotion_id, key AS store_no, arg_max(value, side) AS merged_value FROM entries GROUP BY ALL""")
def map_concat(spark, folder):
    """The maps of a promotion's first and last version, the last one's values where both have a key."""
    rows = table(spark, folder, "promotions", "chain_id", "promotion_id", "updated_at", "promotion_description", "store_promotions")
    order = F.struct("updated_at", "promotion_description")
    both = rows.groupBy("chain_id", "promotion_id").agg(F.min_by("store_promotions", order).alias("a"), F.max_by("store_promotions", order).alias("b"))
    return both.select("chain_id", "promotion_id", F.explode(folding.map_concat_right(F.col("a"), F.col("b"))).alias("store_no", "merged_value"))


@query()
def lenient_values(spark, folder):
    """Texts that are JSON, Python literals or JSON in single quotes, as JSON, with their number."""
    rows = table(spark, folder, "promotions", "items")
    return rows.select(folding.lenient_json("items").alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("row_count"))


@query("SELECT id, chain_id, city FROM stores WHERE city IS NOT NULL ORDER BY id LIMIT 200")
def scan_sample(spark, folder):
    """A staged table's first rows by key: staged in the shared folder, read again, cut to a sample."""
    staged = materialise(table(spark, folder, "stores", "id", "chain_id", "city").filter("city IS NOT NULL"), "staged")
    return staged.orderBy("id").limit(200)

"""Product search: words first, similar spellings where words find too little."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import materialise
from ..functions import text

# How a product's number of chains adds to its rank.
LOG_WEIGHT, COUNT_WEIGHT, MOST_CHAINS = 0.20, 0.03, 20


def popularity(chains: str | Column) -> Column:
    """What being sold by many chains adds to a rank."""
    c = F.col(chains) if isinstance(chains, str) else chains
    return F.log1p(c.cast("double")) * LOG_WEIGHT + F.least(c, F.lit(MOST_CHAINS)) * COUNT_WEIGHT


def search_ranked(products: DataFrame, chains: DataFrame, query: str, name: str = "item_name", maker: str = "manufacturer_name") -> DataFrame:
    """Products whose name and maker hold all words of the query, or contain it as it stands, with their rank.

    ``chains``: id and chain_count. Rank: cover density of the words (0 where
    only the text contains the query) and popularity. A query without words
    finds nothing.
    """
    words = text.tokens(F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(maker, F.lit(""))))
    contained = text.contains_text(F.coalesce(name, F.lit("")), query) | text.contains_text(F.coalesce(maker, F.lit("")), query)
    hits = products.filter(text.matches_all(words, query) | (contained if query.strip() else F.lit(False)))
    ranked = hits.withColumn("density", text.cover_density(words, query).cast("double"))
    joined = ranked.join(chains.select("id", "chain_count"), "id", "left").withColumn("chain_count", F.coalesce("chain_count", F.lit(0)))
    return joined.withColumn("search_rank", F.col("density") + popularity("chain_count"))


def two_stage_search(products: DataFrame, chains: DataFrame, query: str, least: int, similarity: float = 0.3) -> DataFrame:
    """``search_ranked`` and, if that finds fewer than ``least`` products, similar names that it left out.

    The first stage is written to the shared folder, as it is counted, given and
    left out of the second; only whether it has ``least`` rows comes to the driver.
    """
    first = materialise(search_ranked(products, chains, query).withColumn("stage", F.lit("words")), "found")
    if first.limit(least).count() >= least:
        return first
    rest = products.join(first.select("id"), "id", "left_anti")
    similar = rest.withColumn("density", text.trigram_similarity("item_name", F.lit(query))).filter(F.col("density") >= similarity)
    joined = similar.join(chains.select("id", "chain_count"), "id", "left").withColumn("chain_count", F.coalesce("chain_count", F.lit(0)))
    return first.unionByName(joined.withColumns({"search_rank": F.col("density") + popularity("chain_count"), "stage": F.lit("similar")}))

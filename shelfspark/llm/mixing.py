"""Mixing sources to target shares of all tokens."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how byte-level BPE tokenizers of this kind split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEED = 20_250_101
DEVIATIONS = 3.0


@lru_cache(maxsize=4)
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str, tokenizer: str = TOKENIZER) -> Column:
    """Tokens of a text column; null where the text is null."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = _encoding(tokenizer)
        for batch in batches:
            yield batch.map(lambda t: None if t is None else len(encoding.encode_ordinary(t))).astype("Int64")

    return F.pandas_udf(count, "long")(text)


def source_key(column: str) -> Column:
    """A source's name without case and outer blanks."""
    return F.lower(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""))


def distinct_texts(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, size: Column | None = None) -> DataFrame:
    """doc_id, source_name, tokens of each distinct text of a source with a target.

    ``size`` measures a text otherwise than by the tokenizer's tokens.

    Of equal texts the one with the smallest doc_id stands for all, so a text
    that is repeated under other ids or sources is one text. Equal texts meet by
    128 bits of their hash; the rows that are shuffled hold no text, and copies
    are combined before. Null and blank texts and null sources are left out.
    """
    named = targets.select(source_key("source").alias("source_name")).distinct()
    rows = documents.select("doc_id", "text", source_key("source").alias("source_name")).filter(F.col("text").rlike(r"(?U)\S"))
    sized = rows.join(F.broadcast(named), "source_name").select("doc_id", "source_name", F.unhex(F.md5("text")).alias("hash"), (token_count("text", tokenizer) if size is None else size).alias("tokens"))
    one = sized.groupBy("hash").agg(F.min(F.struct("doc_id", "source_name", "tokens")).alias("r"))
    return one.select("r.doc_id", "r.source_name", "r.tokens")


def source_rates(texts: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """Repetition rate of each target source: target_share * total / its tokens, at most max_repeats.

    ``total`` is the size of the mixture in tokens. None: the largest one at
    which every source that has texts reaches its share within its repeats,
    shares being taken among the sources that have texts. Where a given total
    is larger, sources at their limit fall short, as their actual share shows.
    ``expected_share`` is the share at these rates, ``tolerance`` three standard
    deviations of what the draw of single copies makes of it: with few long
    texts it is wide, and it shrinks with the root of the number of texts. One
    row per target; a target named twice counts with its shares' sum and
    its least repeats; without texts its rate is 0. The table has one row per
    source of the target list.
    """
    goals = targets.filter(F.col("source").isNotNull()).groupBy(source_key("source").alias("source_name")).agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    sizes = texts.groupBy("source_name").agg(F.sum("tokens").alias("available_tokens"), F.count(F.lit(1)).alias("texts"), F.sum(F.col("tokens").cast("double") ** 2).alias("squares"))
    joined = goals.join(F.broadcast(sizes), "source_name", "left").fillna(0, ["available_tokens", "texts", "squares"])
    usable = F.when((F.col("available_tokens") > 0) & (F.col("target_share") > 0), F.col("target_share"))
    whole = Window.partitionBy(F.lit(0))  # one row per source
    joined = joined.withColumns({"shares": F.sum(usable).over(whole), "feasible": F.min(F.col("max_repeats") * F.col("available_tokens") / usable).over(whole)})
    size = F.lit(float(total)) if total is not None else F.col("feasible") * F.col("shares")
    rate = F.when(usable.isNotNull(), F.least(usable / F.col("shares") * size / F.col("available_tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    rated = joined.withColumn("rate", rate)
    part = F.col("rate") - F.floor("rate")
    rated = rated.withColumns({"wanted": F.col("rate") * F.col("available_tokens"), "variance": part * (1 - part) * F.col("squares")})
    total, spread, share = F.sum("wanted").over(whole), F.sum("variance").over(whole), F.col("wanted") / F.sum("wanted").over(whole)
    # How a source's own draw moves its share, and how the others' draws move the total.
    deviation = F.sqrt((1 - share) ** 2 * F.col("variance") + share**2 * (spread - F.col("variance"))) / total
    rated = rated.withColumns({"expected_share": F.when(total > 0, share).otherwise(0.0), "tolerance": F.when(total > 0, DEVIATIONS * deviation).otherwise(0.0)})
    return rated.select("source_name", "target_share", "max_repeats", "available_tokens", "texts", "rate", "expected_share", "tolerance")


def chosen_repeats(texts: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source_name, tokens, copies of each text that is used.

    floor(rate) copies and one more with the rate's fraction as its chance,
    drawn from a hash of the doc_id and ``seed``: the same texts at every run.
    """
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "doc_id")), 1, 13), 16, 10).cast("double") / float(1 << 52)
    whole = F.floor("rate")
    copies = (whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0)).cast("int")
    used = texts.join(F.broadcast(rates.select("source_name", "rate")), "source_name")
    return used.select("doc_id", "source_name", "tokens", copies.alias("copies")).filter(F.col("copies") > 0)


def emitted(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """The mixture itself: doc_id, source_name, copy_no (from 1), tokens and text, one row for each copy.

    Each chosen text is found again by its doc_id, which is unique; copies are
    made after the join, so each text is shuffled once at most.
    """
    found = documents.select("doc_id", "text").join(chosen, "doc_id")
    return found.select("doc_id", "source_name", F.explode(F.sequence(F.lit(1), "copies")).alias("copy_no"), "tokens", "text")


def actual_shares(rates: DataFrame, chosen: DataFrame) -> DataFrame:
    """Target and actual share of each source of the target list; 0 where nothing is used."""
    used = chosen.groupBy("source_name").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_repeats"))
    joined = rates.join(F.broadcast(used), "source_name", "left").fillna(0, ["mixed_tokens", "most_repeats"])
    total = F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0)))
    share = F.when(total > 0, F.col("mixed_tokens") / total).otherwise(0.0)
    return joined.select("source_name", "target_share", "max_repeats", "texts", "available_tokens", "rate", "mixed_tokens", "most_repeats", "expected_share", "tolerance", share.alias("actual_share"))

"""Extendible hashing in DataFrame functions only.

A directory indexed by the leading bits of a key's hash maps every row to a
bucket; a bucket over the byte limit is split on one more bit, and only it,
until every bucket fits. The hash is the first 60 bits of the MD5 of the key,
followed, where those are used up (rows that share a key), by 60 bits of the MD5
of the content. Rows equal in key and content cannot be told apart by bits:
they go to overflow pages of the last bucket, each within the limit. A bucket
that holds a single row over the limit stays as it is (``oversize``).

The first round counts cells of a few more bits than the expected depth, some sixteen a
shard, by one aggregation with map-side sums, and rolls them up to every shorter prefix;
only the rows of cells that are still too large go to a next round of more bits. Texts
are never shuffled, only ids and sizes; a very long text is one row of its size.

Defined results: a null or empty content has 0 bytes; null keys share a hash and
are told apart by content; repeated rows are each placed; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import scratch

KEY_BITS = 60
ALL_BITS = 120
# Extra bits the first round looks at beyond the expected depth; every further round, for
# the buckets that are still too large alone, looks at twice as many as the last.
ROUND_BITS = 4


def _bits(value: Column) -> Column:
    """60 bits of the MD5 of a string as a string of 0 and 1."""
    n = F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("bigint")
    return F.lpad(F.bin(n), KEY_BITS, "0")


def _leaves(cells: DataFrame, lo: int, hi: int, max_bytes: int) -> DataFrame:
    """Final buckets of depth lo..hi: (prefix, depth, shard_bytes, shard_rows).
    ``cells`` has one row per prefix of ``hi`` bits: (cell, bytes, n)."""
    levels = (cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("depth"))
              .groupBy("depth", F.expr("substring(cell, 1, depth)").alias("prefix"))
              .agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows")))
    fits = scratch(levels.where((F.col("shard_bytes") <= max_bytes) | (F.col("shard_rows") == 1)), "shard-fits")
    parents = fits.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    return (fits.withColumn("parent", F.expr("substring(prefix, 1, depth - 1)"))
            .join(parents, ["depth", "parent"], "left_anti").drop("parent"))


def extendible_shards(df: DataFrame, max_bytes: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: key, ``n_bytes``, ``shard_id`` (the hash prefix, with
    ``-page`` on overflow pages), ``depth`` (bits in use), ``shard_bytes``,
    ``shard_rows``, ``oversize`` (one row above the limit)."""
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = scratch(df.select(
        F.col(key_col).alias("key"), F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.concat(_bits(F.coalesce(F.col(key_col).cast("string"), F.lit(""))), _bits(text)).alias("bits")), "shard-rows")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    hi = min(ALL_BITS, max(0, math.ceil(math.log2(max(1, total / max_bytes)))) + ROUND_BITS)
    lo, pending, done, step = 0, rows, [], ROUND_BITS
    while True:
        cells = scratch(pending.groupBy(F.expr(f"substring(bits, 1, {hi})").alias("cell"))
                        .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")), "shard-cells")
        leaves = scratch(_leaves(cells, lo, hi, max_bytes), "shard-leaves")
        # the directory of this round: every cell of hi bits points to its bucket
        directory = scratch(
            cells.select("cell", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("depth"))
            .withColumn("prefix", F.expr("substring(cell, 1, depth)"))
            .join(leaves, ["depth", "prefix"]).drop("depth").withColumn("depth", F.length("prefix")), "shard-directory")
        keyed = pending.withColumn("cell", F.expr(f"substring(bits, 1, {hi})"))
        done.append(keyed.join(directory, "cell").select(
            "key", "n_bytes", F.col("prefix").alias("shard_id"), "depth", "shard_bytes", "shard_rows"))
        open_cells = cells.join(directory, "cell", "left_anti")
        if open_cells.isEmpty():
            break
        pending = scratch(keyed.join(open_cells, "cell", "left_semi").drop("cell"), "shard-open")
        if hi == ALL_BITS:
            done.append(_overflow(pending, max_bytes))
            break
        step *= 2
        lo, hi = hi + 1, min(ALL_BITS, hi + step)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select(F.col("key").alias(key_col), "n_bytes", "shard_id", F.col("depth").cast("int").alias("depth"),
                      "shard_bytes", "shard_rows", (F.col("shard_bytes") > max_bytes).alias("oversize"))


def _overflow(rows: DataFrame, max_bytes: int) -> DataFrame:
    """Rows equal in key and content, placed on pages of at most ``max_bytes``.
    They are interchangeable, so they are counted and dealt out again by page."""
    same = rows.groupBy("bits", "key", "n_bytes").agg(F.count("*").alias("n"))
    page_rows = F.greatest(F.lit(1).cast("bigint"), F.expr(f"{max_bytes} div greatest(n_bytes, 1)"))
    pages = (same.withColumn("per", page_rows)
             .withColumn("page", F.explode(F.expr("sequence(0L, (n - 1) div per)")))
             .withColumn("shard_rows", F.least(F.col("per"), F.col("n") - F.col("page") * F.col("per"))))
    return (pages.repartition("bits", "page")
            .withColumn("i", F.explode(F.expr("sequence(1L, shard_rows)")))
            .select("key", "n_bytes", F.concat_ws("-", "bits", F.xxhash64("key", "n_bytes").cast("string"),
                                                  F.col("page").cast("string")).alias("shard_id"),
                    F.lit(ALL_BITS).alias("depth"), (F.col("shard_rows") * F.col("n_bytes")).alias("shard_bytes"),
                    "shard_rows"))

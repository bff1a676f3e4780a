"""Row-set operators of the conversation generators (WN-2, AG-1, AG-2, AG-4..7,
AG-10, JN-1, JN-4, FLT-1..5, MAP-1..3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kenning.functions.text import is_malformed_literal

# Replies in one record: a longer conversation has one record for each page of so many.
REPLY_PAGE = 10_000


def first_per_group(df: DataFrame, key, order, cols=None, out="first") -> DataFrame:
    """WN-2: the first row of each group by ``order`` (file order stands in as row_seq).

    ``min_by`` is an aggregate with partial results, so a hot group is reduced
    map-side instead of being sorted in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = cols or [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.col(order)).alias(out)).select(*keys, out + ".*")


def first_with_count(df: DataFrame, key, order, count_col, cols=None) -> DataFrame:
    """WN-2 + AG-1 + JN-1 in one aggregate: the first row and the non-null count
    of ``count_col`` per group, no join needed."""
    cols = cols or [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_f"),
                                F.count(count_col).alias("num_messages"))
            .select(key, "_f.*", "num_messages"))


def replies(df: DataFrame, key, order) -> DataFrame:
    """JN-4: every row that is not the first of its group (anti join on the first keys)."""
    firsts = df.groupBy(key).agg(F.min(order).alias(order))
    return df.join(firsts, on=[key, order], how="left_anti")


def nest_replies(first: DataFrame, reply_rows: DataFrame, key, order, fields, out="replies",
                 page_size: int | None = REPLY_PAGE) -> DataFrame:
    """AG-10 + PRJ-7: replies as an array of structs sorted by ``order`` under
    their conversation; conversations without replies get an empty array.

    A conversation's replies are cut into consecutive pages of at most ``page_size``
    (exact order from a skew-safe rank), one record per (conversation, ``page``): every
    reply is kept and no record, nor the task building it, grows with the size of a hot
    conversation. Shorter conversations are one record, as the original writes them;
    ``None`` makes one record of any conversation, without the column ``page``."""
    r = reply_rows
    gkeys = [key]
    if page_size:
        from kenning.operators.profile import rank_within
        r = rank_within(r, [key], [F.col(order).asc()], out="_rk").withColumn(
            "page", ((F.col("_rk") - 1) / F.lit(page_size)).cast("bigint")).drop("_rk")
        gkeys = [key, "page"]
    packed = (r.groupBy(*gkeys)
              .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *fields))).alias("_r")))
    if page_size:
        first = first.join(packed.select(key, "page"), on=key, how="left") \
            .withColumn("page", F.coalesce(F.col("page"), F.lit(0).cast("bigint")))
    j = first.join(packed, on=gkeys, how="left")
    empty = F.array().cast(packed.schema["_r"].dataType)
    return (j.withColumn(out, F.transform(F.coalesce(F.col("_r"), empty), lambda x: x.dropFields("_o")))
            .drop("_r"))


def reply_pages(rows: DataFrame, counts: DataFrame, key, order, page_size: int) -> DataFrame:
    """(order, ``_pages``): for the rows of groups that need more than one page of
    ``page_size`` replies, a map from the group to the pages of the row: its own, or all
    of them for the first row. ``counts`` has the rows ``_n`` of each group. Only those
    groups are ranked, by their keys alone."""
    from kenning.operators.joins import sized_broadcast
    from kenning.operators.profile import rank_within
    hot = counts.filter(F.col("_n") > page_size + 1)
    ranked = rank_within(rows.filter(F.col(order).isNotNull()).join(sized_broadcast(hot), on=key), [key], [F.col(order).asc()], out="_rk")
    size = F.lit(page_size)
    last = F.floor((F.col("_n") - 2) / size)
    # equal numbers in one group stay on one page
    spots = ranked.groupBy(key, order, "_n").agg(F.min("_rk").alias("_rk"))
    own = F.when(F.col("_rk") == 1, F.sequence(F.lit(0).cast("bigint"), last)).otherwise(F.array(F.floor((F.col("_rk") - 2) / size)))
    return (spots.withColumn("_own", own).groupBy(order)
            .agg(F.map_from_entries(F.collect_list(F.struct(key, "_own"))).alias("_pages")))


def nest_marked(rows: DataFrame, keys, order, head, fields, whole, out="replies") -> DataFrame:
    """AG-10 + PRJ-7 on rows that know their place: ``head`` is a struct on the first row of a
    conversation (of every page of it), null on replies. One grouping by ``keys`` brings head
    and replies together, so a row is sent once; ``whole(reply, head)`` completes a reply."""
    keys = list(keys)
    reply = F.when(F.col(head).isNull(), F.struct(F.col(order).alias("_o"), *fields))
    g = (rows.select(*keys, F.col(head).alias("_h"), reply.alias("_r")).repartition(*keys).groupBy(*keys)
         .agg(F.collect_list("_h").alias("_heads"), F.array_sort(F.collect_list("_r")).alias("_rs"))
         .select(*keys, F.explode("_heads").alias("_h"), "_rs"))
    return g.select(*keys, "_h.*", F.transform("_rs", lambda r: whole(r, F.col("_h"))).alias(out))


def neighbors(df: DataFrame, key, order, value, carry=None) -> DataFrame:
    """``value`` of the previous and next row (order - 1, order + 1) of the same group.

    One shuffle on (key, order): every row is sent as itself, as the previous
    row of order + 1 and as the next row of order - 1. No window over the whole
    group, so a long conversation is not one task. ``carry`` columns of the row
    itself ride along in the same shuffle, so no join back is needed."""
    carry = [c for c in (carry or []) if c not in (key, order)]
    kinds = F.array(
        F.struct(F.lit(0).alias("k"), F.col(order).alias("o")),
        F.struct(F.lit(1).alias("k"), (F.col(order) + 1).alias("o")),
        F.struct(F.lit(2).alias("k"), (F.col(order) - 1).alias("o")))
    own = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(True)
    # only the row itself carries its columns; the copies for its neighbours hold the value alone
    e = (df.select("*", F.explode(kinds).alias("_e"))
         .select(key, F.col(value).alias("_v"), F.when(F.col("_e.k") == 0, own).alias("_own"), "_e"))
    g = (e.groupBy(key, F.col("_e.o").alias(order))
         .agg(F.first("_own", ignorenulls=True).alias("_self"),
              F.max(F.when(F.col("_e.k") == 1, F.col("_v"))).alias("prev_" + value),
              F.max(F.when(F.col("_e.k") == 2, F.col("_v"))).alias("next_" + value)))
    g = g.filter(F.col("_self").isNotNull())
    if carry:
        return g.select(key, order, *[F.col("_self." + c).alias(c) for c in carry],
                        "prev_" + value, "next_" + value)
    return g.drop("_self")


def value_counts(df: DataFrame, col, out="n") -> DataFrame:
    """AG-4."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def distinct_count(df: DataFrame, col, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """AG-5: number of distinct values; ``approx`` uses HyperLogLog++ (fixed
    memory per partial aggregate, mergeable) for very large inputs."""
    agg = F.approx_count_distinct(col, rsd) if approx else F.countDistinct(col)
    return df.agg(agg.alias("n_distinct"))


def first_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """SO-2: the first n rows by ``order`` (a distributed top-k: each partition
    keeps its n best, the driver merges at most n per partition)."""
    return df.orderBy(*order).limit(n)


def null_counts(df: DataFrame, cols) -> DataFrame:
    """FLT-3: nulls per column, one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(F.col(c).isNull()).alias("null_" + c) for c in cols])


def malformed_literals(df: DataFrame, cols) -> DataFrame:
    """STR-12: cells that hold something but no list literal, per column, one row."""
    return df.agg(*[F.count_if(is_malformed_literal(c)).alias("malformed_" + c) for c in cols])


def dictionary(df: DataFrame, key, value, order) -> DataFrame:
    """MAP-1: ``dict(zip(keys, values))``: one row per key, the last by ``order`` wins."""
    return df.groupBy(key).agg(F.max_by(F.col(value), F.col(order)).alias(value))


def overlay(old: DataFrame, new: DataFrame, key, value) -> DataFrame:
    """MAP-2: ``old.update(new)``; ``origin`` tells which side the value came from."""
    j = old.select(key, F.col(value).alias("_old")).join(new.select(key, F.col(value).alias("_new")), key, "full_outer")
    return j.select(key, F.coalesce("_new", "_old").alias(value),
                    F.when(F.col("_new").isNotNull(), "new").otherwise("old").alias("origin"))


def number_rows(df: DataFrame, place: str, out: str) -> DataFrame:
    """The position (0, 1, ...) of each row over all files of a reader, as ``out``.

    ``place`` is a struct of file, block of the file and a row number that grows by one
    within a block (``read_csv_renamed(order=...)``). Rows are counted per block; a
    table with one row per block, which is what a task reads, gives each block the rows
    before it by a running sum, and a row adds its place in the block. No row moves but
    for the join with that table, and the row numbers are written first, so every later
    stage and every re-run sees the same ones."""
    from kenning.operators.joins import sized_broadcast
    from kenning.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    block = [F.col(place)["_file"].alias("_file"), F.col(place)["_block"].alias("_block")]
    rows = df.select("*", *block, F.col(place)["_row"].alias("_row")).drop(place).checkpoint(eager=True)
    blocks = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    start = blocks.select("_file", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_add"))
    return (rows.join(sized_broadcast(start), on=["_file", "_block"])
            .withColumn(out, F.col("_row") + F.col("_add")).drop("_file", "_block", "_row", "_add"))

"""Exact de-duplication by progressive refinement, in DataFrame functions only.

Texts are equal when identical after deleting space and \\t \\n \\v \\f \\r. Rows are
refined in three steps: by length, within a length by the hash of the first
``PREFIX`` characters, and only within the groups that survive both by the
SHA-256 of the whole text. The first scan yields rows without text, aggregated
on the map side; what survives is sent to the second scan as a bitmap of fixed
size (see ``common``), so no text is shuffled to find the groups, and a group of
any size is one row per map task when it is counted.

Defined results: a null text counts as empty; a null id sorts after all others;
of rows equal in text, length and id (repeated rows) exactly one is kept; an
empty table gives an empty result; other columns are neither read nor required
by ``exact_dedup`` and are carried whole by ``drop_exact_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import BLANKS, bitmap, flag_by_bitmap, scratch

PREFIX = 256
# Tasks that share the rows of one group of equal texts.
SPREAD = 16


def normalized(text: Column) -> Column:
    """The text without blanks; null as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in BLANKS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _refine_key(norm: Column) -> Column:
    return F.xxhash64(F.length(norm), F.substring(norm, 1, PREFIX))


def _surviving(text: DataFrame) -> DataFrame:
    """Bitmap of the (length, prefix hash) groups that hold more than one row;
    ``text`` has the one column ``t``."""
    norm = normalized(F.col("t"))
    by_prefix = (text.select(F.length(norm).alias("len"), _refine_key(norm).alias("prefix"))
                 .groupBy("len", "prefix").agg(F.count("*").alias("n")))
    by_prefix = scratch(by_prefix, "prefix")
    lengths = by_prefix.groupBy("len").agg(F.sum("n").alias("n_len")).where("n_len > 1")
    groups = by_prefix.where("n > 1").join(lengths, "len", "left_semi")
    return scratch(bitmap(groups, "prefix"), "prefix-bits")


def _with_hash(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``full``: SHA-256 (binary) of the normalised text for rows of
    surviving groups, null for rows known to be alone."""
    bits = _surviving(df.select(text.alias("t")))
    norm = normalized(text)
    marked = flag_by_bitmap(df, _refine_key(norm), bits, "ed_maybe")
    return marked.withColumn("ed_full", F.when(F.col("ed_maybe"), F.unhex(F.sha2(norm, 256)))).drop("ed_maybe")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: str | None = None) -> DataFrame:
    """One row per input row: id, ``keep_id`` (the id of the row that stays),
    ``group_size``, ``kept``. Of equal texts the row with the most code points,
    then the smallest id, stays. ``digest`` names an extra column with the
    SHA-256 of the normalised text (every row's text is then hashed)."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    sha = [F.sha2(normalized(F.col("t")), 256).alias("sha")] if digest else []
    rows = scratch(_with_hash(src, F.col("t")).select(
        "id", F.coalesce(F.length("t"), F.lit(0)).alias("n_cp"), F.col("ed_full").alias("full"), *sha), "exact")
    extra = ["sha"] if digest else []
    alone = rows.where("full is null").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), *extra)
    # repeated rows (same text, length and id) are one row with a count until the end
    same = rows.where("full is not null").groupBy("full", "n_cp", "id", *extra).agg(F.count("*").alias("m"))
    order = F.struct((-F.col("n_cp")).alias("o"), F.col("id").isNull().alias("z"), F.col("id").alias("i"))
    groups = same.groupBy("full").agg(F.sum("m").alias("group_size"), F.min(order).alias("best"))
    first = F.col("id").eqNullSafe(F.col("best.i")) & (F.col("n_cp") == -F.col("best.o"))
    # a group may hold a third of all rows: they are dealt to SPREAD tasks, its one row to each
    part = F.pmod(F.hash("id", "n_cp"), F.lit(SPREAD))
    groups = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    grouped = (same.withColumn("part", part).join(groups, ["full", "part"])
               .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))))
               .select("id", F.col("best.i").alias("keep_id"), "group_size",
                       (first & (F.col("copy") == 1)).alias("kept"), *extra))
    out = alone.unionByName(grouped)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                      *([F.col("sha").alias(digest)] if digest else []))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    Rows known to be alone pass through without a shuffle. The others are
    aggregated by the full hash; each map task sends one row per group."""
    cols = df.columns
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r"))
    text, key = F.col(f"r.`{text_col}`"), F.col(f"r.`{id_col}`")
    marked = _with_hash(whole, text)
    alone = marked.where("ed_full is null").select("r.*")
    order = F.struct((-F.coalesce(F.length(text), F.lit(0))).alias("o"), key.isNull().alias("z"), key.alias("i"),
                     F.xxhash64("r").alias("h"))
    grouped = (marked.where("ed_full is not null").groupBy("ed_full")
               .agg(F.min_by("r", order).alias("r")).select("r.*"))
    return alone.unionByName(grouped)

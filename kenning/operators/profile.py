"""User profiles: mentions -> counts -> modal day -> aged counts -> ranks
(AG-8, AG-9, DT-4, MA-1..3, WN-1, SO-3, JN-5, NER-9, NER-10)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kenning import config
from kenning.functions.dates import days_since
from kenning.functions.mathx import aged_count
from kenning.functions.text import name_tokens, rank_key, starts_with_any


def mention_counts(mentions: DataFrame, user="user_id", category="category", value="value") -> DataFrame:
    """AG-9: mentions per (user, category, value). Algebraic: partial aggregation
    before the shuffle keeps a hot user cheap."""
    return (mentions.groupBy(user, category, value)
            .agg(F.count(F.lit(1)).alias("frequency")))


def modal_day(messages: DataFrame, user="user_id", ts="ts") -> DataFrame:
    """AG-8: the most frequent mail day per user, least day on a tie.

    ``mode`` keeps a day -> count map per user; it is bounded by the number of
    distinct days and merges partial results, so a hot user stays one small map.
    Users whose days are all null get a null modal day (tenant B)."""
    return messages.groupBy(user).agg(F.mode(F.to_date(F.col(ts)), True).alias("modal_day"))


def age_counts(counts: DataFrame, days: DataFrame, schedule, as_of: _dt.date, user="user_id",
               null_day_keeps_count: bool = False, freq="frequency") -> DataFrame:
    """DT-4 + MA-1..3: attach the user's modal day and the aged count.

    ``days`` has one row per user; the join shuffles (or, when the runtime size
    is small, broadcasts) on the user key."""
    if isinstance(schedule, str):
        schedule = config.DECAY_SCHEDULES[schedule]
    out = counts.join(days, on=user, how="left")
    d = days_since(F.col("modal_day"), as_of)
    return (out.withColumn("days", d.cast("bigint"))
            .withColumn("decay_frequency",
                        aged_count(F.col(freq), F.col("days"), schedule, null_day_keeps_count)))


def rank_within(df: DataFrame, keys, order, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Exact ``row_number()`` within ``keys`` by ``order`` (a total order) that
    does not put a hot group into one task.

    Rows are range-partitioned on (keys, order), so a group holding a third of
    all rows spans many contiguous partitions. Each row is numbered inside its
    (partition, group) chunk; a small table with one count per chunk gives each
    chunk the number of rows of the same group in earlier partitions. The
    partition id is materialized (checkpoint in the shared folder) so every
    branch sees the same assignment, also after a lost executor."""
    from kenning.session import ensure_checkpoint_dir
    spark = df.sparkSession
    keys = list(keys)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    s = (df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
         .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    local = s.withColumn("_lr", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)))
    chunks = s.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select("_pid", *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(offsets, on=["_pid", *keys])
            .withColumn(out, (F.col("_lr") + F.col("_off")).cast("bigint"))
            .drop("_pid", "_lr", "_off"))


def rank_values(profile: DataFrame, user="user_id", category="category", value="value",
                freq="frequency", skew_safe: bool = True, at_most: int | None = None) -> DataFrame:
    """WN-1 + STR-14: rank of each value within (user, category) by count, value
    ascending on ties, and the ``TAG_<category>_<rank>`` key.

    ``skew_safe`` (default) ranks with ``rank_within`` so a user with a huge
    number of distinct values (say, every address of a mailing-list mailbox) is
    spread over many tasks; otherwise a window per (user, category). ``at_most`` keeps
    the ranks up to it."""
    order = [F.col(freq).desc(), F.col(value).asc()]
    if skew_safe:
        ranked = rank_within(profile, [user, category], order)
        if at_most is not None:
            ranked = ranked.filter(F.col("rank") <= at_most)
    else:
        w = Window.partitionBy(user, category).orderBy(*order)
        ranked = profile.withColumn("rank", F.row_number().over(w))
        if at_most is not None:
            ranked = ranked.filter(F.col("rank") <= at_most)
        ranked = ranked.withColumn("rank", F.col("rank").cast("bigint"))
    return ranked.withColumn("sk", rank_key(F.col(category), F.col("rank")))


def top_k(profile: DataFrame, k: int, user="user_id", category="category", value="value", freq="frequency") -> DataFrame:
    """SO-3: the k best-ranked values per (user, category).

    The planner puts the limit below the shuffle as well (``WindowGroupLimit``), so a task
    sends at most k rows of a group, however many it has. Above the k up to which it
    does that, the exact ranks of ``rank_within`` are cut instead."""
    limit = int(profile.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    return rank_values(profile, user, category, value, freq, skew_safe=k > limit, at_most=k)


def explode_participants(messages: DataFrame, msg="message_id", sender="sender",
                         recipients=("to", "cc")) -> DataFrame:
    """JN-5: one row per (message, participant): sender, to and cc, without repeats.

    Replaces the per-user scan of the whole table with one explode and one
    de-duplication keyed by (message, user)."""
    arrs = [F.array(F.col(sender))] + [F.coalesce(F.col(r), F.array().cast("array<string>")) for r in recipients]
    parts = F.array_distinct(F.filter(F.concat(*arrs), lambda x: x.isNotNull()))
    return messages.select("*", F.explode(parts).alias("user_id"))


def drop_self_mentions(rows: DataFrame, user="user_id", value="value") -> DataFrame:
    """NER-9 + NER-10: lower and right-trim the mention; drop it when it starts
    with one of the user's own name words (from the address before '@')."""
    own = F.transform(name_tokens(F.col(user)), lambda t: F.rtrim(F.lower(t)))
    v = F.rtrim(F.lower(F.col(value)))
    return rows.withColumn(value, v).filter(~F.coalesce(starts_with_any(v, own), F.lit(False)))

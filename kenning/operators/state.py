"""Profile state: merge a new batch into the stored profile (JN-11, SE-2, SE-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning import config
from kenning.operators.directory import complete_names

KEY = ("user_id", "category", "value")


def merge_profiles(stored: DataFrame, new: DataFrame, complete_people: bool = False,
                   people_category: str = config.PEOPLE) -> DataFrame:
    """Full outer merge on (user, category, value), counts added.

    Categories new to a stored user are kept, and so are stored users without
    new mail. With ``complete_people`` the people names of both sides are first
    completed within each user (ARR-10) and colliding names are summed.
    ``origin`` tells whether the key was stored, new or both (SE-2/SE-4).
    """
    s = stored.select(*KEY, F.col("frequency").alias("_sf"), F.col("decay_frequency").alias("_sd"))
    n = new.select(*KEY, F.col("frequency").alias("_nf"), F.col("decay_frequency").alias("_nd"))
    if complete_people:
        # both sides are completed once, over the names both had before the merge
        names = (stored.select(*KEY).unionByName(new.select(*KEY))
                 .filter(F.col("category") == people_category).select("user_id", "value").distinct())
        done = complete_names(names, ["user_id"], "value", out="_completed")
        s = _complete_people(s, ["_sf", "_sd"], people_category, done)
        n = _complete_people(n, ["_nf", "_nd"], people_category, done)
    m = s.join(n, on=list(KEY), how="full_outer")
    return m.select(
        *KEY,
        (F.coalesce("_sf", F.lit(0)) + F.coalesce("_nf", F.lit(0))).cast("bigint").alias("frequency"),
        (F.coalesce("_sd", F.lit(0)) + F.coalesce("_nd", F.lit(0))).cast("bigint").alias("decay_frequency"),
        F.when(F.col("_sf").isNotNull() & F.col("_nf").isNotNull(), "both")
         .when(F.col("_sf").isNotNull(), "stored").otherwise("new").alias("origin"))


def _complete_people(side: DataFrame, measures, people_category, done: DataFrame) -> DataFrame:
    """Put the completed names into ``side`` and add up those that became equal."""
    people = side.filter(F.col("category") == people_category)
    completed = (people.join(done, on=["user_id", "value"], how="left")
                 .withColumn("value", F.coalesce("_completed", "value")).drop("_completed")
                 .groupBy(*KEY).agg(*[F.sum(m).alias(m) for m in measures]))
    return side.filter(F.col("category") != people_category).unionByName(completed)


DAY_KEY = ("user_id", "category", "value", "modal_day")


def merge_by_day(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Q21 option, state side: keep counts per (user, category, value, mail day)
    so they can be aged again later. Batches are added on that key (a full outer
    join on unique keys, no skew)."""
    s = stored.select(*DAY_KEY, F.col("frequency").alias("_sf"))
    n = new.select(*DAY_KEY, F.col("frequency").alias("_nf"))
    return s.join(n, on=list(DAY_KEY), how="full_outer").select(
        *DAY_KEY, (F.coalesce("_sf", F.lit(0)) + F.coalesce("_nf", F.lit(0))).cast("bigint").alias("frequency"))


def reage(by_day: DataFrame, schedule, as_of, null_day_keeps_count: bool = False) -> DataFrame:
    """Q21 option, read side: age every day's count at ``as_of`` and add them up
    per (user, category, value). Without it, stored aged counts are added as
    they were computed (the original behaviour, the default of the pipeline)."""
    from kenning import config as _config
    from kenning.functions.dates import days_since
    from kenning.functions.mathx import aged_count
    if isinstance(schedule, str):
        schedule = _config.DECAY_SCHEDULES[schedule]
    d = days_since(F.col("modal_day"), as_of)
    aged = by_day.withColumn("decay_frequency", aged_count(F.col("frequency"), d, schedule, null_day_keeps_count))
    return aged.groupBy(*KEY).agg(F.sum("frequency").cast("bigint").alias("frequency"),
                                  F.sum("decay_frequency").cast("bigint").alias("decay_frequency"))

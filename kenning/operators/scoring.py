"""Popularity lookups, min-max scaling and the interest weight (AG-3, JN-10, MA-4..7, WN-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning import config
from kenning.functions.mathx import minmax
from kenning.session import ensure_checkpoint_dir


def popularity(rows: DataFrame, key="entityName", freq="frequency", dfreq="decay_frequency") -> DataFrame:
    """AG-3: summed frequency and aged frequency per key; null keys are left out."""
    return (rows.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.sum(freq).cast("bigint").alias("lookup_freq"),
                 F.sum(dfreq).cast("bigint").alias("lookup_decay_freq")))


def with_column_range(df: DataFrame, cols, suffix=("_min", "_max")) -> DataFrame:
    """WN-3: attach the whole-table minimum and maximum of ``cols``.

    One aggregate computes all ranges with partial results per task and ends in a
    single row, read as a scalar subquery when the query runs: building the plan
    starts no job, no row moves into one task and no join is needed."""
    ends = F.struct(*[F.min(c).cast("double").alias(c + suffix[0]) for c in cols],
                    *[F.max(c).cast("double").alias(c + suffix[1]) for c in cols])
    row = df.agg(ends.alias("_ends")).scalar()
    return df.withColumn("_ends", row).withColumns(
        {c + s: F.col("_ends." + c + s) for c in cols for s in suffix}).drop("_ends")


def minmax_scale(df: DataFrame, col: str, outs: dict[str, float]) -> DataFrame:
    """MA-6 over a whole table: ``outs`` maps a new column to the low end of its scale."""
    ranged = with_column_range(df, [col])
    return (ranged.withColumns({out: minmax(F.col(col), F.col(col + "_min"), F.col(col + "_max"), low)
                                for out, low in outs.items()})
            .drop(col + "_min", col + "_max"))


def interest_weights(profile: DataFrame, people_category: str = config.PEOPLE,
                     categories=config.WEIGHT_CATEGORIES, key="entityName", user_name="userName",
                     digits: int = config.WEIGHT_DIGITS, materialize: bool = True) -> DataFrame:
    """P-4 weight step.

    Over rows of the kept categories, with f the frequency:
    lookup = sum f over the same entity name; own = sum f over entity name =
    the user's own name for people rows of named users (else f, also when the
    name is not an entity); t = sqrt(lookup + own); s = ln f;
    weight = minmax01(1.2 * minmax(0.1..1)(s) + minmax(0.1..1)(t)), rounded.
    ``d_weight`` is the same over aged counts.

    The scaling needs whole-table minima and maxima of values that depend on
    the joins, and then of the combined score: with ``materialize`` the joined
    rows are checkpointed to the shared checkpoint folder once, so the range
    aggregates re-read that table instead of re-running the joins (and an
    executor loss re-reads it instead of recomputing the lineage).
    """
    rows = profile.filter(F.col("category").isin(list(categories))) if categories else profile
    pop = popularity(rows, key)
    own = pop.select(F.col(key).alias("_own_key"), F.col("lookup_freq").alias("_own_f"),
                     F.col("lookup_decay_freq").alias("_own_df"))
    people_named = F.coalesce((F.col("category") == F.lit(people_category)) & F.col(user_name).isNotNull(), F.lit(False))
    # rows without an own name match nothing; their key is spread so that they do not meet in one task
    spread_key = F.pmod(F.xxhash64(key, "category", "frequency"), F.lit(4096)).cast("string")
    j = (rows.join(pop, on=key, how="left")
         .withColumn("_own", people_named)
         .withColumn("_probe", F.when(people_named, F.col(user_name)).otherwise(spread_key))
         .join(own.withColumn("_is", F.lit(True)), (F.col("_own") == F.col("_is")) & (F.col("_probe") == F.col("_own_key")), "left"))
    own_f = F.when(people_named, F.coalesce(F.col("_own_f"), F.col("frequency"))).otherwise(F.col("frequency"))
    own_df = F.when(people_named, F.coalesce(F.col("_own_df"), F.col("decay_frequency"))) \
        .otherwise(F.col("decay_frequency"))
    base = (j.withColumn("_t", F.sqrt((F.col("lookup_freq") + own_f).cast("double")))
            .withColumn("_s", F.ln(F.col("frequency").cast("double")))
            .withColumn("_dt", F.sqrt((F.col("lookup_decay_freq") + own_df).cast("double")))
            .withColumn("_ds", F.ln(F.col("decay_frequency").cast("double")))
            .drop("_own", "_probe", "_is", "_own_key", "_own_f", "_own_df"))
    if materialize:
        ensure_checkpoint_dir(base.sparkSession)
        base = base.checkpoint(eager=True)
    r1 = with_column_range(base, ["_s", "_t", "_ds", "_dt"])
    raw = (r1.withColumn("_w", F.lit(config.OWN_WEIGHT) * minmax("_s", "_s_min", "_s_max", config.SCALE_LOW)
                         + minmax("_t", "_t_min", "_t_max", config.SCALE_LOW))
           .withColumn("_dw", F.lit(config.OWN_WEIGHT) * minmax("_ds", "_ds_min", "_ds_max", config.SCALE_LOW)
                       + minmax("_dt", "_dt_min", "_dt_max", config.SCALE_LOW)))
    r2 = with_column_range(raw, ["_w", "_dw"])
    out = (r2.withColumn("weight", F.round(minmax("_w", "_w_min", "_w_max"), digits))
           .withColumn("d_weight", F.round(minmax("_dw", "_dw_min", "_dw_max"), digits)))
    return out.drop(*[c for c in out.columns if c.startswith("_")])

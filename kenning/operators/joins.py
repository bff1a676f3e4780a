"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bound under which a dictionary-like side is broadcast explicitly. Beyond it
# the join is left to the planner (sort-merge or shuffled hash, with adaptive
# execution turning it into a broadcast at run time if the measured size is small).
DEFAULT_BROADCAST_ROWS = 200_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads at most max_rows + 1 rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its row count is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def spread(df: DataFrame, min_partitions: int | None = None, per_core: int = 4) -> DataFrame:
    """Round-robin the rows over at least ``min_partitions`` tasks (default:
    ``per_core`` tasks per core of the cluster) when the input arrives in fewer
    partitions.

    Text work is per row and CPU-bound: a small file stored as one row group
    would otherwise be tokenized by one task, and texts of very different
    lengths need a few tasks per core to even out. Large inputs already arrive
    in many splits and pass through without a shuffle."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism * per_core
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDD access: leave the input as it is
        return df
    return df.repartition(want) if have < want else df

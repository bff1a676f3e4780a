"""Helpers shared by the operators: scratch tables, bounded bitmaps, text batches.

Bounded bitmaps are how a set of keys that grows with the corpus is sent to
every task: the keys set bits in a bitmap of fixed size (``BITMAP_BUCKETS`` rows
of 4 KB, 16 MB in all), whatever their number. A set bit means "perhaps in the
set"; every user of a bitmap decides the rest exactly afterwards, so a bitmap
that fills up costs work but never changes a result.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning.session import prepare, scratch_path

BITMAP_BUCKETS = 4096
BITMAP_BITS = BITMAP_BUCKETS * 32768
# Texts of one Arrow batch are in a Python worker's memory together.
BATCH_ROWS = 512
# The white space of every contract here: space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\x0c\r"


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches (texts are long).

    The functions of this subpackage travel to the executors by value, so they
    need not be installed there."""
    import kenning.llm
    prepare(spark)
    cloudpickle.register_pickle_by_value(kenning.llm)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders of scratch tables that are still there, oldest first.
_TABLES: list[str] = []


def scratch(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage with files every executor can read; they are deleted by
    ``forget``, or when the driver ends."""
    spark = df.sparkSession
    path = scratch_path(spark, f"kenning-{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    _TABLES.append(path)
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(p)
    except AttributeError:  # a session without a JVM gateway: the files stay
        pass
    return spark.read.schema(df.schema).parquet(path)


def known_tables() -> set[str]:
    """The scratch tables there are now, for ``forget``."""
    return set(_TABLES)


def forget(spark: SparkSession, paths) -> None:
    """Delete scratch tables that no frame in use reads any more."""
    for path in [p for p in _TABLES if p in paths]:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
        except AttributeError:  # a session without a JVM gateway: the files stay
            pass
        _TABLES.remove(path)


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """The bounded bitmap of the bigint column ``key``: at most ``BITMAP_BUCKETS``
    rows (``bm_bucket``, ``bm_bits``), nulls ignored."""
    x = F.expr(f"pmod(`{key}`, {BITMAP_BITS}L) + 1L")
    return (keys.where(F.col(key).isNotNull())
            .select(F.bitmap_bucket_number(x).alias("bm_bucket"), F.bitmap_bit_position(x).alias("bm_pos"))
            .groupBy("bm_bucket").agg(F.bitmap_construct_agg("bm_pos").alias("bm_bits")))


def flag_by_bitmap(df: DataFrame, key: Column, bits: DataFrame, flag: str) -> DataFrame:
    """``df`` with the boolean ``flag``: false if ``key`` is surely not among the
    bitmap's keys. The bitmap is broadcast; its size is bounded by construction."""
    names = df.columns
    x = F.pmod(key, F.lit(BITMAP_BITS)) + F.lit(1).cast("bigint")
    probe = df.withColumns({"bm_bucket": F.bitmap_bucket_number(x), "bm_at": F.bitmap_bit_position(x)})
    hit = F.expr("(shiftright(cast(conv(hex(substring(bm_bits, cast(bm_at div 8 as int) + 1, 1)), 16, 10) as int),"
                 " cast(bm_at % 8 as int)) & 1) = 1")
    return (probe.join(F.broadcast(bits), "bm_bucket", "left")
            .select(*[F.col(f"`{c}`") for c in names], F.coalesce(hit, F.lit(False)).alias(flag)))


def bitmap_array(bits: DataFrame) -> np.ndarray:
    """The bitmap as bytes for use inside Python tasks (16 MB, fixed)."""
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for bucket, data in bits.toLocalIterator():
        out[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(bytes(data), np.uint8)
    return out


def bitmap_has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Per uint64 key: may it be in the set?"""
    x = keys & np.uint64(BITMAP_BITS - 1)
    return (bits[(x >> np.uint64(3)).astype(np.int64)] >> (x & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


def without(df: DataFrame, dropped: DataFrame, keys: dict[str, Column], flag_key: Column) -> DataFrame:
    """Rows of ``df`` whose ``keys`` (name in ``dropped`` -> expression over ``df``)
    are not in ``dropped``, nulls equal to nulls.

    Rows the bounded bitmap clears stay where they are; only the others, with
    their texts, are shuffled to the exact anti join. ``flag_key`` is a bigint
    over ``df``; ``dropped`` carries the same value as ``flag_key``."""
    # the row is one struct, so none of its columns can clash with a helper's
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("r"), flag_key.alias("flag_key"),
                     *[e.alias(f"k_{k}") for k, e in keys.items()])
    marked = flag_by_bitmap(rows, F.col("flag_key"), bitmap(dropped, "flag_key"), "bm_maybe")
    clear = marked.where(~F.col("bm_maybe")).select("r.*")
    rest = marked.where("bm_maybe")
    cond = None
    for k in keys:
        c = F.col(f"k_{k}").eqNullSafe(F.col(f"d_{k}"))
        cond = c if cond is None else cond & c
    gone = dropped.select(*[F.col(k).alias(f"d_{k}") for k in keys]).distinct()
    return clear.unionByName(rest.join(gone, cond, "left_anti").select("r.*"))


def text_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null as empty."""
    import pyarrow as pa
    return [b or b"" for b in column.cast(pa.large_binary() if pa.types.is_large_string(column.type)
                                          else pa.binary()).to_pylist()]


def signed(x: int) -> int:
    """A 64-bit unsigned value as a bigint holds it."""
    return x - (1 << 64) if x >> 63 else x

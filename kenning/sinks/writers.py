"""Writers (SNK-1..6). Outputs are JSON lines / CSV / Parquet folders written by
the executors; nothing is assembled on the driver."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["write_json", "write_csv", "write_pieces", "write_state", "write_buckets", "read_buckets", "state_buckets",
           "bucket_of", "current_state_path", "applied"]


def write_json(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """SNK-1/2/4/5 as JSON lines; SNK-6 pieces via ``maxRecordsPerFile``."""
    w = df.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.json(path)


def write_csv(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """SNK-5 as CSV with a header (arrays and structs as JSON text)."""
    flat = df.select(*[F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map")
                       else F.col(f.name) for f in df.schema.fields])
    w = flat.write.mode("overwrite").option("header", True)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.csv(path)


def write_pieces(df: DataFrame, path: str, rows: int, order, fmt: str = "json") -> int:
    """SNK-6: files of exactly ``rows`` rows in the order of the columns ``order`` (a
    total order), the last one with the rest. Returns the number of files.

    Rows get their exact rank (``rank_within``, no task sorts all), the rank gives the
    piece, and tasks take ranges of whole pieces, so a piece is never cut between
    tasks; each task starts a new file after ``rows`` rows."""
    from kenning.operators.profile import rank_within
    if rows < 1:
        raise ValueError("a piece has one row at least")
    ranked = rank_within(df, [], [F.col(c) for c in order], out="_at")
    pieces = (ranked.withColumn("_piece", F.floor((F.col("_at") - 1) / rows)).repartitionByRange("_piece")
              .sortWithinPartitions("_at").drop("_at", "_piece"))
    pieces.write.mode("overwrite").option("maxRecordsPerFile", rows).option("header", True).format(fmt).save(path)
    return -(-(ranked.agg(F.max("_at")).first()[0] or 0) // rows)


POINTER_SCHEMA = "seq bigint, version string, path string, source string, n_buckets int, folders array<string>"
STATE_BUCKETS = 64


def _pointers(spark: SparkSession, root: str) -> DataFrame | None:
    """All pointer rows, or None if there is no pointer folder. Anything else that
    goes wrong (a damaged file, no access) is an error: an unreadable pointer must
    not look like an empty state."""
    try:
        rows = spark.read.schema(POINTER_SCHEMA).option("mode", "FAILFAST").json(f"{root}/_pointer")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows.withColumn("seq", F.coalesce("seq", F.lit(0)))


def write_state(spark: SparkSession, df: DataFrame, root: str, version: str, source: str | None = None) -> str:
    """SNK-3: write the profile to a new version folder, then add a pointer row.

    Nothing is overwritten: the version folders stay as backups, and each version
    appends its own pointer file, so a crash leaves the previous state in force.
    ``source`` names what was merged (see ``applied``). Returns the new folder."""
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    _point(spark, root, version, path, source)
    return path


def _point(spark: SparkSession, root: str, version: str, path: str, source: str | None, n_buckets: int | None = None,
           folders: list[str] | None = None) -> None:
    known = _pointers(spark, root)
    last = known.agg(F.max("seq")).first()[0] if known is not None else None
    spark.createDataFrame([((last or 0) + 1, version, path, source, n_buckets, folders)], POINTER_SCHEMA) \
        .coalesce(1).write.mode("append").json(f"{root}/_pointer")


def bucket_of(key, n: int):
    """The bucket of a user in a state of ``n`` buckets."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def state_buckets(spark: SparkSession, root: str) -> int | None:
    """How many buckets the state in force has; None if there is no state or it has none."""
    row = _current(spark, root)
    return row["n_buckets"] if row else None


def read_buckets(spark: SparkSession, root: str, buckets) -> DataFrame | None:
    """The rows of some buckets of the state in force, from their folders alone; None if
    they have no rows yet."""
    row = _current(spark, root)
    if row is None:
        return None
    wanted = {f"bucket={b}" for b in buckets}
    folders = [f"{root}/{f}" for f in row["folders"] or [] if f.rsplit("/", 1)[-1] in wanted]
    return spark.read.parquet(*folders) if folders else None


def write_buckets(spark: SparkSession, df: DataFrame, root: str, version: str, source: str | None, touched, n: int = STATE_BUCKETS,
                  key: str = "user_id", spread_by: str = "value") -> str:
    """SNK-3 for a state laid out by a hash of the user: write the buckets ``touched`` (with
    all their rows, from ``df``) to a new version folder. The other buckets stay the files
    that they were; the pointer lists, bucket by bucket, the folder in force.

    A bucket's rows go to several files, so a user with very many rows is not one task."""
    touched = sorted(set(touched))
    folder = f"version={version}"
    rows = df.withColumn("bucket", bucket_of(key, n)).where(F.col("bucket").isin(touched))
    (rows.repartition("bucket", F.pmod(F.xxhash64(spread_by), F.lit(4))).write.mode("overwrite").partitionBy("bucket")
     .parquet(f"{root}/{folder}"))
    written = {r["bucket"] for r in rows.select("bucket").distinct().collect()}    # at most n
    row = _current(spark, root)
    gone = {f"bucket={b}" for b in touched}
    kept = [f for f in (row["folders"] or [] if row else []) if f.rsplit("/", 1)[-1] not in gone]
    folders = kept + [f"{folder}/bucket={b}" for b in sorted(written)]
    path = root + "/{" + ",".join(folders) + "}"
    _point(spark, root, version, path, source, n, folders)
    return path


def _current(spark: SparkSession, root: str):
    known = _pointers(spark, root)
    return known.orderBy(F.desc("seq")).first() if known is not None else None


def current_state_path(spark: SparkSession, root: str) -> str | None:
    """The folder the newest pointer names (of a state in buckets: a pattern of all its
    folders), or None before the first write."""
    row = _current(spark, root)
    return row["path"] if row else None


def applied(spark: SparkSession, root: str, source: str) -> bool:
    """Was this source (a stream's batch) merged into the state already?"""
    known = _pointers(spark, root)
    return known is not None and not known.where(F.col("source") == source).isEmpty()

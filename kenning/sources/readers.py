"""Readers for the message tables, conversation files, dictionaries, directory
and stored profile (SRC-1..9). Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning import schemas
from kenning.operators.relational import number_rows

__all__ = ["read_csv_renamed", "read_message_table", "read_companion", "read_aligned", "align_rows", "read_user_ids",
           "read_json_dict", "read_conversations_a", "read_conversations_b", "parse_conversations_a",
           "parse_conversations_b", "read_directory", "read_profile_state",
           "nested_profile_to_rows", "people_directory"]


def read_csv_renamed(spark: SparkSession, path: str, columns: dict, longs=(), order: str | None = None) -> DataFrame:
    """CSV with a header, all columns read as strings (no inference), names trimmed
    and mapped by ``columns`` (original trimmed name -> new name); ``order`` names a
    column for the place of a row: file, block, row."""
    raw = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
           .option("inferSchema", False).csv(path))
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
             F.monotonically_increasing_id().alias("_row")] if order else []
    out = raw.select(*[F.col(f"`{c}`").alias(c.strip()) for c in raw.columns], *place)
    kept = [F.col(f"`{k}`").alias(v) for k, v in columns.items() if k in out.columns]
    if order:
        kept.append(F.struct("_file", "_block", "_row").alias(order))
    out = out.select(*kept)
    for c in longs:
        if c in out.columns:
            out = out.withColumn(c, F.col(c).cast("bigint"))
    return out


def _numbered(spark: SparkSession, path: str, columns: dict, longs) -> tuple[DataFrame, bool]:
    """The table with its own ``row_seq``, or with the rows' positions over all files;
    and which of the two it is."""
    df = read_csv_renamed(spark, path, columns, longs=longs, order="_place")
    if "row_seq" in df.columns:
        return df.drop("_place"), False
    return number_rows(df, "_place", "row_seq"), True


def read_message_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: the F4 message table; ``row_seq`` carries the file order (the column of
    that name, else the position of the row over all files)."""
    return _numbered(spark, path, schemas.MESSAGE_TABLE_COLUMNS, ("row_seq", "conversationId"))[0]


def read_companion(spark: SparkSession, path: str) -> DataFrame:
    """F5 companion table (row-aligned with F4 through ``row_seq``, see there)."""
    return _numbered(spark, path, schemas.COMPANION_COLUMNS, ("row_seq",))[0]


def read_aligned(spark: SparkSession, messages: str, companion: str) -> tuple[DataFrame, DataFrame]:
    """SRC-2: the message table and its companion with row numbers that agree. Where
    either has none, both are numbered by position, and tables of different lengths are
    an error: a shift by one row would put every date on the wrong message."""
    (m, by_place), (c, c_by_place) = (_numbered(spark, p, cols, longs) for p, cols, longs in (
        (messages, schemas.MESSAGE_TABLE_COLUMNS, ("row_seq", "conversationId")), (companion, schemas.COMPANION_COLUMNS, ("row_seq",))))
    if not (by_place or c_by_place):
        return m, c
    if by_place != c_by_place:
        raise ValueError("only one of the two tables has row numbers")
    n, n_c = m.count(), c.count()
    if n != n_c:
        raise ValueError(f"the companion has {n_c} rows, the message table {n}")
    return m, c


def align_rows(main: DataFrame, companion: DataFrame, key="row_seq") -> DataFrame:
    """SRC-2: take the companion's columns for the same row: an equi-join on the row
    number both have (see ``read_aligned``)."""
    return main.join(companion, on=key, how="left")


def read_user_ids(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: (emailId, userId) -> (email, user_id)."""
    return read_csv_renamed(spark, path, {"emailId": "email", "userId": "user_id"})


def read_json_dict(spark: SparkSession, path: str, key="key", value="value", lines: bool = False) -> DataFrame:
    """SRC-4: a JSON object ``{k: v}`` as two columns.

    A single JSON object cannot be split by any reader; ``lines=True`` reads the
    scalable form, one ``{"key":..., "value":...}`` object per line."""
    if lines:
        return spark.read.schema(f"{key} string, {value} string").json(path)
    t = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), "map<string,string>")
    return t.select(F.explode(m).alias(key, value))


def _with_batch(df: DataFrame) -> DataFrame:
    return df.withColumn("batch_id", F.col("_metadata.file_name"))


def parse_conversations_a(text: DataFrame) -> DataFrame:
    """Shape A lines (column ``value``, plus ``batch_id``) to message rows."""
    m = text.select("batch_id", F.explode(F.from_json("value", schemas.CONVERSATIONS_A)).alias("_conv", "_msgs"))
    r = m.select("batch_id", F.inline("_msgs"))
    return r.select(
        F.col("conversation_id"), F.col("id").alias("message_id"), F.coalesce("subject", F.lit("NA")).alias("subject"),
        "body", "date", "from_email", F.col("to_recipients").alias("to"), F.col("cc_recipients").alias("cc"),
        "batch_id")


def read_conversations_a(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5/SRC-7: JSON lines, each line ``{conversation: [message, ...]}``; every
    line of every file is read (Q7). Missing subject -> 'NA'."""
    return parse_conversations_a(_with_batch(spark.read.text(path)))


def parse_conversations_b(text: DataFrame, lower_addresses: bool = True) -> DataFrame:
    """Shape B lines (column ``value``, plus ``batch_id``) to message rows."""
    r = text.select("batch_id", F.inline(F.from_json("value", schemas.CONVERSATIONS_B)))
    low = (lambda c: F.lower(c)) if lower_addresses else (lambda c: c)
    return r.select(
        "conversation_id", F.col("id").alias("message_id"), F.coalesce("subject", F.lit("NA")).alias("subject"),
        "body", "date", low(F.col("from.email")).alias("from_email"),
        F.transform("recipients", lambda p: low(p["email"])).alias("to"),
        F.array().cast("array<string>").alias("cc"), "batch_id")


def read_conversations_b(spark: SparkSession, path: str, lower_addresses: bool = True) -> DataFrame:
    """SRC-6: JSON lines, each line an array of messages with a sender object and
    recipient objects; addresses are taken from them (and lower-cased, tenant B)."""
    return parse_conversations_b(_with_batch(spark.read.text(path)), lower_addresses)


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: the user directory: (sub_id, email_id, user_name, ord); ``ord`` keeps
    file order for "first row wins" rules: (file, block of the file, row of the task),
    whatever order the files are read in."""
    return read_csv_renamed(spark, path, schemas.DIRECTORY_COLUMNS, order="ord")


def read_profile_state(spark: SparkSession, path: str | None) -> DataFrame:
    """SRC-9: the stored profile, or an empty one."""
    if path is None:
        return spark.createDataFrame([], schemas.PROFILE)
    return spark.read.schema(schemas.PROFILE).parquet(path)


def nested_profile_to_rows(spark: SparkSession, path: str, measure="frequency") -> DataFrame:
    """SRC-9 importer: a nested JSON profile ``{user: {category: {value: n}}}``
    (one object per line) to rows."""
    t = spark.read.text(path)
    u = t.select(F.explode(F.from_json("value", schemas.NESTED_PROFILE)).alias("user_id", "_c"))
    c = u.select("user_id", F.explode("_c").alias("category", "_v"))
    return c.select("user_id", "category", F.explode("_v").alias("value", measure))


def people_directory(names: DataFrame, ids: DataFrame, id_overlay: DataFrame | None = None,
                     tag_ids: bool = True) -> DataFrame:
    """(email, user_id, display) from the display-name and id dictionaries
    (MAP-1/MAP-3); ``id_overlay`` entries win over ``ids`` (MAP-2)."""
    from kenning.functions.text import user_tag
    from kenning.operators.relational import overlay
    i = ids.select("email", (user_tag(F.col("user_id")) if tag_ids else F.col("user_id")).alias("user_id"))
    if id_overlay is not None:
        i = overlay(i, id_overlay.select("email", "user_id"), "email", "user_id").drop("origin")
    n = names.select("email", F.col("display_name").alias("display"))
    return i.join(n, on="email", how="full_outer")

"""Reading the driver's parquet tables and the stand-in views built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as entity mentions: user = user_id, category = event_type,
    value = props.k, date = ts."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").cast("string").alias("user_id"),
                     F.col("event_type").alias("category"),
                     F.get_json_object("props", "$.k").alias("value"),
                     "ts")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as messages: conversation = conv_id, order = turn, sender = role."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("conversation_id"), "turn",
                    F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"),
                    F.col("role").alias("sender"), F.col("text").alias("body"))


def messages_with_neighbors(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The sender and ``columns`` of every message, with the sender of the previous and
    of the next turn."""
    from kenning.operators.relational import neighbors
    m = messages(spark, sf_dir).select("conversation_id", "turn", "sender", *columns)
    return neighbors(m, "conversation_id", "turn", "sender", carry=["sender", *columns])


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A text-heavy table, spread over the cluster when it arrives in few splits."""
    from kenning.operators.joins import spread
    return spread(table(spark, sf_dir, name))

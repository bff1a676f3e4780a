"""P-2 chat messages: message table + companion dates -> one record per message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.functions.arrays import first_item, without_sender
from kenning.functions.dates import format_out, parse_any_date, shift_after
from kenning.functions.text import parse_list_literal
from kenning.operators.directory import insert_ids, user_structs, with_directory_lists
from kenning.sources.readers import align_rows


def shifted_comment_dates(df: DataFrame) -> DataFrame:
    """DT-1 tolerant parse of both dates, then DT-2: the comment date moved after
    the mail date; rows where either date is missing keep the parsed comment date
    (FLT-11)."""
    rec = parse_any_date(F.col("receivedDateTime"))
    com = parse_any_date(F.col("commentDate"))
    shifted = F.when(rec.isNotNull() & com.isNotNull(), shift_after(com, rec)).otherwise(com.cast("timestamp"))
    return (df.withColumn("commentDate", format_out(shifted))
            .withColumn("receivedDateTime", format_out(rec)))


def chat_messages(msgs: DataFrame, companion: DataFrame, people: DataFrame) -> DataFrame:
    m = shifted_comment_dates(align_rows(msgs, companion))
    perms = parse_list_literal(F.col("_allow_permissions"))
    by = parse_list_literal(F.col("commentBy"))
    m = m.withColumn("_perms", perms).withColumn("_by", by) \
        .withColumn("_rec", without_sender(F.col("_perms"), first_item(F.col("_by"))))
    none = F.array().cast("array<string>")
    j = with_directory_lists(m, "row_seq", {"perms": "_perms", "rec": "_rec", "frm": "_by"}, people,
                             msgs, F.concat(F.coalesce(perms, none), F.coalesce(by, none)))
    out = j.select(
        F.col("conversationId").cast("string").alias("conversation_id"), "subject",
        F.col("comment").alias("body"), F.col("commentDate").alias("date"), F.col("id"),
        insert_ids(F.col("perms")).alias("_allow_permissions"), user_structs(F.col("rec")).alias("recipients"),
        F.lit("email").alias("type"), user_structs(F.col("frm")).alias("from"))
    return out.dropna(how="any").withColumn("message_id", F.col("id"))

"""P-1 mail conversations: message table -> one record per conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.functions.arrays import first_item, recipients_merge
from kenning.functions.dates import date_clean
from kenning.functions.text import parse_list_literal
from kenning.operators.directory import insert_ids, user_structs, with_directory_lists


def mail_conversations(msgs: DataFrame, people: DataFrame, replace: dict | None = None) -> DataFrame:
    """``msgs``: the F4 table (``read_message_table``); ``people``: (email, user_id, display).

    Steps: dates to ``YYYY-MM-DDTHH:MM:SSZ`` (DT-1); rows with any null dropped
    (FLT-1); optional whole-cell replacements (FLT-5, first mapping wins);
    messages per conversation counted on the null-free rows (AG-1); recipients =
    to + cc entries not in the sender (ARR-1); first row per conversation by file
    order (WN-2); permissions made distinct (ARR-3) with ids inserted (ARR-4);
    recipients and sender as user structs (ARR-5); count attached (JN-1) in the
    same aggregate."""
    m = msgs.withColumn("receivedDateTime", date_clean(F.col("receivedDateTime"))).dropna(how="any")
    if replace:
        for col, mapping in replace.items():
            m = m.replace(mapping, subset=[col])
    frm = parse_list_literal(F.col("fromEmailAddress"))
    m = m.withColumn("_from", frm).withColumn(
        "_recipients", recipients_merge(parse_list_literal(F.col("toRecipients")),
                                        parse_list_literal(F.col("ccRecipients")), first_item(frm)))
    cols = ["subject", "body_content", "receivedDateTime", "id", "_allow_permissions", "_from", "_recipients"]
    first = (m.groupBy("conversationId")
             .agg(F.min_by(F.struct(*cols), F.col("row_seq")).alias("_f"), F.count("commentBy").alias("num_messages"))
             .select("conversationId", "_f.*", "num_messages"))
    first = first.withColumn("_perms", F.array_distinct(parse_list_literal(F.col("_allow_permissions"))))
    none = F.array().cast("array<string>")
    j = with_directory_lists(first, "conversationId", {"perms": "_perms", "rec": "_recipients", "frm": F.array_distinct("_from")},
                             people, first, F.concat(*[F.coalesce(c, none) for c in ("_perms", "_recipients", "_from")]))
    return j.select(
        F.col("conversationId").cast("string").alias("conversation_id"), "subject",
        F.col("body_content").alias("body"), F.col("receivedDateTime").alias("date"),
        F.col("conversationId").cast("string").alias("id"),
        insert_ids(F.col("perms")).alias("_allow_permissions"),
        user_structs(F.col("rec")).alias("recipients"), F.lit("email-message").alias("type"),
        user_structs(F.col("frm")).alias("from"), F.col("num_messages").cast("bigint").alias("num_messages"))

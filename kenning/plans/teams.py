"""P-3 team conversations: message table + companion -> one record per
conversation with the first message and its replies nested under it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning import config
from kenning.functions.arrays import first_item
from kenning.functions.text import append_mentions, parse_list_literal
from kenning.operators import synth
from kenning.operators.directory import insert_ids, with_directory_lists
from kenning.operators.relational import REPLY_PAGE, nest_marked, reply_pages
from kenning.plans.chat import shifted_comment_dates
from kenning.sources.readers import align_rows


def _mentions(names, *row):
    """RND-3: half of the rows (keyed coin) mention 1..n participants, drawn with
    repeats by keyed hashes (n = distinct participants)."""
    n = F.size(F.array_distinct(names))
    k = F.pmod(synth.hash_int(*row, salt="mention-k"), F.greatest(n, F.lit(1))) + 1
    picks = F.transform(F.sequence(F.lit(1), k.cast("int")),
                        lambda i: F.element_at(names, (F.pmod(synth.hash_int(*row, i, salt="mention"),
                                                              F.size(names)) + 1).cast("int")))
    return F.when(synth.coin(*row, salt="mention-coin") & (F.size(names) > 0), picks) \
        .otherwise(F.array().cast("array<string>"))


def team_conversations(msgs: DataFrame, companion: DataFrame, people: DataFrame,
                       team_names=config.TEAM_NAMES, channel_names=config.CHANNEL_NAMES,
                       page_size: int | None = REPLY_PAGE) -> DataFrame:
    """``page_size``: split very long reply lists into pages (see ``nest_replies``)."""
    m = shifted_comment_dates(align_rows(msgs, companion))
    m = m.withColumn("component", F.coalesce(F.col("component"), F.lit("nan")))
    # RND-4, ARR-12: at most as many rows as there are names
    teams = synth.pseudonym_head(m, "component", team_names, out="team_name")
    m = m.join(F.broadcast(teams), on="component", how="left")
    m = m.withColumn("team_id", F.when(F.col("team_name").isNotNull(),
                                       F.substring(F.sha2(F.concat(F.lit("team|"), F.col("team_name")), 256), 1, 36)))
    m = m.dropna(subset=["comment"])                                                    # FLT-2
    perms, none = parse_list_literal(F.col("_allow_permissions")), F.array().cast("array<string>")
    by, sender = (F.array(first_item(parse_list_literal(F.col(c)))) for c in ("commentBy", "fromEmailAddress"))
    m = m.withColumn("_perms", perms).withColumn("_by", by).withColumn("_sender", sender)
    said = msgs.dropna(subset=["comment"])
    m = with_directory_lists(m, "row_seq", {"perms": "_perms", "by": "_by", "snd": "_sender"}, people,
                             said, F.concat(F.coalesce(perms, none), by, sender))
    names = F.transform("perms", lambda s: s["display"])
    m = (m.withColumn("mentions", _mentions(names, F.col("row_seq")))
         .withColumn("comment", append_mentions(F.col("comment"), F.col("mentions"))))       # STR-15
    # RND-2 + AG-2 + JN-1: a channel per row, the greatest per conversation; with it the
    # first row of the conversation, from the message table alone. It goes to that row only.
    channel = synth.pick(channel_names, F.col("conversationId"), F.col("row_seq"), salt="channel")
    conversations = (said.filter(F.col("conversationId").isNotNull()).groupBy("conversationId")
                     .agg(F.max(channel).alias("channel_name"), F.min("row_seq").alias("_first"), F.count("row_seq").alias("_n")))
    firsts = (conversations.filter(F.col("_first").isNotNull()).groupBy(F.col("_first").alias("row_seq"))
              .agg(F.map_from_entries(F.collect_list(F.struct("conversationId", "channel_name"))).alias("_firsts")))
    m = (m.filter(F.col("conversationId").isNotNull()).join(firsts, on="row_seq", how="left")
         .withColumn("channel_name", F.try_element_at("_firsts", F.col("conversationId"))))
    if page_size:
        pages = reply_pages(said.select("conversationId", "row_seq"), conversations.select("conversationId", "_n"),
                            "conversationId", "row_seq", page_size)
        m = (m.join(pages, on="row_seq", how="left")
             .withColumn("page", F.explode(F.coalesce(F.try_element_at("_pages", F.col("conversationId")),
                                                      F.array(F.lit(0).cast("bigint"))))))
    channel_id = F.substring(F.sha2(F.concat(F.lit("channel|"), F.col("channel_name")), 256), 1, 45)
    m = m.withColumn("channel_id", channel_id)
    person = (lambda c: F.struct(F.element_at(c, 1)["user_id"].alias("user_id"),
                                 F.element_at(c, 1)["display"].alias("user_display_name")))
    conv = F.col("conversationId").cast("string")
    m = m.withColumn("conversation_id", conv)
    message = F.struct(
        F.col("conversation_id"), F.col("conversation_id").alias("message_id"), "team_id", "team_name", "channel_id",
        "channel_name", F.col("body_content").alias("body"), person(F.col("snd")).alias("from"),
        F.col("receivedDateTime").alias("date"), F.lit("MESSAGE").alias("message_type"))
    head = F.struct(insert_ids(F.col("perms")).alias("_allow_permissions"), F.col("conversation_id").alias("id"),
                    F.col("receivedDateTime").alias("date"), message.alias("message"))
    reply = [F.col("id").cast("string").alias("id"), F.col("team_id"), F.col("team_name"),
             F.col("comment").alias("body"),
             person(F.col("by")).alias("from"), F.col("commentDate").alias("date"), F.col("mentions")]
    m = m.withColumn("_head", F.when(F.col("channel_name").isNotNull(), head))

    def whole(r, h):
        """A reply with what the conversation says of it."""
        return F.struct(
            h["message"]["conversation_id"].alias("conversation_id"), r["id"].alias("id"), r["team_id"].alias("team_id"),
            r["team_name"].alias("team_name"), h["message"]["channel_id"].alias("channel_id"),
            h["message"]["channel_name"].alias("channel_name"), r["body"].alias("body"), r["from"].alias("from"),
            r["date"].alias("date"), r["mentions"].alias("mentions"), F.lit("REPLY").alias("message_type"))

    return nest_marked(m, ["conversation_id", *(["page"] if page_size else [])], "row_seq", "_head", reply, whole)

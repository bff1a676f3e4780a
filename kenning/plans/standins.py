"""Queries over the driver's tables, one per operator group of the survey.

The driver has no mail tables, so the operators run on stand-ins (see
README): events are entity mentions, conversations are messages, documents and
pages are message text, customer/part/supplier are directories and names.
Every query reads whole tables; parameters are the operator's own.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning import config
from kenning.functions.arrays import recipients_merge, without_sender
from kenning.functions.dates import date_clean, format_out, shift_after
from kenning.functions.mathx import sigmoid
from kenning.functions.text import (append_mentions, build_content, clean_content, extract_mails, is_iso8601, lower_clean_body,
                                    name_tokens, parse_list_literal, rtrim_list, slash_paren, strip_brackets, title_case, user_tag)
from kenning.operators import directory as dirops
from kenning.operators import extract as ext
from kenning.operators import gazetteer as gz
from kenning.operators import profile as prof
from kenning.operators import relational as rel
from kenning.operators import scoring, state, synth
from kenning.operators.relational import REPLY_PAGE
from kenning.operators.joins import sized_broadcast, spread
from kenning.session import scratch_path
from kenning.sinks import writers
from kenning.sources.readers import (nested_profile_to_rows, read_conversations_a, read_conversations_b, read_json_dict,
                                     read_profile_state)
from kenning.plans.tables import event_mentions, messages, messages_with_neighbors, table, text_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AS_OF = _dt.date(2024, 2, 1)
SPLIT_TS = "2024-01-16 00:00:00"
EVENT_CATEGORIES = ("view", "click", "purchase", "signup", "error")
EVENT_PEOPLE = "signup"


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- events: profiles and weights

def _aged_profile(m: DataFrame, schedule: str) -> DataFrame:
    counts = prof.mention_counts(m)
    days = prof.modal_day(m)
    return prof.age_counts(counts, days, schedule, AS_OF)


@query("mention_counts")
def q_mention_counts(spark, sf):
    return prof.mention_counts(event_mentions(spark, sf))


@query("modal_day")
def q_modal_day(spark, sf):
    return prof.modal_day(event_mentions(spark, sf))


def _decay_query(schedule):
    def run(spark, sf):
        return _aged_profile(event_mentions(spark, sf), schedule).select(
            "user_id", "category", "value", "frequency", "modal_day", "days", "decay_frequency")
    return run


for _s in ("v1", "v2", "v3"):
    QUERIES[f"decay_{_s}"] = _decay_query(_s)


@query("rank_tags")
def q_rank_tags(spark, sf):
    return prof.rank_values(prof.mention_counts(event_mentions(spark, sf)))


@query("top_k_interests")
def q_top_k(spark, sf):
    return prof.top_k(prof.mention_counts(event_mentions(spark, sf)), 3)


def _weight_input(spark, sf) -> DataFrame:
    p = _aged_profile(event_mentions(spark, sf), "v2")
    return p.select("user_id", "category", "value", "frequency", "decay_frequency",
                    title_case(F.col("value")).alias("entityName"),
                    F.col("user_id").alias("userName"))


@query("interest_weights")
def q_interest_weights(spark, sf):
    return scoring.interest_weights(_weight_input(spark, sf), people_category=EVENT_PEOPLE,
                                    categories=EVENT_CATEGORIES)


@query("category_fold")
def q_category_fold(spark, sf):
    """NER-11 labels, then NER-12 folds, then FLT-8 keeps the listed categories.
    Stand-in roles: signup = PEOPLE, purchase = EMAIL, click = COMPONENTS, view = TOPICS."""
    from kenning.plans.interests import fold_categories, label_entities
    c = label_entities(prof.mention_counts(event_mentions(spark, sf)), {"signup": "Mention", "purchase": "Mail"})
    return (fold_categories(c, {"click": "view", "purchase": "signup"})
            .filter(F.col("category").isin("view", "signup", "error")))


@query("popularity_by_id")
def q_popularity_by_id(spark, sf):
    p = _aged_profile(event_mentions(spark, sf), "v2").withColumn("nameToId", user_tag(F.col("value")))
    return scoring.popularity(p, key="nameToId")


@query("profile_merge")
def q_profile_merge(spark, sf):
    m = event_mentions(spark, sf)
    stored = _aged_profile(m.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp")), "v2")
    new = _aged_profile(m.filter(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp")), "v2")
    return state.merge_profiles(stored, new)


@query("profile_merge_completed")
def q_profile_merge_completed(spark, sf):
    """JN-11 with the people names of both sides completed first (signup = PEOPLE;
    the values are numbers, so a one-digit one is often part of a longer one)."""
    m = event_mentions(spark, sf)
    stored = _aged_profile(m.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp")), "v2")
    new = _aged_profile(m.filter(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp")), "v2")
    return state.merge_profiles(stored, new, complete_people=True, people_category=EVENT_PEOPLE)


# ---------------------------------------------------------------- conversations: records and participants



def _nonnull(*cols):
    return F.filter(F.array(*cols), lambda x: x.isNotNull())


@query("first_message")
def q_first_message(spark, sf):
    m = messages(spark, sf)
    f = rel.first_per_group(m, "conversation_id", "turn", ["turn", "sender", "body"])
    return f.withColumn("type", F.lit("chat-message"))


@query("message_counts")
def q_message_counts(spark, sf):
    m = messages(spark, sf)
    return rel.first_with_count(m, "conversation_id", "turn", "body", ["sender"])


@query("replies_only")
def q_replies_only(spark, sf):
    return rel.replies(messages(spark, sf), "conversation_id", "turn").select(
        "conversation_id", "turn", "sender", "body")


@query("nested_replies")
def q_nested_replies(spark, sf):
    m = messages(spark, sf)
    first = rel.first_per_group(m, "conversation_id", "turn", ["turn", "sender"])
    reps = rel.replies(m, "conversation_id", "turn")
    nested = rel.nest_replies(first, reps, "conversation_id", "turn",
                              [F.col("turn"), F.col("sender"), F.col("body")], page_size=REPLY_PAGE)
    return nested.select(
        "conversation_id", F.col("turn").alias("message_turn"), F.col("sender").alias("message_sender"),
        F.size("replies").cast("bigint").alias("num_replies"),
        F.array_join(F.transform("replies", lambda r: r["turn"].cast("string")), ",").alias("reply_turns"),
        F.array_join(F.transform("replies", lambda r: r["sender"]), ",").alias("reply_senders"))


@query("channel_assign")
def q_channel_assign(spark, sf):
    m = messages(spark, sf).withColumn(
        "channel_name", synth.pick(config.CHANNEL_NAMES, F.col("conversation_id"), F.col("turn"), salt="channel"))
    per_conv = m.groupBy("conversation_id").agg(F.max("channel_name").alias("channel_name"))
    return per_conv.withColumn("channel_id", F.substring(F.sha2(F.concat(F.lit("channel|"), F.col("channel_name")),
                                                                  256), 1, 16))


@query("user_messages")
def q_user_messages(spark, sf):
    """JN-5: a message belongs to its sender and to the sender of the turn it
    answers (the recipient)."""
    m = messages_with_neighbors(spark, sf, "message_id").withColumn("to", _nonnull(F.col("prev_sender")))
    p = prof.explode_participants(m, recipients=("to",)).select("message_id", "conversation_id", "user_id")
    return p.groupBy("user_id").agg(F.count(F.lit(1)).alias("num_messages"),
                                    F.countDistinct("conversation_id").alias("num_conversations"))


@query("participants_minus_sender")
def q_participants_minus_sender(spark, sf):
    m = messages_with_neighbors(spark, sf)
    perms = _nonnull(F.col("prev_sender"), F.col("sender"), F.col("next_sender"))
    others = without_sender(perms, F.col("sender"))
    return m.select("conversation_id", "turn", F.array_join(others, ",").alias("participants"),
                    F.size(others).cast("bigint").alias("n_participants"))


@query("recipients_merge")
def q_recipients_merge(spark, sf):
    m = messages_with_neighbors(spark, sf)
    rec = F.array_distinct(recipients_merge(_nonnull(F.col("prev_sender")),
                                            _nonnull(F.col("next_sender"), F.col("sender")), F.col("sender")))
    return m.select("conversation_id", "turn", F.array_join(rec, ",").alias("recipients"),
                    F.size(rec).cast("bigint").alias("n_recipients"))


@query("mention_suffix")
def q_mention_suffix(spark, sf):
    m = messages_with_neighbors(spark, sf, "message_id", "body")
    mentions = F.when(synth.coin(F.col("message_id"), salt="mention"),
                      _nonnull(F.col("prev_sender"), F.col("next_sender"))).otherwise(F.array().cast("array<string>"))
    return m.select("conversation_id", "turn", append_mentions(F.col("body"), mentions).alias("comment"))


# ---------------------------------------------------------------- text: cleaning, addresses, dictionary entities


# Stand-in dictionary over the invented prose of ``documents``: frequent words
# and word pairs per category, with overlaps (a pair and its words), one
# phrase in two categories, a case-sensitive rule, alternatives, an optional
# word, punctuation phrases and a versioned name.
STANDIN_GAZETTEER = (
    # category, phrase, canonical, case_sensitive, versioned, priority
    ("PROG_SCRIPT_LANG", "c++", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "c#", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "objective-c", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "que", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "{les|el}", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "the the", None, False, False, 1),
    ("TOPICS", "orantion", None, False, False, 2),
    ("TOPICS", "inoran", None, False, False, 2),
    ("TOPICS", "thatin", None, False, False, 2),
    ("TOPICS", "ononst", None, False, False, 2),
    ("TOPICS", "orre", None, False, False, 2),
    ("TOPICS", "attion", None, False, False, 2),
    ("TOPICS", "thanedble", None, False, False, 2),
    ("TOPICS", "eriner thanea", None, False, False, 2),
    ("PEOPLE", "hehely hehely", None, False, False, 3),
    ("PEOPLE", "rewh", None, False, False, 3),
    ("PEOPLE", "Der", "der", True, False, 3),
    ("PEOPLE", "inoran inoran", None, False, False, 3),
    ("COMPONENTS", "orre orre", None, False, False, 4),
    ("COMPONENTS", "orantion orantion", None, False, False, 4),
    ("COMPONENTS", "{of|in} the", None, False, False, 4),
    ("COMPONENTS", "and the", None, False, False, 4),
    ("COMPONENTS", "la de", None, False, False, 4),
    ("OS", "mail", None, False, True, 5),
    ("OS", "windows", None, False, True, 5),
    ("OS", "example.com", None, False, False, 5),
    ("TEAMS", "der", None, False, False, 6),
    ("TEAMS", "{die|das|den}", None, False, False, 6),
    ("TEAMS", "und", None, False, False, 6),
    ("TEAMS", "von", None, False, False, 6),
    ("CLOUD_PLATFORMS", "the of", None, False, False, 7),
    ("CLOUD_PLATFORMS", "de la", None, False, False, 7),
    ("COMMUNICATION_TECH_PLATFORMS", "attion to?", None, False, False, 8),
    ("COMMUNICATION_TECH_PLATFORMS", "thanedble the", None, False, False, 8),
)


def standin_gazetteer(spark):
    return gz.from_rows(spark, STANDIN_GAZETTEER)


def _doc_and_page_text(spark, sf):
    d = text_table(spark, sf, "documents").select(F.lit("doc").alias("source"), F.col("doc_id").alias("id"), "text")
    p = text_table(spark, sf, "pages").select(F.lit("page").alias("source"), F.col("page_id").alias("id"),
                                          F.col("html").alias("text"))
    return d.unionByName(p)


@query("clean_text")
def q_clean_text(spark, sf):
    d = text_table(spark, sf, "documents")
    return d.select("doc_id", clean_content(lower_clean_body(F.col("text"))).alias("clean"))


@query("html_strip_brackets")
def q_html_strip(spark, sf):
    return text_table(spark, sf, "pages").select("page_id", strip_brackets(F.col("html")).alias("text"))


@query("extract_mails")
def q_extract_mails(spark, sf):
    return _extract_mails(_doc_and_page_text(spark, sf))


def _extract_mails(t):
    return (t.select("source", "id", F.explode(extract_mails(F.col("text"))).alias("value"))
            .withColumn("category", F.lit("EMAIL")))


@query("known_mails")
def q_known_mails(spark, sf):
    """JN-3: addresses found in documents that are known from the pages."""
    d = text_table(spark, sf, "documents")
    known = _extract_mails(_doc_and_page_text(spark, sf).filter(F.col("source") == "page")) \
        .select(F.col("value").alias("address"))
    return ext.mail_entities(d, known=known).select("doc_id", "value")


@query("name_tokens")
def q_name_tokens(spark, sf):
    mails = _extract_mails(_doc_and_page_text(spark, sf)).select("value").distinct()
    toks = name_tokens(F.col("value"))
    return mails.select("value", F.array_join(toks, ",").alias("tokens"), F.size(toks).cast("bigint").alias("n_tokens"))


@query("gazetteer_matches")
def q_gazetteer_matches(spark, sf):
    return ext.match(text_table(spark, sf, "documents"), standin_gazetteer(spark))


# One-or-more rules on the text of ``_repeated_words``.
REPEAT_RULES = (("SIZE", "{part}+", "part", False, False, 1), ("SIZE", "{part}+ {is|was}", "part is", False, False, 2),
                ("TYPE", "{Steel|brass}+ and", None, False, False, 3), ("EXACT", "{PART}+ is", None, True, False, 4),
                ("TWO", "part {part}+ is", "two parts", False, False, 5))


def _repeated_words(spark, sf):
    """Parts described with a word that comes one to twenty times in a row."""
    k = F.col("p_partkey")
    word = F.when(k % 5 == 0, "PART ").otherwise("part ")
    parts = spread(table(spark, sf, "part").select("p_partkey", "p_type"))
    return parts.select(k.alias("doc_id"), F.concat(
        F.lit("the "), F.repeat(word, (k % 20 + 1).cast("int")), F.when(k % 3 == 0, "was ").otherwise("is "), F.col("p_type"), F.lit(" "),
        F.repeat(F.lit("Steel "), (k % 4).cast("int")), F.lit("and part")).alias("text"))


@query("gazetteer_repeats")
def q_gazetteer_repeats(spark, sf):
    """NER-4: words that may repeat."""
    return ext.match(_repeated_words(spark, sf), gz.from_rows(spark, REPEAT_RULES))


@query("longest_spans")
def q_longest_spans(spark, sf):
    return ext.entities(text_table(spark, sf, "documents"), standin_gazetteer(spark))


@query("self_mention_filter")
def q_self_mention_filter(spark, sf):
    """NER-9: users = addresses found in a document, mentions = its words; a
    mention is dropped when it starts with one of the user's own name words."""
    d = text_table(spark, sf, "documents")
    words = F.regexp_extract_all(F.lower(F.col("text")), F.lit(r"\p{L}+"), 0)
    rows = d.select("doc_id", words.alias("words"), F.explode(extract_mails(F.col("text"))).alias("mail"))
    said = rows.select("doc_id", F.col("mail").alias("user_id"), F.explode("words").alias("value"))
    kept = (prof.drop_self_mentions(said).groupBy("doc_id", F.col("user_id").alias("mail"))
            .agg(F.count(F.lit(1)).alias("n_kept")))
    return (rows.select("doc_id", "mail", F.size("words").cast("bigint").alias("n_words"))
            .join(kept, on=["doc_id", "mail"], how="left").fillna(0, subset=["n_kept"]))


@query("title_case")
def q_title_case(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", title_case(F.concat(F.col("p_name"), F.lit("-"), F.col("p_brand"), F.lit(" "),
                                                     F.col("p_type"))).alias("title"))


# ---------------------------------------------------------------- directory, names and addresses


# Alias dictionary for part names (alias, canonical, file order); the repeated
# key shows that the later entry wins, as in a Python dict.
STANDIN_ALIASES = (
    ("small ring", "ring", 1),
    ("red widget", "widget", 2),
    ("blue bolt", "bolt", 3),
    ("red widget", "gadget", 4),
    ("old anvil", "anvil", 5),
)


@query("name_completion")
def q_name_completion(spark, sf):
    """ARR-10 per brand over the part names and their first words."""
    p = table(spark, sf, "part")
    pool = (p.select("p_brand", F.col("p_name").alias("value"))
            .unionByName(p.select("p_brand", F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("value"))))
    return dirops.complete_names(pool, ["p_brand"], "value", out="completed")


@query("alias_map")
def q_alias_map(spark, sf):
    a = spark.createDataFrame(list(STANDIN_ALIASES), "alias string, canonical string, ord int")
    d = rel.dictionary(a, "alias", "canonical", "ord")
    p = table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_name").alias("value"))
    return dirops.apply_aliases(p, d, value="value")


def _names_and_directory(spark, sf):
    p = table(spark, sf, "part")
    names = (p.select(F.col("p_name").alias("value"))
             .unionByName(p.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("value")))
             .unionByName(p.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("value")))
             .unionByName(table(spark, sf, "customer").select(F.lower("c_mktsegment").alias("value"))))
    directory = p.select(F.concat(F.lit("SUB"), F.col("p_partkey").cast("string")).alias("sub_id"),
                         F.concat_ws(" ", "p_type", "p_brand").alias("user_name"), F.col("p_partkey").alias("ord"))
    known = p.select(F.concat(F.replace("p_name", F.lit(" "), F.lit(".")), F.lit("@"),
                              F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit(".example.com"))
                     .alias("address")).distinct()
    return dirops.resolve_names(names, directory, known)


@query("name_to_id")
def q_name_to_id(spark, sf):
    return _names_and_directory(spark, sf).select("value", "name_id")


@query("name_to_display")
def q_name_to_display(spark, sf):
    return _names_and_directory(spark, sf).select("value", "name_display")


def _mails_resolved(spark, sf):
    t = _doc_and_page_text(spark, sf)
    mails = _extract_mails(t)
    pages = text_table(spark, sf, "pages")
    directory = (pages.select(F.explode(extract_mails(F.col("html"))).alias("email_id"),
                              F.concat(F.lit("PAGE"), F.col("page_id").cast("string")).alias("sub_id"),
                              F.regexp_extract("url", r"://([^/:?#]+)", 1).alias("user_name"),
                              F.col("page_id").alias("ord")))
    known = mails.filter(F.col("source") == "doc").select(F.col("value").alias("address"))
    return dirops.resolve_mails(mails.select("value"), directory, known)


@query("mail_to_id")
def q_mail_to_id(spark, sf):
    return _mails_resolved(spark, sf).select("value", "mail_id")


@query("mail_to_name")
def q_mail_to_name(spark, sf):
    return _mails_resolved(spark, sf).select("value", "mail_display")


@query("directory_left_join")
def q_directory_left_join(spark, sf):
    # users of error events stand for people the directory does not know
    who = F.when(F.col("category") == "error", F.concat(F.lit("guest."), "user_id")).otherwise(F.col("user_id"))
    prof_rows = prof.mention_counts(event_mentions(spark, sf)).withColumn("email_id", who).drop("user_id")
    c = table(spark, sf, "customer")
    d = c.select(F.col("c_custkey").cast("string").alias("email_id"),
                 F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("sub_id"),
                 F.col("c_name").alias("user_name"), F.col("c_custkey").alias("ord"))
    return dirops.directory_join(prof_rows, d)


def _customer_address(k):
    return F.concat(F.lit("customer."), F.lpad(k.cast("string"), 9, "0"), F.lit("@example.com"))


def _people(spark, sf):
    return table(spark, sf, "customer").select(
        _customer_address(F.col("c_custkey")).alias("email"),
        F.concat(F.lit("USER_"), F.col("c_custkey").cast("string")).alias("user_id"), F.col("c_name").alias("display"))


def _order_entries(spark, sf):
    o = table(spark, sf, "orders")
    a = _customer_address(F.col("o_custkey"))
    perms = F.array_distinct(F.array(a, a, F.concat(F.lit("status."), F.lower("o_orderstatus"), F.lit("@example.com"))))
    d = _people(spark, sf)
    return dirops.list_with_directory(o.select("o_orderkey", perms.alias("perms")), "o_orderkey", "perms", d)


@query("permissions_expand")
def q_permissions_expand(spark, sf):
    e = _order_entries(spark, sf)
    return e.select("o_orderkey", F.array_join(dirops.insert_ids(F.col("entries")), ",").alias("permissions"))


@query("user_structs")
def q_user_structs(spark, sf):
    e = _order_entries(spark, sf)
    return e.select("o_orderkey", _users_text(dirops.user_structs(F.col("entries"))).alias("users"),
                    F.size(F.filter("entries", lambda s: s["user_id"].isNull())).cast("bigint").alias("n_unknown"))


def _users_text(users):
    """User structs as text: fields joined by '|', users by ';'."""
    return F.array_join(F.transform(users, lambda s: F.concat_ws("|", F.coalesce(s["user_id"], F.lit("")),
                                                                 F.coalesce(s["user_display_name"], F.lit("")), s["email"])), ";")


# ---------------------------------------------------------------- the message pipelines on orders

def _message_table(spark, sf):
    """orders as the message table: conversation = customer, row = order, the customer
    writes to the order's status address and to the customer of the same number as the
    order (unknown beyond the directory). List cells are Python literals; finished
    orders have empty recipient lists, every 97th a malformed permission cell, every
    13th a mail date that no format reads."""
    k, own = F.col("o_orderkey"), _customer_address(F.col("o_custkey"))
    status = F.concat(F.lit("status."), F.lower("o_orderstatus"), F.lit("@example.com"))
    other = _customer_address(k)
    received = F.when(k % 13 == 0, F.lit("some day")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))

    def cell(*items):
        return F.concat(F.lit("['"), F.concat_ws("', '", *items), F.lit("']"))

    done = F.col("o_orderstatus") == "F"
    return table(spark, sf, "orders").select(
        k.alias("row_seq"), F.col("o_custkey").alias("conversationId"), k.cast("string").alias("id"),
        F.col("o_orderpriority").alias("subject"), F.concat(F.lit("order "), k.cast("string")).alias("body_content"),
        received.alias("receivedDateTime"), cell(own).alias("fromEmailAddress"),
        F.when(done, "[]").otherwise(cell(status)).alias("toRecipients"),
        F.when(done, "[]").otherwise(cell(own, other)).alias("ccRecipients"),
        F.concat(F.lit("paid "), F.col("o_totalprice").cast("bigint").cast("string")).alias("comment"),
        cell(other).alias("commentBy"),
        F.when(k % 97 == 0, "['broken").when(done & (k % 2 == 0), "[]").otherwise(cell(own, own, other, status)).alias("_allow_permissions"))


def _companion(spark, sf):
    """The companion columns of the same rows: comment date (a day of 2001 on, none for
    every 17th row) and component (the priority; none for every 19th)."""
    k = F.col("o_orderkey")
    day = F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), (k % 700).cast("int")), "dd MMM yyyy")
    return table(spark, sf, "orders").select(
        k.alias("row_seq"), F.when(k % 17 != 0, day).alias("commentDate"), F.when(k % 19 != 0, F.col("o_orderpriority")).alias("component"))


@query("mail_conversations")
def q_mail_conversations(spark, sf):
    """P-1 end to end."""
    from kenning.plans.mail import mail_conversations
    c = mail_conversations(_message_table(spark, sf), _people(spark, sf), replace={"subject": {"5-LOW": "5-NONE"}})
    return c.select("conversation_id", "subject", "body", "date", "id", F.array_join("_allow_permissions", ",").alias("permissions"),
                    _users_text(F.col("recipients")).alias("recipients"), "type", _users_text(F.col("from")).alias("sender"),
                    "num_messages")


@query("chat_messages")
def q_chat_messages(spark, sf):
    """P-2 end to end."""
    from kenning.plans.chat import chat_messages
    c = chat_messages(_message_table(spark, sf), _companion(spark, sf), _people(spark, sf))
    return c.select("conversation_id", "message_id", "subject", "body", "date", "id",
                    F.array_join("_allow_permissions", ",").alias("permissions"),
                    _users_text(F.col("recipients")).alias("recipients"), "type", _users_text(F.col("from")).alias("sender"))


@query("team_conversations")
def q_team_conversations(spark, sf):
    """P-3 end to end: first message and replies of each conversation, one text per reply."""
    from kenning.plans.teams import team_conversations
    c = team_conversations(_message_table(spark, sf), _companion(spark, sf), _people(spark, sf), page_size=REPLY_PAGE)

    def text(*parts):
        return F.concat_ws("|", *[F.coalesce(p, F.lit("-")) for p in parts])

    reply = F.transform("replies", lambda r: text(
        r["id"], r["team_id"], r["team_name"], r["channel_id"], r["channel_name"], r["body"], r["from"]["user_id"],
        r["from"]["user_display_name"], r["date"], F.array_join(r["mentions"], ","), r["message_type"]))
    m = F.col("message")
    head = text(m["message_id"], m["team_id"], m["team_name"], m["channel_id"], m["channel_name"], m["body"],
                m["from"]["user_id"], m["from"]["user_display_name"], m["date"], m["message_type"])
    return c.select("conversation_id", "id", "date", F.array_join("_allow_permissions", ",").alias("permissions"),
                    head.alias("message"), F.array_join(reply, ";").alias("replies"),
                    F.size("replies").cast("bigint").alias("n_replies"))


# ---------------------------------------------------------------- dates, nulls, counts, dictionaries, pseudonyms

@query("date_clean")
def q_date_clean(spark, sf):
    o = spread(table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority"))
    li = spread(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"))
    forms = {"space_offset": "yyyy-MM-dd HH:mm:ss'+00:00'", "slashes": "M/d/yyyy", "half_day": "M/d/yyyy h:mm a", "day_first": "d MMMM yyyy HH:mm",
             "no_comma": "MMM d yyyy", "to_the_minute": "yyyy-MM-dd'T'HH:mm", "dashes": "dd-MMM-yyyy", "digits": "yyyyMMdd",
             "c_time": "EEE MMM dd HH:mm:ss yyyy", "comment": "EEE, d MMM yyyy HH:mm:ss '+0000 (UTC)'", "zone": "d MMM yyyy HH:mm:ss 'EST'",
             "dots": "yyyy.MM.dd", "left_over": "yyyy-MM-dd 'or so'", "header": "EEE, dd MMM yyyy HH:mm:ss '+0000'", "long": "d MMMM yyyy", "american": "MMMM d, yyyy", "minutes": "yyyy-MM-dd HH:mm",
             "offset": "yyyy-MM-dd'T'HH:mm:ss'+0000'"}
    written = {"orders": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "priority": F.col("o_orderpriority")}
    written |= {name: F.date_format("o_orderdate", form) for name, form in forms.items()}
    # the table is read once, each row written in every form
    cells = F.array(*[F.struct(F.lit(name).alias("source"), F.col("o_orderkey").alias("k1"), F.lit(0).cast("int").alias("k2"),
                               c.alias("raw")) for name, c in written.items()])
    raw = o.select(F.inline(cells)).unionByName(li.select(
        F.lit("lineitem").alias("source"), F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"),
        F.date_format("l_shipdate", "dd MMM yyyy").alias("raw")))
    return raw.withColumn("clean", date_clean(F.col("raw")))


def _list_cells(spark, sf):
    """Cells of several forms written from two values of an order: well-formed lists and
    tuples, and what is none."""
    a, b = F.col("o_orderpriority"), F.concat(F.lit("it's "), F.col("o_orderstatus"))
    forms = {"double": F.concat(F.lit("['"), a, F.lit("', \""), b, F.lit("\"]")),
             "escaped": F.concat(F.lit("['"), a, F.lit("', '"), F.replace(b, F.lit("'"), F.lit("\\'")), F.lit("']")),
             "none": F.concat(F.lit("[None, '"), a, F.lit("']")),
             "comma": F.concat(F.lit("[ '"), a, F.lit("' , ]")),
             "tuple": F.concat(F.lit("('"), a, F.lit("', '\\x41\\t')")),
             "empty": F.lit("[]"), "numbers": F.lit("(1, -2.5,)"),
             "junk": F.concat(F.lit("['"), a, F.lit("'] junk")), "open": F.concat(F.lit("['"), a),
             "names": F.concat(F.lit("["), a, F.lit("]")), "lone": F.concat(F.lit("('"), a, F.lit("')")), "blank": F.lit("")}
    cells = F.array(*[F.struct(F.lit(n).alias("form"), c.alias("cell")) for n, c in forms.items()],
                    F.struct(F.lit("null").alias("form"), F.lit(None).cast("string").alias("cell")))
    return table(spark, sf, "orders").select("o_orderkey", F.explode(cells).alias("c")).select("o_orderkey", "c.form", "c.cell")


@query("list_literals")
def q_list_literals(spark, sf):
    """STR-12 on every form of cell."""
    items = F.transform(parse_list_literal("cell"), lambda x: F.coalesce(x, F.lit("-")))
    return _list_cells(spark, sf).select("o_orderkey", "form", F.array_join(items, "|").alias("items"))


@query("malformed_literals")
def q_malformed_literals(spark, sf):
    """STR-12: how many cells of each form are no list."""
    cells = _list_cells(spark, sf)
    wide = cells.groupBy("o_orderkey").pivot("form", ["double", "tuple", "junk", "open", "names", "lone", "blank", "null"]).agg(F.first("cell"))
    return rel.malformed_literals(wide, [c for c in wide.columns if c != "o_orderkey"])


@query("date_shift")
def q_date_shift(spark, sf):
    """DT-2 on events: each event (the comment) is moved to fall within a day
    after the user's first event (the mail)."""
    ev = table(spark, sf, "events")
    first = ev.groupBy("user_id").agg(F.min("ts").alias("received"))
    j = ev.select("event_id", "user_id", "ts").join(first, on="user_id")
    return j.select("event_id", format_out(shift_after(F.col("ts"), F.col("received"))).alias("shifted"))


@query("iso_valid")
def q_iso_valid(spark, sf):
    o = table(spark, sf, "orders")
    forms = {"plain": "yyyy-MM-dd'T'HH:mm:ss", "zulu": "yyyy-MM-dd'T'HH:mm:ss'Z'", "broken": "yyyy-MM-dd'T':HH:mm:ss"}
    parts = [o.select("o_orderkey", F.lit(k).alias("form"), F.date_format("o_orderdate", f).alias("raw"))
             for k, f in forms.items()]
    raw = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return raw.withColumn("valid", is_iso8601(F.col("raw")))


def _docs_labels(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), on="doc_id", how="left")


@query("null_profile")
def q_null_profile(spark, sf):
    return rel.null_counts(_docs_labels(spark, sf), ["quality", "toxic", "lang", "source"])


@query("fill_from_column")
def q_fill_from_column(spark, sf):
    d = _docs_labels(spark, sf).select("doc_id", "quality", "toxic")
    return (d.withColumn("toxic", F.coalesce(F.col("toxic"), F.col("quality")))
            .fillna(0, subset=["quality", "toxic"]))


@query("value_counts")
def q_value_counts(spark, sf):
    d = rel.value_counts(table(spark, sf, "documents").select(F.col("lang").alias("value")), "value")
    o = rel.value_counts(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("value")), "value")
    return d.withColumn("column", F.lit("lang")).unionByName(o.withColumn("column", F.lit("o_orderpriority")))


@query("distinct_values")
def q_distinct_values(spark, sf):
    d = table(spark, sf, "documents")
    o = table(spark, sf, "orders")
    parts = [rel.distinct_count(t, c).withColumn("column", F.lit(c)) for t, c in ((d, "lang"), (d, "source"), (o, "o_custkey"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    s = scoring.minmax_scale(o, "o_totalprice", {"scaled01": 0.0, "scaled0110": 0.1})
    return s.select("o_orderkey", F.round("scaled01", 6).alias("scaled01"), F.round("scaled0110", 6).alias("scaled0110"))


@query("dict_overlay")
def q_dict_overlay(spark, sf):
    old = rel.dictionary(table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"),
                                                            F.col("c_name").alias("name"), F.col("c_custkey").alias("ord")),
                         "nationkey", "name", "ord")
    new = rel.dictionary(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"),
                                                            F.col("s_name").alias("name"), F.col("s_suppkey").alias("ord")),
                         "nationkey", "name", "ord")
    return rel.overlay(old, new, "nationkey", "name")


@query("pseudo_ids")
def q_pseudo_ids(spark, sf):
    c = table(spark, sf, "customer")
    teams = synth.pseudonym_map(c, "c_mktsegment", config.TEAM_NAMES, out="team_name")
    return (c.join(teams, on="c_mktsegment", how="left")
            .select("c_custkey", synth.keyed_id(F.col("c_custkey"), 8, "id").alias("pseudo_id"), "c_mktsegment",
                    "team_name",
                    F.substring(F.sha2(F.concat(F.lit("team|"), F.col("team_name")), 256), 1, 12).alias("team_id")))


# ---------------------------------------------------------------- readers, writers and functions of the jobs

def _written(spark, df, name: str, write):
    """``df`` written by ``write(path)`` below the shared checkpoint folder; the path."""
    path = scratch_path(spark, f"kenning-{name}-{uuid.uuid4().hex}")
    write(df, path)
    return path


@query("conversation_files_a")
def q_conversation_files_a(spark, sf):
    """SRC-5, SRC-7: conversations written as JSON lines of shape A and read again."""
    c = messages(spark, sf)
    address = F.concat("sender", F.lit("@chat.example"))
    message = F.struct("conversation_id", F.col("message_id").alias("id"), F.when(F.col("turn") > 0, F.col("sender")).alias("subject"), "body",
                       address.alias("from_email"), F.array(F.lit("all@chat.example"), address).alias("to_recipients"),
                       F.array().cast("array<string>").alias("cc_recipients"))
    lines = (c.withColumn("m", message).groupBy("conversation_id").agg(F.sort_array(F.collect_list(F.struct("turn", "m"))).alias("ms"))
             .select(F.to_json(F.create_map("conversation_id", F.transform("ms", lambda x: x["m"]))).alias("value")))
    path = _written(spark, lines, "shape-a", lambda df, p: df.write.text(p))
    r = read_conversations_a(spark, path)
    return r.select("conversation_id", "message_id", "subject", "body", "from_email", F.array_join("to", ",").alias("to"),
                    F.size("cc").alias("n_cc"))


@query("conversation_files_b")
def q_conversation_files_b(spark, sf):
    """SRC-6, ARR-7: the same in shape B: sender and recipients as objects, addresses lowered."""
    c = messages(spark, sf)
    address = F.concat(F.upper("sender"), F.lit("@Chat.Example"))

    def person(email):
        return F.struct(email.alias("email"), F.lit("x").alias("user_id"), F.col("sender").alias("user_display_name"))

    message = F.struct("conversation_id", F.col("message_id").alias("id"), F.lit("s").alias("subject"), "body", person(address).alias("from"),
                       F.array(person(F.lit("All@chat.example")), person(address)).alias("recipients"))
    lines = c.select(F.to_json(F.array(message)).alias("value"))
    path = _written(spark, lines, "shape-b", lambda df, p: df.write.text(p))
    return read_conversations_b(spark, path).select("conversation_id", "message_id", "subject", "body", "from_email",
                                                    F.array_join("to", ",").alias("to"), F.size("cc").alias("n_cc"))


@query("json_dictionaries")
def q_json_dictionaries(spark, sf):
    """SRC-4: customers' segments as JSON objects, one file for each segment, and as lines of
    key and value."""
    c = table(spark, sf, "customer").select(F.col("c_name").alias("key"), F.col("c_mktsegment").alias("value"))
    objects = (c.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(32))).groupBy("part")
               .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("m"))
               .select("part", F.to_json("m").alias("text")))
    as_object = _written(spark, objects, "object", lambda df, p: df.write.partitionBy("part").text(p))
    as_lines = _written(spark, c, "lines", lambda df, p: df.write.json(p))
    return (read_json_dict(spark, as_object + "/*").select(F.lit("object").alias("form"), "*")
            .unionByName(read_json_dict(spark, as_lines, lines=True).select(F.lit("lines").alias("form"), "*")))


@query("profile_files")
def q_profile_files(spark, sf):
    """SRC-9: a nested JSON profile read to rows."""
    counts = prof.mention_counts(event_mentions(spark, sf)).filter(F.col("value").isNotNull())
    nested = (counts.groupBy("user_id", "category").agg(F.map_from_entries(F.collect_list(F.struct("value", "frequency"))).alias("v"))
              .groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("category", "v"))).alias("c"))
              .select(F.to_json(F.create_map("user_id", "c")).alias("value")))
    path = _written(spark, nested, "nested", lambda df, p: df.write.text(p))
    return nested_profile_to_rows(spark, path)


@query("state_versions")
def q_state_versions(spark, sf):
    """SNK-3, SRC-9: the profile as two state versions, the newest read again."""
    p = prof.mention_counts(event_mentions(spark, sf)).withColumns({"decay_frequency": F.col("frequency"), "batch_id": F.lit("b")})
    root = scratch_path(spark, f"kenning-state-{uuid.uuid4().hex}")
    writers.write_state(spark, p.filter("category = 'view'"), root, "1")
    writers.write_state(spark, p, root, "2")
    return read_profile_state(spark, writers.current_state_path(spark, root)).select("user_id", "category", "value", "frequency")


@query("json_and_csv_files")
def q_json_and_csv_files(spark, sf):
    """SNK-1, SNK-5: orders as JSON lines and as CSV with a list column, read again."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.array(F.col("o_orderstatus"), F.lit("it's, \"so\"")).alias("tags"))
    as_json = _written(spark, o, "json", lambda df, p: writers.write_json(df, p))
    as_csv = _written(spark, o, "csv", lambda df, p: writers.write_csv(df, p))
    j = spark.read.schema(o.schema).json(as_json)
    c = spark.read.option("header", True).option("escape", '\\').schema("o_orderkey bigint, o_orderpriority string, tags string").csv(as_csv)
    c = c.withColumn("tags", F.from_json("tags", "array<string>"))
    both = j.select(F.lit("json").alias("form"), "*").unionByName(c.select(F.lit("csv").alias("form"), "*"))
    return both.withColumn("tags", F.array_join("tags", "|"))


@query("pieces")
def q_pieces(spark, sf):
    """SNK-6: customers in files of 700 rows; rows per file, in order."""
    path = scratch_path(spark, f"kenning-pieces-{uuid.uuid4().hex}")
    writers.write_pieces(table(spark, sf, "customer").select("c_custkey"), path, 700, ["c_custkey"])
    r = spark.read.schema("c_custkey bigint").json(path).select("c_custkey", F.col("_metadata.file_name").alias("f"))
    return r.groupBy("f").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"), F.max("c_custkey").alias("last")).drop("f")


@query("content_text")
def q_content_text(spark, sf):
    """STR-4, STR-5, STR-9: subject, body and recipients as one text; trimmed lists; ' (' as '/'."""
    p = table(spark, sf, "part")
    names = F.array(F.concat("p_brand", F.lit("  ")), F.col("p_type"))
    size = F.concat("p_name", F.lit(" ("), F.col("p_type"), F.lit(")"))
    return p.select("p_partkey", build_content(F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand")), F.col("p_name"), names).alias("content"),
                    rtrim_list(names).alias("trimmed"), slash_paren(size).alias("slashed"))


@query("logistic")
def q_logistic(spark, sf):
    """MA-8 on account balances."""
    return table(spark, sf, "customer").select("c_custkey", F.round(sigmoid(F.col("c_acctbal") / 1000.0), 6).alias("p"))


@query("profiled_users")
def q_profiled_users(spark, sf):
    """AG-12, FLT-6, FLT-9: all participants of the documents as mails; those of the own
    domain or the directory are profiled."""
    from kenning.plans import interests
    d = text_table(spark, sf, "documents")
    m = d.select("doc_id", F.concat("source", F.lit("@docs.example")).alias("sender"), extract_mails(F.col("text")).alias("to"),
                 F.array().cast("array<string>").alias("cc"))
    everyone = prof.explode_participants(m, msg="doc_id").select("user_id").distinct()
    directory = everyone.filter(F.length("user_id") % 3 == 0).select(F.col("user_id").alias("email_id"))
    cfg = config.TenantConfig(domains=("@docs.example",), min_address_len=20)
    kept = interests.profile_users(everyone, directory, cfg).select("user_id", F.lit(True).alias("profiled"))
    return everyone.join(kept, "user_id", "left").fillna({"profiled": False})


@query("first_orders")
def q_first_orders(spark, sf):
    """SO-2: the first 100 orders by date and key."""
    return rel.first_rows(table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey"), 100, "o_orderdate", "o_orderkey")


# ---------------------------------------------------------------- the whole interest job on documents

def _document_dates(spark, sf, d):
    """documents with a ``date``: the last order of the customer numbered as the source,
    every third document up to 400 days before; none for one source in four or without an
    order, and for every 13th document one that no format reads."""
    last = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("_last"))
    earlier = F.when(F.col("doc_id") % 3 == 0, F.col("doc_id") % 400).otherwise(0).cast("int")
    date = F.date_format(F.date_sub(F.col("_last").cast("date"), earlier), "yyyy-MM-dd HH:mm:ss")
    number = F.regexp_extract("source", r"(\d+)$", 1).try_cast("bigint") + 1
    by_source = (d.select("source").distinct().withColumn("o_custkey", number)
                 .filter(F.pmod(F.crc32("source"), F.lit(4)) != 1).join(last, on="o_custkey").select("source", "_last"))
    date = F.when(F.col("_last").isNotNull(), F.when(F.col("doc_id") % 13 == 0, "some day").otherwise(date))
    return d.join(sized_broadcast(by_source), on="source", how="left").withColumn("date", date).drop("_last")


def _document_directory(spark, sf, d):
    """Customers as the directory: the address is the first in the document of
    the customer's number, or else its source's (of three sources in four), the display
    name that document's first three words."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("doc_id"))
    listed = F.when(F.pmod(F.crc32("source"), F.lit(4)) != 0, F.concat(F.col("source"), F.lit("@docs.example")))
    return (d.join(c, on="doc_id")
            .select(F.col("doc_id").cast("string").alias("sub_id"),
                    F.coalesce(F.try_element_at(extract_mails(F.col("text")), F.lit(1)), listed).alias("email_id"),
                    F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)), 1, 3), " ").alias("user_name"),
                    F.col("doc_id").alias("ord"))
            .filter(F.col("email_id").isNotNull()))


@query("document_interests")
def q_document_interests(spark, sf):
    """P-4 end to end: each document is a mail from its source (``<source>@docs.example``)
    to the addresses found in its text, dated by orders; customers are the directory.
    Without a readable date counts stay unaged (tenant-B rule)."""
    from kenning.plans import interests
    d = text_table(spark, sf, "documents")
    msgs = _document_dates(spark, sf, d).select(
        F.col("source").alias("conversation_id"), F.col("doc_id").cast("string").alias("message_id"),
        F.col("lang").alias("subject"), F.col("text").alias("body"), "date",
        F.concat(F.col("source"), F.lit("@docs.example")).alias("from_email"),
        extract_mails(F.col("text")).alias("to"), F.array().cast("array<string>").alias("cc"))
    directory = _document_directory(spark, sf, d)
    cfg = config.TenantConfig(domains=("@docs.example",), decay="v3", null_day_keeps_count=True, as_of=_dt.date(2001, 8, 3),
                              weight_categories=("TOPICS", "PEOPLE", "TEAMS", "PROG_SCRIPT_LANG"))
    return interests.run(spark, msgs, standin_gazetteer(spark), directory, cfg)["weights"]

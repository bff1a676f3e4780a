"""P-4 interest job: messages -> entities -> per-user profile -> merged state ->
ranks -> resolved names -> interest weights. One Spark plan; the driver holds
no data.

Stages and their shuffles: content and entities are per message (narrow, plus
one shuffle of the matches per message); the profile is one aggregation on
(user, category, value) with partial results, the modal day one on user; the
state merge a full outer join on the profile key; ranks a window on (user,
category) over the aggregated profile; resolution runs on distinct values
only; the weights need two whole-table ranges over a checkpointed table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning import config
from kenning.functions.dates import parse_any_date
from kenning.functions.text import (build_content, clean_content, extract_mails, lower_clean_body, slash_paren,
                                   title_case, user_tag)
from kenning.operators import extract, profile as prof, scoring, state
from kenning.operators.directory import apply_aliases, complete_names, directory_join, resolve_mails, resolve_names
from kenning.operators.joins import spread
from kenning.session import ensure_checkpoint_dir


def prepare_messages(messages: DataFrame, cfg: config.TenantConfig) -> DataFrame:
    """STR-2/3/5/1: the content text the matcher reads; addresses per tenant."""
    m = messages
    if cfg.lower_addresses:
        m = (m.withColumn("from_email", F.lower("from_email"))
             .withColumn("to", F.transform("to", lambda x: F.lower(x)))
             .withColumn("cc", F.transform("cc", lambda x: F.lower(x))))
    if not cfg.use_cc:
        m = m.withColumn("cc", F.array().cast("array<string>"))
    m = m.withColumns({c: F.transform(c, lambda x: F.rtrim(x)) for c in ("to", "cc")})   # STR-4
    m = m.withColumn("from_email", F.rtrim("from_email"))
    body = lower_clean_body(F.col("body")) if cfg.clean_body else F.col("body")
    content = build_content(F.col("subject"), body, F.col("to"), F.col("cc") if cfg.use_cc else None)
    return m.withColumn("content", clean_content(content, strip_punct=cfg.strip_punct))


def profile_users(parts: DataFrame, directory: DataFrame, cfg: config.TenantConfig) -> DataFrame:
    """FLT-6 + FLT-9: participants profiled are own-domain or directory addresses
    longer than ``min_address_len``."""
    in_dir = directory.select(F.col("email_id").alias("user_id")).distinct().withColumn("_in_dir", F.lit(True))
    p = parts.join(in_dir, on="user_id", how="left")
    own = reduce(lambda a, b: a | b, [F.col("user_id").endswith(d) for d in cfg.domains], F.lit(False))
    return p.filter((own | F.coalesce(F.col("_in_dir"), F.lit(False))) &
                    (F.length("user_id") > cfg.min_address_len)).drop("_in_dir")


def new_profile(messages: DataFrame, gazetteer: DataFrame, directory: DataFrame, cfg: config.TenantConfig,
                aliases: DataFrame | None = None) -> dict:
    """Counts and aged counts of one batch, plus the annotated messages."""
    # A key per row: message ids repeat across conversations and may be null. The
    # cleaned messages are materialized with it once, so every branch sees the same
    # keys (also after a lost executor) and none cleans the text again.
    ensure_checkpoint_dir(messages.sparkSession)
    m = (spread(prepare_messages(messages, cfg))
         .withColumn("mails_ext", extract_mails(F.col("content"), cfg.mail_pattern))
         .withColumn("_row", F.monotonically_increasing_id()).checkpoint(eager=True))
    ents = extract.entities(m.select("_row", "content"), gazetteer, id_col="_row",
                            text_col="content", complete_in_row=True).select("_row", "value", "category")
    # Per-message metadata without the text (senders, recipients, date, address
    # candidates found in the content): participants, known addresses, mail entities
    # and modal days read these columns of the materialized messages only.
    slim = m.select("_row", "from_email", "to", "cc", "date", F.col("mails_ext").alias("_mails"))
    parts = prof.explode_participants(slim.select("_row", "from_email", "to", "cc", "date"),
                                      msg="_row", sender="from_email", recipients=("to", "cc"))
    known = parts.select(F.col("user_id").alias("address")).distinct()
    mails = (slim.select("_row", F.explode("_mails").alias("value"))
             .join(known.select(F.col("address").alias("value")), on="value", how="left_semi")
             .withColumn("category", F.lit(config.EMAIL)))
    all_ents = ents.unionByName(mails.select("_row", "value", "category"))
    users = profile_users(parts.select("_row", "user_id", "date").distinct(), directory, cfg)
    mentions = prof.drop_self_mentions(users.select("_row", "user_id").join(all_ents, on="_row"))
    if aliases is not None:
        a = aliases.filter(F.col("category").isin(list(cfg.alias_categories)))
        mentions = apply_aliases(mentions, a, value="value", category="category")
    if cfg.complete_people:
        people = mentions.filter(F.col("category") == config.PEOPLE).select("user_id", "value")
        done = complete_names(people, ["user_id"], "value", out="_done")
        mentions = (mentions.join(done.withColumn("category", F.lit(config.PEOPLE)),
                                  on=["user_id", "category", "value"], how="left")
                    .withColumn("value", F.coalesce("_done", "value")).drop("_done"))
    counts = prof.mention_counts(mentions)
    days = prof.modal_day(users.withColumn("ts", parse_any_date(F.col("date"))).select("user_id", "ts"))
    aged = prof.age_counts(counts, days, cfg.decay, cfg.as_of, null_day_keeps_count=cfg.null_day_keeps_count)
    annotated = m.join(all_ents.groupBy("_row").agg(
        F.collect_list(F.struct("value", "category")).alias("entities")), on="_row", how="left").drop("_row")
    return {"profile": aged.select("user_id", "category", "value", "frequency", "decay_frequency"),
            "by_day": aged.select("user_id", "category", "value", "modal_day", "frequency"),
            "known": known, "annotated": annotated}


def label_entities(df: DataFrame, labels: dict) -> DataFrame:
    """NER-11: ``entityLabel`` by category; null for the others."""
    label = F.lit(None).cast("string")
    for category, text in labels.items():
        label = F.when(F.col("category") == category, F.lit(text)).otherwise(label)
    return df.withColumn("entityLabel", label)


def fold_categories(df: DataFrame, fold: dict) -> DataFrame:
    """NER-12: categories written under another category's name."""
    return df.replace(fold, subset=["category"])


def enrich(profile: DataFrame, directory: DataFrame, known: DataFrame) -> DataFrame:
    """WN-1 ranks, STR-9, JN-6..9 resolution, NER-11 labels, JN-2 directory join,
    STR-7/8/10, NER-12 folds."""
    ranked = (prof.rank_values(profile).withColumn("sk", slash_paren(F.col("sk")))
              .withColumn("value", slash_paren(F.col("value"))))
    names = (resolve_names(ranked.filter(F.col("category") == config.PEOPLE).select("value"), directory, known)
             .select("value", F.lit(config.PEOPLE).alias("category"), F.col("name_id").alias("_alt"),
                     F.col("name_display").alias("_avatar")))
    mails = (resolve_mails(ranked.filter(F.col("category") == config.EMAIL).select("value"), directory, known)
             .select("value", F.lit(config.EMAIL).alias("category"), F.col("mail_id").alias("_alt"),
                     F.col("mail_display").alias("_avatar")))
    r = ranked.join(names.unionByName(mails), on=["value", "category"], how="left")
    labels = {config.PEOPLE: config.ENTITY_LABELS["PEOPLE"], config.EMAIL: config.ENTITY_LABELS["EMAIL"]}
    r = (label_entities(r, labels)
         .withColumn("nameToId", user_tag(F.col("_alt")))
         .withColumn("entityName", F.coalesce(F.col("_avatar"), title_case(F.col("value"))))
         .drop("_alt", "_avatar"))
    e = directory_join(r.withColumnRenamed("user_id", "email_id"), directory)
    return fold_categories(e, dict(config.CATEGORY_FOLD))


def run(spark: SparkSession, messages: DataFrame, gazetteer: DataFrame, directory: DataFrame,
        cfg: config.TenantConfig = config.TENANT_A, aliases: DataFrame | None = None,
        stored: DataFrame | None = None, stored_by_day: DataFrame | None = None) -> dict:
    """The whole job for one batch. Returns the new state (``profile``), the
    enriched profile, the weight table and the annotated messages.

    With ``cfg.re_age`` the state is kept per mail day (``by_day``; pass the
    stored one as ``stored_by_day``) and all counts are aged again at
    ``cfg.as_of``; otherwise stored aged counts are added as they are."""
    # read by the choice of users, the name search, the addresses and the final join: a
    # directory file is parsed by one task, so once
    ensure_checkpoint_dir(spark)
    directory = directory.checkpoint(eager=True)
    batch = new_profile(messages, gazetteer, directory, cfg, aliases)
    prof_new = batch["profile"]
    by_day = None
    if cfg.re_age:
        by_day = batch["by_day"] if stored_by_day is None else state.merge_by_day(stored_by_day, batch["by_day"])
        by_day = by_day.checkpoint(eager=True)
        merged = state.reage(by_day, cfg.decay, cfg.as_of, cfg.null_day_keeps_count).withColumn("origin", F.lit("re-aged"))
    elif stored is not None:
        merged = state.merge_profiles(stored, prof_new, complete_people=cfg.complete_people,
                                      people_category=config.PEOPLE)
    else:
        merged = prof_new.withColumn("origin", F.lit("new"))
    # The merged profile is the new state: materialize it once (shared
    # checkpoint folder), so resolution and weights read it instead of
    # re-deriving entities in every branch, and a lost executor re-reads it.
    merged = merged.checkpoint(eager=True)
    known = batch["known"].checkpoint(eager=True)
    # read by the weights and by every sink: resolved and ranked once
    enriched = enrich(merged.drop("origin"), directory, known).checkpoint(eager=True)
    weights = scoring.interest_weights(enriched, people_category=config.PEOPLE, categories=cfg.weight_categories)
    return {"profile": merged, "by_day": by_day, "enriched": enriched, "weights": weights,
            "annotated": batch["annotated"]}

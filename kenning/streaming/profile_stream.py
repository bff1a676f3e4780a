"""ST-1: the profile merge over arriving conversation files.

``readStream`` on a folder of JSON-lines files, ``foreachBatch`` runs the batch
job on each micro-batch and writes the merged profile as a new state version.
The stream checkpoint records which files were taken; the state's pointers record
which batches of which stream were applied, so a re-run of a batch after a failure
(or a replay) is skipped instead of being counted twice. No custom state store is needed:
the state is an ordinary Parquet table in buckets by a hash of the user. A batch reads and
writes the buckets of its users only; a merge never looks beyond a user, so the other
buckets stay the files that they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kenning import config
from kenning.plans import interests
from kenning.sinks.writers import STATE_BUCKETS, applied, bucket_of, current_state_path, read_buckets, state_buckets, write_buckets
from kenning.sources.readers import parse_conversations_a, parse_conversations_b

STATE_COLUMNS = ("user_id", "category", "value", "frequency", "decay_frequency")
BY_DAY_COLUMNS = ("user_id", "category", "value", "modal_day", "frequency")


def merge_batch(spark: SparkSession, text: DataFrame, epoch: int, gazetteer: DataFrame, directory: DataFrame,
                cfg: config.TenantConfig, shape: str, state_root: str, aliases: DataFrame | None = None,
                stream: str = "") -> None:
    """One micro-batch: parse, run the job against the stored state, write the next version.

    ``stream`` is the id of the stream's checkpoint: (stream, epoch) tells a replayed
    batch from a new one, also on a state the batch job or another stream wrote."""
    source = f"{stream}:{epoch}"
    if applied(spark, state_root, source):
        return                                           # already applied: replay is harmless
    msgs = parse_conversations_a(text) if shape == "a" else parse_conversations_b(text, cfg.lower_addresses)
    cur, n = current_state_path(spark, state_root), state_buckets(spark, state_root)
    if cur and not n:                                    # a state that a batch job wrote whole: laid out now
        n, touched = STATE_BUCKETS, range(STATE_BUCKETS)
        stored = spark.read.parquet(cur)
    else:
        n = n or STATE_BUCKETS
        touched = _touched(msgs, cfg, n)
        stored = read_buckets(spark, state_root, touched)
    version = f"{stream or 'batch'}-{epoch:08d}"
    if cfg.re_age:                                       # state kept per mail day (Q21 option)
        out = interests.run(spark, msgs, gazetteer, directory, cfg, aliases=aliases,
                            stored_by_day=stored and stored.select(*BY_DAY_COLUMNS))["by_day"].select(*BY_DAY_COLUMNS)
    else:
        out = interests.run(spark, msgs, gazetteer, directory, cfg, aliases=aliases,
                            stored=stored and stored.select(*STATE_COLUMNS))["profile"].select(*STATE_COLUMNS)
    write_buckets(spark, out.withColumn("batch_id", F.lit(version)), state_root, version, source, touched, n)


def _touched(msgs: DataFrame, cfg: config.TenantConfig, n: int) -> list[int]:
    """Buckets of everyone who wrote or got a message of the batch: at most ``n`` numbers."""
    m = interests.prepare_messages(msgs, cfg).select("from_email", "to", "cc")
    who = F.explode(F.concat(F.array("from_email"), *[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("to", "cc")]))
    users = m.select(who.alias("user_id")).where("user_id is not null")
    return [r[0] for r in users.select(bucket_of("user_id", n).alias("b")).distinct().collect()]


def run_available(spark: SparkSession, inbox: str, gazetteer: DataFrame, directory: DataFrame,
                  cfg: config.TenantConfig, shape: str, state_root: str, checkpoint: str,
                  aliases: DataFrame | None = None) -> None:
    """Process every file that arrived since the last run, then stop."""
    src = (spark.readStream.format("text").load(inbox)
           .select("value", F.col("_metadata.file_name").alias("batch_id")))

    def each(df: DataFrame, epoch: int) -> None:
        session = df.sparkSession
        stream = session.read.json(f"{checkpoint}/metadata").first()["id"]     # unique per checkpoint
        merge_batch(session, df, epoch, gazetteer, directory, cfg, shape, state_root, aliases, stream)

    q = (src.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()

"""Job entry points (``spark-submit -m``-style): the four pipelines from files to files.

    python -m kenning.jobs interests --conversations DIR --shape a --directory dir.csv \\
        --gazetteer gaz.csv [--aliases aliases.csv] --state STATE_ROOT --out OUT [--tenant a|b]
    python -m kenning.jobs mail  --messages m.csv --names names.json --ids ids.csv [--overlay o.json] --out OUT
    python -m kenning.jobs chat  --messages m.csv --companion c.csv --names ... --ids ... --out OUT
    python -m kenning.jobs teams --messages m.csv --companion c.csv --names ... --ids ... --out OUT

Outputs are JSON lines (and CSV for the enriched profile); the interest job
reads the current state version and writes the next one (SNK-3).
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as _dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kenning import config
from kenning.session import build_session, prepare
from kenning.functions.text import rtrim_list
from kenning.operators.relational import REPLY_PAGE
from kenning.sinks import writers as W
from kenning.sources import readers as R


def _people(spark, a):
    names = R.read_json_dict(spark, a.names, "email", "display_name")
    ov = R.read_json_dict(spark, a.overlay, "email", "user_id") if a.overlay else None
    return R.people_directory(names, R.read_user_ids(spark, a.ids), ov)


def _gazetteer(spark, path):
    from kenning.operators import gazetteer as gz
    raw = R.read_csv_renamed(spark, path, {c: c for c in gz.SCHEMA.fieldNames()})
    return raw.select(*[raw[f.name].cast(f.dataType).alias(f.name) for f in gz.SCHEMA.fields])


def run_interests(spark: SparkSession, a) -> None:
    from kenning.plans import interests
    cfg = config.TENANT_A if a.tenant == "a" else config.TENANT_B
    cfg = dataclasses.replace(cfg, domains=tuple(a.domain or ()),
                              as_of=_dt.date.fromisoformat(a.as_of))
    msgs = (R.read_conversations_a(spark, a.conversations) if a.shape == "a"
            else R.read_conversations_b(spark, a.conversations, cfg.lower_addresses))
    aliases = None
    if a.aliases:
        aliases = R.read_csv_renamed(spark, a.aliases, {"category": "category", "alias": "alias",
                                                        "canonical": "canonical", "ord": "ord"}, longs=("ord",))
    cfg = dataclasses.replace(cfg, re_age=a.re_age)
    cur = W.current_state_path(spark, a.state)
    stored = stored_by_day = None
    if cur and a.re_age:
        stored_by_day = spark.read.parquet(cur).select("user_id", "category", "value", "modal_day", "frequency")
    elif cur:
        stored = spark.read.parquet(cur).select("user_id", "category", "value", "frequency", "decay_frequency")
    out = interests.run(spark, msgs, _gazetteer(spark, a.gazetteer), R.read_directory(spark, a.directory), cfg,
                        aliases=aliases, stored=stored, stored_by_day=stored_by_day)
    version = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    new_state = out["by_day"] if a.re_age else out["profile"].drop("origin")
    W.write_state(spark, new_state.withColumn("batch_id", F.lit(version)), a.state, version)
    dump = out["annotated"].withColumns({c: rtrim_list(F.col(c)) for c in ("to", "cc")})
    W.write_json(dump, f"{a.out}/annotated")
    W.write_json(out["weights"], f"{a.out}/weights", a.max_records)
    W.write_json(out["enriched"], f"{a.out}/enriched", a.max_records)
    W.write_csv(out["enriched"], f"{a.out}/enriched_csv", a.max_records)


def run_records(spark: SparkSession, a) -> None:
    from kenning.plans import chat, mail, teams
    people = _people(spark, a)
    if a.job == "mail":
        out = mail.mail_conversations(R.read_message_table(spark, a.messages), people)
    else:
        msgs, companion = R.read_aligned(spark, a.messages, a.companion)
        out = (chat.chat_messages(msgs, companion, people) if a.job == "chat"
               else teams.team_conversations(msgs, companion, people, page_size=a.page_size))
    W.write_json(out, a.out, a.max_records)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kenning.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    i = sub.add_parser("interests")
    i.add_argument("--conversations", required=True)
    i.add_argument("--shape", choices=["a", "b"], default="a")
    i.add_argument("--directory", required=True)
    i.add_argument("--gazetteer", required=True, help="CSV: category,phrase,canonical,case_sensitive,versioned,priority")
    i.add_argument("--aliases", help="CSV: category,alias,canonical,ord")
    i.add_argument("--state", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--tenant", choices=["a", "b"], default="a")
    i.add_argument("--domain", action="append", help="own mail domain, e.g. @example.com (repeatable)")
    i.add_argument("--as-of", dest="as_of", required=True, help="YYYY-MM-DD")
    i.add_argument("--max-records", dest="max_records", type=int)
    i.add_argument("--re-age", dest="re_age", action="store_true", help="keep state per mail day and re-age it")
    for name in ("mail", "chat", "teams"):
        r = sub.add_parser(name)
        r.add_argument("--messages", required=True)
        r.add_argument("--companion")
        r.add_argument("--names", required=True)
        r.add_argument("--ids", required=True)
        r.add_argument("--overlay")
        r.add_argument("--out", required=True)
        r.add_argument("--max-records", dest="max_records", type=int)
        r.add_argument("--page-size", dest="page_size", type=int, default=REPLY_PAGE, help="replies in one record")
    return p


def main(argv=None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = prepare(spark) if spark is not None else build_session(app=f"kenning-{a.job}")
    if a.job == "interests":
        run_interests(spark, a)
    else:
        run_records(spark, a)


if __name__ == "__main__":
    main()

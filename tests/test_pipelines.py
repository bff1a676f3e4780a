"""The four pipelines on invented fixtures (FIXTURES.md shapes), plus the
streaming merge: two batches equal one, a replay changes nothing."""

import os
import tempfile

from pyspark.sql import functions as F

import fixtures as FX
from kenning import config
from kenning.operators import gazetteer as gz
from kenning.plans import chat, interests, mail, teams
from kenning.sources import readers as R

CFG_A = config.TenantConfig(domains=("@acme.test",), decay="v2")
CFG_B = config.TenantConfig(domains=("@acme.test",), decay="v3", use_cc=False, clean_body=True,
                            lower_addresses=True, null_day_keeps_count=True, alias_categories=("TOPICS", "PEOPLE"))


def _people(spark, P):
    names = R.read_json_dict(spark, P["names"], "email", "display_name")
    return R.people_directory(names, R.read_user_ids(spark, P["ids"]),
                              R.read_json_dict(spark, P["overlay"], "email", "user_id"))


def test_mail_conversations(spark, fx_paths):
    out = mail.mail_conversations(R.read_message_table(spark, fx_paths["messages"]), _people(spark, fx_paths))
    rows = {r.conversation_id: r for r in out.collect()}
    assert set(rows) == {"100", "200", "300"}
    c = rows["100"]
    assert c.num_messages == 2 and c.date == "2024-01-05T10:00:00Z" and c.type == "email-message"
    assert c._allow_permissions == ["ana.lima@acme.test", "USER_a1", "bo.chen@acme.test", "USER_b2",
                                    "zed.q@other.test", "USER_z9"]
    assert [p.email for p in c.recipients] == ["bo.chen@acme.test", "cy.dorn@acme.test"]
    assert c["from"][0].user_display_name == "Ana Lima" and c["from"][0].user_id == "USER_a1"
    assert rows["300"].num_messages == 4


def test_chat_messages(spark, fx_paths):
    out = chat.chat_messages(R.read_message_table(spark, fx_paths["messages"]),
                             R.read_companion(spark, fx_paths["companion"]), _people(spark, fx_paths))
    rows = {r.id: r for r in out.collect()}
    assert "e3" not in rows and "e4" not in rows          # null comment, unparsable comment date
    assert rows["e1"].date == "2024-01-06T09:00:00Z"      # moved after the mail day
    assert [p.email for p in rows["e1"].recipients] == ["ana.lima@acme.test", "ana.lima@acme.test",
                                                        "zed.q@other.test"]
    assert rows["e1"].message_id == "e1"


def test_team_conversations(spark, fx_paths):
    out = teams.team_conversations(R.read_message_table(spark, fx_paths["messages"]),
                                   R.read_companion(spark, fx_paths["companion"]), _people(spark, fx_paths))
    rows = {r.conversation_id: r for r in out.collect()}
    assert {k: len(v.replies) for k, v in rows.items()} == {"100": 1, "200": 0, "300": 3}
    assert [x.id for x in rows["300"].replies] == ["e6", "e7", "e8"]
    assert rows["300"].message.message_type == "MESSAGE" and rows["300"].replies[0].message_type == "REPLY"
    assert rows["300"].message["from"].user_display_name == "Bo Chen"
    assert len({r.message.channel_name for r in rows.values()}) >= 1
    again = {r.conversation_id: r.message.channel_name for r in
             teams.team_conversations(R.read_message_table(spark, fx_paths["messages"]),
                                      R.read_companion(spark, fx_paths["companion"]),
                                      _people(spark, fx_paths)).collect()}
    assert again == {k: v.message.channel_name for k, v in rows.items()}   # deterministic pseudonyms


def _run_a(spark, P, stored=None, path=None):
    conv = R.read_conversations_a(spark, path or P["conv_a"])
    g = gz.from_rows(spark, FX.GAZETTEER)
    al = spark.createDataFrame(FX.ALIASES, "category string, alias string, canonical string, ord int")
    return interests.run(spark, conv, g, R.read_directory(spark, P["directory"]), CFG_A, aliases=al, stored=stored)


def test_interests_shape_a(spark, fx_paths):
    out = _run_a(spark, fx_paths)
    prof = {(r.user_id, r.category, r.value): r.frequency for r in out["profile"].collect()}
    # "Ana Lima, Ana and Lima": stopwords go first, so two "Ana Lima" spans remain
    assert prof[("bo.chen@acme.test", "PEOPLE", "ana lima")] == 2
    assert prof[("ana.lima@acme.test", "TOPICS", "gpu")] == 2              # alias: graphics processing unit
    assert prof[("ana.lima@acme.test", "OS", "windows10")] == 1
    assert prof[("ana.lima@acme.test", "EMAIL", "zed.q@other.test")] == 1  # known participant address
    assert not any(u == "ana.lima@acme.test" and c == "PEOPLE" and v.startswith(("ana", "lima"))
                   for u, c, v in prof)                                     # own name dropped
    assert "zed.q@other.test" not in {u for u, _, _ in prof}                # outside domain and directory
    w = out["weights"].collect()
    assert w and all(0 <= r.weight <= 1 and 0 <= r.d_weight <= 1 for r in w)
    assert {r.category for r in w} <= set(config.WEIGHT_CATEGORIES)
    e = {(r.email_id, r.value): r for r in out["enriched"].collect()}
    assert e[("bo.chen@acme.test", "ana lima")].nameToId == "USER_s-1"
    assert e[("bo.chen@acme.test", "ana lima")].entityName == "Ana Lima"
    assert e[("ana.lima@acme.test", "bo.chen@acme.test")].category == "PEOPLE"  # EMAIL folded
    assert e[("ana.lima@acme.test", "bo.chen@acme.test")].entityLabel == "Mail"
    assert e[("cy.dorn@acme.test", "gpu")].id_type == "EMAIL"
    assert e[("bo.chen@acme.test", "gpu")].sub_id == "USER_s-2"


def test_interests_shape_b(spark, fx_paths):
    conv = R.read_conversations_b(spark, fx_paths["conv_b"])
    out = interests.run(spark, conv, gz.from_rows(spark, FX.GAZETTEER),
                        R.read_directory(spark, fx_paths["directory"]), CFG_B)
    prof = {(r.user_id, r.category, r.value): (r.frequency, r.decay_frequency) for r in out["profile"].collect()}
    assert prof[("ana.lima@acme.test", "PROG_SCRIPT_LANG", "python")][0] == 1
    assert ("bo.chen@acme.test", "PEOPLE", "ana") not in prof            # addresses are whole tokens
    assert all(f >= 1 for f, _ in prof.values())


def test_stream_two_batches_equal_one_and_replay(spark, fx_paths):
    import json
    from kenning.streaming.profile_stream import run_available
    root = tempfile.mkdtemp(prefix="kenning-stream-", dir="/tmp")
    inbox = os.path.join(root, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "b1.jsonl"), "w") as f:
        f.write(json.dumps(FX.CONV_A) + "\n")
    kw = dict(gazetteer=gz.from_rows(spark, FX.GAZETTEER), directory=R.read_directory(spark, fx_paths["directory"]),
              cfg=CFG_A, shape="a", state_root=os.path.join(root, "state"), checkpoint=os.path.join(root, "ck"),
              aliases=spark.createDataFrame(FX.ALIASES, "category string, alias string, canonical string, ord int"))
    run_available(spark, inbox, **kw)
    with open(os.path.join(inbox, "b2.jsonl"), "w") as f:
        f.write(json.dumps(FX.CONV_A_LINE2) + "\n")
    run_available(spark, inbox, **kw)
    run_available(spark, inbox, **kw)                 # nothing new: replay-safe
    from kenning.sinks.writers import current_state_path
    streamed = {(r.user_id, r.category, r.value): r.frequency
                for r in spark.read.parquet(current_state_path(spark, kw["state_root"])).collect()}
    one = {(r.user_id, r.category, r.value): r.frequency for r in _run_a(spark, fx_paths)["profile"].collect()}
    assert streamed == one


def test_job_entry_points(spark, fx_paths):
    import csv
    from kenning import jobs
    root = tempfile.mkdtemp(prefix="kenning-jobs-", dir="/tmp")
    gpath = os.path.join(root, "gaz.csv")
    with open(gpath, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["category", "phrase", "canonical", "case_sensitive", "versioned", "priority"])
        for r in FX.GAZETTEER:
            w.writerow(["" if v is None else v for v in r])
    args = ["interests", "--conversations", fx_paths["conv_a"], "--directory", fx_paths["directory"],
            "--gazetteer", gpath, "--state", os.path.join(root, "state"), "--out", os.path.join(root, "out"),
            "--domain", "@acme.test", "--as-of", "2024-02-01"]
    jobs.main(args, spark=spark)
    w = spark.read.json(os.path.join(root, "out", "weights"))
    assert w.count() > 0 and {"weight", "d_weight", "entityName"} <= set(w.columns)
    jobs.main(["teams", "--messages", fx_paths["messages"], "--companion", fx_paths["companion"],
               "--names", fx_paths["names"], "--ids", fx_paths["ids"], "--out", os.path.join(root, "teams")],
              spark=spark)
    assert spark.read.json(os.path.join(root, "teams")).count() == 3


def test_interests_re_age_two_batches(spark, fx_paths):
    import dataclasses
    import json
    root = tempfile.mkdtemp(prefix="kenning-reage-", dir="/tmp")
    p1, p2 = os.path.join(root, "b1.jsonl"), os.path.join(root, "b2.jsonl")
    with open(p1, "w") as f:
        f.write(json.dumps(FX.CONV_A) + "\n")
    with open(p2, "w") as f:
        f.write(json.dumps(FX.CONV_A_LINE2) + "\n")
    g = gz.from_rows(spark, FX.GAZETTEER)
    d = R.read_directory(spark, fx_paths["directory"])
    cfg = dataclasses.replace(CFG_A, re_age=True)
    first = interests.run(spark, R.read_conversations_a(spark, p1), g, d, cfg)
    later = dataclasses.replace(cfg, as_of=cfg.as_of.replace(month=4))
    second = interests.run(spark, R.read_conversations_a(spark, p2), g, d, later, stored_by_day=first["by_day"])
    one = interests.run(spark, R.read_conversations_a(spark, [p1, p2]), g, d, later)
    key = lambda df: {(r.user_id, r.category, r.value): (r.frequency, r.decay_frequency)
                      for r in df.collect()}
    # same totals; aged counts of the first batch are re-aged at the later date
    assert {k: v[0] for k, v in key(second["profile"]).items()} == {k: v[0] for k, v in key(one["profile"]).items()}
    # ana's python: 1 mention on 2024-01-30 aged 62 days -> ceil(1.117) = 2, plus 2 mentions on 2023-12-01
    # aged 122 days -> ceil(2.083) = 3 (schedule V2 at as-of 2024-04-01)
    assert key(first["profile"])[("ana.lima@acme.test", "PROG_SCRIPT_LANG", "python")] == (1, 2)
    assert key(second["profile"])[("ana.lima@acme.test", "PROG_SCRIPT_LANG", "python")] == (3, 5)


def test_job_re_age_state_round_trip(spark, fx_paths):
    import csv
    import json
    from kenning import jobs
    from kenning.sinks.writers import current_state_path
    root = tempfile.mkdtemp(prefix="kenning-jobs-reage-", dir="/tmp")
    gpath = os.path.join(root, "gaz.csv")
    with open(gpath, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["category", "phrase", "canonical", "case_sensitive", "versioned", "priority"])
        for r in FX.GAZETTEER:
            w.writerow(["" if v is None else v for v in r])
    inputs = []
    for i, conv in enumerate((FX.CONV_A, FX.CONV_A_LINE2)):
        p = os.path.join(root, f"in{i}")
        os.makedirs(p)
        with open(os.path.join(p, "b.jsonl"), "w") as f:
            f.write(json.dumps(conv) + "\n")
        inputs.append(p)
    state_root = os.path.join(root, "state")
    for i, (p, as_of) in enumerate(zip(inputs, ("2024-02-01", "2024-04-01"))):
        jobs.main(["interests", "--conversations", p, "--directory", fx_paths["directory"], "--gazetteer", gpath,
                   "--state", state_root, "--out", os.path.join(root, f"out{i}"), "--domain", "@acme.test",
                   "--as-of", as_of, "--re-age"], spark=spark)
    st = spark.read.parquet(current_state_path(spark, state_root))
    assert "modal_day" in st.columns
    rows = {(r.user_id, r.value, str(r.modal_day)): r.frequency for r in st.collect()}
    assert rows[("ana.lima@acme.test", "python", "2024-01-30")] == 1
    assert rows[("ana.lima@acme.test", "python", "2023-12-01")] == 2


def test_stream_batch_merge_re_age_and_replay(spark, fx_paths):
    import dataclasses
    import json
    from pyspark.sql import functions as F
    from kenning.sinks.writers import current_state_path
    from kenning.streaming.profile_stream import merge_batch
    root = tempfile.mkdtemp(prefix="kenning-mb-", dir="/tmp")
    state_root = os.path.join(root, "state")
    g = gz.from_rows(spark, FX.GAZETTEER)
    d = R.read_directory(spark, fx_paths["directory"])
    cfg = dataclasses.replace(CFG_A, re_age=True)

    def text(conv):
        return spark.createDataFrame([(json.dumps(conv),)], "value string").withColumn("batch_id", F.lit("x"))

    merge_batch(spark, text(FX.CONV_A), 0, g, d, cfg, "a", state_root)
    merge_batch(spark, text(FX.CONV_A_LINE2), 1, g, d, cfg, "a", state_root)
    path1 = current_state_path(spark, state_root)
    merge_batch(spark, text(FX.CONV_A_LINE2), 1, g, d, cfg, "a", state_root)     # replayed batch: skipped
    assert current_state_path(spark, state_root) == path1
    rows = {(r.user_id, r.value, str(r.modal_day)): r.frequency for r in spark.read.parquet(path1).collect()}
    assert rows[("ana.lima@acme.test", "python", "2023-12-01")] == 2
    assert rows[("ana.lima@acme.test", "python", "2024-01-30")] == 1


def test_document_interests_acts_on_dates_and_directory(spark, monkeypatch):
    """Ageing, the directory and the name lookup each meet real rows, and rows they leave alone."""
    from kenning.plans import interests, standins
    seen, run = {}, interests.run
    monkeypatch.setattr(interests, "run", lambda *a, **k: seen.update(run(*a, **k)) or seen)
    n = standins.QUERIES["document_interests"](spark, "/root/testdata/sf0.01").count()
    aged = {r.frequency != r.decay_frequency for r in seen["profile"].select("frequency", "decay_frequency").collect()}
    rows = seen["enriched"].select("id_type", "userName", "category", "value", "nameToId").collect()
    users = {(r.id_type == "EMAIL", r.userName is None) for r in rows}
    found = {r.nameToId[len("USER_"):].isdigit() for r in rows if r.category in ("PEOPLE", "PERSON") and r.nameToId}
    assert n > 0 and aged == {True, False}
    assert users == {(True, True), (False, False)}
    assert True in found

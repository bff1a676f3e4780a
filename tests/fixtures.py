"""Invented fixture inputs (FIXTURES.md shapes). No real names or addresses."""

from __future__ import annotations

import csv
import json
import os

DOMAIN = "acme.test"

CONV_A = {
    "c1": [
        {"conversation_id": "c1", "id": "m1", "subject": "Kickoff", "date": "2024-01-30T10:00:00Z",
         "body": "We use c++ and Python on the secure vault. Ask Bo Chen about the GPU.",
         "from_name": "Ana", "from_email": "ana.lima@acme.test", "to_recipients": ["bo.chen@acme.test"],
         "cc_recipients": ["cy.dorn@acme.test"]},
        {"conversation_id": "c1", "id": "m2", "date": "2024-01-25T09:00:00Z",
         "body": "The graphics processing unit <draft>; windows10 and windows 10 builds. Mail zed.q@other.test now",
         "from_name": "Bo", "from_email": "bo.chen@acme.test", "to_recipients": ["ana.lima@acme.test"],
         "cc_recipients": ["zed.q@other.test"]},
    ],
    "c2": [
        {"conversation_id": "c2", "id": "m3", "subject": "Review", "date": "2024-01-30 08:00:00",
         "body": "dram controller review with Ana Lima, Ana and Lima; platform team agrees. http://x.test/y gone",
         "from_name": "Cy", "from_email": "cy.dorn@acme.test", "to_recipients": ["ana.lima@acme.test",
                                                                            "bo.chen@acme.test"],
         "cc_recipients": []},
    ],
}
CONV_A_LINE2 = {
    "c3": [
        {"conversation_id": "c3", "id": "m4", "subject": "Later", "date": "2023-12-01T10:00:00Z",
         "body": "python python secure vault", "from_name": "Ana", "from_email": "ana.lima@acme.test",
         "to_recipients": ["dee.fox@acme.test"], "cc_recipients": []},
    ],
}

CONV_B = [
    {"conversation_id": "b1", "id": "n1", "subject": "Hi", "date": "2024-01-30T10:00:00Z",
     "body": "Python and the GPU", "from": {"user_display_name": "Ana", "user_id": "u1", "email": "Ana.Lima@ACME.test"},
     "recipients": [{"email": "bo.chen@acme.test", "user_id": "u2", "user_display_name": "Bo"}]},
    {"conversation_id": "b1", "id": "n2", "date": "not a date",
     "body": "c# later", "from": {"user_display_name": "Bo", "user_id": "u2", "email": "bo.chen@acme.test"},
     "recipients": [{"email": "ana.lima@acme.test", "user_id": "u1", "user_display_name": "Ana"}]},
]

GAZETTEER = [
    ("PEOPLE", "ana lima", None, False, False, 3),
    ("PEOPLE", "ana", None, False, False, 3),
    ("PEOPLE", "lima", None, False, False, 3),
    ("PEOPLE", "bo chen", None, False, False, 3),
    ("TOPICS", "secure vault", None, False, False, 2),
    ("TOPICS", "gpu", None, False, False, 2),
    ("TOPICS", "graphics processing unit", None, False, False, 2),
    ("COMPONENTS", "dram controller", None, False, False, 4),
    ("PROG_SCRIPT_LANG", "c++", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "c#", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "python", None, False, False, 1),
    ("OS", "windows", None, False, True, 5),
    ("TEAMS", "platform team", None, False, False, 6),
]
ALIASES = [("TOPICS", "graphics processing unit", "gpu", 1), ("COMPONENTS", "dram controller", "drc", 2)]

DIRECTORY = [
    {"cognitoSubjectId (S)": "s-1", "email (S)": "ana.lima@acme.test", "displayName (S)": "ana lima"},
    {"cognitoSubjectId (S)": "s-2", "email (S)": "bo.chen@acme.test", "displayName (S)": "Bo Chen"},
    {"cognitoSubjectId (S)": "s-2b", "email (S)": "bo.chen@acme.test", "displayName (S)": "Bo Chen Dup"},
]

# F4 message table rows (CSV headers carry the trailing blank of the original files)
MESSAGE_TABLE = [
    # row_seq, conversationId, id, subject, body, received, from, to, cc, comment, commentBy, perms, from_user, type
    (0, 100, "e1", "Plan", "first body", "2024-01-05T10:00:00", "['ana.lima@acme.test']",
     "['bo.chen@acme.test']", "['cy.dorn@acme.test', 'ana.lima@acme.test']", "nice", "['bo.chen@acme.test']",
     "['ana.lima@acme.test', 'bo.chen@acme.test', 'ana.lima@acme.test', 'zed.q@other.test']", "Ana", "mail"),
    (1, 100, "e2", "Re: Plan", "second", "2024-01-06 11:00:00", "['bo.chen@acme.test']",
     "['ana.lima@acme.test']", "[]", "ok", "['ana.lima@acme.test']",
     "['ana.lima@acme.test', 'bo.chen@acme.test']", "Bo", "mail"),
    (2, 100, "e3", "Re: Plan", "third", "2024-01-07T12:00:00", "['cy.dorn@acme.test']",
     "['ana.lima@acme.test']", "[]", "", "['cy.dorn@acme.test']",
     "['ana.lima@acme.test', 'cy.dorn@acme.test']", "Cy", "mail"),
    (3, 200, "e4", "Solo", "only one", "2024-01-08T09:30:00", "['cy.dorn@acme.test']",
     "['bo.chen@acme.test']", "['bo.chen@acme.test']", "solo", "['cy.dorn@acme.test']",
     "['cy.dorn@acme.test', 'bo.chen@acme.test']", "Cy", "mail"),
    (4, 300, "e5", "Team", "t body", "2024-01-09T09:30:00", "['bo.chen@acme.test']",
     "['ana.lima@acme.test']", "['cy.dorn@acme.test']", "r1", "['ana.lima@acme.test']",
     "['ana.lima@acme.test', 'bo.chen@acme.test']", "Bo", "mail"),
    (5, 300, "e6", "Team", "t2", "2024-01-09T10:30:00", "['ana.lima@acme.test']",
     "['bo.chen@acme.test']", "[]", "r2", "['bo.chen@acme.test']",
     "['ana.lima@acme.test', 'bo.chen@acme.test']", "Ana", "mail"),
    (6, 300, "e7", "Team", "t3", "2024-01-09T11:30:00", "['cy.dorn@acme.test']",
     "['bo.chen@acme.test']", "[]", "r3", "['cy.dorn@acme.test']",
     "['cy.dorn@acme.test', 'bo.chen@acme.test']", "Cy", "mail"),
    (7, 300, "e8", "Team", "t4", "2024-01-09T12:30:00", "['bo.chen@acme.test']",
     "['cy.dorn@acme.test']", "[]", "r4", "['bo.chen@acme.test']",
     "['cy.dorn@acme.test', 'bo.chen@acme.test']", "Bo", "mail"),
]
COMPANION = [
    (0, "2024-01-04T09:00:00", "Core"), (1, "2024-01-20T10:00:00", "Core"), (2, None, None),
    (3, "garbage", "Edge"), (4, "2024-01-09T08:00:00", "Edge"), (5, "2024-01-09T09:00:00", "Core"),
    (6, "2024-01-10T09:00:00", "Core"), (7, "2024-01-09T13:00:00", "Edge"),
]
NAMES = {"ana.lima@acme.test": "Ana Lima", "bo.chen@acme.test": "Bo Chen", "cy.dorn@acme.test": "Cy Dorn",
         "zed.q@other.test": "Zed Q"}
USER_IDS = [("ana.lima@acme.test", "a1"), ("bo.chen@acme.test", "b2"), ("cy.dorn@acme.test", "c3")]
ID_OVERLAY = {"zed.q@other.test": "USER_z9", "cy.dorn@acme.test": "USER_c3x"}


def write_all(d: str) -> dict:
    os.makedirs(d, exist_ok=True)
    paths = {}
    paths["conv_a"] = os.path.join(d, "conv_a")
    os.makedirs(paths["conv_a"], exist_ok=True)
    with open(os.path.join(paths["conv_a"], "batch1.jsonl"), "w") as f:
        f.write(json.dumps(CONV_A) + "\n" + json.dumps(CONV_A_LINE2) + "\n")
    paths["conv_b"] = os.path.join(d, "conv_b.jsonl")
    with open(paths["conv_b"], "w") as f:
        f.write(json.dumps(CONV_B) + "\n")
    paths["directory"] = os.path.join(d, "directory.csv")
    with open(paths["directory"], "w", newline="") as f:
        w = csv.DictWriter(f, fieldnames=list(DIRECTORY[0]))
        w.writeheader()
        w.writerows(DIRECTORY)
    paths["messages"] = os.path.join(d, "messages.csv")
    hdr = ["row_seq", "conversationId ", "id ", "subject ", "body.content ", "receivedDateTime ", "fromEmailAddress ",
           "toRecipients ", "ccRecipients ", "comment", "commentBy", "_allow_permissions", "from_user", "type"]
    with open(paths["messages"], "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(hdr)
        for r in MESSAGE_TABLE:
            w.writerow(["" if v is None else v for v in r])
    paths["companion"] = os.path.join(d, "companion.csv")
    with open(paths["companion"], "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["row_seq", "commentDate", "Component.s"])
        for r in COMPANION:
            w.writerow(["" if v is None else v for v in r])
    paths["names"] = os.path.join(d, "names.json")
    with open(paths["names"], "w") as f:
        json.dump(NAMES, f, indent=2)
    paths["ids"] = os.path.join(d, "ids.csv")
    with open(paths["ids"], "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["emailId", "userId"])
        w.writerows(USER_IDS)
    paths["overlay"] = os.path.join(d, "overlay.json")
    with open(paths["overlay"], "w") as f:
        json.dump(ID_OVERLAY, f)
    return paths

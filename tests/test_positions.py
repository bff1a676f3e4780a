"""Rows by position over several files, and files of an exact number of rows."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from kenning.sinks.writers import write_pieces
from kenning.sources import readers as R

HEAD = "conversationId,id,subject,body_content,receivedDateTime,fromEmailAddress,toRecipients,ccRecipients,comment,commentBy,_allow_permissions"


def write(folder, sizes, header, row):
    os.makedirs(folder)
    at = 0
    for i, n in enumerate(sizes):
        with open(f"{folder}/part-{i:03d}.csv", "w") as f:
            f.write(header + "\n" + "".join(row(k) + "\n" for k in range(at, at + n)))
        at += n


def test_companion_without_row_numbers(spark, tmp_path):
    m, c = str(tmp_path / "m"), str(tmp_path / "c")
    write(m, [5, 1, 40, 0, 7], HEAD, lambda k: f"{k % 3},{k},s,\"b\n{k}\",d,f,t,c,x,y,z")
    write(c, [20, 33], "commentDate,component", lambda k: f"day {k},c{k}")
    msgs, companion = R.read_aligned(spark, m, c)
    rows = R.align_rows(msgs, companion).collect()
    assert len(rows) == 53
    assert all(r.commentDate == f"day {r.id}" and r.row_seq == int(r.id) for r in rows)


def test_lengths_must_agree(spark, tmp_path):
    m, c = str(tmp_path / "m"), str(tmp_path / "c")
    write(m, [5], HEAD, lambda k: f"{k % 3},{k},s,b,d,f,t,c,x,y,z")
    write(c, [3, 1], "commentDate,component", lambda k: f"day {k},c{k}")
    with pytest.raises(ValueError, match="4 rows, the message table 5"):
        R.read_aligned(spark, m, c)
    n = str(tmp_path / "n")
    write(n, [5], "row_seq,commentDate,component", lambda k: f"{k},day {k},c{k}")
    with pytest.raises(ValueError, match="only one"):
        R.read_aligned(spark, m, n)


@pytest.mark.parametrize("n, rows", [(0, 7), (1, 7), (7, 7), (20, 7), (1000, 64), (1000, 1000)])
def test_pieces_of_exactly_n_rows(spark, tmp_path, n, rows):
    path = str(tmp_path / "out")
    df = spark.range(n).repartition(5).withColumn("x", F.concat(F.lit("v"), "id"))
    files = write_pieces(df, path, rows, ["id"])
    found = [open(f).read().splitlines() for f in sorted(glob.glob(f"{path}/part-*.json"))]
    found = [f for f in found if f]
    assert files == len(found) == -(-n // rows)
    assert sorted(map(len, found)) == sorted([rows] * (n // rows) + ([n % rows] if n % rows else []))
    ids = sorted([int(line.split(":")[1].split(",")[0]) for line in f] for f in found)
    assert [i for f in ids for i in f] == list(range(n))  # consecutive rows in order, piece after piece

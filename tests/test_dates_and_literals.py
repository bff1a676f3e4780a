"""The date grammar and Python list literals, against hand-written values and Python's own reader."""
import ast

import pytest

from kenning.functions.dates import date_clean
from kenning.functions.text import is_malformed_literal, parse_list_literal
from kenning.operators.relational import malformed_literals

DATES = [
    ("2024-01-05 10:00:00+00:00","2024-01-05T10:00:00Z"),
    ("1/5/2024","2024-01-05T00:00:00Z"),
    ("1/5/2024 3:04 PM","2024-01-05T15:04:00Z"),
    ("5 January 2024 10:00","2024-01-05T10:00:00Z"),
    ("Jan 5 2024","2024-01-05T00:00:00Z"),
    ("2024-01-05T10:00","2024-01-05T10:00:00Z"),
    ("14-Aug-2018","2018-08-14T00:00:00Z"),
    ("20180814","2018-08-14T00:00:00Z"),
    ("Tue Aug 14 10:00:00 2018","2018-08-14T10:00:00Z"),
    ("Tue, 14 Aug 2018 10:00:00 +0000 (UTC)","2018-08-14T10:00:00Z"),
    ("Tue, 14 Aug 2018 10:00:00 EST","2018-08-14T15:00:00Z"),
    ("14.08.2018","2018-08-14T00:00:00Z"),
    ("Aug. 14, 2018 at 3 p.m.","2018-08-14T15:00:00Z"),
    ("20180814T101112Z","2018-08-14T10:11:12Z"),
    ("201808141011","2018-08-14T10:11:00Z"),
    ("20180814101112","2018-08-14T10:11:12Z"),
    ("2018-08-14T10:11:12.123456789Z","2018-08-14T10:11:12Z"),
    ("2018-08-14T10:11:12-05:00","2018-08-14T15:11:12Z"),
    ("2018-08-14 10:11:12 UTC+02:00","2018-08-14T08:11:12Z"),
    ("Sept 3rd, 2019","2019-09-03T00:00:00Z"),
    ("31/12/2019","2019-12-31T00:00:00Z"),
    ("12/31/19 12:05 am","2019-12-31T00:05:00Z"),
    ("2019/2/3","2019-02-03T00:00:00Z"),
    ("3 Mar 70","1970-03-03T00:00:00Z"),
    ("Wednesday, March 6, 2019 9:30 AM PST","2019-03-06T17:30:00Z"),
    ("2019-02-30",None),
    ("25:00 2019-02-03",None),
    ("13 pm 2019-02-03",None),
    ("junk",None),
    ("",None),(None,None),
    ("some day",None),
    ("January 2024",None),
    ("5 Foo 2024",None),
    ("1-URGENT",None),
    ("4-NOT SPECIFIED",None),
    ("2024-01-05 10:61",None),
    ("10:00",None),
    ("2024-01-05 extra",None),
    ("2024-01-05 10:00:00 XYZ",None),
    ("1.2.3.4",None),
    ("123",None),
    ("2018-08-14T10:11:12+0530","2018-08-14T04:41:12Z"),
    ("2018-08-14 10:00 -05","2018-08-14T15:00:00Z"),
    ("Tue Aug 14 10:00:00 EDT 2018","2018-08-14T14:00:00Z"),
    ("2024-01-05T10:00:00+0000","2024-01-05T10:00:00Z"),
    ("mayor 5 2024",None),
    ("may 5 2024","2024-05-05T00:00:00Z"),
    ("99999999999999999999 1 2",None)]


def test_dates(spark):
    rows = [(i, raw) for i, (raw, _) in enumerate(DATES)]
    got = spark.createDataFrame(rows, "i int, raw string").select("i", date_clean("raw").alias("out")).collect()
    assert {DATES[r.i][0]: r.out for r in got} == dict(DATES)


CELLS = ["['a', 'b']", "[]", "()", "[None]", "['a', None, \"b'c\"]", "['a',]", "('a', 'b')", "('a',)", "('a')", "['a'] junk",
         r"['it\'s', 'x\n\ty', '\x41\u00e9\U0001F600']", "[1, -2.5, True]", "'a'", "", "['broken", "[','] ", "['a', ['b']]", "[a]",
         " [ 'x' , 'y' ] ", r"['a\q']", r"['\\']", r'["a\"b"]', "['a', ]", "[,]", "(,)", "['a',, 'b']", "('a' , 'b' , )", "['é ü', '漢']",
         "['a\nb']", "['a\\\nb']", r"['\'']", "[" + ", ".join(f"'{i}'" for i in range(20000)) + "]", "[" + "'" * 50001, None]


def python_list(cell):
    try:
        got = ast.literal_eval(cell.strip())
    except (AttributeError, SyntaxError, ValueError):
        return None
    if not isinstance(got, (list, tuple)) or any(isinstance(x, list) for x in got):
        return None
    return [x if x is None or isinstance(x, str) else str(x) for x in got]


@pytest.mark.filterwarnings("ignore")
def test_list_literals_as_python_reads_them(spark):
    df = spark.createDataFrame(list(enumerate(CELLS)), "i int, cell string")
    got = df.select("i", parse_list_literal("cell").alias("out"), is_malformed_literal("cell").alias("bad")).collect()
    for r in got:
        assert r.out == python_list(CELLS[r.i])
        assert r.bad == (CELLS[r.i] is not None and r.out is None)
    assert malformed_literals(df, ["cell"]).first()[0] == sum(r.bad for r in got)
    # strings side by side are one string to Python, no list item here
    assert spark.createDataFrame([("['a' 'b']",)], "c string").select(parse_list_literal("c")).first()[0] is None

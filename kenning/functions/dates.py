"""Date functions (DT-*)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from kenning import config

__all__ = ["parse_any_date", "parse_date_strict", "format_out", "shift_after", "days_since", "date_clean", "now_string"]

# Fixed values of the date grammar. Months are known by their names and every shortening
# of at least three letters; zones are those of mail headers (minutes ahead of UTC).
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
ZONES = {"z": 0, "ut": 0, "utc": 0, "gmt": 0, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360,
         "pst": -480, "pdt": -420, "bst": 60, "cet": 60, "cest": 120}
# Two-digit years below this one are of this century.
CENTURY = 69
_OFFSET = r"[+-]\d{2}(?::?\d{2})?(?!\d)"
# hour:minute[:second[.fraction]] [am/pm] [zone], or an hour with am/pm
TIME = (r"(?i)(?<![\d:.-])(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(?![\d:])\s*(?:([ap])\.?m\b\.?)?|\s*([ap])\.?m\b\.?)"
        r"(?:\s*((?:(?:utc|gmt)\s*)?" + _OFFSET + "|(?:" + "|".join(sorted(ZONES, key=len, reverse=True)) + r")\b))?")
# words that say nothing about the date: weekdays, "at", the T before a time, ordinal endings
FILLER = (r"(?i)\b(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\b\.?|\b(?:at|on|of|the)\b"
          r"|(?<=\d)(?:st|nd|rd|th)\b|(?<=\d)T(?=\s|$)")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int(c) -> Column:
    return c.try_cast("int")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it: the
    end of a fold over nothing that starts with the value. (An array of one element that is
    transformed and taken out again asks for its type, hence the whole body's, in every row.)"""
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


# Put around the fields of a time that is taken out; a value that has it is no date.
_MARK = "\x01"


def _take_time(v: Column) -> Column:
    """``v`` cut at its times, with their fields between: rest, fields, rest, ...; the value
    alone without a time. Only what may hold one (a colon, am or pm) is searched."""
    may = F.contains(v, F.lit(":")) | v.rlike(r"(?i)[ap]\.?m\b")
    return F.when(may, F.split(F.regexp_replace(v, TIME, f"{_MARK}$1|$2|$3|$4|$5$6|$7{_MARK}"), _MARK)).otherwise(F.array(v))


def _clock(cut: Column) -> Column:
    """The fields of the first time as texts: hour, minute, second, fraction, half, zone;
    one empty text without a time."""
    return F.when(F.size(cut) > 1, F.split(F.get(cut, F.lit(1)), r"\|")).otherwise(F.array(F.lit("")))


def _rest(cut: Column) -> Column:
    """What stands around the times, a blank for each of them."""
    return F.when(F.size(cut) > 1, F.array_join(F.filter(cut, lambda x, i: i % 2 == 0), " ")).otherwise(F.get(cut, F.lit(0)))


def _time(part: Column) -> tuple[Column, Column, Column, Column]:
    """(hour, minute, second, minutes ahead of UTC), midnight UTC without a time; null for
    what is no time (25:00, 13 pm)."""
    def field(i):
        return F.get(part, F.lit(i))

    none = F.size(part) == 1
    half, hour = F.lower(field(4)), _int(field(0))
    hour = (F.when(none, 0).when(field(4) == "", F.when(hour < 24, hour))
            .when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0)))

    def sixty(i):
        return F.when(none | (field(i) == ""), 0).otherwise(F.when(_int(field(i)) < 60, _int(field(i))))

    fraction = F.when(none, "").otherwise(F.substring(field(3), 1, 6))
    second = F.when(fraction == "", sixty(2).cast("decimal(8,6)")).otherwise(
        F.when(sixty(2).isNotNull(), F.concat_ws(".", sixty(2).cast("string"), fraction).try_cast("decimal(8,6)")))
    zone = F.lower(field(5))
    sign = F.when(F.contains(zone, F.lit("-")), -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    ahead = sign * (F.coalesce(_int(F.substring(digits, 1, 2)), F.lit(0)) * 60 + F.coalesce(_int(F.substring(digits, 3, 2)), F.lit(0)))
    names = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    named = F.when(digits == "", F.coalesce(F.try_element_at(names, zone), F.lit(0))).otherwise(ahead)
    return hour, sixty(1), second, F.when(none | (field(5) == ""), 0).otherwise(named)


def _month_of(words: Column) -> Column:
    """The month that the only word names or shortens to three letters or more, else null."""
    def month(word):
        at = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(word, 1, 3)).cast("int")
        return _let(at, lambda at: F.when(F.startswith(F.get(F.array(*[F.lit(m) for m in MONTHS]), at - 1), word), at))

    return F.when(F.size(words) == 1, _let(F.lower(F.get(words, F.lit(0))), month))


def _date(v: Column, numbers: Column, words: Column, month_word: Column, body) -> Column:
    """``body`` of (year, month, day) of three parts in any usual order: a month word or
    number, a day, a year of four or two digits; null unless all three are there and nothing
    else."""
    def number(i):
        return F.get(numbers, F.lit(i))

    spelt = (F.size(words) == 1) & (F.size(numbers) == 2)
    digits = (F.size(words) == 0) & (F.size(numbers) == 3)
    clean = ~v.rlike(r"[^\p{L}\d\s,./-]")
    year_first = F.length(number(0)) == 4
    year = F.when(year_first, number(0)).when(spelt, number(1)).otherwise(number(2))
    a = F.when(year_first, number(1)).otherwise(number(0))
    b = F.when(year_first, number(2)).otherwise(number(1))

    def whole(p):
        # month before day, unless only the other order is possible
        swap = (p["a"] > 12) & (p["b"] <= 12)
        year = F.when(p["digits"] == 4, p["year"]).when(
            p["digits"] == 2, p["year"] + F.when(p["year"] < CENTURY, 2000).otherwise(1900))
        month = F.when(p["spelt"], month_word).when(swap, p["b"]).otherwise(p["a"])
        day = F.when(p["spelt"], p["a"]).when(swap, p["a"]).otherwise(p["b"])
        return body(year, month, day)

    fields = F.struct(spelt.alias("spelt"), _int(year).alias("year"), F.length(year).alias("digits"), _int(a).alias("a"), _int(b).alias("b"))
    return _let(F.when((spelt | digits) & clean, fields), whole)


def parse_any_date(c) -> Column:
    """DT-1, the tolerant form: a value is read by a grammar, not by whole formats. A time
    with its zone and am/pm is taken out wherever it stands; comments in brackets,
    weekdays and filler words go; what is left must be a year, a month and a day, in
    numbers or with a month word, whatever separates them. Digits alone are read as
    ``yyyyMMdd[HHmm[ss]]``. Of two numbers that could both be the month the first is.
    Null when a part is missing, left over or no real date."""
    def where(test, pattern, new):
        """The pattern replaced where a cheap ``test`` says that it may be found."""
        return lambda v: F.when(test(v), F.regexp_replace(v, pattern, new)).otherwise(v)

    v = _let(F.trim(_c(c)), where(lambda v: F.contains(v, F.lit(")")), r"\s*\([^()]*\)$", ""))
    v = _let(v, where(lambda v: F.substring(v, 5, 1).between("0", "9"),
                      r"^(\d{4})(\d{2})(\d{2})(?:[T ]?(\d{2})(\d{2})(\d{2})?)?(?=$|[Z+-])", "$1-$2-$3 $4:$5:$6"))
    v = _let(v, where(lambda v: F.contains(v, F.lit(":")), r" :?:$|:(?=$|[Z+-])", ""))
    v = _let(v, lambda v: F.when(~F.contains(v, F.lit(_MARK)), v))

    def worded(time, rest):
        """The words of the rest, and the month if that is the only one."""
        words = F.regexp_extract_all(rest, F.lit(r"\p{L}+"), F.lit(0))
        return _let(words, lambda w: F.struct(time.alias("time"), rest.alias("rest"), w.alias("words"), _month_of(w).alias("month")))

    def without_filler(p):
        # nothing is filler where no words are, or a month alone
        return F.when((F.size(p["words"]) == 0) | p["month"].isNotNull(), p).otherwise(
            _let(F.regexp_replace(p["rest"], FILLER, " "), lambda rest: worded(p["time"], rest)))

    def read(p):
        hour, minute, second, ahead = _time(p["time"])
        numbers = F.regexp_extract_all(p["rest"], F.lit(r"\d+"), F.lit(0))
        return _let(numbers, lambda n: _date(p["rest"], n, p["words"], p["month"], lambda year, month, day: F.timestamp_add(
            "MINUTE", -ahead, F.try_make_timestamp(year, month, day, hour, minute, second))))

    def parts(cut):
        return _let(F.struct(_clock(cut).alias("time"), _rest(cut).alias("rest")),
                    lambda p: _let(_let(worded(p["time"], p["rest"]), without_filler), read))

    return _let(_let(v, _take_time), parts)


def parse_date_strict(c) -> Column:
    """The strict form: a value that is no date is an error; null stays null."""
    parsed = parse_any_date(c)
    return F.when(_c(c).isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("no date format reads: "), _c(c))).cast("timestamp")).otherwise(parsed)


def format_out(ts) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` in the session time zone (UTC)."""
    return F.date_format(_c(ts), config.OUT_TS_FORMAT)


def date_clean(c) -> Column:
    """DT-1: parse any date and write the output format."""
    return format_out(parse_any_date(c))


def shift_after(comment_ts, received_ts) -> Column:
    """DT-2: move the comment forward by whole days so it falls after the mail.

    ``comment + (floor(days(received - comment)) + 1) days``; null when either is null.
    """
    r, c = _c(received_ts), _c(comment_ts)
    diff_days = F.floor(F.timestamp_diff("MICROSECOND", c, r) / F.lit(86400000000.0))
    return F.timestamp_add("DAY", (diff_days + 1).cast("int"), c)


def days_since(day, as_of: _dt.date) -> Column:
    """DT-4: whole days from ``day`` to ``as_of`` (a parameter, never the clock)."""
    return F.datediff(F.lit(as_of), _c(day))


def now_string() -> Column:
    """DT-5: the current time in the output format (the query start time, the
    same for every row)."""
    return format_out(F.current_timestamp())

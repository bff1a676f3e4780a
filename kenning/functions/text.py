"""String functions (STR-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kenning import config

__all__ = [
    "WS_CLASS", "TOKEN_PATTERN", "ws_split", "clean_content", "strip_brackets", "lower_clean_body",
    "build_content", "rtrim_list", "name_tokens", "user_tag", "id_type", "slash_paren", "title_case",
    "extract_mails", "parse_list_literal", "is_malformed_literal", "is_iso8601", "rank_key", "append_mentions",
    "starts_with_any", "tokenize",
]

# The blanks of Python's str.split(), written out: ASCII, the separators
# \x1C-\x1F and the Unicode blanks (no-break space in HTML mail).
WS_CLASS = (r"[ \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# Token rule: a mail address or a web address as one token; else runs of
# letters, digits and '_', or one other non-blank character.
TOKEN_CORE = (r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]+|https?://[^ \t\n\x0B\f\r]+"
              r"|[\p{L}\p{N}_]+|[^ \t\n\x0B\f\r\p{L}\p{N}_]")
TOKEN_PATTERN = TOKEN_CORE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ws_split(c) -> Column:
    """Python ``str.split()``: blank-separated words, no empty strings."""
    return F.filter(F.split(_c(c), WS_CLASS + "+"), lambda w: w != F.lit(""))


def clean_content(c, stopwords=config.STOPWORDS, strip_punct: bool = False) -> Column:
    """STR-1: drop stopwords (compared in lower case), collapse blanks, drop ``http...`` words."""
    # ``isin`` over literals is planned as a hash-set test (InSet), not a scan of the list
    kept = F.filter(ws_split(c), lambda w: ~F.lower(w).isin(*stopwords))
    out = F.regexp_replace(F.array_join(kept, " "), r"http[^ ]+", "")
    if strip_punct:
        out = F.lower(F.translate(out, config.PUNCTUATION_STRIP, ""))
    return out


def strip_brackets(c) -> Column:
    """STR-2: '<' and '>' become blanks."""
    return F.translate(_c(c), "<>", "  ")


def lower_clean_body(c) -> Column:
    """STR-3 then STR-2, as tenant B applies them to the body."""
    return strip_brackets(F.lower(_c(c)))


def build_content(subject, body, to=None, cc=None) -> Column:
    """STR-5: subject, body, recipients (arrays are joined by blanks); nulls skipped."""
    parts = [_c(subject), _c(body)]
    if to is not None:
        parts.append(F.array_join(_c(to), " "))
    if cc is not None:
        parts.append(F.array_join(_c(cc), " "))
    return F.concat_ws(" ", *parts)


def rtrim_list(c) -> Column:
    """STR-4 for a list: right-trim each element, join by ', '."""
    return F.array_join(F.transform(_c(c), lambda x: F.rtrim(x)), ", ")


def name_tokens(mail) -> Column:
    """STR-6: words of the part before '@', dots read as blanks."""
    local = F.substring_index(_c(mail), "@", 1)
    return ws_split(F.replace(local, F.lit("."), F.lit(" ")))


def user_tag(c) -> Column:
    """STR-7: prefix ``USER_``; null stays null."""
    return F.when(_c(c).isNotNull(), F.concat(F.lit("USER_"), _c(c)))


def id_type(sub_id) -> Column:
    """STR-8: the id kind: no directory id vs directory id (fixed labels in ``config``)."""
    return F.when(_c(sub_id).isNull(), F.lit(config.ID_TYPE_EMAIL)).otherwise(F.lit(config.ID_TYPE_DIRECTORY))


def slash_paren(c) -> Column:
    """STR-9: ' (' becomes '/'."""
    return F.replace(_c(c), F.lit(" ("), F.lit("/"))


def title_case(c) -> Column:
    """STR-10: Python ``str.title``: first letter of each letter run upper, the rest lower.

    ``initcap`` differs (it only splits at blanks), so runs of letters and of
    non-letters are rebuilt one by one.
    """
    runs = F.regexp_extract_all(_c(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))),
        "")


def extract_mails(c, pattern: str = config.MAIL_PATTERN_WIDE) -> Column:
    """STR-11: distinct addresses found in the text, first-seen order."""
    return F.array_distinct(F.regexp_extract_all(_c(c), F.lit(pattern), 0))


# One element of a Python list literal: a quoted string with escapes, a number, a name.
_ITEM = r"""(?:'(?:[^'\\\n]|\\.)*+'|"(?:[^"\\\n]|\\.)*+"|[+-]?\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|None|True|False)"""
_ITEMS = rf"(?:{_ITEM}\s*+(?:,\s*+{_ITEM}\s*+)*+"
# a list, or a tuple: of one element only with its comma
LIST_LITERAL = rf"(?s)^\s*+(?:\[\s*+{_ITEMS}(?:,\s*+)?)?\]|\(\s*+\)|\(\s*+{_ITEM}\s*+,\s*+\)|\(\s*+{_ITEM}\s*+,\s*+{_ITEMS}(?:,\s*+)?)\))\s*+$"
# Escapes of one letter in a quoted string.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v"}


def _unescape(piece) -> Column:
    """One escape sequence, or a stretch without any, as it is meant."""
    second = F.substring(piece, 2, 1)
    code = F.conv(F.substring(piece, 3, 8), 16, 10).try_cast("int")
    out = F.when(second.isin("x", "u", "U") & (F.length(piece) > 2), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    for letter, meant in _ESCAPES.items():
        out = out.when(second == letter, F.lit(meant))
    out = out.when(second == "\n", F.lit("")).when(second.isin("\\", "'", '"'), second).otherwise(piece)
    return F.when(F.startswith(piece, F.lit("\\")), out).otherwise(piece)


def _item_value(item) -> Column:
    inner = F.substring(item, F.lit(2), F.length(item) - 2)
    pieces = F.regexp_extract_all(inner, F.lit(r"(?s)[^\\]+|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\."), F.lit(0))
    quoted = F.when(F.contains(inner, F.lit("\\")), F.array_join(F.transform(pieces, _unescape), "")).otherwise(inner)
    return F.when(item.rlike("""^['"]"""), quoted).when(item != "None", item)


def parse_list_literal(c) -> Column:
    """STR-12: a Python list or tuple literal of strings to array<string>.

    Read as Python does: single or double quotes, escapes, a comma at the end; ``None`` is
    a null element, numbers and truth values keep their spelling. A cell that is anything
    else (text after the bracket, an open quote, names, a lone value) is null; count them
    with ``relational.malformed_literals``."""
    v = _c(c)
    items = F.regexp_extract_all(v, F.lit("(?s)" + _ITEM), F.lit(0))
    return F.when(v.rlike(LIST_LITERAL), F.transform(items, _item_value))


def is_malformed_literal(c) -> Column:
    """STR-12: a cell that holds something, but no list literal."""
    return _c(c).isNotNull() & ~_c(c).rlike(LIST_LITERAL)


def is_iso8601(c) -> Column:
    """STR-13: matches the ISO-8601 pattern; null is false."""
    return F.coalesce(_c(c).rlike(config.ISO8601_PATTERN), F.lit(False))


def rank_key(category, rank) -> Column:
    """STR-14: ``TAG_<category>_<rank, 4 digits or more>``."""
    return F.format_string("TAG_%s_%04d", _c(category), _c(rank).cast("int"))


def append_mentions(text, mentions) -> Column:
    """STR-15: text followed by ``@name `` for each mention."""
    suffix = F.array_join(F.transform(_c(mentions), lambda m: F.concat(F.lit("@"), m, F.lit(" "))), "")
    return F.concat(_c(text), F.coalesce(suffix, F.lit("")))


def starts_with_any(value, prefixes) -> Column:
    """STR-16: the value starts with one of the prefixes."""
    return F.exists(_c(prefixes), lambda p: F.startswith(_c(value), p))


def tokenize(c) -> Column:
    """Token array of a text (see TOKEN_PATTERN)."""
    return F.regexp_extract_all(_c(c), F.lit(TOKEN_PATTERN), 0)

"""Array, map and struct functions (ARR-*, MAP-4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kenning.functions.text import ws_split

__all__ = ["recipients_merge", "without_sender", "first_item", "label_mails", "complete_names_in_row",
           "word_count"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recipients_merge(to, cc, sender) -> Column:
    """ARR-1: ``to`` followed by the cc entries that do not occur in the sender.

    The test is a substring test against the sender string, as in the original.
    """
    kept_cc = F.filter(F.coalesce(_c(cc), F.array().cast("array<string>")),
                       lambda x: ~F.coalesce(F.contains(_c(sender), x), F.lit(False)))
    return F.concat(F.coalesce(_c(to), F.array().cast("array<string>")), kept_cc)


def without_sender(participants, sender) -> Column:
    """ARR-2: participants other than the sender; repeats are kept (not array_except)."""
    return F.filter(_c(participants), lambda x: ~F.coalesce(x == _c(sender), F.lit(False)))


def first_item(c) -> Column:
    """ARR-8: first element or null."""
    return F.try_element_at(_c(c), F.lit(1))


def label_mails(mails, label: str = "EMAIL") -> Column:
    """ARR-13: pair each address with a label."""
    return F.transform(_c(mails), lambda m: F.struct(m.alias("value"), F.lit(label).alias("category")))


def word_count(c) -> Column:
    return F.size(ws_split(c))


def complete_names_in_row(names) -> Column:
    """ARR-10 inside one row: each name becomes the longest names of the same list
    that start with it (one-word names: or end with it); ties joined by a blank
    in sorted order. Quadratic in the list length: meant for short lists (a
    mail's mentions); long texts use ``directory.complete_names`` grouped by
    message, which is an equi-join on prefix and suffix keys."""
    n = _c(names)

    def complete(x):
        ms = F.when(word_count(x) == 1, F.filter(n, lambda y: F.startswith(y, x) | F.endswith(y, x))) \
            .otherwise(F.filter(n, lambda y: F.startswith(y, x)))
        top = F.array_max(F.transform(ms, lambda y: F.length(y)))
        return F.array_join(F.array_sort(F.array_distinct(F.filter(ms, lambda y: F.length(y) == top))), " ")

    return F.transform(n, complete)

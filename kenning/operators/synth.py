"""Pseudonymous values (RND-1..4). Deterministic: keyed hashes of the row, so a
re-run (or a re-computed partition after an executor loss) gives the same value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_int(*parts, salt: str = "") -> Column:
    """A non-negative integer from the first 32 bits of sha256(salt | parts)."""
    s = F.concat_ws("|", F.lit(salt), *[p.cast("string") if isinstance(p, Column) else F.col(p).cast("string")
                                       for p in parts])
    return F.conv(F.substring(F.sha2(s, 256), 1, 8), 16, 10).cast("bigint")


def keyed_id(value, n: int = 8, salt: str = "id") -> Column:
    """RND-1: value followed by n hex characters of a keyed hash."""
    v = F.col(value) if isinstance(value, str) else value
    return F.concat(v.cast("string"), F.substring(F.sha2(F.concat_ws("|", F.lit(salt), v.cast("string")), 256), 1, n))


def pick(names, *parts, salt: str = "pick") -> Column:
    """RND-2: one element of ``names`` chosen by a keyed hash of the row."""
    arr = F.array(*[F.lit(x) for x in names])
    return F.element_at(arr, (F.pmod(hash_int(*parts, salt=salt), F.lit(len(names))) + 1).cast("int"))


def coin(*parts, salt: str = "coin") -> Column:
    """RND-3: a fair keyed coin."""
    return F.pmod(hash_int(*parts, salt=salt), F.lit(2)) == 1


def pseudonym_map(values: DataFrame, col: str, names, out: str = "pseudonym") -> DataFrame:
    """RND-4: pair the distinct values (sorted) with a list of names, first with
    first; values beyond the list get null.

    Only the first len(names) distinct values can get a name, so they are taken
    with a distributed top-k and ranked on that bounded row set; the rest of the
    distinct values is joined back with a null name."""
    d = values.select(col).filter(F.col(col).isNotNull()).distinct()
    return d.join(F.broadcast(pseudonym_head(d, col, names, out)), on=col, how="left")


def pseudonym_head(values: DataFrame, col: str, names, out: str = "pseudonym") -> DataFrame:
    """The values of ``pseudonym_map`` that get a name: at most len(names) rows."""
    d = values.select(col).filter(F.col(col).isNotNull()).distinct()
    arr = F.array(*[F.lit(x) for x in names])
    return (d.orderBy(col).limit(len(names))
            .withColumn("_r", F.row_number().over(Window.orderBy(col)))
            .withColumn(out, F.try_element_at(arr, F.col("_r"))).drop("_r"))

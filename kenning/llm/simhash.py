"""SimHash near-duplicates with pivot distance tables.

Fingerprints are made in one pass over the texts (Arrow batches, vectorised bit
counts). Rows with equal fingerprints form a class; everything after that works
on distinct fingerprints, so groups of copies cost one row.

Each distinct fingerprint has a row in a table of its Hamming distances to reference
fingerprints: the empty one, sixteen that set four neighbouring bits each, and
``PIVOTS`` spread over the cube. Flipping a bit changes a distance by one, so two
fingerprints within k bits differ by at most k in every coordinate of the table.

Candidates come from the table too. The distances to the empty reference and to one of
four bits tell how many of those bits are set, d(x, 0) + 4 - d(x, M) = 2 |x & M|, and at
most k of these sixteen counts change within k bits. They are dealt to six groups, so
6 - k groups are equal as a whole: a fingerprint is filed under each choice of that many
groups (15 keys for two bits, some 22 bits of the counts each), and pairs meet by an
equi-join on a key. Pairs that differ by more than k in any coordinate are discarded,
the survivors verified by XOR and bit count; all three are conditions of the join, so
only true links leave it. A fingerprint has at most 2,080 neighbours within two bits:
links grow linearly with distinct fingerprints however large a group of near copies is.
Distinct fingerprints that share a key do meet; adaptive execution splits such a key.

Defined results: null, empty and blank texts have fingerprint zero and link like
any other; a null id sorts after all others (a component of null ids only has a
null component id); rows that repeat are each returned; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import scratch, signed, text_bytes, without
from kenning.llm.components import connected_components

SEED = 42
MAX_BITS = 2
# The sixteen references of four bits in groups, by the number of their bits.
GROUPS = ((0, 1, 2), (3, 4, 5), (6, 7, 8), (9, 10, 11), (12, 13), (14, 15))
# Shingles hashed at a time: bounds the memory of a very long text.
CHUNK = 1 << 16
PIVOTS = 16


def pivot_fingerprints(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: XXH64 of 0, 1, 2, ... (spread over the cube)."""
    import xxhash
    return [xxhash.xxh64_intdigest(str(i), SEED) for i in range(n)]


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of one text (UTF-8 bytes) as an unsigned 64-bit value."""
    import xxhash
    words = text.lower().split()  # on bytes: A-Z only, and the six blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    starts, ends = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, CHUNK):
        part = [joined[s:e] for s, e in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, th, fp) per row: ``th`` is a hash of the whole text (tells rows that
    share an id apart), ``fp`` the fingerprint as a bigint."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))

    def run(batches):
        import pyarrow as pa
        import xxhash
        for b in batches:
            texts = text_bytes(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0),
                 pa.array([signed(xxhash.xxh64_intdigest(t, SEED)) for t in texts], pa.int64()),
                 pa.array([signed(fingerprint(t, width)) for t in texts], pa.int64())], ["id", "th", "fp"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, th bigint, fp bigint")


def bit_counts(fp: Column) -> Column:
    """Set bits of each four bits of ``fp``, as sixteen fields of four bits: half the
    difference of the distances to the empty reference and to each one of four bits."""
    ones, twos = (F.lit(m).cast("bigint") for m in (0x5555555555555555, 0x3333333333333333))
    low, high = fp.bitwiseAND(ones), F.shiftrightunsigned(fp, 1).bitwiseAND(ones)
    # two bits added by logic, so that no sum reaches the sign
    pair = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    return pair.bitwiseAND(twos) + F.shiftrightunsigned(pair, 2).bitwiseAND(twos)


def distance_table(fps: DataFrame) -> DataFrame:
    """(fp, counts, p0, p1): the coordinates of each fingerprint, the distances to the
    ``PIVOTS`` references packed eight to a bigint."""
    fp = F.col("fp")
    tables = []
    refs = [signed(p) for p in pivot_fingerprints()]
    for at in range(0, PIVOTS, 8):
        packed = F.lit(0).cast("bigint")
        for j, r in enumerate(refs[at:at + 8]):
            d = F.bit_count(fp.bitwiseXOR(F.lit(r).cast("bigint"))).cast("bigint")
            packed = packed.bitwiseOR(F.shiftleft(d, 8 * j))
        tables.append(packed.alias(f"p{at // 8}"))
    return fps.select("fp", bit_counts(fp).alias("counts"), *tables)


def candidates(table: DataFrame, max_bits: int = MAX_BITS) -> tuple[DataFrame, Column, Column]:
    """Pairs (sides a and b) that share a key; the condition that no coordinate of the
    table differs by more than ``max_bits``; the condition that the pair is a link."""
    if not 0 <= max_bits < len(GROUPS):
        raise ValueError(f"max_bits must be from 0 to {len(GROUPS) - 1}")
    keys = []
    for n, chosen in enumerate(combinations(GROUPS, len(GROUPS) - max_bits)):
        mask = sum(15 << 4 * i for g in chosen for i in g)
        keys.append(F.struct(F.lit(n).alias("choice"), F.col("counts").bitwiseAND(F.lit(signed(mask)).cast("bigint")).alias("equal")))
    filed = table.select("*", F.explode(F.array(*keys)).alias("key")).select(*table.columns, "key.choice", "key.equal")
    a, b = filed.alias("a"), filed.alias("b")
    met = a.join(b, (F.col("a.choice") == F.col("b.choice")) & (F.col("a.equal") == F.col("b.equal")) & (F.col("a.fp") < F.col("b.fp")))

    def differ(name, shift, mask):
        at = [F.shiftrightunsigned(F.col(f"{side}.{name}"), shift).bitwiseAND(F.lit(mask).cast("bigint")) for side in "ab"]
        return F.abs(at[0] - at[1])

    near = F.lit(True)
    for k in range(PIVOTS):
        near = near & (differ(f"p{k // 8}", 8 * (k % 8), 127) <= max_bits)
    for i in range(16):
        near = near & (differ("counts", 4 * i, 15) <= max_bits)
    return met, near, F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (column ``fp``) that differ in at
    most ``max_bits`` bits; a pair may come more than once."""
    met, near, link = candidates(distance_table(fps), max_bits)
    return met.where(near).where(link).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def _components(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, best): per distinct fingerprint the first row (struct z, i, th) of its component."""
    first = F.min(F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("i"), F.col("th").alias("th")))
    classes = scratch(fps.groupBy("fp").agg(first.alias("first")), "fp-classes")
    comp = connected_components(links(classes.select("fp"), max_bits), "a", "b")
    rooted = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    return scratch(rooted.select("fp", "root").join(best, "root").select("fp", "best"), "fp-components")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits) and ``component_id``,
    the smallest id reachable by links of at most ``max_bits`` differing bits."""
    fps = scratch(fingerprints(df, id_col, text_col, width), "fps")
    return (fps.join(_components(fps, max_bits), "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("best.i").alias("component_id")))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with one row text of each component (the smallest id; among rows that
    share it, one text), all columns kept."""
    fps = scratch(fingerprints(df, id_col, text_col, width), "fps")
    comp = _components(fps, max_bits)
    same = F.col("id").eqNullSafe(F.col("best.i")) & (F.col("th") == F.col("best.th"))
    gone = scratch(fps.join(comp, "fp").where(~same).select("id", "th", F.xxhash64("id", "th").alias("flag_key")), "gone")
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return without(df, gone, {"id": F.col(id_col), "th": th}, F.xxhash64(F.col(id_col), th))

"""Names, addresses and the user directory (ARR-10, ARR-11, JN-2, JN-6..9, STR-7, STR-8).

No operator here pairs every row of a group with every other: the prefix,
suffix and substring relations the original tested in nested loops are turned
into equi-joins on generated keys whose count is bounded by the length of each
string, not by the size of the group or the directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kenning.functions.arrays import word_count
from kenning.functions.text import id_type, name_tokens, title_case, user_tag, ws_split
from kenning.operators.joins import sized_broadcast
from kenning.session import ensure_checkpoint_dir

# Rows of a word's posting that one task meets.
POSTING_SLOT = 20_000


def _prefixes(c):
    return F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(c, 1, i))


def _suffixes(c):
    return F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(c, i, 1 << 30))


def complete_names(names: DataFrame, group_cols, name="value", out="completed") -> DataFrame:
    """ARR-10 over a group: each distinct name becomes the longest names of its
    group that start with it (one-word names: or end with it); ties are joined
    by a blank in sorted order.

    Every candidate emits its prefixes (and suffixes) as keys; of the candidates of one
    key only the longest stay, cut in each task before the shuffle (a ranking window
    with a limit). A name then meets the longest candidates of its own two keys, so the
    work is the total length of the names plus the longest matches, and a short name
    that begins a third of a group's names is cheap."""
    group_cols = list(group_cols)
    base = names.select(*group_cols, F.col(name).alias("_x")).filter(F.col("_x").isNotNull()).distinct()
    keys = (base.select(*group_cols, F.col("_x").alias("_y"),
                        F.explode(F.array(
                            F.struct(F.lit("p").alias("kind"), F.array_distinct(_prefixes(F.col("_x"))).alias("ks")),
                            F.struct(F.lit("s").alias("kind"), F.array_distinct(_suffixes(F.col("_x"))).alias("ks")),
                        )).alias("_k"))
            .select(*group_cols, "_y", F.col("_k.kind").alias("_kind"), F.explode("_k.ks").alias("_key")))
    by_length = Window.partitionBy(*group_cols, "_key", "_kind").orderBy(F.length("_y").desc())
    longest = keys.withColumn("_rank", F.rank().over(by_length)).filter(F.col("_rank") == 1)
    cond = [F.col("m." + g) == F.col("k." + g) for g in group_cols] + [
        F.col("m._x") == F.col("k._key"),
        (F.col("k._kind") == "p") | (word_count(F.col("m._x")) == 1)]
    # at most two kinds of hits per name, each of one length: the longer kind, or both
    hits = (base.alias("m").join(longest.alias("k"), cond, "inner")
            .groupBy(*[F.col("m." + g).alias(g) for g in group_cols], F.col("m._x").alias(name))
            .agg(F.array_sort(F.collect_set("k._y")).alias("_ys")))
    top = F.filter("_ys", lambda y: F.length(y) == F.array_max(F.transform("_ys", F.length)))
    return hits.select(*group_cols, name, F.array_join(top, " ").alias(out))


def apply_aliases(df: DataFrame, aliases: DataFrame, value="value", category=None,
                  alias_col="alias", canonical_col="canonical") -> DataFrame:
    """ARR-11: whole-value alias -> canonical term; values without alias stay.

    With ``category`` the alias table is keyed by (category, alias). When the
    table repeats a key, the later entry (largest ``ord``, if present) wins, as
    in a Python dict."""
    keys = ([category] if category else []) + [alias_col]
    a = aliases
    if "ord" in a.columns:
        a = a.groupBy(*keys).agg(F.max_by(canonical_col, "ord").alias(canonical_col))
    a = sized_broadcast(a.select(*[F.col(k).alias("_ak_" + k) for k in keys], F.col(canonical_col).alias("_canon")))
    cond = [F.col(value) == F.col("_ak_" + alias_col)]
    if category:
        cond.append(F.col(category) == F.col("_ak_" + category))
    j = df.join(a, cond, "left")
    return j.withColumn(value, F.coalesce(F.col("_canon"), F.col(value))).drop("_canon", *["_ak_" + k for k in keys])


def dedupe_directory(directory: DataFrame, key="email_id", order="ord") -> DataFrame:
    """Q30: one directory row per address, the first by ``order``."""
    cols = [c for c in directory.columns if c != key]
    first = directory.groupBy(key).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_r"))
    return first.select(key, "_r.*")


def directory_join(profile: DataFrame, directory: DataFrame, key="email_id") -> DataFrame:
    """JN-2 + STR-7 + STR-8 + STR-10: attach directory id and name.

    ``directory``: (email_id, sub_id, user_name, ord). ``id_type`` is EMAIL when
    the address is not in the directory; ``sub_id`` then falls back to the address;
    both get the ``USER_`` tag; the name is title-cased."""
    d = dedupe_directory(directory, key).select(key, "sub_id", F.col("user_name").alias("userName"))
    j = profile.join(d, on=key, how="left")
    return (j.withColumn("id_type", id_type(F.col("sub_id")))
            .withColumn("sub_id", user_tag(F.coalesce(F.col("sub_id"), F.col(key))))
            .withColumn("userName", title_case(F.col("userName"))))


def _name_words(name_col):
    local = F.substring_index(name_col, "@", 1)
    plain = F.replace(local, F.lit("."), F.lit(" "))
    return plain, ws_split(plain)


def _substring_index(directory: DataFrame) -> DataFrame:
    """(s, r): every substring of every lower-cased word of the display name, with the
    row (ord, sub_id, user_name).

    A word never contains a blank, so "w is a substring of the display name"
    equals "w is a substring of one of its words"; each word of length L gives
    L(L+1)/2 keys."""
    words = F.array_distinct(ws_split(F.lower(F.col("user_name"))))

    def subs(w):
        return F.flatten(F.transform(F.sequence(F.lit(1), F.length(w)),
                                     lambda i: F.transform(F.sequence(F.lit(1), F.length(w) - i + 1),
                                                           lambda n: F.substring(w, i, n))))

    return (directory.filter(F.col("ord").isNotNull())
            .select(F.struct("ord", "sub_id", "user_name").alias("r"),
                    F.explode(F.array_distinct(F.flatten(F.transform(words, subs)))).alias("s")))


def _first_hits(names: DataFrame, index: DataFrame, holds, slot: int = POSTING_SLOT) -> DataFrame:
    """(w1, w2, r): the smallest index row that holds the words, per distinct pair of words.

    Only the postings (index rows) of words that occur in ``names`` are kept, and
    counted. One word takes the first row of its posting. Two words probe with the
    rarer one and ``holds(r, other)`` tests the other on the row; a posting longer than
    ``slot`` is dealt to slots and the pair sent to each, so no task holds it, and the
    first row is found again by an aggregation with partial results."""
    pairs = names.select("_w1", "_w2").filter(F.col("_w1").isNotNull()).distinct()
    words = (pairs.select(F.explode(F.array("_w1", "_w2")).alias("s")).filter(F.col("s").isNotNull()).distinct())
    ensure_checkpoint_dir(index.sparkSession)
    postings = index.join(sized_broadcast(words), on="s").checkpoint(eager=True)
    stats = postings.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("r")).checkpoint(eager=True)
    one = (pairs.filter(F.col("_w2").isNull()).join(stats, F.col("_w1") == F.col("s")).select("_w1", "_w2", "r"))
    n1, n2 = (stats.select(F.col("s").alias(w), F.col("n").alias("n" + w)) for w in ("_w1", "_w2"))
    # the rarer word, of two equally rare ones the longer
    first_rarer = F.struct(F.col("n_w1"), -F.length("_w1")) <= F.struct(F.col("n_w2"), -F.length("_w2"))
    two = (pairs.join(sized_broadcast(n1), on="_w1").join(sized_broadcast(n2), on="_w2")
           .select("_w1", "_w2", F.when(first_rarer, F.col("_w1")).otherwise(F.col("_w2")).alias("s"),
                   F.when(first_rarer, F.col("_w2")).otherwise(F.col("_w1")).alias("_other"),
                   F.least("n_w1", "n_w2").alias("_n")))
    slots = F.ceil(F.col("_n") / slot)
    sent = two.withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("bigint"), slots - 1))).drop("_n")
    hot = stats.filter(F.col("n") > slot).select("s", F.ceil(F.col("n") / slot).alias("_slots"))
    dealt = (postings.join(sized_broadcast(hot), on="s", how="left")
             .withColumn("_slot", F.coalesce(F.pmod(F.xxhash64("r"), F.col("_slots")), F.lit(0).cast("bigint"))).drop("_slots"))
    two = (sent.join(dealt, on=["s", "_slot"]).filter(holds(F.col("r"), F.col("_other")))
           .groupBy("_w1", "_w2").agg(F.min("r").alias("r")))
    return one.unionByName(two)


def resolve_names(names: DataFrame, directory: DataFrame, known_addresses: DataFrame, name="value") -> DataFrame:
    """JN-6 + JN-7 on distinct names.

    Tier 1: the first directory row (by ``ord``) whose display name contains the
    first and, for two-word names, the second word (substring test, both sides
    lower-cased). Tier 2: the first known address (by address) whose name words
    include them. Result ``name_id``: tier-1 id, tier-2 address, or the name
    itself; ``name_display``: title-cased tier-1 display name, tier-2 address
    words, or null."""
    plain, words = _name_words(F.col(name))
    n = (names.select(name).filter(F.col(name).isNotNull()).distinct()
         .select(name, plain.alias("_plain"),
                 F.lower(F.try_element_at(words, F.lit(1))).alias("_w1"),
                 F.lower(F.try_element_at(words, F.lit(2))).alias("_w2")))
    t1 = _first_hits(n, _substring_index(directory), lambda r, w: F.contains(F.lower(r["user_name"]), w))
    tokens = F.array_distinct(F.transform(name_tokens(F.col("address")), lambda t: F.lower(t)))
    parts = (known_addresses.filter(F.col("address").isNotNull())
             .select(F.struct("address", tokens.alias("tokens")).alias("r"), F.explode(tokens).alias("s")))
    t2 = _first_hits(n, parts, lambda r, w: F.array_contains(r["tokens"], w))
    # the first rows of both tiers per pair of words, by one aggregation
    row, none = "struct<ord:{},sub_id:string,user_name:string>", F.lit(None)
    row = row.format(directory.schema["ord"].dataType.simpleString())
    found = (t1.select("_w1", "_w2", F.col("r").cast(row).alias("_t1"), none.cast("string").alias("_t2_addr"))
             .unionByName(t2.select("_w1", "_w2", none.cast(row).alias("_t1"), F.col("r.address").alias("_t2_addr")))
             .groupBy("_w1", "_w2").agg(F.min("_t1").alias("_t1"), F.min("_t2_addr").alias("_t2_addr")))
    found = found.select(F.col("_w1").alias("_f1"), F.col("_w2").alias("_f2"), "_t1", "_t2_addr")
    r = (n.join(found, (F.col("_w1") == F.col("_f1")) & F.col("_w2").eqNullSafe(F.col("_f2")), "left")
         .select(name, "_plain", F.col("_t1.sub_id").alias("_t1_id"), F.col("_t1.user_name").alias("_t1_name"), "_t2_addr"))
    t2_name = title_case(F.array_join(name_tokens(F.col("_t2_addr")), " "))
    return r.select(
        name,
        F.coalesce(F.col("_t1_id"), F.col("_t2_addr"), F.col("_plain")).alias("name_id"),
        F.when(F.col("_t1_id").isNotNull(), title_case(F.col("_t1_name")))
         .when(F.col("_t2_addr").isNotNull(), t2_name).alias("name_display"))


def resolve_mails(mails: DataFrame, directory: DataFrame, known_addresses: DataFrame, mail="value",
                  min_len: int = 3) -> DataFrame:
    """JN-8 + JN-9 on distinct addresses: directory id (equality) or the address;
    directory name (title case), else the name words of a known address, else null."""
    m = mails.select(mail).filter(F.col(mail).isNotNull()).distinct()
    d = dedupe_directory(directory).select(F.col("email_id").alias(mail), F.col("sub_id").alias("_id"),
                                           F.col("user_name").alias("_nm"))
    k = known_addresses.select(F.col("address").alias(mail)).distinct().withColumn("_known", F.lit(True))
    j = m.join(d, on=mail, how="left").join(k, on=mail, how="left")
    long_enough = F.length(F.col(mail)) > min_len
    return j.select(
        mail,
        F.when(long_enough & F.col("_id").isNotNull(), F.col("_id")).otherwise(F.col(mail)).alias("mail_id"),
        F.when(long_enough & F.col("_id").isNotNull(), title_case(F.col("_nm")))
         .when(F.col("_known"), title_case(F.array_join(name_tokens(F.col(mail)), " "))).alias("mail_display"))


def _hits(asked: DataFrame, keys, addresses, directory: DataFrame, email: str) -> DataFrame:
    """(keys, _hit): what the directory knows of the addresses of each row, one struct
    (address, array of its (user_id, display)) for each known one.

    An address goes out once per row, and only known ones come back. The directory is
    the hashed side whatever its size is guessed to be, so an address that most rows
    hold streams through its task and is neither sorted nor held there."""
    some = F.filter(F.array_distinct(addresses), lambda x: x.isNotNull())
    known = directory.groupBy(email).agg(F.collect_list(F.struct("user_id", "display")).alias("_who"))
    return (asked.select(*keys, F.explode(some).alias(email)).join(known.hint("shuffle_hash"), on=email)
            .select(*keys, F.struct(F.col(email).alias("email"), "_who").alias("_hit")))


def _resolved(rows, known, name: str, email: str):
    """The entries of list ``name`` of all ``rows`` of a key with what is ``known`` of their
    addresses, by position; null if the list is null in one of the rows."""
    def entries(x, i):
        unknown = F.array(F.struct(F.lit(None).cast("string").alias("user_id"), F.lit(None).cast("string").alias("display")))
        return F.transform(F.coalesce(F.try_element_at(known, x), unknown), lambda who: F.struct(
            i.alias("_pos"), x.alias(email), who["user_id"].alias("user_id"), who["display"].alias("display")))

    every = F.flatten(F.transform(rows, lambda r: F.flatten(F.transform(F.coalesce(r[name], F.array().cast("array<string>")), entries))))
    return F.when(~F.exists(rows, lambda r: r[name].isNull()),
                  F.transform(F.array_sort(every), lambda s: s.dropFields("_pos")))


def lists_with_directory(df: DataFrame, key, lists: dict, directory: DataFrame, email="email") -> DataFrame:
    """ARR-4/ARR-5/ARR-6 support: look every element of several list columns up in
    a directory (email, user_id, display) and give back, per ``key``, each list
    as an array of structs (email, user_id, display) in its original order.

    The addresses of a row meet the directory by equality (``_hits``); the lists
    themselves are sent once, to their key, where the known addresses are put in; a
    key's work is bounded by its own lists. Unknown addresses keep null fields. A row
    whose lists are all null or empty stays: an empty list comes back empty, a null
    list (or one that could not be parsed) null."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = {name: F.col(c) if isinstance(c, str) else c for name, c in lists.items()}
    own = df.select(*keys, F.struct(*[c.alias(name) for name, c in cols.items()]).alias("_row"))
    every = F.concat(*[F.coalesce(F.col("_row")[name], F.array().cast("array<string>")) for name in cols])
    hits = _hits(own, keys, every, directory, email)
    back = (own.unionByName(hits, allowMissingColumns=True).repartition(*keys).groupBy(*keys)
            .agg(F.collect_list("_row").alias("_rows"), F.map_from_entries(F.collect_set("_hit")).alias("_known")))
    return back.select(*keys, *[_resolved(F.col("_rows"), F.col("_known"), name, email).alias(name) for name in cols])


def with_directory_lists(df: DataFrame, key: str, lists: dict, directory: DataFrame, asked: DataFrame, addresses,
                         email="email") -> DataFrame:
    """``df`` joined on ``key`` with its ``lists_with_directory``, in less traffic.

    The lists stay in their rows, so rows already dealt by ``key`` are not sent again.
    ``asked`` has the keys and the column ``addresses`` with every address of the lists: the
    table that the lists come from, before it was joined with others. Rows of one key
    share their lists; rows without a key go, as in the join."""
    back = (_hits(asked, [key], addresses, directory, email).repartition(key).groupBy(key)
            .agg(F.map_from_entries(F.collect_set("_hit")).alias("_known")))
    own = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in lists.items()])
    j = (df.filter(F.col(key).isNotNull()).join(back, on=key, how="left")
         .withColumn("_rows", F.collect_list(own).over(Window.partitionBy(key))))
    return j.select(*df.columns, *[_resolved(F.col("_rows"), F.col("_known"), name, email).alias(name) for name in lists])


def list_with_directory(df: DataFrame, key, list_col, directory: DataFrame, email="email", out="entries") -> DataFrame:
    """One list column: see ``lists_with_directory``."""
    return lists_with_directory(df, key, {out: list_col}, directory, email)


def user_structs(entries, with_email: bool = True):
    """ARR-5: entries -> array of (user_id, user_display_name[, email])."""
    def one(s):
        fields = [s["user_id"].alias("user_id"), s["display"].alias("user_display_name")]
        if with_email:
            fields.append(s["email"].alias("email"))
        return F.struct(*fields)
    return F.transform(entries, one)


def insert_ids(entries) -> "F.Column":
    """ARR-4: after each known address its id (unknown addresses stay alone)."""
    return F.flatten(F.transform(entries, lambda s: F.when(s["user_id"].isNull(), F.array(s["email"]))
                                 .otherwise(F.array(s["email"], s["user_id"]))))

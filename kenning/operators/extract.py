"""Entity extraction (NER-5..8): dictionary matches in text, longest
non-overlapping spans, addresses as entities.

Text is tokenized with one regular expression that also keeps the blank run in
front of each token, so a match's text is rebuilt exactly as written. The
n-grams of a document are built inside one array per document and exploded
as small structs; the token array itself is never copied per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.functions.arrays import label_mails
from kenning.functions.text import TOKEN_CORE, extract_mails
from kenning.operators.gazetteer import expand, match_keys
from kenning.operators.directory import complete_names
from kenning.session import ensure_checkpoint_dir

TOKEN_WS_PATTERN = r"([ \t\n\x0B\f\r]*)(" + TOKEN_CORE + ")"
VERSION_SUFFIX = r"^(.*[^0-9])[0-9]+$"


def _unversioned(token):
    """``name123`` -> ``name``; null when there is no version to strip."""
    return F.nullif(F.regexp_extract(token, VERSION_SUFFIX, 1), F.lit(""))


def _first_tokens(gx: DataFrame) -> DataFrame:
    """(first, versions): the tokens a phrase can start with; ``versions`` are those
    among them that become ``first`` when their version is stripped."""
    firsts = gx.select(F.lower(F.element_at("tokens", 1)).alias("first")).distinct()
    versions = (firsts.select(_unversioned(F.col("first")).alias("_name"), F.col("first").alias("_full"))
                .filter(F.col("_name").isNotNull() & (F.col("_name") != F.col("_full")))
                .groupBy(F.col("_name").alias("first")).agg(F.collect_set("_full").alias("versions")))
    return (firsts.join(versions, on="first", how="left")
            .select("first", F.coalesce("versions", F.array().cast("array<string>")).alias("versions")))


def _one_row_per_hit(keys: DataFrame) -> DataFrame:
    """Dictionary keys such that a text position meets each (category, canonical,
    priority) once, so the matches need no ``distinct``: spellings of one key share a
    row, and a plain key goes when the version key of the same term finds it anyway."""
    same = ["category", "canonical", "priority"]
    rows = (keys.groupBy("kind", "key", *same)
            .agg(F.bool_and("case_sensitive").alias("case_sensitive"), F.collect_set("exact").alias("exacts")))
    words = F.split("key", " ")
    name = (F.when(F.size(words) == 1, _unversioned(F.col("key")))
            .when((F.size(words) == 2) & F.try_element_at(words, F.lit(2)).rlike("^[0-9]+$"), words[0]))
    v = rows.filter("kind = 'v'")
    found = v.select(F.col("key").alias("_name"), *same)
    plain = rows.filter("kind = 'x'").withColumn("_name", name).join(found, on=["_name", *same], how="left_anti")
    return v.unionByName(plain.drop("_name"))


def ngrams(docs: DataFrame, id_col: str, text_col: str, max_n: int, firsts: DataFrame | None = None) -> DataFrame:
    """(id, start, n, exact, key, vkey, value) for every token n-gram, n <= max_n.

    ``key`` is the lower-cased tokens joined by blanks, ``value`` the text as
    written; ``vkey`` is the versioned-name key: a one-token n-gram ``name123``
    gives ``name``, a two-token ``name 123`` gives ``name``.

    The shifted token arrays are zipped once per document and exploded with
    their position; every n-gram is then plain column arithmetic (no lambda
    functions), so the whole stage stays in generated code."""
    t = F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_WS_PATTERN), 2)
    w = F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_WS_PATTERN), 1)
    d = docs.select(F.col(id_col), t.alias("_t"), w.alias("_w"))
    size = F.size("_t")
    shifted = []
    for k in range(1, max_n + 1):
        tk = F.col("_t") if k == 1 else F.slice("_t", k, size)
        wk = F.col("_w") if k == 1 else F.slice("_w", k, size)
        shifted += [tk.alias(f"t{k}"), wk.alias(f"w{k}")]
    z = (d.select(id_col, F.posexplode(F.arrays_zip(*shifted)).alias("_pos", "_z"))
         .select(id_col, "_pos", *[F.col(f"_z.{c}").alias(f"_{c}") for k in range(1, max_n + 1)
                                   for c in (f"t{k}", f"w{k}")]))
    if firsts is not None:
        # keep only positions whose token (or its version-stripped name) can
        # start a phrase: a map-side semi join with the dictionary's first tokens
        f = F.lower(F.col("_t1"))
        fv = _unversioned(f)
        keys = F.when(fv.isNull() | (fv == f), F.array(f)).otherwise(F.array(f, fv))
        z = (z.select("*", F.explode(keys).alias("first")).join(firsts, on="first")
             # a position that its full token lets in is not let in again by the stripped name
             .filter((F.col("first") == f) | ~F.array_contains("versions", f)).drop("first", "versions"))
    grams = []
    for n in range(1, max_n + 1):
        toks = [F.col(f"_t{k}") for k in range(1, n + 1)]
        exact = F.concat_ws(" ", *toks)
        value = F.concat(*[toks[0]] + [F.concat(F.col(f"_w{k}"), F.col(f"_t{k}")) for k in range(2, n + 1)])
        first = F.lower(toks[0])
        if n == 1:
            vkey = _unversioned(first)
        elif n == 2:
            vkey = F.when(toks[1].rlike("^[0-9]+$"), first)
        else:
            vkey = F.lit(None).cast("string")
        grams.append(F.when(toks[-1].isNotNull(), F.struct(
            F.lit(n).alias("n"), exact.alias("exact"), F.lower(exact).alias("key"), vkey.alias("vkey"),
            value.alias("value"))))
    return (z.select(id_col, (F.col("_pos") + 1).cast("bigint").alias("start"), F.explode(F.array(*grams)).alias("g"))
            .filter(F.col("g").isNotNull()).select(id_col, "start", "g.*"))


def repeat_matches(docs: DataFrame, rules: DataFrame, id_col: str, text_col: str, max_n: int, small: bool = False) -> DataFrame:
    """NER-4: matches of the expanded ``rules`` with ``runs``, the longest at each place.

    Equal neighbouring tokens of a text are collapsed into islands (token, start, how
    often), inside one array per document; phrases then meet n-grams of islands by
    equality of the collapsed tokens, as plain phrases meet plain n-grams. A word that may
    repeat takes its whole island if that is long enough; of the others the islands
    inside a match must have the exact length, and the outer two at least that, of which
    the nearest tokens count.

    ``small``: the rules are few enough to be sent to every task. The texts never are,
    whatever size the planner guesses for them, and a word that most texts hold then
    stays in the tasks that read it."""
    t = F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_WS_PATTERN), 2)
    w = F.regexp_extract_all(F.col(text_col), F.lit(TOKEN_WS_PATTERN), 1)
    d = (docs.select(F.col(id_col), t.alias("_t"), w.alias("_w"))
         .withColumn("_low", F.transform("_t", F.lower)))
    firsts = F.filter(F.sequence(F.lit(1), F.size("_t")),
                      lambda i: (i == 1) | (F.element_at("_low", i) != F.element_at("_low", F.greatest(i - 1, F.lit(1)))))
    # no filter on the tokens: it would be moved to the read, before the texts are spread
    d = d.withColumn("_at", F.when(F.size("_t") > 0, firsts).otherwise(F.array().cast("array<int>")))

    def island(i, k):
        run = F.coalesce(F.get("_at", k + 1), F.size("_t") + 1) - i
        return F.struct(F.element_at("_low", i).alias("tok"), i.alias("start"), run.alias("run"),
                        F.transform(F.sequence(i, i + run - 1), lambda j: F.struct(
                            F.element_at("_w", j).alias("w"), F.element_at("_t", j).alias("t"))).alias("parts"))

    d = d.select(id_col, F.transform("_at", island).alias("_is"))
    shifted = [(F.col("_is") if k == 0 else F.slice("_is", k + 1, F.size("_is"))).alias(f"i{k}") for k in range(max_n)]
    z = d.select(id_col, F.explode(F.arrays_zip(*shifted)).alias("_z"))
    keys = rules.select(F.array_join(F.transform("runs", lambda x: F.lower(x["tok"])), " ").alias("key"), F.col("runs").alias("want"),
                        "category", "canonical", "priority", "case_sensitive").distinct()
    starts = keys.select(F.lower(F.col("want")[0]["tok"]).alias("_first")).distinct()
    keys, starts = (F.broadcast(r) if small else r.hint("merge") for r in (keys, starts))
    z = z.join(starts, F.col("_z.i0.tok") == F.col("_first")).drop("_first")
    grams = []
    for n in range(1, max_n + 1):
        parts = [F.col(f"_z.i{k}") for k in range(n)]
        grams.append(F.when(parts[-1].isNotNull(), F.struct(
            F.concat_ws(" ", *[p["tok"] for p in parts]).alias("key"), F.array(*parts).alias("got"))))
    g = z.select(id_col, F.explode(F.array(*grams)).alias("g")).filter(F.col("g").isNotNull()).select(id_col, "g.*")
    j = g.join(keys, on="key")
    last = F.size("want") - 1
    pairs = F.zip_with("got", F.transform("want", lambda x, k: F.struct(
        x["tok"].alias("tok"), x["n"].alias("n"), x["several"].alias("several"),
        ((k == 0) | (k == last)).alias("outer"), (k == 0).alias("head"))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    fits = F.forall("_p", lambda p: F.when(p["b"]["several"] | p["b"]["outer"], p["a"]["run"] >= p["b"]["n"])
                    .otherwise(p["a"]["run"] == p["b"]["n"]))
    j = j.withColumn("_p", pairs).filter(fits)

    def used(p):
        n, run = p["b"]["n"], p["a"]["run"]
        whole = F.when(p["b"]["several"], run).otherwise(n)
        return F.transform(F.slice(p["a"]["parts"], F.when(p["b"]["head"], run - whole + 1).otherwise(F.lit(1)), whole),
                           lambda x: F.struct(x["w"].alias("w"), x["t"].alias("t"), p["b"]["tok"].alias("tok")))

    j = j.withColumn("_u", F.flatten(F.transform("_p", used)))
    head = F.col("_p")[0]
    start = head["a"]["start"] + F.when(head["b"]["several"], 0).otherwise(head["a"]["run"] - head["b"]["n"])
    ok = ~F.col("case_sensitive") | F.forall("_u", lambda x: x["t"] == x["tok"])
    value = F.array_join(F.transform("_u", lambda x, k: F.concat(F.when(k == 0, F.lit("")).otherwise(x["w"]), x["t"])), "")
    return (j.filter(ok).select(id_col, start.cast("bigint").alias("start"), F.size("_u").alias("n_tokens"), "category", "canonical",
                                "priority", value.alias("value")).distinct())


def match(docs: DataFrame, gazetteer: DataFrame, id_col="doc_id", text_col="text",
          broadcast_rows: int = 500_000) -> DataFrame:
    """NER-5 + NER-7: every dictionary match (overlaps included), each once.

    The expanded dictionary is broadcast when its row count is proven small
    (else it is joined by shuffle); the n-gram stream is never shuffled for
    the match itself. Rules with a word that may repeat go through ``repeat_matches``."""
    gx = expand(gazetteer)
    # one small job on the dictionary: the longest phrase and the row count
    # that bounds both join sides below (keys <= 2 rows per phrase, firsts <= 1)
    plain_rule = F.col("runs").isNull()
    stats = gx.agg(F.max(F.when(plain_rule, F.col("n_tokens"))).alias("n"), F.count(F.lit(1)).alias("rows"),
                   F.max(F.size("runs")).alias("runs"), F.count_if(plain_rule).alias("plain")).first()
    small = 2 * stats["rows"] <= broadcast_rows
    more = (repeat_matches(docs, gx.filter(F.col("runs").isNotNull()), id_col, text_col, stats["runs"], small)
            if stats["plain"] < stats["rows"] else None)
    if more is not None and not stats["plain"]:
        return more
    gx = gx.filter(plain_rule).drop("runs")
    max_n = stats["n"] or 1
    keys, firsts = _one_row_per_hit(match_keys(gx)), _first_tokens(gx)
    if small:
        keys, firsts = F.broadcast(keys), F.broadcast(firsts)
    g = ngrams(docs, id_col, text_col, max_n, firsts)
    plain = F.struct(F.lit("x").alias("kind"), F.col("key").alias("key"))
    ver = F.struct(F.lit("v").alias("kind"), F.col("vkey").alias("key"))
    probes = g.select(id_col, "start", "n", "exact", "value",
                      F.explode(F.when(F.col("vkey").isNull(), F.array(plain)).otherwise(F.array(plain, ver)))
                      .alias("p"))
    j = probes.join(keys, (F.col("p.kind") == F.col("kind")) & (F.col("p.key") == F.col("key")))
    ok = (~F.col("case_sensitive")) | F.array_contains("exacts", F.col("exact"))
    found = j.filter(ok).select(id_col, "start", F.col("n").alias("n_tokens"), "category", "canonical", "priority", "value")
    return found if more is None else found.unionByName(more)


def _choose_spans(batches):
    """The sweep of ``longest_spans`` over Arrow batches sorted by (id, start, longest
    first, priority, category): the rows that stay. Imports what it needs, so it travels
    to the executors by itself."""
    import numpy as np
    import pyarrow as pa

    def clusters(b, last_id=None, reach=None):
        """Which rows start a cluster (no earlier span of the document reaches over
        them), and how far the last document's spans reach."""
        start = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        end = start + b.column(2).to_numpy(zero_copy_only=False)
        code = b.column(0).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new_doc = np.concatenate(([reach is None or b.column(0)[0].as_py() != last_id], code[1:] != code[:-1]))
        far = max(int(end.max()), reach or 0) + 1
        shift = np.cumsum(new_doc) * far
        before = -1 if new_doc[0] else reach
        upto = np.maximum.accumulate(np.maximum(end + shift, before))
        return start + shift >= np.concatenate(([before], upto[:-1])), int(upto[-1] - shift[-1])

    def chosen(parts):
        t = pa.Table.from_batches(parts).combine_chunks()
        b = t.to_batches(max_chunksize=t.num_rows)[0]
        first = np.flatnonzero(clusters(b)[0])
        size = np.diff(np.append(first, b.num_rows))
        keep = np.zeros(b.num_rows, bool)
        keep[first[size == 1]] = True
        start, length = b.column(1).to_pylist(), b.column(2).to_pylist()
        for s, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
            taken = set()
            for i in sorted(range(s, s + n), key=lambda i: -length[i]):
                at, to = start[i], start[i] + length[i]
                # kept spans are at least as long, so one that overlaps holds an end of this one
                if at not in taken and to - 1 not in taken:
                    taken.update(range(at, to))
                    keep[i] = True
        return b.filter(pa.array(keep))

    held, last_id, reach = [], None, None
    for b in batches:
        if not b.num_rows:
            continue
        new, reach = clusters(b, last_id, reach)
        last_id = b.column(0)[b.num_rows - 1].as_py()
        last = int(np.flatnonzero(new)[-1]) if new.any() else None
        if last is None:
            held.append(b)
            continue
        ready = held + ([b.slice(0, last)] if last else [])
        held = [b.slice(last)]
        if ready:
            yield chosen(ready)
    if held:
        yield chosen(held)


def longest_spans(matches: DataFrame, id_col="doc_id", complete_in_row: bool = False) -> DataFrame:
    """NER-6: keep the longest matches that do not overlap, the earliest on a
    tie; one span found under two categories keeps the lower ``priority``.

    A document's matches are sorted by start and swept once (one shuffle by document).
    Where no span reaches over, a new cluster begins; a cluster of one span stays as it
    is, in others spans are taken longest first if both their ends are free. A choice
    depends on all choices before it, which no built-in function can carry from row to
    row, so the sweep is a small Arrow function; its work is linear in the matches and
    their tokens, its memory one Arrow batch or one cluster."""
    cols = [id_col, "start", "n_tokens", "category", "priority", "canonical", "value"]
    rows = (matches.select(*cols).repartition(id_col)
            .sortWithinPartitions(id_col, "start", F.desc("n_tokens"), "priority", "category", "canonical", "value"))
    spans = rows.mapInArrow(_choose_spans, rows.schema)
    if complete_in_row:
        # ARR-10 within each message over the kept spans of all categories: the
        # prefix/suffix-key equi-join grouped by message (linear in the text,
        # where comparing every span with every other would be quadratic).
        # The kept spans are read three times below, so they are materialized
        # once in the shared checkpoint folder instead of re-matching the text.
        ensure_checkpoint_dir(spans.sparkSession)
        spans = spans.checkpoint(eager=True)
        done = complete_names(spans.select(id_col, "value"), [id_col], "value", out="_done")
        spans = (spans.join(done, on=[id_col, "value"], how="left")
                 .withColumn("value", F.coalesce("_done", "value")).drop("_done"))
    return spans


def entities(docs: DataFrame, gazetteer: DataFrame, id_col="doc_id", text_col="text",
             complete_in_row: bool = False) -> DataFrame:
    """Dictionary entities of each document: longest non-overlapping spans."""
    return longest_spans(match(docs, gazetteer, id_col, text_col), id_col, complete_in_row)


def mail_entities(docs: DataFrame, id_col="doc_id", text_col="text", pattern=None, known: DataFrame | None = None,
                  address_col="address") -> DataFrame:
    """NER-8 (STR-11 + JN-3 + ARR-13): addresses in the text as EMAIL entities,
    kept only when they are known participants (left semi join) if ``known`` is given."""
    arr = extract_mails(F.col(text_col), pattern) if pattern else extract_mails(F.col(text_col))
    e = docs.select(id_col, F.explode(label_mails(arr)).alias("e")).select(id_col, "e.value", "e.category")
    if known is not None:
        e = e.join(known.select(F.col(address_col).alias("value")), on="value", how="left_semi")
    return e

"""Phrase dictionaries (NER-1..4).

The dictionary is an input table ``(category, phrase, canonical, case_sensitive,
versioned, priority)``. A phrase may hold alternatives and optional words:
``{a|b}`` is one of the words, a trailing ``?`` makes a word optional, ``{a}+`` and
``{a|b}+`` stand for one of the words once or more often in a row. Loading
expands every rule into plain phrases and tokenizes them with the same rule as
the text, so phrases and text compare as token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kenning.functions.text import TOKEN_PATTERN, ws_split

SCHEMA = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("phrase", T.StringType()),
    T.StructField("canonical", T.StringType()),
    T.StructField("case_sensitive", T.BooleanType()),
    T.StructField("versioned", T.BooleanType()),
    T.StructField("priority", T.IntegerType()),
])


def from_rows(spark: SparkSession, rows) -> DataFrame:
    """Dictionary from (category, phrase, canonical, case_sensitive, versioned, priority) tuples."""
    return spark.createDataFrame(list(rows), SCHEMA)


# Put behind a word that may come several times in a row; no text has it.
REPEAT = "\x01"


def _alternatives(word):
    """``{a|b}`` -> [a, b]; ``w?`` -> [w, '']; ``{a|b}+`` -> [a, b], each marked; ``w`` -> [w]."""
    several = word.startswith("{") & word.endswith("}+")
    one = _alternatives_of(F.when(several, F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word))
    return F.when(several, F.transform(one, lambda x: F.concat(x, F.lit(REPEAT)))).otherwise(one)


def _alternatives_of(word):
    opt = word.endswith(F.lit("?")) & (F.length(word) > 1)      # a lone "?" is a literal token
    core = F.when(opt, F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)
    alts = F.when(core.startswith("{") & core.endswith("}"),
                  F.split(F.substring(core, F.lit(2), F.length(core) - 2), r"\|")).otherwise(F.array(core))
    return F.when(opt, F.concat(alts, F.array(F.lit("")))).otherwise(alts)


def _word_tokens(tokens, several):
    return F.transform(tokens, lambda t: F.struct(t.alias("tok"), (several & (F.size(tokens) == 1)).alias("several")))


def _add_to_runs(runs, x):
    """Neighbouring equal tokens as one: how often at least, and whether more may come."""
    last = F.try_element_at(runs, F.lit(-1))
    same = F.lower(last["tok"]) == F.lower(x["tok"])
    more = F.struct(last["tok"].alias("tok"), (last["n"] + 1).alias("n"), (last["several"] | x["several"]).alias("several"))
    new = F.struct(x["tok"].alias("tok"), F.lit(1).alias("n"), x["several"].alias("several"))
    return F.when(F.coalesce(same, F.lit(False)), F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(more))).otherwise(
        F.concat(runs, F.array(new)))


def expand(gaz: DataFrame) -> DataFrame:
    """NER-4: one row per plain phrase, with its token array and the match key.

    ``key`` is the lower-cased tokens joined by blanks (capital letters in a
    lower-case rule would never match, so they are lowered at load); ``exact``
    keeps the case for case-sensitive rules; ``runs`` (tok, n, several) is set where a
    word may repeat. Empty rules are rejected."""
    words = F.transform(ws_split(F.col("phrase")), _alternatives)
    combos = F.aggregate(
        words, F.array(F.array().cast("array<string>")),
        lambda acc, alts: F.flatten(F.transform(acc, lambda a: F.transform(
            alts, lambda x: F.when(x == "", a).otherwise(F.concat(a, F.array(x)))))))
    e = gaz.select("*", F.explode(F.array_distinct(combos)).alias("_words"))
    # a marked word of one token may repeat; of several tokens none does
    toks = F.flatten(F.transform("_words", lambda w: _word_tokens(F.regexp_extract_all(
        F.replace(w, F.lit(REPEAT), F.lit("")), F.lit(TOKEN_PATTERN), F.lit(0)), F.endswith(w, F.lit(REPEAT)))))
    runs = F.aggregate("_toks", F.array().cast("array<struct<tok:string,n:int,several:boolean>>"), _add_to_runs)
    return (e.withColumn("_toks", toks)
            .withColumn("tokens", F.transform("_toks", lambda x: x["tok"]))
            .filter(F.size("tokens") > 0)
            .withColumn("runs", F.when(F.exists("_toks", lambda x: x["several"]), runs)).drop("_toks")
            .withColumn("n_tokens", F.size("tokens"))
            .withColumn("exact", F.array_join("tokens", " "))
            .withColumn("key", F.lower(F.col("exact")))
            .withColumn("canonical", F.coalesce(F.col("canonical"), F.lower(F.col("phrase"))))
            .withColumn("priority", F.coalesce(F.col("priority"), F.lit(100)))
            .withColumn("versioned", F.coalesce(F.col("versioned"), F.lit(False)))
            .withColumn("case_sensitive", F.coalesce(F.col("case_sensitive"), F.lit(False)))
            .drop("_words"))


def match_keys(gx: DataFrame) -> DataFrame:
    """Join side of the matcher: plain keys for every phrase, plus version keys
    (``kind`` = 'v') for one-word versioned names."""
    plain = gx.select(F.lit("x").alias("kind"), "key", "exact", "n_tokens", "category", "canonical",
                      "case_sensitive", "priority")
    ver = (gx.filter(F.col("versioned") & (F.col("n_tokens") == 1))
           .select(F.lit("v").alias("kind"), "key", "exact", "n_tokens", "category", "canonical",
                   F.lit(False).alias("case_sensitive"), "priority"))
    return plain.unionByName(ver).dropDuplicates(["kind", "key", "category", "case_sensitive", "exact"])

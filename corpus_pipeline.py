"""A training corpus from raw documents: five stages, each a dealt operator.

Quality classifier, exact dedup, SimHash near-dedup, substring dedup, packing. Every
stage is written as Parquet below ``spark.checkpoint.dir`` and read again, so each
works on all its predecessor kept and a lost executor repeats one stage at most; the
tables of a stage are deleted when the next one is written, so they do not pile up.

Defined results: null and empty texts are kept by the classifier if the model's bias
is positive, are one group for both dedups, and become the single id 0; an empty
table passes through; a very long text is held whole by one task at a time; extra columns of ``documents`` are carried to the last stage,
which returns pieces.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from kenning.llm import exact_dedup, packing, quality, simhash, substring  # noqa: E402
from kenning.llm.common import forget, known_tables, ready, scratch, table  # noqa: E402
from kenning.llm.queries import tokenizer_path  # noqa: E402


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject (score of at least 0.5)."""
    model = quality.train(docs, quality.not_held_out(table(ready(spark), sf_dir, "labels")))
    return quality.keep_quality(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    ready(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    ready(spark)
    return simhash.drop_near_duplicates(docs, width=3, max_bits=2)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    ready(spark)
    return substring.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    ready(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality_classifier", quality_filter), ("exact_dedup", exact), ("simhash_near_dedup", near),
          ("substring_dedup", passages), ("packing", pack)]

# Trained weights, fingerprints and token ids have no SQL form; the tests hold run()
# against a plain Python version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    last: set[str] = set()
    for name, stage in STAGES[:-1]:
        before = known_tables()
        out = stage(spark, docs, sf_dir)
        helpers = known_tables() - before
        docs = scratch(out, name)
        # the stage is written: what it read and made on the way is not needed any more
        forget(spark, helpers | last)
        last = known_tables() - before
    return STAGES[-1][1](spark, docs, sf_dir)

"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal.

Features of a text are its tokens (runs of letters and digits, runs of other
characters) and token pairs, hashed into 2^18 slots, weighted by log(1 + count)
and scaled to length one. Training uses at most ``TRAIN_ROWS`` labelled rows, those
with the smallest hash of their id (a documented bound; the rest of the labels is
not needed), by follow-the-regularised-leader updates in hash order. With more than
one of ``SHARDS`` the rows are split by hash and the models averaged: faster for a
larger bound, but at this one a single sequence of updates rejects more bad texts.
The model is at most 2^18 weights, the one thing that passes through the driver.
Scoring is a sparse dot product per text in the one pass that reads it.

Defined results: null, empty and blank texts have no features and get the bias
alone; without any label of both kinds the score is the share of label 1 (0.5
without labels); rows that repeat are each scored; null ids are scored; labels
that are null or not 0/1 are ignored; an empty table gives an empty result; other
columns are ignored or carried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import scratch, text_bytes

SLOTS = 1 << 18
TRAIN_ROWS = 8000
SHARDS = 1
EPOCHS = 5
ALPHA, BETA, L1, L2 = 5.0, 1.0, 0.01, 0.0
CACHE = 200_000
_TOKEN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff]+")


class _Words(dict):
    """Word -> hashes of its tokens, filled on demand."""

    def __missing__(self, word):
        import xxhash
        if len(self) > CACHE:
            self.clear()
        out = self[word] = tuple(xxhash.xxh3_64_intdigest(t) for t in _TOKEN.findall(word))
        return out


def features(text: bytes, words: dict) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of one text; slot 0 is left to the bias."""
    h = np.fromiter(chain.from_iterable(map(words.__getitem__, text.split())), np.uint64)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:]
    pairs ^= pairs >> np.uint64(31)
    slot = (np.concatenate((h, pairs)) >> np.uint64(7)) % np.uint64(SLOTS - 1) + np.uint64(1)
    slot, count = np.unique(slot.astype(np.int64), return_counts=True)
    value = np.log1p(count)
    return slot, value / np.sqrt(value @ value)


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS, np.float32))

    def score(self, text: bytes, words: dict) -> float:
        slot, value = features(text, words)
        z = float(self.weights[0]) + float(self.weights[slot].astype(np.float64) @ value)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def ftrl(rows, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from (label, slots, values) rows, one update each, in order. The bias
    is slot 0 and not regularised."""
    z, n = np.zeros(SLOTS), np.zeros(SLOTS)

    def weights(i):
        w = -np.where(np.abs(z[i]) <= L1, 0.0, z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(i == 0, -z[i] / ((BETA + np.sqrt(n[i])) / ALPHA), w)

    for _ in range(epochs):
        for y, slot, value in rows:
            i, x = np.concatenate(([0], slot)), np.concatenate(([1.0], value))
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(np.arange(SLOTS))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS, shards: int = SHARDS) -> Model:
    """A model from the labelled documents; ``labels`` (id, label) must already lack
    whatever is held out."""
    picked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
              .where("id is not null and y in (0, 1)").distinct()
              .withColumn("h", F.xxhash64("id")).orderBy("h", "id", "y").limit(rows))
    picked = scratch(picked, "train-ids")  # at most ``rows`` rows of three numbers
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(picked), "id")

    def featurize(batches):
        import pyarrow as pa
        words = _Words()
        for b in batches:
            xs = [features(t, words) for t in text_bytes(b.column(0))]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.array([x[0].astype(np.int32) for x in xs], pa.list_(pa.int32())),
                 pa.array([x[1].astype(np.float32) for x in xs], pa.list_(pa.float32()))], ["y", "h", "slot", "value"])

    rows_df = scratch(texts.select("t", "y", "h").mapInArrow(featurize, "y int, h bigint, slot array<int>, value array<float>"), "train")
    counts = {r.y: r.n for r in rows_df.groupBy("y").agg(F.count("*").alias("n")).collect()}
    model = Model()
    if len(counts) < 2:
        share = {frozenset(): 0.5, frozenset([0]): 0.02, frozenset([1]): 0.98}[frozenset(counts)]
        model.weights[0] = np.log(share / (1 - share))
        return model

    def fit(pdf):
        import pandas as pd
        pdf = pdf.sort_values(["h", "y"], kind="stable")
        w = ftrl([(y, np.asarray(s, np.int64), np.asarray(v, np.float64)) for y, s, v in zip(pdf.y, pdf.slot, pdf.value)])
        i = np.flatnonzero(w)
        return pd.DataFrame({"slot": i, "w": w[i]})

    shard = F.pmod(F.shiftright("h", 3), F.lit(shards)).alias("shard")
    fitted = rows_df.withColumn("shard", shard).groupBy("shard").applyInPandas(fit, "slot bigint, w double")
    used = rows_df.select(shard).distinct().count()
    for slot, w in fitted.groupBy("slot").agg(F.sum("w")).toLocalIterator():  # at most SLOTS rows
        model.weights[slot] = w / used
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))

    def run(batches):
        import pyarrow as pa
        words = _Words()
        for b in batches:
            s = [model.score(t, words) for t in text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["id", "score"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def keep_quality(df: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``df`` that score at least ``least``, all columns kept."""
    cols = df.columns
    names = ["c" + str(i) for i in range(len(cols))]
    flat = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(cols, names)])
    at = cols.index(text_col)

    def run(batches):
        import pyarrow as pa
        words = _Words()
        for b in batches:
            yield b.filter(pa.array([model.score(t, words) >= least for t in text_bytes(b.column(at))], pa.bool_()))

    return flat.mapInArrow(run, flat.schema).select(*[F.col(n).alias(c) for n, c in zip(names, cols)])


def not_held_out(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labels whose id may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return labels.where(F.crc32(F.col(id_col).cast("string")) % 3 != 1)

"""Quality scores by a factorisation machine.

Inputs of a text: its distinct words, hashed to buckets, and statistics of
its structure and size. The score adds a weight per input and, for every pair
of inputs, the product of two short factor vectors; the pairs are summed in linear
time, since sum_{i<j} <v_i, v_j> x_i x_j = ((sum v x)^2 - sum v^2 x^2) / 2 per factor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import byte_texts, slices, span_hashes, words_joined

FIT_ROWS = 8_000   # labelled rows that the machine is fitted on at most, chosen by hash
BUCKETS = 1 << 13  # hashed words
FACTORS = 8
_SETS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "stop": b".,;:?'\"()-",
         "mark": b"!#$%&*+/<=>@[\\]^_`{|}~", "line": b"\n"}
_CLASSES = np.array([[b in s for s in _SETS.values()] for b in range(256)], dtype=np.float64)
STRUCTURE = len(_SETS) + 9


def inputs(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(structure statistics, buckets of the distinct words)."""
    data, starts, ends = words_joined(text)
    n, raw = len(starts), np.frombuffer(text, dtype=np.uint8)
    shares = np.bincount(raw, minlength=256) @ _CLASSES / max(1, len(raw))
    if not n:
        return np.concatenate([shares, np.zeros(9)]), np.zeros(0, dtype=np.int64)
    lengths, hashes = ends - starts, span_hashes(data, starts, ends)
    distinct, counts = np.unique(hashes, return_counts=True)
    edge = np.frombuffer(data, dtype=np.uint8)[ends - 1]
    rest = [np.log1p(n), np.log1p(len(raw)), lengths.mean() / 10, lengths.std() / 10, len(distinct) / n, counts.max() / n,
            (hashes[1:] == hashes[:-1]).mean() if n > 1 else 0.0, (_CLASSES[edge, 4] > 0).mean(), (lengths == 1).mean()]
    return np.concatenate([shares, rest]), np.unique((distinct % np.uint64(BUCKETS)).astype(np.int64))


class Machine:
    """Weights of a fitted factorisation machine; inputs are the structure's statistics, then the buckets."""

    def __init__(self, mean, scale, bias, weights, factors) -> None:
        self.mean, self.scale, self.bias, self.weights, self.factors = mean, scale, bias, weights, factors

    def ragged(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input numbers, their values and where each row's begin."""
        numbers, values, starts = [], [], []
        at = 0
        for structure, buckets in rows:
            starts.append(at)
            at += STRUCTURE + len(buckets)
            numbers += [np.arange(STRUCTURE), buckets + STRUCTURE]
            values += [np.clip((structure - self.mean) / self.scale, -4, 4), np.full(len(buckets), 1 / np.sqrt(max(1, len(buckets))))]
        return np.concatenate(numbers), np.concatenate(values), np.array(starts)

    def raw(self, numbers, values, starts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vx = self.factors[numbers] * values[:, None]
        summed = np.add.reduceat(vx, starts, axis=0)
        pairs = (summed ** 2 - np.add.reduceat(vx ** 2, starts, axis=0)).sum(axis=1) / 2
        return self.bias + np.add.reduceat(self.weights[numbers] * values, starts) + pairs, vx, summed

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.ragged(rows))[0], -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = 10, batch: int = 64, step: float = 0.02, decay: float = 1e-4) -> Machine:
    """Logistic loss by Adam over the given (bounded) rows; the same rows give the same machine."""
    structure = np.stack([s for s, _ in rows])
    random = np.random.default_rng(8)
    size = STRUCTURE + BUCKETS
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    m = Machine(structure.mean(axis=0), structure.std(axis=0) + 1e-6, np.array([np.log(share / (1 - share))]), np.zeros(size), random.normal(0, 0.02, (size, FACTORS)))
    parts = (m.bias, m.weights, m.factors)
    first, second, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            numbers, values, starts = m.ragged([rows[i] for i in chosen])
            raw, vx, summed = m.raw(numbers, values, starts)
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[chosen]) / len(chosen)
            owner = np.repeat(np.arange(len(chosen)), np.diff([*starts, len(numbers)]))
            each = error[owner] * values
            gw = np.bincount(numbers, each, minlength=size)
            gv = np.zeros_like(m.factors)
            np.add.at(gv, numbers, each[:, None] * (summed[owner] - vx))
            t += 1
            for p, g, a, b in zip(parts, (np.array([error.sum()]), gw + decay * m.weights, gv + decay * m.factors), first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= step * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return m


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", learn=None) -> DataFrame:
    """Score every text: (id column, `score` from 0 to 1, `predicted`: 1 if score >= 0.5).

    Learns from the labels of rows where the condition `learn` holds (all, if None); the
    text alone enters the score. Null and empty texts are scored by their (empty) statistics.
    Null labels are ignored; of labels repeated for an id the largest holds. Without both labels,
    all rows score the share of label 1 (0 without any). Repeated rows are scored alike; other
    columns are not carried.
    """
    key = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    known = (labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
             .filter("__id is not null and __label in (0, 1)"))
    if learn is not None:
        known = known.filter(learn(F.col("__id")))
    known = known.groupBy("__id").agg(F.max("__label").alias("__label")).orderBy(F.xxhash64("__id", F.lit(8)), "__id").limit(FIT_ROWS)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__text"):
                found = [inputs(t) for t in byte_texts(batch.column("__text"))]
                yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__label"), pa.array([s for s, _ in found], pa.list_(pa.float64())), pa.array([b for _, b in found], pa.list_(pa.int32()))],
                                                 ["__id", "__label", "structure", "buckets"])

    # FIT_ROWS rows at most, so they can be broadcast and their inputs gathered.
    sample = texts.join(F.broadcast(known), "__id").mapInArrow(seen, f"__id {key}, __label int, structure array<double>, buckets array<int>").orderBy("__id").limit(FIT_ROWS).toArrow()
    label = sample["__label"].to_numpy().astype(np.float64)
    share = float(label.mean()) if len(label) else 0.0
    if not 0 < share < 1:
        return texts.select(F.col("__id").alias(id_col), F.lit(share).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"))
    machine = fit([(np.array(s), np.array(b, dtype=np.int64)) for s, b in zip(sample["structure"].to_pylist(), sample["buckets"].to_pylist())], label)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "__text", 1 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(shared.value.scores([inputs(t) for t in byte_texts(batch.column("__text"))]))], [id_col, "score"])

    return texts.mapInArrow(scored, f"`{id_col}` {key}, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

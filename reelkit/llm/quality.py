"""Operator 4, a quality classifier: a factorisation machine on hashed words and structure statistics."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelkit.llm.common import pieces

#: Slots of hashed words and metadata values; statistics have their own slots after these.
SLOTS = 1 << 16
FACTORS = 4
#: Labelled rows that the fit takes at most (those of the smallest hash of their id).
SAMPLE = 12_000
EDGES = np.array([0.0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8, 0.95])
BINS = len(EDGES) + 1
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SYMBOL = re.compile(r"[^\w\s.,'’()-]")
_DIGIT = re.compile(r"\d")


def statistics(text: str, words: list[str], distinct: int) -> list[float]:
    """Shares between 0 and 1, each of which becomes one feature by its bin."""
    n, chars = max(1, len(words)), max(1, len(text))
    capitals = len(_UPPER.findall(text))
    symbols = _SYMBOL.findall(text)
    runs = sum(map(str.__eq__, words[1:], words))
    lines = [x for x in text.split("\n") if x]
    return [min(1.0, np.log2(n + 1) / 16), capitals / chars, len(symbols) / chars, runs / n,
            1 - distinct / n, min(1.0, (chars - n) / n / 20), text.count("|") / n, len(_DIGIT.findall(text)) / chars,
            1 - len(set(lines)) / max(1, len(lines)), min(1.0, len(lines) / n),
            sum(map(text.count, ".,")) / n / 2, float(not words)]


N_STATISTICS = len(statistics("", [], 0))
WIDTH = SLOTS + N_STATISTICS * BINS


def features(text: str | None, metadata: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a whole text: its distinct words, evenly, with length 1 together, and a bin a statistic."""
    text = text or ""
    words = text.split()
    distinct = set(words)
    slots = np.fromiter((zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % SLOTS for w in distinct), np.int64, len(distinct))
    slots = np.unique(slots)
    bins = np.searchsorted(EDGES, statistics(text, words, len(distinct)), side="left")
    extra = [zlib.crc32(m.encode()) % SLOTS for m in metadata]
    all_slots = np.concatenate([slots, np.array(extra, np.int64), SLOTS + np.arange(N_STATISTICS) * BINS + bins])
    values = np.concatenate([np.full(len(slots), 1 / np.sqrt(max(1, len(slots)))), np.ones(len(extra) + N_STATISTICS)])
    return all_slots, values


@dataclass
class Machine:
    """score = sigmoid(bias + sum w x + half the sum over factors of (sum v x)^2 - sum (v x)^2): every pair of
    features interacts by the product of their factors, at a cost linear in the features."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        vx = self.factors[slots] * values[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        pairs = 0.5 * (sums ** 2 - np.add.reduceat(vx ** 2, starts, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.weights[slots] * values, starts) + pairs, sums

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        starts = np.cumsum([0] + [len(s) for s, _ in rows[:-1]])
        z, _ = self.raw(np.concatenate([s for s, _ in rows]), np.concatenate([v for _, v in rows]), starts)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8, batch: int = 128,
          rate: float = 0.1, decay: float = 1e-5, seed: int = 42) -> Machine:
    """Log loss by adaptive gradient steps (one rate a parameter) over seeded batches.  No rows: score one half."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(WIDTH), rng.normal(0, 0.02, (WIDTH, FACTORS)))
    if not rows:
        return Machine(0.0, m.weights, np.zeros_like(m.factors))
    share = np.clip(labels.mean(), 0.01, 0.99)
    m.bias = float(np.log(share / (1 - share)))
    g0, gw, gv = 1e-6, np.full(WIDTH, 1e-6), np.full((WIDTH, FACTORS), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            some = order[at:at + batch]
            slots = np.concatenate([rows[i][0] for i in some])
            values = np.concatenate([rows[i][1] for i in some])
            sizes = np.array([len(rows[i][0]) for i in some])
            z, sums = m.raw(slots, values, np.concatenate([[0], np.cumsum(sizes[:-1])]))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[some]) / len(some)
            each = np.repeat(err, sizes) * values
            used, where = np.unique(slots, return_inverse=True)
            dw = np.bincount(where, each) + decay * m.weights[used]
            dv = each[:, None] * (np.repeat(sums, sizes, axis=0) - m.factors[slots] * values[:, None])
            dv = np.stack([np.bincount(where, dv[:, f]) for f in range(FACTORS)], axis=1) + decay * m.factors[used]
            g0 += err.sum() ** 2
            gw[used] += dw ** 2
            gv[used] += dv ** 2
            m.bias -= rate * err.sum() / np.sqrt(g0)
            m.weights[used] -= rate * dw / np.sqrt(gw[used])
            m.factors[used] -= rate * dv / np.sqrt(gv[used])
    return m


def _values(batch: pa.RecordBatch, metadata: tuple[str, ...]):
    columns = [[f"{c}={v}" for v in batch.column(c).to_pylist()] for c in metadata]
    for i, t in enumerate(batch.column("text").to_pylist()):
        yield features(t, [c[i] for c in columns])


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from every fit: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", metadata: tuple[str, ...] = (),
        sample: int = SAMPLE) -> Machine:
    """A machine fitted on at most ``sample`` labelled rows, of those that are not held out.

    The rows of least id hash are taken, so the sample is the same whatever the
    partitions.  Their ids, bounded by ``sample``, are broadcast to the scan of
    ``docs``; only slot lists come back.  Null labels and ids are no labels; of
    several for an id the least counts, of several texts the first by content.
    """
    some = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("double").alias("__label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *metadata)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                found = list(_values(part, metadata))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("__label"), pa.array([s.astype("<i4").tobytes() for s, _ in found]),
                     pa.array([v.astype("<f4").tobytes() for _, v in found])], names=["doc_id", "label", "slots", "values"])

    got = (rows.join(F.broadcast(some), "doc_id")
               .mapInArrow(run, "doc_id long, label double, slots binary, values binary").toArrow().to_pylist())
    first = {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["slots"], r["values"])):
        first.setdefault(r["doc_id"], r)
    data = [(np.frombuffer(r["slots"], "<i4").astype(np.int64), np.frombuffer(r["values"], "<f4").astype(float)) for r in first.values()]
    return train(data, np.array([r["label"] for r in first.values()]))


def with_score(docs: DataFrame, machine: Machine, name: str = "score", metadata: tuple[str, ...] = ()) -> DataFrame:
    """All columns of ``docs`` and the score of every whole text, in the scan's tasks.  Null text: as empty."""
    if name in docs.columns:
        raise ValueError(f"docs has a column {name} already")
    model = docs.sparkSession.sparkContext.broadcast(machine)  # a few MB, whatever the data

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                scores = model.value.score(list(_values(part, metadata)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``: higher scores for label 1.

    Null, empty and blank texts are scored by their statistics.  Repeated ids
    and rows: a row each.  No labels, or none for these documents: score one
    half.  Empty table: no rows.  Other columns are not read.
    """
    machine = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_score(rows, machine).select("doc_id", held_out().alias("held_out"), "score",
                                            (F.col("score") >= threshold).cast("int").alias("predicted"))

"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters and digits, or runs of other visible characters, in lower case (A-Z). A token
equal to the one before it is replaced by a repeat mark, so that a text that says one word over and over
has features of its own. Features are tokens and pairs of neighbours, hashed to 2**bits slots; a value is
the slot's share of the text's features. The score is a sparse dot product through the logistic function.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+").findall
_REPEAT = np.uint64(0x9E3779B97F4A7C15)
_P1, _P2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Entries of the token cache of a worker; it is emptied when full.
CACHE = 200_000
#: A feature's share is multiplied by this, so that weights stay near one.
SCALE = 20.0


class _Hashes(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[token] = xxhash.xxh64_intdigest(token)
        return h


def features(text: bytes | None, bits: int, hashes: _Hashes) -> np.ndarray:
    """The slot of every token and pair of the whole text, repeats included."""
    tokens = _TOKEN(text.lower()) if text else []
    if not tokens:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    h[1:][h[1:] == h[:-1]] = _REPEAT
    pair = h[:-1] * _P1 + h[1:]
    pair ^= pair >> np.uint64(29)
    pair *= _P2
    return (np.concatenate([h * _P2, pair]) >> np.uint64(64 - bits)).astype(np.int64)


def margin(slots: np.ndarray, weights: np.ndarray, bias: float) -> float:
    return bias + (SCALE * float(weights[slots].sum()) / len(slots) if len(slots) else 0.0)


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + float(np.exp(-np.clip(x, -35, 35))))


class Ftrl:
    """FTRL-proximal with per-slot rates; the bias is slot -1 of the state."""

    def __init__(self, bits: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, slots: np.ndarray, y: int) -> None:
        at, counts = np.unique(slots, return_counts=True)
        at = np.append(at, len(self.z) - 1)
        x = np.append(SCALE * counts / max(len(slots), 1), 1.0)
        w = self.weights(at)
        g = (sigmoid(float(w @ x)) - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, bits: int = 18, max_rows: int = 20_000, epochs: int = 3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, float]:
    """Weights and bias from at most max_rows labelled rows, those with the smallest hash of the id.

    Features are made where the texts are; one task then learns from them in the order of that hash, as a
    stream over Arrow batches. Only the bounded sample of ids is broadcast, and only 2**bits weights come
    to the driver. Null labels and ids are passed over; several labels of one id count as their majority.
    Without labelled rows all weights are zero.
    """
    sample = labels.select(F.col(id_col).alias("k"), F.col(label_col).alias("y")).where("k is not null and y is not null").groupBy("k").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    sample = sample.withColumn("o", F.xxhash64("k")).orderBy("o", "k").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("binary").alias("t")).join(F.broadcast(sample), "k").select("o", "y", "t")

    def extract(batches):
        hashes = _Hashes()
        for b in batches:
            slots = [features(t.as_py(), bits, hashes) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.astype(np.int32).tobytes() for s in slots], pa.binary())], ["o", "y", "s"])

    def learn(batches):
        model, kept = Ftrl(bits), []
        for b in batches:
            for y, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                kept.append((np.frombuffer(s, np.int32), y))
                if len(kept) >= 2_000:
                    _learn(model, kept, epochs)
                    kept = []
        _learn(model, kept, epochs)
        w = model.weights(np.arange(len(model.z)))
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()], pa.binary())], ["w"])

    spark = docs.sparkSession
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    coded = common.materialise(rows.mapInArrow(extract, "o long, y int, s binary"), "features")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = coded.repartition(1).sortWithinPartitions("o", "y", "s").mapInArrow(learn, "w binary").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    common.discard(coded)
    w = np.frombuffer(got[0].w, np.float32) if got else np.zeros((1 << bits) + 1, np.float32)
    return w[:-1], float(w[-1])


def _learn(model: Ftrl, rows: list, epochs: int) -> None:
    for _ in range(epochs):
        for slots, y in rows:
            model.learn(slots, y)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1) of every row's whole text. Null and empty texts get the score of the bias alone."""
    weights, bias = model
    bits = int(len(weights)).bit_length() - 1
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("binary").alias("t"))
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # 2**bits numbers

    def run(batches):
        hashes, w = _Hashes(), sent.value
        for b in batches:
            s = [sigmoid(margin(features(t.as_py(), bits, hashes), w, bias)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["k", "score"])

    return rows.mapInArrow(run, f"k {rows.schema['k'].dataType.simpleString()}, score double").withColumnRenamed("k", id_col)

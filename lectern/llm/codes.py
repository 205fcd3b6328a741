"""Vector codes: each vector as short indexes into codebooks of its parts, learned in rounds and looked up by vantage-point trees.

Components are integers, floor(scale * x), and all distances, sums and means are exact. A codebook's entries stand in a
vantage-point tree, one for each part position. A search compares a part with a vantage point, and enters a side of it only if the
triangle inequality leaves room for an entry as near as the best so far. Distances are roots in floating point, so each radius
is rounded outward by one step and a side that could hold an equal entry is entered, too; what decides is always the squared
distance in integers, ties going to the lower index. A batch of parts goes through a tree together.

Rows without a vector, or with null or non-finite components, are dropped. Vectors that are shorter than the longest, or whose
length the parts don't divide, count as if zeros followed. Rows that repeat an id each count; a null id stands after
all others. With fewer vectors than entries, codebooks have as many entries as there are vectors. Errors beyond a long are
null, and so are sums with them. Other columns aren't read. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: Squares of differences of integers within this bound, summed over MOST components, fit in 64 bits.
SMALL, MOST = 1 << 24, 1 << 12
#: Sums travel in digits of this many bits, so that they can be added as longs at any size.
DIGIT = 40
#: Labels whose sums are sent to every task; beyond, they are joined by salted keys.
BROADCAST_LABELS, SALTS = 100_000, 64


def integers(vectors: pa.ListArray, size: int, scale: int) -> np.ndarray:
    """The vectors as rows of integers, of Python's own if they could overflow."""
    ends = vectors.offsets.to_numpy()
    lengths = np.diff(ends)
    x = np.zeros((len(vectors), size))
    at = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], lengths)
    x[np.repeat(np.arange(len(vectors)), lengths), at] = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    if size <= MOST and (not x.size or np.abs(x).max() < SMALL / scale):
        return np.floor(x * scale).astype(np.int64)
    return np.array([floor(Fraction(c) * scale) for c in x.ravel().tolist()], object).reshape(x.shape)


class Tree:
    """A vantage-point tree over the rows of entries; equal rows may be among them."""

    def __init__(self, entries: np.ndarray, at: list[int] | None = None):
        at = list(range(len(entries))) if at is None else at
        self.at, self.entry, rest = at[0], entries[at[0]], at[1:]
        self.sides: list[tuple[float, float, Tree]] = []
        if rest:
            low, high = _roots(((entries[rest] - self.entry) ** 2).sum(1))
            order = np.argsort(low, kind="stable")
            half = (len(rest) + 1) // 2
            for part in (order[:half], order[half:]):
                if len(part):
                    self.sides.append((low[part].min(), high[part].max(), Tree(entries, [rest[i] for i in part])))

    def search(self, parts: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> int:
        """Lowers best (squared distances) and index of the rows of parts; the number of distances taken."""
        d2 = ((parts[rows] - self.entry) ** 2).sum(1)
        nearer = (d2 < best[rows]) | ((d2 == best[rows]) & (self.at < index[rows]))
        best[rows[nearer]], index[rows[nearer]] = d2[nearer], self.at
        taken = len(rows)
        if not self.sides:
            return taken
        low, high = _roots(d2)
        bound = np.stack([np.nextafter(np.maximum(least - high, low - most), -np.inf) for least, most, _ in self.sides])
        inside = bound[0] <= bound[-1]
        for first in (True, False):  # the nearer side of each row, then what is left of the other
            for k, (_, _, side) in enumerate(self.sides):
                turn = (inside if k == 0 else ~inside) == first if len(self.sides) > 1 else np.full(len(rows), first)
                go = turn & (bound[k] <= _roots(best[rows])[1])
                if go.any():
                    taken += side.search(parts, rows[go], best, index)
        return taken


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the roots, one step of floating point outward; beyond 64 bits there are none, and all is searched."""
    if squares.dtype == object:
        return np.zeros(len(squares)), np.full(len(squares), np.inf)
    d = np.sqrt(squares.astype(np.float64))
    return np.nextafter(d, 0), np.nextafter(d, np.inf)


def nearest(parts: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each part's nearest entry."""
    whole = parts.dtype != object and tree.entry.dtype != object
    best = np.full(len(parts), np.iinfo(np.int64).max if whole else None, np.int64 if whole else object)
    if not whole:
        best[:] = ((parts - tree.entry) ** 2).sum(1)
    index = np.full(len(parts), np.iinfo(np.int64).max)
    tree.search(parts, np.arange(len(parts)), best, index)
    return index, best


def _split(x: np.ndarray, n_parts: int) -> list[np.ndarray]:
    return np.split(x, n_parts, axis=1)


def _digits(value: int):
    """(place, digit) pairs of an integer, whose sum of digit << DIGIT * place it is; the last one carries the sign."""
    place = 0
    while not -(1 << DIGIT) < value < 1 << DIGIT:
        yield place, value & ((1 << DIGIT) - 1)
        value, place = value >> DIGIT, place + 1
    yield place, value


def _book(entries: list[list[int]]) -> np.ndarray:
    small = all(abs(c) <= SMALL for e in entries for c in e)
    return np.array(entries, np.int64 if small and len(entries[0]) <= MOST else object).reshape(len(entries), len(entries[0]))


def _trees(books: list[list[list[int]]]) -> list[Tree]:
    return [Tree(_book(b)) for b in books]


def _sums(kept: DataFrame, books, size: int, n_parts: int, scale: int) -> dict[tuple[int, int, int], int]:
    """For (part, entry, position) the sum of the components assigned, and at position -1 their number: one row for
    each comes to the driver, whatever the number of vectors."""

    def run(batches):
        trees, sums = _trees(books), {}
        for b in batches:
            if not b.num_rows:
                continue
            for p, part in enumerate(_split(integers(b.column(0), size, scale), n_parts)):
                index, _ = nearest(part, trees[p])
                for e in np.unique(index):
                    of = part[index == e]
                    for i, s in enumerate([*of.sum(0).tolist(), len(of)]):
                        at = (p, int(e), i if i < part.shape[1] else -1)
                        sums[at] = sums.get(at, 0) + s
        out = [(*at, place, digit) for at, s in sums.items() for place, digit in _digits(s)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["p", "e", "i", "place", "digit"])

    rows = kept.select("v").mapInArrow(run, "p long, e long, i long, place long, digit long").groupBy("p", "e", "i", "place").agg(F.sum("digit").alias("digit"))
    out: dict[tuple[int, int, int], int] = {}
    for r in rows.collect():
        out[r.p, r.e, r.i] = out.get((r.p, r.e, r.i), 0) + (r.digit << DIGIT * r.place)
    return out


def learn(kept: DataFrame, size: int, n_parts: int = 8, n_entries: int = 16, rounds: int = 6, scale: int = 4096) -> list[list[list[int]]]:
    """The codebooks after some rounds, from the parts of the vectors of the smallest ids on."""
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(n_entries).select("v").collect()
    books = [part.tolist() for part in _split(integers(pa.array([r.v for r in first], pa.list_(pa.float64())), size, scale), n_parts)]
    for _ in range(rounds):
        sums = _sums(kept, books, size, n_parts, scale)
        books = [[[sums[p, e, i] // n for i in range(len(entry))] if (n := sums.get((p, e, -1), 0)) else entry for e, entry in enumerate(book)] for p, book in enumerate(books)]
    return books


def with_label_sums(coded: DataFrame, label: str = "label", error: str = "error") -> DataFrame:
    """coded, a written table, with label_error: error summed over rows of an equal label, nulls together. A label may have any part of the rows."""
    sums = coded.groupBy(F.col(label).alias("_l")).agg(F.when(F.count(F.lit(1)) == F.count(error), F.try_sum(error)).alias("label_error"))
    sums = materialise(sums, "labels")
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), F.col(label).eqNullSafe(F.col("_l"))).drop("_l")
    salted = coded.withColumn("_s", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)))
    many = sums.withColumn("_t", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(many, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_s") == F.col("_t"))).drop("_l", "_s", "_t")


def encode(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", n_parts: int = 8, n_entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, list[list[list[int]]]]:
    """(id, label, code, error, label_error), and the codebooks by part, entry and position. A code has two hexadecimal
    digits for each part, so at most 256 entries."""
    if not 0 < n_entries <= 256:
        raise ValueError("a code's part has two hexadecimal digits: from 1 to 256 entries")
    v = F.col(vector_col).cast("array<double>")
    kept = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v.alias("v"))
    kept = materialise(kept.where(F.expr("v is not null and forall(v, x -> x is not null and abs(x) < double('infinity'))")), "vectors")
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    size = -(-(longest or 0) // n_parts) * n_parts
    books = learn(kept, size, n_parts, n_entries, rounds, scale) if longest is not None else [[] for _ in range(n_parts)]
    types = {f.name: f.dataType for f in kept.schema}
    schema = f"id {types['id'].simpleString()}, label {types['label'].simpleString()}, code string, error long"

    def run(batches):
        trees = _trees(books) if books[0] else []
        for b in batches:
            if not b.num_rows:
                continue
            codes, error = [], 0
            for part, tree in zip(_split(integers(b.column(2), size, scale), n_parts), trees, strict=True):
                index, d2 = nearest(part, tree)
                codes.append(index)
                error = error + d2
            code = [bytes(c).hex() for c in np.stack(codes, 1).astype(np.uint8)]
            fits = [e if e < 1 << 63 else None for e in error.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code, pa.string()), pa.array(fits, pa.int64())], ["id", "label", "code", "error"])

    coded = materialise(kept.mapInArrow(run, schema), "codes")
    discard(kept)
    return with_label_sums(coded), books


def digest(books: list[list[list[int]]]) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()

"""Many patterns in many texts: an automaton for each key's patterns, run once over each of the key's texts.

patterns(key, pattern, value) become one automaton a key: a trie with failure links, expanded to a table of steps. Texts aren't
joined with patterns. Texts and automata of a key are dealt together and sorted, automata first, so that a task meets each automaton
once and streams the key's texts past it. A key's texts are split into blocks of rows, for which its automaton is sent
along, so that a key with most of the texts runs spread. All texts of a batch step through the table side by side.

Null keys, texts and patterns match nothing, an empty pattern neither. Of a pattern that a key has twice the least value is kept.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts of a key in one block, and characters that step side by side.
BLOCK, CHARACTERS = 2_000, 1 << 22
FOUND = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("pattern", T.StringType()), T.StructField("value", T.StringType())]))


class Automaton:
    """alphabet: code points that patterns hold, rising; step[state, 1 + place in the alphabet] (0: any other code point);
    own[state]: the pattern that ends there or -1; next_[state]: the longest shorter state where one ends, or 0."""

    def __init__(self, alphabet: np.ndarray, step: np.ndarray, own: np.ndarray, next_: np.ndarray):
        self.alphabet, self.step, self.own, self.next_ = alphabet, step, own, next_
        self.ends = (own >= 0) | (next_ > 0)

    @classmethod
    def of(cls, patterns: list[str]) -> Automaton:
        alphabet = np.array(sorted({ord(c) for p in patterns for c in p}), np.int32)
        place = {int(c): i + 1 for i, c in enumerate(alphabet)}
        children: list[dict[int, int]] = [{}]
        own = [-1]
        for n, p in enumerate(patterns):
            at = 0
            for c in p:
                down = children[at].setdefault(place[ord(c)], len(children))
                if down == len(children):
                    children.append({})
                    own.append(-1)
                at = down
            own[at] = n
        step = np.zeros((len(children), len(alphabet) + 1), np.int32)
        fail, next_ = np.zeros(len(children), np.int32), np.zeros(len(children), np.int32)
        todo = deque([0])
        while todo:  # breadth first: a state's failure state has its row before it
            at = todo.popleft()
            step[at] = step[fail[at]] if at else 0
            for c, down in children[at].items():
                fail[down] = step[at, c] if at else 0
                next_[down] = fail[down] if own[fail[down]] >= 0 else next_[fail[down]]
                step[at, c] = down
                todo.append(down)
        return cls(alphabet, step, np.array(own, np.int32), next_)

    def dump(self) -> bytes:
        whole = np.concatenate([np.array([len(self.alphabet), len(self.own)], np.int32), self.alphabet, self.own, self.next_, self.step.ravel()])
        return zlib.compress(whole.tobytes(), 1)  # most steps lead back to few states; a batch holds many automata

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        a = np.frombuffer(zlib.decompress(data), np.int32)
        m, n = int(a[0]), int(a[1])
        return cls(a[2 : 2 + m], a[2 + m + 2 * n :].reshape(n, m + 1), a[2 + m : 2 + m + n], a[2 + m + n : 2 + m + 2 * n])

    def scan(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Of each text (last, pattern) of every occurrence, by last, then from the longest pattern down."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        found: list[list[tuple[int, int]]] = [[] for _ in texts]
        lo = 0
        while lo < len(order) and texts[order[lo]]:
            hi = max(lo + 1, min(len(order), lo + CHARACTERS // len(texts[order[lo]])))
            self._side_by_side(texts, order[lo:hi], found)
            lo = hi
        return found

    def _side_by_side(self, texts: list[str], rows: list[int], found: list) -> None:
        length = np.array([len(texts[i]) for i in rows])
        flat = np.frombuffer("".join(texts[i] for i in rows).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        at = np.minimum(np.searchsorted(self.alphabet, flat), len(self.alphabet) - 1)
        codes = np.where(self.alphabet[at] == flat, at + 1, 0)
        start = np.concatenate([[0], np.cumsum(length)[:-1]])
        state = np.zeros(len(rows), np.int32)
        live = len(rows)
        for i in range(int(length[0])):
            while length[live - 1] <= i:
                live -= 1
            state[:live] = self.step[state[:live], codes[start[:live] + i]]
            for k in np.flatnonzero(self.ends[state[:live]]):
                s = int(state[k])
                while s:
                    if self.own[s] >= 0:
                        found[rows[k]].append((i + 1, int(self.own[s])))
                    s = int(self.next_[s])


def automata(patterns: DataFrame, key: str) -> DataFrame:
    """key, automaton, names, values: one row for each key, made where its patterns are."""
    rows = patterns.where(F.col(key).isNotNull() & (F.col("pattern") != "")).groupBy(key, "pattern").agg(F.min("value").alias("value"))
    kind = rows.schema[key].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, ps in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                names = [p["pattern"] for p in ps]
                yield pa.RecordBatch.from_arrays([pa.array([k], b.column(0).type), pa.array([Automaton.of(names).dump()], pa.binary()), pa.array([names], pa.list_(pa.string())), pa.array([[p["value"] for p in ps]], pa.list_(pa.string()))], [key, "automaton", "names", "values"])

    grouped = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pattern", "value"))).alias("p"))
    return grouped.mapInArrow(build, f"{key} {kind}, automaton binary, names array<string>, values array<string>")


def occurrences(texts: DataFrame, patterns: DataFrame, key: str, order: str, text: str = "text", extent: DataFrame | None = None) -> DataFrame:
    """The rows of texts that hold a pattern of their key, with found: every occurrence (first, last, pattern, value), by
    first and then by last. order: a whole number that numbers a key's rows, more or less evenly. extent: a table with at least the keys and
    orders of texts, if there is one that is cheaper to read."""
    machines = automata(patterns, key)
    block = F.floor(F.col(order) / BLOCK).cast("long")
    own = texts.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    blocks = (own if extent is None else extent.where(F.col(key).isNotNull())).select(key, F.coalesce(block, F.lit(0).cast("long")).alias("_block")).distinct()
    columns = texts.columns
    row = F.struct(*columns)
    held = own.select(F.col(key).alias("_key"), F.coalesce(block, F.lit(0).cast("long")).alias("_block"), F.lit(1).alias("_kind"), row.alias("_row"), F.col(text).alias("_text"), *[F.lit(None).cast(t).alias(c) for c, t in (("automaton", "binary"), ("names", "array<string>"), ("values", "array<string>"))])
    sent = blocks.join(machines, key).select(F.col(key).alias("_key"), "_block", F.lit(0).alias("_kind"), F.lit(None).cast(held.schema["_row"].dataType).alias("_row"), F.lit(None).cast("string").alias("_text"), "automaton", "names", "values")
    both = sent.unionByName(held).repartition("_key", "_block").sortWithinPartitions("_key", "_block", "_kind")
    out = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("pattern", pa.string()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, machine, names, values = None, None, [], []
        for b in batches:
            where = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
            for (k, block_, kind), group in groupby(range(b.num_rows), lambda i: where[i]):
                rows = list(group)
                if not kind:
                    at, machine = (k, block_), Automaton.load(b.column(5)[rows[0]].as_py())
                    names, values = b.column(6)[rows[0]].as_py(), b.column(7)[rows[0]].as_py()
                elif at == (k, block_):
                    part = b.slice(rows[0], len(rows))
                    hits = machine.scan(part.column(4).to_pylist())
                    keep = [i for i, h in enumerate(hits) if h]
                    if keep:
                        spans = [sorted(({"first": z - len(names[p]), "last": z, "pattern": names[p], "value": values[p]} for z, p in hits[i]), key=lambda s: (s["first"], s["last"])) for i in keep]
                        yield pa.RecordBatch.from_arrays([part.column(3).take(pa.array(keep)), pa.array(spans, out)], ["_row", "found"])

    schema = T.StructType([held.schema["_row"], T.StructField("found", FOUND)])
    return both.mapInArrow(run, schema).select("_row.*", "found")

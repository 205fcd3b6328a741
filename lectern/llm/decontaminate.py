"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Symbols are words. Patterns are the windows of the benchmark items; those of one length share a table
that maps a block of three words to the distance by which the search may move on. A block that no
pattern holds moves it by all but two words of the pattern length. At distance zero the suffix block
selects a bucket of patterns, and each is compared word by word.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Lower-cases A-Z; turns every ASCII byte that is no digit or letter into a space; other bytes stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BLOCK = 3
SCHEMA = "n_words long, spans array<struct<first:long,last:long>>, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class WuManber:
    """Patterns of one length in words: shift table, suffix buckets, search."""

    def __init__(self, length: int):
        self.m, self.b = length, min(BLOCK, length)
        self.far = length - self.b + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, dict[tuple, set]] = {}

    def add(self, pattern: list[bytes], item) -> None:
        for end in range(self.b, self.m + 1):
            block = b" ".join(pattern[end - self.b : end])
            self.shift[block] = min(self.shift.get(block, self.far), self.m - end)
        self.bucket.setdefault(b" ".join(pattern[-self.b :]), {}).setdefault(tuple(pattern), set()).add(item)

    def search(self, words: list[bytes]):
        """Yields (first word, items) of each occurrence."""
        m, b, far, shift, bucket, n, end = self.m, self.b, self.far, self.shift.get, self.bucket, len(words), self.m
        join = b" ".join
        while end <= n:
            block = join(words[end - b : end])
            step = shift(block, far)
            if step:
                end += step
                continue
            items = bucket[block].get(tuple(words[end - m : end]))
            if items:
                yield end - m, items
            end += 1


def build(items: list[tuple], window: int) -> list[WuManber]:
    """Tables by pattern length; an item with fewer words than a window is one pattern."""
    tables: dict[int, WuManber] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            tables.setdefault(size, WuManber(size)).add(words[i : i + size], item)
    return list(tables.values())


def scan(words: list[bytes], tables: list[WuManber]) -> tuple[list[tuple[int, int]], set]:
    """Merged spans of hit words (last exclusive), and the items that occur."""
    found, items = [], set()
    for t in tables:
        for first, which in t.search(words):
            items |= which
            found.append((first, first + t.m))
    spans: list[tuple[int, int]] = []
    for a, z in sorted(found):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(z, spans[-1][1]))
        else:
            spans.append((a, z))
    return spans, items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """The number of blocks, and the benchmark in blocks of about block_bytes of text, one at a time on the driver."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("binary").alias("t")).where("t is not null")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // block_bytes) or 1

    def each():
        for k in range(n):
            part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
            yield [(r.i if r.i is not None else "null", bytes(r.t)) for r in part.collect()]

    return n, each()


#: The tables of the block that this worker process searched last.
_tables: dict[str, list[WuManber]] = {}


def tables_of(name: str, sent, window: int) -> list[WuManber]:
    """The tables of a broadcast block: built once for a worker, not for each task."""
    if name not in _tables:
        _tables.clear()
        _tables[name] = build(sent.value, window)
    return _tables[name]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 8 << 20) -> DataFrame:
    """Per document: the id, n_words, spans of hit words (first, last exclusive, merged) and the items found.

    The benchmark goes to the executors in blocks of about block_bytes; a larger benchmark takes one
    pass over the documents for each block, so that memory is bounded by a block (and the longest item) and all items
    are searched.
    Null or empty text: no words, no spans. A null item id is named "null"; items without words match
    nothing. Repeated rows give repeated results. Other columns of either table are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("binary").alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    n, blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)

    def search(items: list[tuple]):
        sent = spark.sparkContext.broadcast(items)
        name = uuid.uuid4().hex

        def run(batches):
            tables = tables_of(name, sent, window)
            for b in batches:
                n, spans, names = [], [], []
                for t in b.column(1):
                    w = words_of(t.as_py())
                    s, i = scan(w, tables)
                    n.append(len(w))
                    spans.append([{"first": x, "last": y} for x, y in s])
                    names.append(sorted(i))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), pa.array(names, pa.list_(pa.string()))],
                    ["k", "n_words", "spans", "items"],
                )

        return sent, run

    if n == 1:
        out = rows.mapInArrow(search(next(blocks))[1], f"k {kind}, {SCHEMA}")
    else:
        out = _merged(rows, map(search, blocks))
    return out.withColumnRenamed("k", id_col)


def _merged(rows: DataFrame, searches) -> DataFrame:
    """Several passes, each written before the next block is read, so that one block is in memory at a time; put together
    by document. Rows with one id and text share a result and keep their number."""
    tagged = rows.select(F.struct("k", F.sha2("t", 256).alias("h")).alias("key"), "t").withColumn("k", F.to_json("key"))
    plain = rows.select("k", F.to_json(F.struct("k", F.sha2("t", 256).alias("h"))).alias("j"))
    part = None
    for sent, run in searches:
        p = common.materialise(tagged.select("k", "t").mapInArrow(run, f"k string, {SCHEMA}").dropDuplicates(["k"]), "hits")
        sent.destroy()
        part = p if part is None else part.unionByName(p)
    both = part.groupBy(F.col("k").alias("j")).agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    empty = F.expr("cast(array() as array<struct<first:bigint,last:bigint>>)")
    step = lambda acc, x: F.when(
        (F.size(acc) > 0) & (x["first"] <= F.element_at(acc, F.greatest(F.size(acc), F.lit(1)))["last"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, F.greatest(F.size(acc), F.lit(1)))["first"].alias("first"), F.greatest(F.element_at(acc, F.greatest(F.size(acc), F.lit(1)))["last"], x["last"]).alias("last")))),
    ).otherwise(F.concat(acc, F.array(x)))
    both = both.select("j", "n_words", F.aggregate("s", empty, step).alias("spans"), "items")
    return plain.join(both, "j").select("k", "n_words", "spans", "items")

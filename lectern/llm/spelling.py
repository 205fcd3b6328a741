"""Spelling variants: words one edit apart, found by bands of letter-parity masks.

A word's mask has one bit for each letter, set if the letter stands in the word an odd number of times. One inserted,
deleted or replaced code point flips one bit or two, so of three bands of the mask at least one stays equal (at least one of
the first two, if one bit flips). Letters are dealt to the bands by how evenly their bit falls over all words, so that the
bands tell as much as each other. A few letters carry a band, so a band alone is shared by ever more words as a corpus grows; keys
therefore hold, beside band and length, the half of the word that the edit left alone. What shares a key is compared by masks
and then by edit distance; a pair is taken at its first common key alone.

Texts that are null or empty have no words; a null id counts as an empty one; repeated rows count again. Empty
tables give empty tables. Other columns of docs aren't read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Texts of more characters are read run by run, not as one list of runs.
LONG = 1 << 22
#: Words counted in a task before they are handed on.
HELD = 200_000
#: Bits of a band; three bands take the 90 letters of the words.
BAND_BITS = 30


def with_typo(key: str, run: str, every: int) -> str:
    """run without one code point if every divides the checksum of key:run, at the place the checksum names."""
    h = zlib.crc32(f"{key}:{run}".encode())
    at = h % len(run)
    return run if h % every else run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 7, min_count: int = 2, typo_every: int | None = None) -> DataFrame:
    """word, n: runs of letters of whole texts with A-Z in lower case, of min_length code points and min_count
    occurrences or more. With typo_every, every so-manieth pair of document and run loses a letter before it is counted."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("k"), F.col(text_col).alias("t")).where("t is not null")

    def batch(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for b in batches:
            for k, t in zip(b.column(0), b.column(1), strict=True):
                key, text = k.as_py(), t.as_py()
                found = Counter(_RUNS.findall(text) if len(text) < LONG else (m[0] for m in _RUNS.finditer(text)))
                for word, n in found.items():
                    if len(word) < min_length:
                        continue
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    if typo_every:
                        word = with_typo(key, word, typo_every)
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) >= HELD:
                    yield batch(held)
                    held = Counter()
        if held:
            yield batch(held)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def deal_letters(words: DataFrame) -> dict[str, int]:
    """The mask bit of each letter, as an integer of three bands: letters by falling evenness of their parity over all
    words, each to the band that has had the least of it so far. One row for each letter comes to the driver."""

    def odd(batches):
        total, found = 0, Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                total += 1
                found.update(c for c, n in Counter(w).items() if n & 1)
        found[""] = total
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["c", "n"])

    odds = {r.c: r.n for r in words.select("word").mapInArrow(odd, "c string, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()}
    total = odds.pop("", 0)
    letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
    even = {c: min(odds.get(c, 0), total - odds.get(c, 0)) for c in letters}
    load, dealt, bits = [0, 0, 0], [0, 0, 0], {}
    for c in sorted(letters, key=lambda c: (-even[c], c)):
        band = min((b for b in range(3) if dealt[b] < BAND_BITS), key=lambda b: (load[b], dealt[b]))
        bits[c] = 1 << (band * BAND_BITS + dealt[band])
        load[band] += even[c]
        dealt[band] += 1
    return bits


def bands(word: str, bits: dict[str, int]) -> tuple[int, int, int]:
    mask, low = 0, (1 << BAND_BITS) - 1
    for c in word:
        mask ^= bits[c]
    return mask & low, mask >> BAND_BITS & low, mask >> 2 * BAND_BITS


def keys(word: str, own: tuple[int, int, int]) -> Iterator[tuple[int, bool, int]]:
    """(key, longer, place): under which keys the word meets words of its own length and longer ones, and, as the longer
    one, words that are one code point shorter. place is 3 * side + band."""
    for longer in (False, True):
        short = len(word) - longer
        cut = short // 2
        for side, half in enumerate((word[:cut], word[cut + longer :])):
            for band in range(2 if longer else 3):
                key = xxhash.xxh64_intdigest(f"{short} {side} {band} {own[band]} {half}")
                yield key - (1 << 64) if key >> 63 else key, longer, 3 * side + band


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: each two of the distinct words that differ by one inserted, deleted or replaced code point, once."""
    bits = deal_letters(words)

    def deal(batches):
        for b in batches:
            out = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = bands(word, bits)
                out += [(key, longer, place, word, n, *own) for key, longer, place in keys(word, own)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["key", "longer", "place", "word", "n", "m0", "m1", "m2"])

    rows = words.select("word", "n").mapInArrow(deal, "key long, longer boolean, place long, word string, n long, m0 long, m1 long, m2 long")
    x, y = rows.where("not longer").alias("x"), rows.alias("y")
    flips = F.bit_count(F.expr("x.m0 ^ y.m0")) + F.bit_count(F.expr("x.m1 ^ y.m1")) + F.bit_count(F.expr("x.m2 ^ y.m2"))
    first: Column = F.expr("""(x.place % 3 < 1 or x.m0 <> y.m0) and (x.place % 3 < 2 or x.m1 <> y.m1)
        and (x.place < 3 or left(x.word, length(x.word) div 2) <> left(y.word, length(x.word) div 2))""")
    meet = F.expr("x.key = y.key and x.place = y.place and length(y.word) = length(x.word) + int(y.longer) and (y.longer or x.word < y.word)")
    found = x.join(y, meet & (flips <= 2) & first & (F.levenshtein("x.word", "y.word", 1) == 1))
    return found.selectExpr("x.word as a", "x.n as a_n", "y.word as b", "y.n as b_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form) rows whose forms lead on to others without a circle: the last of each chain, by doubled steps."""
    now = materialise(forms.selectExpr("word", "form as root"), "roots")
    while True:
        on = now.alias("a").join(now.alias("b"), F.expr("a.root = b.word"), "left")
        new = materialise(on.selectExpr("a.word as word", "coalesce(b.root, a.root) as root", "b.root is not null as moved"), "roots")
        moved = not new.where("moved").isEmpty()
        discard(now)
        now = new
        if not moved:
            return now.drop("moved")


def group_variants(words: DataFrame, lead: int = 10) -> DataFrame:
    """word, n, n_near, form, form_n, root for distinct words (word, n).

    n_near counts the words one edit away. form is the most frequent of these (of equal ones the smallest in code-point order) if it is at
    least lead times as frequent as the word; root follows forms to the last, and is the word itself without a form.
    """
    if lead < 2:
        raise ValueError("lead must be 2 or more, so that forms make no circle")
    words = materialise(words.select("word", "n"), "words")
    both = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("m"))))
    best = near_pairs(words).select(both.alias("p")).select("p.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("best"))
    takes = F.expr(f"-best.m >= {lead} * n")
    rows = materialise(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.m")).alias("form_n")), "near")
    discard(words)
    return rows.join(roots(rows.where("form is not null")), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

A document's set holds its distinct 5-word shingles as 64-bit hashes. Documents with equal sets are one
vertex, named by the 128-bit digest of the set; vertices that may have others like them are numbered. Shingles have a global order, rare before frequent. If two sets overlap enough, their prefixes of
n - ceil(t n) + l shingles share at least l; each document takes the l with the least estimated candidate
cost, and a pair needs min(l) shared shingles in the prefixes of that l before its sets are compared.

links() gives every link. near_duplicates() needs them for components only, so there a shingle's list of documents is not expanded into all pairs: its
first document is compared with the others (short lists in full), lists whose documents are in one component are done, and the
rest goes on with more first documents, until no list holds two components that are not compared. The longest lists are
compared with their centers where their rows lie, so that no task holds such a list.
Lists with one first document go on as one list, in which a document stands once, however many shingles it shares. What its
rows share with the first document is found once, exactly. Two of them have in common at most what both
hold of it, and the lesser of what else they hold that others may have; pairs that this bound rules out are not made.
A document whose shingles that others may have are too few for a link has no list.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHINGLE = 5
#: Words that a worker keeps the hashes of; the first ones stay, for frequent words come early.
CACHE = 300_000
#: The sketch that orders shingles: bits of shingles found in two documents or more, and the most frequent
#: shingles with their counts. Its size is fixed; if it is full, more shingles are treated as frequent or
#: as shared than need be, which costs time but loses nothing.
SHARED_BITS, FREQUENT, LEAST_FREQUENT = 1 << 27, 1 << 20, 8
MAX_MATCHES = 6
TOKENS_PER_BUCKET = 1 << 21
#: Shingles that a task sorts at once.
HELD = 2_000_000
#: Bytes of a word and the space after it, for the number of buckets.
BYTES_PER_WORD = 6
#: Lists of HOT rows or more are split, MOST_HOT of them at most (the longest), with MOST_CENTERS centers in all.
HOT, MOST_HOT, MOST_CENTERS = 1000, 10_000, 100_000
#: Up to so many edges are joined in one task, in about 200 bytes each.
FEW_EDGES = 300_000
#: Up to so many vertices are looked up in a table by broadcasting their names.
BROADCAST_IDS = 200_000
#: Words of 64 bits in which a set's shingles are marked; what one set marks and another doesn't, the other hasn't.
MARK_WORDS = 64
#: Words of 64 bits that say which shingles of its list's first center a set lacks; of larger centers a bit stands for some.
LACK_WORDS = 32
_P = np.uint64(0x9E3779B97F4A7C15)
_FULL = (1 << 64) - 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < CACHE:
            self[word] = h
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, hashes: dict) -> np.ndarray:
    """The sorted distinct shingles of a whole text: lower-cases A-Z, splits at ASCII white space."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(h))
    x = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        x = x * _P + h[i : i + len(x)]
    return np.unique(_mix(x + np.uint64(width if width < SHINGLE else 0)))


def vertex(s: np.ndarray) -> bytes:
    return hashlib.md5(s.tobytes()).digest()


def needed(n: int, percent: int) -> int:
    """The least overlap of a set of n with a set that it is linked with."""
    return -(-percent * n // 100)


def marks(s: np.ndarray) -> np.ndarray:
    """The bits that the shingles of a set mark, as longs."""
    bits = np.zeros(64 * MARK_WORDS, np.uint8)
    bits[(_mix(s) >> np.uint64(64 - bits.size.bit_length() + 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def lacked(p: np.ndarray, s: np.ndarray) -> tuple[int, np.ndarray]:
    """How many shingles of p the set s holds, and the bits of p's shingles that it lacks, as longs."""
    has = np.isin(p, s, assume_unique=True)
    width = min(len(p), 64 * LACK_WORDS)
    bits = np.zeros(-(-width // 64) * 64, np.uint8)
    bits[np.flatnonzero(~has) * width // len(p)] = 1
    return int(has.sum()), np.packbits(bits).view(np.int64)


def text_hash(t: bytes) -> int:
    """Finds the texts of wanted sets again without their shingles."""
    return xxhash.xxh64_intdigest(t) >> 1


class Order:
    """The sketch, and the global order of shingles that it gives."""

    def __init__(self, bits: np.ndarray, keys: np.ndarray, counts: np.ndarray, shift: int = 20):
        """keys: the frequent shingles, sorted, without their last shift bits."""
        self.bits, self.keys, self.counts, self.shift = bits, keys, counts, np.uint64(shift)

    def shared(self, s: np.ndarray) -> np.ndarray:
        """1 where another document may have the shingle, else 0; frequent ones have their bit, too."""
        at = s >> np.uint64(64 - SHARED_BITS.bit_length() + 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1

    def frequency(self, s: np.ndarray) -> np.ndarray:
        """1: in no other document; 2: perhaps in others; else the count."""
        f = 1 + self.shared(s).astype(np.int64)
        if len(self.keys):
            k = s >> self.shift
            i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
            f = np.where(self.keys[i] == k, self.counts[i], f)
        return f

    def sort(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """s, rare before frequent, and the frequencies. The order depends on the shingle alone."""
        f = self.frequency(s)
        level = np.where(f >= LEAST_FREQUENT, np.log2(np.maximum(f, 1)).astype(np.int64), 0)
        o = np.argsort(level, kind="stable")
        return s[o], f[o]


def matches(f: np.ndarray, n: int, percent: int) -> int:
    """The number of shared prefix shingles to require: the least of scanned list entries plus comparisons."""
    base = n - needed(n, percent)
    cost = np.cumsum(np.maximum(f - 1, 0))
    best, least = 1, None
    for ell in range(1, min(MAX_MATCHES, n - base) + 1):
        scan = float(cost[base + ell - 1])
        total = scan * (1 + n / 8 / ell)
        if least is None or total < least:
            best, least = ell, total
    return best


def _members(docs: DataFrame, kind: str) -> DataFrame:
    def run(batches):
        hashes = _Hashes()
        for b in batches:
            sets = [shingles(t.as_py(), hashes) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([vertex(s) if len(s) else None for s in sets], pa.binary())], ["k", "n", "v"])

    return common.materialise(docs.mapInArrow(run, f"k {kind}, n long, v binary"), "members")


def _words(texts: DataFrame) -> int:
    """About the number of words."""
    return (texts.agg(F.sum(F.length("t"))).first()[0] or 0) // BYTES_PER_WORD


def _order(docs: DataFrame, tokens: int) -> Order:
    """Counts every shingle of every text. Shingles travel as sorted blocks of 4 bytes each, by the bucket
    that their first bits name; those found LEAST_FREQUENT times in a block travel with their count, so that
    no shingle fills a bucket. Buckets grow in number with the corpus."""
    b = max(6, min(20, (tokens // TOKENS_PER_BUCKET).bit_length()))

    def spread(batches):
        hashes = _Hashes()

        def blocks(parts):
            x = np.sort(np.concatenate(parts))
            edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            n = np.diff(np.r_[edge, len(x)])
            often = n >= LEAST_FREQUENT
            few, many, counts = np.repeat(x[edge][~often], n[~often]), x[edge][often], n[often].astype("<u4")
            edges = np.arange(1, 1 << b, dtype=np.uint64) << np.uint64(64 - b)
            low = lambda v: ((v << np.uint64(b)) >> np.uint64(32)).astype("<u4")
            at = np.searchsorted(many, edges)
            found = [(i, f.tobytes(), m.tobytes(), c.tobytes()) for i, (f, m, c) in enumerate(zip(np.split(low(few), np.searchsorted(few, edges)), np.split(low(many), at), np.split(counts, at), strict=True)) if len(f) or len(m)]
            cols = list(zip(*found, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], ["b", "z", "m", "c"])

        parts, held = [], 0
        for batch in batches:
            for t in batch.column(0):
                s = shingles(t.as_py(), hashes)
                parts.append(s)
                held += len(s)
                if held >= HELD:
                    yield blocks(parts)
                    parts, held = [], 0
        if held:
            yield blocks(parts)

    size, most = SHARED_BITS >> b, max(1, FREQUENT >> b)

    def count(table: pa.Table) -> pa.Table:
        at = table.column("b")[0].as_py()
        z, m, c = (np.frombuffer(b"".join(table.column(name).to_pylist()), "<u4") for name in ("z", "m", "c"))
        x, weight = np.concatenate([z, m]), np.concatenate([np.ones(len(z), np.int64), c.astype(np.int64)])
        by = np.argsort(x, kind="stable")
        x, weight = x[by], weight[by]
        edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        low, n = x[edge].astype(np.uint64), np.add.reduceat(weight, edge)
        bits = np.zeros(size, np.uint8)
        bits[(low[n > 1] >> np.uint64(32 - (size.bit_length() - 1))).astype(np.int64)] = 1
        often = np.flatnonzero(n >= LEAST_FREQUENT)
        often = often[np.argsort(-n[often], kind="stable")[:most]]
        keys = (np.uint64(at) << np.uint64(32)) | low[often]
        return pa.table({"b": pa.array([at], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()), "keys": pa.array([keys.astype("<u8").tobytes()], pa.binary()), "n": pa.array([n[often].astype("<i8").tobytes()], pa.binary())})

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["b"])
        first = rows[0]["b"] >> (b - 10) << (b - 10)
        bits = bytearray((size >> 3) << (b - 10))
        for r in rows:
            at = (r["b"] - first) * (size >> 3)
            bits[at : at + (size >> 3)] = r["bits"]
        return pa.table({"b": pa.array([first], pa.int32()), "bits": pa.array([bytes(bits)], pa.binary()), **{c: pa.array([b"".join(r[c] for r in rows)], pa.binary()) for c in ("keys", "n")}})

    counted = docs.select("t").mapInArrow(spread, "b int, z binary, m binary, c binary").groupBy("b").applyInArrow(count, "b int, bits binary, keys binary, n binary")
    if b > 12:  # many small buckets: a thousand rows for the driver
        counted = counted.groupBy(F.shiftright("b", b - 10).alias("hi")).applyInArrow(join, "b int, bits binary, keys binary, n binary")
    bits = np.zeros(SHARED_BITS >> 3, np.uint8)
    rows = counted.collect()  # of fixed size in all
    for r in rows:
        part = np.frombuffer(r.bits, np.uint8)
        bits[r.b * (size >> 3) : r.b * (size >> 3) + len(part)] = part
    keys = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(r["keys"], "<u8") for r in rows]])
    n = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r.n, "<i8") for r in rows]])
    keys, first = np.unique(keys, return_index=True)
    return Order(bits, keys, n[first], 32 - b)


def _described(docs: DataFrame, kind: str, order, percent: int) -> DataFrame:
    """Of every row (k, t): k, n, name; and, once for a set and task, ell, base (the length of the prefix for l = 1), and
    the tokens of the prefix that others may have, with their positions in it, the set's marks(), m, the number of its
    shingles that others may have, and h, its text_hash(). If m is too small for a link, it has none of these."""
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32(), pa.int64()]

    def run(batches):
        hashes, rank, seen = _Hashes(), order.value, set()
        for b in batches:
            out = []
            for t in b.column(1):
                text = t.as_py()
                s = shingles(text, hashes)
                if not len(s):
                    out.append((0, *[None] * 8))
                    continue
                v, n, m = vertex(s), len(s), int(np.count_nonzero(rank.shared(s)))
                if m < needed(n, percent) or v in seen:
                    out.append((n, v, *[None] * 7))
                    continue
                if len(seen) < CACHE:
                    seen.add(v)
                own = marks(s)
                s, f = rank.sort(s)
                ell = matches(f, n, percent)
                base = n - needed(n, percent) + 1
                at = np.flatnonzero(f[: base + ell - 1] > 1)
                out.append((n, v, ell, base, s[at].view(np.int64), at.astype(np.int32), own, m, text_hash(text)) if len(at) else (n, v, *[None] * 7))
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]], ["k", "n", "name", "ell", "base", "tokens", "at", "marks", "m", "h"])

    return common.materialise(docs.mapInArrow(run, f"k {kind}, n long, name binary, ell int, base int, tokens array<long>, at array<int>, marks array<long>, m int, h long"), "described")


def _prefixes(described: DataFrame) -> DataFrame:
    """One row for each distinct set that may have others like it, with a number v of its own: written, so that it stays."""
    rows = described.where("tokens is not null").select("name", F.col("n").cast("int").alias("n"), "ell", "base", "tokens", "at", "marks", "m", "h")
    return common.materialise(rows.dropDuplicates(["name"]).withColumn("v", F.monotonically_increasing_id()), "prefixes")


def _postings(prefixes: DataFrame) -> DataFrame:
    """A row for each token: level is the least l whose prefix holds it, pos its position, before the number of
    tokens before it that others may have, own the number of tokens of the prefix that no other has."""
    own = F.col("base") + F.col("ell") - 1 - F.size("tokens")
    rows = prefixes.select("v", "n", "ell", "base", own.alias("own"), F.posexplode(F.arrays_zip("tokens", "at")).alias("before", "x"))
    return rows.select(F.col("x.tokens").alias("token"), "v", "n", F.greatest(F.lit(1), F.col("x.at") - F.col("base") + 2).alias("level"), "ell", "before", F.col("x.at").alias("pos"), "own")


def _enough_matches(pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The pairs that share at least min(ell) tokens of their prefixes for that l, and whose marks leave room for a link: an
    overlap is at most the size of a set less the marks that the other set lacks."""
    cols = ["n", "ell", "base", "tokens", "at", "marks"]
    for side in ("v", "w"):  # the same but for names, so that one shuffle serves both
        own = prefixes.select(F.col("v").alias(f"key_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in cols])
        pairs = pairs.join(own, F.col(side) == F.col(f"key_{side}"))
    ell = F.least("ell_v", "ell_w")
    cut = lambda side: F.filter(f"tokens_{side}", lambda x, i: F.get(f"at_{side}", i) < F.col(f"base_{side}") + ell - 1)
    lacks = lambda a, b: F.aggregate(F.zip_with(f"marks_{a}", f"marks_{b}", lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda t, x: t + x)
    room = (100 + percent) * F.least(F.col("n_v") - lacks("v", "w"), F.col("n_w") - lacks("w", "v")) >= percent * (F.col("n_v") + F.col("n_w"))
    return pairs.where((F.size(F.array_intersect(cut("v"), cut("w"))) >= ell) & room).select("v", "c", "w", "d")


#: A row of a list. held, other and lack stand beside its first center, once that is known: how many shingles of the center the
#: set holds, how many shingles it holds besides that others may have, and lacked().
_LIST = ["token", "v", "n", "level", "ell", "before", "pos", "own", "c", "held", "other", "lack"]


#: A list of so many documents or fewer is compared in full at once.
SHORT = 8


def _more(a: list[int], b: list[int]) -> int:
    """The number of bits of a that b has not."""
    return sum((x & ~y & _FULL).bit_count() for x, y in zip(a, b, strict=True))


def _sweep(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Streams the lists, documents with few tokens of their own first, in the same order in every list, so that lists of
    the same documents have the same centers; rows of one token and v may repeat. All pairs of a
    short list are paired, and a longer one of one component is done. Of others the first width documents are centers, and all are paired with
    those before them. Pairs are of different components, of sizes and positions that allow a link:
    the overlap is at most what others may have of both before the token, the token, and what follows in
    both; or to what both have of the list's first center, and the lesser of what they have besides.
    Gives pairs (token null, v and c, w and d), and the rows after the centers of longer lists, with their first center as w."""
    names = [*_LIST, "w", "d"]
    nothing = (None,) * 6
    kind = rows.schema["v"].dataType.simpleString()
    name = pa.binary() if kind == "binary" else pa.int64()
    kinds = [pa.int64(), name, *[pa.int32()] * 6, name, *[pa.int32()] * 2, pa.list_(pa.int64()), name, name]

    def pair(out, others, row):
        _, v, n, level, ell, before, pos, _, c, has, other, lack = row
        for _, ov, on, olevel, oell, obefore, opos, _, oc, ohas, oother, olack in others:
            if oc != c and max(olevel, level) <= min(oell, ell) and 100 * min(on, n) >= percent * max(on, n):
                most = min(before, obefore) + 1 + min(n - pos, on - opos) - 1
                if (100 + percent) * most < percent * (n + on):
                    continue
                if has is not None and ohas is not None:
                    most = min(has, ohas) + min(other, oother)
                    if (100 + percent) * most >= percent * (n + on):
                        most = min(has - _more(olack, lack), ohas - _more(lack, olack)) + min(other, oother)
                if (100 + percent) * most >= percent * (n + on):
                    out.append((None, ov, *nothing, oc, None, None, None, v, c))

    def run(batches):
        token, last, held, long_ = None, None, [], False

        def close(out):
            if long_:
                return
            if len(held) <= max(SHORT, width):
                for i in range(1, len(held)):
                    pair(out, held[:i], held[i])
            elif len({row[8] for row in held}) > 1:  # else the list is done
                for i in range(1, len(held)):
                    pair(out, held[: min(i, width)], held[i])
                out.extend((*row, held[0][1], None) for row in held[width:])

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for b in batches:
            out: list[tuple] = []
            t = b.column(0).to_numpy()
            same = np.r_[True, t[1:] == t[:-1], True]  # the ends of a batch may go on in another
            for row in zip(*(c.to_pylist() for c in b.filter(pa.array(same[1:] | same[:-1])).columns), strict=True):
                if row[0] != token:
                    close(out)
                    token, last, held, long_ = row[0], None, [], False
                if row[1] == last:
                    continue
                last = row[1]
                if long_:
                    pair(out, held, row)
                    out.append((*row, held[0][1], None))
                    continue
                held.append(row)
                if len(held) > max(HOT, width):  # of these there are few, or more than MOST_HOT
                    long_ = True
                    for i in range(1, len(held)):
                        pair(out, held[: min(i, width)], held[i])
                    out.extend((*row, held[0][1], None) for row in held[width:])
                    held = held[:width]
            if out:
                yield batch(out)
        out = []
        close(out)
        if out:
            yield batch(out)

    dealt = rows.select(*_LIST).repartition("token").sortWithinPartitions("token", "own", "v")
    return dealt.mapInArrow(run, f"token long, v {kind}, n int, level int, ell int, before int, pos int, own int, c {kind}, held int, other int, lack array<long>, w {kind}, d {kind}")


def _hot_pairs(rows: DataFrame, width: int, hot: int, percent: int) -> DataFrame:
    """_sweep() of so many long lists without dealing them out: a center is the first row of a chunk of its list, found with
    partial minima, and the rows meet the broadcast centers where they lie."""
    chunks = max(1, min(width, MOST_CENTERS // hot))
    first = F.min(F.struct("own", *[c for c in _LIST[1:] if c != "own"])).alias("x")
    kind = rows.schema["v"].dataType
    centers = common.materialise(rows.groupBy("token", F.pmod(F.xxhash64("v"), F.lit(chunks)).alias("chunk")).agg(first).select("token", "x"), "centers")
    x = lambda c: F.col(f"x.{c}")
    most = F.least("before", x("before")) + F.least(F.col("n") - F.col("pos"), x("n") - x("pos"))
    more = lambda a, b: F.aggregate(F.zip_with(a, b, lambda s, t: F.bit_count(s.bitwiseAND(F.bitwise_not(t)))), F.lit(0), lambda n, y: n + y)
    enough = lambda n: (100 + percent) * n >= percent * (F.col("n") + x("n"))
    other = F.least(F.col("other"), x("other"))
    close = F.col("held").isNull() | x("held").isNull() | enough(F.least(F.col("held"), x("held")) + other) & enough(F.least(F.col("held") - more(x("lack"), F.col("lack")), x("held") - more(F.col("lack"), x("lack"))) + other)
    may = (F.col("c") != x("c")) & (F.greatest("level", x("level")) <= F.least("ell", x("ell"))) & (100 * F.least("n", x("n")) >= percent * F.greatest("n", x("n"))) & ((100 + percent) * most >= percent * (F.col("n") + x("n"))) & close
    none = lambda *names: [F.lit(None).cast("int").alias(c) for c in names]
    pairs = rows.join(F.broadcast(centers), "token").where(may)
    pairs = pairs.select(F.lit(None).cast("long").alias("token"), x("v").alias("v"), *none("n", "level", "ell", "before", "pos", "own"), x("c").alias("c"), *none("held", "other"), F.lit(None).cast("array<long>").alias("lack"), F.col("v").alias("w"), F.col("c").alias("d"))
    blank = F.lit(None).cast(kind)
    rest = rows.join(F.broadcast(centers.select("token", x("v").alias("v"))), ["token", "v"], "left_anti")
    of_list = centers.groupBy("token").agg(F.min(F.struct(x("own"), x("v").alias("w")))["w"].alias("w"))
    rest = rest.join(F.broadcast(of_list), "token").select(*_LIST, "w", blank.alias("d"))
    return pairs.unionByName(rest)


def _round(rows: DataFrame, width: int, percent: int, count: int | None = None) -> DataFrame:
    """The table of _sweep() for all lists, the longest ones split. count: of rows, if it is known."""
    if count is not None and count < HOT:
        return common.materialise(_sweep(rows, width, percent), "sweep")
    sizes = rows.groupBy("token").agg(F.count(F.lit(1)).alias("size"), (F.min("c") != F.max("c")).alias("mixed")).where(F.col("size") >= HOT)
    long_ = common.materialise(sizes.orderBy(F.desc("size"), "token").limit(MOST_HOT).select("token", "mixed"), "hot")
    hot, mixed = long_.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("mixed").cast("int")), F.lit(0))).first()
    found = _sweep(rows.join(F.broadcast(long_.select("token")), "token", "left_anti") if hot else rows, width, percent)
    if mixed:  # those of one component are done
        found = found.unionByName(_hot_pairs(rows.join(F.broadcast(long_.where("mixed").select("token")), "token", "left_semi"), width, mixed, percent))
    return common.materialise(found, "sweep")


#: Bits of the sketch that says which sets are wanted.
WANTED_BITS = 1 << 26


def is_wanted(bits: np.ndarray, v: bytes) -> bool:
    x = int.from_bytes(v[:8], "little")  # _mix() of one number
    x = ((x ^ (x >> 30)) * int(_M1)) & _FULL
    x = ((x ^ (x >> 27)) * int(_M2)) & _FULL
    h = (x ^ (x >> 31)) >> (64 - WANTED_BITS.bit_length() + 1)
    return bool(bits[h >> 3] >> (h & 7) & 1)


def _wanted(vertices: DataFrame) -> np.ndarray:
    """A bit for the hash of each vertex (16 bytes, or a long), in a sketch of fixed size."""
    b = 10
    size = WANTED_BITS >> b

    def mark(table: pa.Table) -> pa.Table:
        h = table.column("h").to_numpy().view(np.uint64)
        bits = np.zeros(size, np.uint8)
        bits[((h << np.uint64(b)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)] = 1
        return pa.table({"b": pa.array([int(h[0] >> np.uint64(64 - b))], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    def bucket(batches):
        for x in batches:
            v = x.column(0)
            v = np.frombuffer(b"".join(v.to_pylist()), "<u8")[::2] if pa.types.is_binary(v.type) else v.to_numpy().view(np.uint64)
            h = _mix(v)
            yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(64 - b)).astype(np.int32)), pa.array(h.view(np.int64))], ["b", "h"])

    out = np.zeros(WANTED_BITS >> 3, np.uint8)
    for r in vertices.select("v").mapInArrow(bucket, "b int, h long").groupBy("b").applyInArrow(mark, "b int, bits binary").collect():
        out[r.b * (size >> 3) : (r.b + 1) * (size >> 3)] = np.frombuffer(r.bits, np.uint8)
    return out


def _sets(docs: DataFrame, prefixes: DataFrame, vertices: DataFrame) -> DataFrame:
    """v and z (its shingles, 8 bytes each) of these vertices: a sketch of their text_hash(), of fixed size, says which texts' sets are
    made and sent, and joining them by name with prefixes says whose they are."""
    names = prefixes.select("name", "v")
    wanted = docs.sparkSession.sparkContext.broadcast(_wanted(prefixes.select("v", "h").join(vertices.select("v"), "v", "left_semi").select(F.col("h").alias("v"))))

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out, strict=True)], ["name", "z"])

    def run(batches):
        hashes, bits, seen = _Hashes(), wanted.value, set()
        for b in batches:
            out, held = [], 0
            for t in b.column(0):
                text = t.as_py()
                h = text_hash(text)
                if h in seen or not is_wanted(bits, h.to_bytes(8, "little")):
                    continue
                s = shingles(text, hashes)
                if not len(s):
                    continue
                if len(seen) < CACHE:
                    seen.add(h)
                out.append((vertex(s), s.tobytes()))
                held += len(s)
                if held >= 1_000_000:
                    yield batch(out)
                    out, held = [], 0
            if out:
                yield batch(out)

    return docs.select("t").mapInArrow(run, "name binary, z binary").dropDuplicates(["name"]).join(names, "name").select("v", "z")


def linked(xs: list[bytes], ys: list[bytes], percent: int) -> list[bool]:
    """xs, ys: sets of 8-byte shingles, side by side."""
    out = []
    for x, y in zip(xs, ys, strict=True):
        both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
        out.append(100 * both >= percent * ((len(x) + len(y)) // 8 - both))
    return out


def _both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs with x and y, the sets of v and w; one shuffle of sets serves both."""
    for side, z in (("v", "x"), ("w", "y")):
        own = sets.select(F.col("v").alias(f"key_{side}"), F.col("z").alias(z))
        pairs = pairs.join(own, F.col(side) == F.col(f"key_{side}"))
    return pairs


def _verify(pairs: DataFrame, sets: DataFrame, percent: int, same_enough, count: int) -> DataFrame:
    """The links among so many pairs (v, c, w, d), as edges (a, b) between components, by their whole sets. Few pairs go to
    the sets, so that only sets that are compared are dealt; else all sets are."""
    kind = pairs.schema["c"].dataType.simpleString()

    def run(batches):
        for b in batches:
            same = pa.array(same_enough(b.column(2).to_pylist(), b.column(3).to_pylist(), percent), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(same), b.column(1).filter(same)], ["a", "b"])

    def meet(batches):  # the two sides of a pair follow one another
        left = None
        for t in batches:
            ends, xs, ys = [], [], []
            for p, c, d, z in zip(*(x.to_pylist() for x in t.columns), strict=True):
                if left is not None and left[0] == p:
                    ends.append((c, d))
                    xs.append(left[1])
                    ys.append(z)
                    left = None
                else:
                    left = (p, z)
            if ends and any(same := same_enough(xs, ys, percent)):
                ends = [e for e, s in zip(ends, same, strict=True) if s]
                yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in ends], t.schema.field(i + 1).type) for i in (0, 1)], ["a", "b"])

    if 2 * count > BROADCAST_IDS:
        return _both(pairs, sets).select("c", "d", "x", "y").mapInArrow(run, f"a {kind}, b {kind}")
    sides = F.explode(F.array(F.struct("v", F.lit(0).alias("s")), F.struct(F.col("w").alias("v"), F.lit(1).alias("s"))))
    own = pairs.withColumn("p", F.monotonically_increasing_id()).select("p", "c", "d", sides.alias("e")).select("p", "c", "d", F.col("e.v").alias("v"), F.col("e.s").alias("s"))
    rows = sets.join(F.broadcast(own), "v").repartition("p").sortWithinPartitions("p", "s")
    return rows.select("p", "c", "d", "z").mapInArrow(meet, f"a {kind}, b {kind}")


def _only(table: DataFrame, pairs: DataFrame, count: int) -> DataFrame:
    """The rows of table whose v stands in one of count pairs; found in place if these are few, else all rows."""
    if 2 * count > BROADCAST_IDS:
        return table
    ids = pairs.select("v").unionAll(pairs.select(F.col("w").alias("v")))
    return table.join(F.broadcast(ids), "v", "left_semi")


def _joined(edges: DataFrame) -> DataFrame:
    """components() of at most FEW_EDGES edges, in one task: union-find, least names as roots."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches):
        above: dict = {}

        def root(v):
            while (up := above.setdefault(v, v)) != v:
                above[v] = v = above[up]
            return v

        column = None
        for t in batches:
            column = t.schema.field(0).type
            for a, b in zip(t.column(0).to_pylist(), t.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    above[max(a, b)] = min(a, b)
        if above:
            yield pa.RecordBatch.from_arrays([pa.array(list(above), column), pa.array([root(v) for v in list(above)], column)], ["v", "c"])

    return common.materialise(edges.coalesce(1).mapInArrow(run, f"v {kind}, c {kind}"), "labels")


def components(edges: DataFrame) -> DataFrame:
    """v, c: every vertex of edges (a, b) with the name of its component. Up to FEW_EDGES edges one task joins them. Of more, each
    round joins all vertices to their least neighbour and goes on with the contracted graph, which is much smaller; names
    are hashes, so that rounds are few. All steps are joins and aggregates with partial sums over tables."""
    edges = common.materialise(edges.select("a", "b").where("a <> b"), "edges")
    labels = None
    if edges.count() <= FEW_EDGES:
        labels = _joined(edges)
        common.discard(edges)
        return labels
    edges = edges.distinct()
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = common.materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p")), "least")
        if labels is None:
            new = least.select(F.col("a").alias("v"), F.col("p").alias("c"))
        else:
            new = labels.join(least.select(F.col("a").alias("c"), "p"), "c", "left").select("v", F.coalesce("p", "c").alias("c"))
        old, labels = labels, common.materialise(new, "labels")
        ends = edges.join(least, "a").select(F.col("p").alias("x"), F.col("b").alias("a")).join(least, "a").select(F.col("x").alias("a"), F.col("p").alias("b"))
        gone, edges = edges, common.materialise(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        common.discard(old, gone, least)
    if labels is None:
        labels = edges.select(F.col("a").alias("v"), F.col("b").alias("c"))
    return labels


def _by_center(lists: DataFrame) -> DataFrame:
    """The lists of one first center as one list, with a row for each set: what is found beside the center doesn't depend on the token."""
    return common.materialise(lists.select("center", "v", "n", "own", "c").distinct(), "lists")


def _beside_centers(lists: DataFrame, sets: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The lists of _by_center() that have several components, as rows of lists named by their centers, each beside its center: two
    sets share at most what both hold of the center, and the lesser of what they hold besides that others may have."""
    mixed = lists.groupBy("center").agg((F.min("c") != F.max("c")).alias("mixed")).where("mixed").select("center")

    def run(batches):
        for b in batches:
            x = [lacked(np.frombuffer(p, np.uint64), np.frombuffer(z, np.uint64)) for z, p in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([n for n, _ in x], pa.int32()), pa.array([y for _, y in x], pa.list_(pa.int64())), b.column(6)], ["token", "v", "n", "own", "held", "lack", "c"])

    both = lists.join(mixed, "center", "left_semi").join(sets, "v").join(sets.select(F.col("v").alias("center"), F.col("z").alias("y")), "center")
    beside = both.select("center", "v", "n", "own", "z", "y", "c").mapInArrow(run, "token long, v long, n int, own int, held int, lack array<long>, c long")
    one, none = F.lit(1), F.lit(0)  # positions in a shingle's list say no more
    rows = beside.join(prefixes.select("v", "m"), "v").withColumns({"level": one, "ell": one, "before": F.col("n"), "pos": none, "other": F.col("m") - F.col("held")})
    return common.materialise(rows.select(*_LIST), "beside")


def connect(postings: DataFrame, sets_of, percent: int, prefixes: DataFrame | None = None, same_enough=linked) -> DataFrame:
    """v, c: the components of the links among documents that share a list, for every document that has one.

    postings: token, v and n, and level, ell, before, pos and own where they differ. prefixes: see _enough_matches(). Pairs
    that pass are compared by same_enough() of lists of their z; sets_of(v of the vertices wanted) gives (v, z), a row for
    each of them at most, and may give others.
    """
    spark = postings.sparkSession
    width, sets, labels = 1, None, None
    more = {"level": F.lit(1), "ell": F.lit(1), "before": F.lit(0), "pos": F.lit(0), "own": F.lit(0), "c": F.col("v"), "held": F.lit(None).cast("int"), "other": F.lit(None).cast("int"), "lack": F.lit(None).cast("array<long>")}
    rows = postings.withColumns({c: x for c, x in more.items() if c not in postings.columns}).select(*_LIST)
    found = _round(rows, width, percent)
    common.release(spark)
    while True:
        first = labels is None
        pairs = common.materialise(found.where("token is null").select("v", "c", "w", "d").distinct(), "pairs")
        if prefixes is not None:
            every, pairs = pairs, common.materialise(_enough_matches(pairs, _only(prefixes, pairs, pairs.count()), percent), "pairs")
            common.discard(every)
        lists = found.where("token is not null").select(*_LIST, F.col("w").alias("center"))
        if first and prefixes is not None:
            lists = _by_center(lists)
        if sets is None:  # all that a later round may compare is in a longer list now
            wanted = pairs.select("v").unionAll(pairs.select("w")).unionAll(lists.select("v")).unionAll(lists.select("center")).distinct()
            with common.batches_of(spark, common.TEXTS):
                sets = common.materialise(sets_of(wanted), "sets")
            common.release(spark)
        count = pairs.count()
        if first or count:
            with common.batches_of(spark, 256):
                joined = components(_verify(pairs, sets, percent, same_enough, count))
            common.release(spark)
            small = joined.count() <= BROADCAST_IDS
            sent = F.broadcast if small else lambda df: df
            moved = sent(joined.select(F.col("v").alias("c"), F.col("c").alias("m")))
            before, lists = lists, common.materialise(lists.join(moved, "c", "left").withColumn("c", F.coalesce("m", "c")).select(*lists.columns), "lists")
            common.discard(before)
            if first and prefixes is not None:
                with common.batches_of(spark, 256):
                    before, lists = lists, _beside_centers(lists, sets, prefixes)
                common.discard(before)
            if first:
                labels = joined
            else:
                kept = labels.join(moved, "c", "left").select("v", F.coalesce("m", "c").alias("c"))
                known = labels.join(sent(joined.select("v")), "v", "left_semi")  # no more than joined
                fresh = joined.join(F.broadcast(known.select("v")) if small else known, "v", "left_anti")
                last, labels = labels, common.materialise(kept.unionByName(fresh), "labels")
                common.discard(last, joined)
        width = min(4 * width, 1024)
        last, found = found, _round(lists.select(*_LIST), width, percent, lists.count())
        common.discard(lists, pairs, last)
        if found.isEmpty():
            common.discard(sets, found)
            return labels


def links(docs: DataFrame, percent: int = 75, text_col: str = "text") -> DataFrame:
    """v, w (v < w) and overlap: every link between distinct sets, by their names, and how many shingles both hold.

    No pair is passed over because its sets are in one component already: the pairs of a large group of near
    copies are all compared, and so the cost grows with the number of links. Texts are as in near_duplicates().
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("binary").alias("t")).where("length(t) > 0")
    order = spark.sparkContext.broadcast(_order(texts, _words(texts)))  # of fixed size
    prefixes = _prefixes(_described(texts.select(F.lit(0).alias("k"), "t"), "int", order, percent))
    side = lambda s: _postings(prefixes).select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("v", "n", "level", "ell", "before", "pos")])
    both = side("v").join(side("w"), "token").where("v_v < v_w")
    both = both.where((F.greatest("level_v", "level_w") <= F.least("ell_v", "ell_w")) & (100 * F.least("n_v", "n_w") >= percent * F.greatest("n_v", "n_w")))
    most = F.least("before_v", "before_w") + F.least(F.col("n_v") - F.col("pos_v"), F.col("n_w") - F.col("pos_w"))
    pairs = both.where((100 + percent) * most >= percent * (F.col("n_v") + F.col("n_w"))).select(F.col("v_v").alias("v"), F.col("v_w").alias("w")).distinct()
    pairs = common.materialise(_enough_matches(pairs.withColumns({"c": F.col("v"), "d": F.col("w")}), prefixes, percent).select("v", "w"), "pairs")
    sets = common.materialise(_sets(texts, prefixes, pairs.select("v").union(pairs.select("w")).distinct()), "sets")
    sized = _both(pairs, sets).select("v", "w", "x", "y")

    def run(batches):
        for b in batches:
            rows = []
            for v, w, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                overlap = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                if 100 * overlap >= percent * ((len(x) + len(y)) // 8 - overlap):
                    rows.append((v, w, overlap))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64()))], ["v", "w", "overlap"])

    with common.batches_of(spark, 256):
        out = sized.mapInArrow(run, "v long, w long, overlap long")
        for side in ("v", "w"):
            out = out.join(prefixes.select(F.col("v").alias(side), F.col("name").alias(f"name_{side}")), side)
        both = F.least("name_v", "name_w"), F.greatest("name_v", "name_w")
        out = common.materialise(out.select(both[0].alias("v"), both[1].alias("w"), "overlap"), "links")
    common.discard(prefixes, pairs, sets)
    return out


def link_counts(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, v (the name of its set, null if it has none) and n_links, the number of distinct other sets that
    its set is linked with by found, the table of links()."""
    members = _members(docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("binary").alias("t")), docs.schema[id_col].dataType.simpleString())
    ends = found.select("v").unionAll(found.select(F.col("w").alias("v"))).groupBy("v").agg(F.count(F.lit(1)).alias("n_links"))
    return members.join(ends, "v", "left").select(F.col("k").alias(id_col), "v", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles and component_id, the least id reachable over links of a Jaccard similarity of
    percent / 100 or more between sets of 5-word shingles.

    Fewer than five words: the whole sequence is the one shingle. Null, empty and blank texts have no
    shingles and are linked with nothing: their component is their own id. Rows with equal sets are in one
    component whatever their ids; null ids name a component only if it has no other. An empty table gives
    an empty result. Other columns are not read. Shingles are known by 64-bit hashes, sets by 128-bit ones.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).cast("binary").alias("t"))
    texts = rows.where("length(t) > 0")
    with common.batches_of(spark, common.TEXTS):
        order = spark.sparkContext.broadcast(_order(texts, _words(texts)))  # of fixed size
        common.release(spark)
        members = _described(rows, kind, order, percent)
    prefixes = _prefixes(members)
    common.release(spark)
    labels = connect(_postings(prefixes), lambda wanted: _sets(texts, prefixes, wanted), percent, prefixes)
    order.destroy()
    found = common.materialise(prefixes.select("name", "v").join(labels, "v", "left").select("name", F.coalesce("c", "v").alias("c")), "groups")
    common.discard(prefixes, labels)
    named = members.select("k", "n", "name").join(found, "name", "left")  # those without c are like no other
    least = named.where("c is not null").groupBy("c").agg(F.min("k").alias("least"))
    out = named.join(least, "c", "left")
    return out.select(F.col("k").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "k").alias("component_id"))

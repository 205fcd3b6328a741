"""Token-ID output in training order.

Documents are dealt to buckets by a hash of id and text and sorted there, so that their order depends on the
rows alone, not on files or partitions. Texts become sequences of a fixed number of token ids, written once as a
table in which each row has its bucket and its place there. These number the sequences 0..N-1; a keyed Feistel
network permutes these numbers, walking its cycle until the number lies below N, and so gives every sequence a
global slot. Sequences are dealt by ranges of slots and written as shards in which record i starts at byte
i * stride: a reader seeks to any slot, reads on, and resumes from a slot number alone. A writer that was
stopped resumes, too: rounds of shards that were committed are not written again.

Record: document id (int64, NULL_ID for null), sequence number in the document (int32), count of ids
(int32), the ids (uint16, padded with the end id), a newline; all little-endian.
"""

from __future__ import annotations

import base64
import json

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

NULL_ID = -(1 << 63)
HEADER = 16
#: Words that a worker keeps the ids of. The first ones stay: frequent words come early, and rare ones aren't worth a place.
CACHE = 300_000
#: Characters of text that are encoded at once, that a bucket has about, and that a task has about.
AT_ONCE, BUCKET_CHARS, TASK_CHARS = 1_000_000, 2_000_000, 8_000_000
_M64 = (1 << 64) - 1


def record_type(seq_len: int) -> np.dtype:
    return np.dtype([("doc", "<i8"), ("seq", "<i4"), ("n", "<i4"), ("ids", "<u2", (seq_len,)), ("end", "u1")])


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = x + np.uint64(key & _M64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _round_keys(key: int, rounds: int) -> list[int]:
    return [int(_mix(np.array([i + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15), key)[0]) for i in range(rounds)]


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def permute(index: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The slots of indices below n: a bijection of range(n), by balanced Feistel rounds and cycle walking."""
    half = _half_bits(n)
    mask = np.uint64((1 << half) - 1)
    keys = _round_keys(key, rounds)
    out = np.asarray(index, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right, k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def restore(slot: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The indices of slots: permute() backwards."""
    half = _half_bits(n)
    mask = np.uint64((1 << half) - 1)
    keys = _round_keys(key, rounds)[::-1]
    out = np.asarray(slot, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right ^ (_mix(left, k) & mask), left
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


class Pieces(dict):
    """Ids of a word with a space before it, as uint16 bytes. The tokenizer's pattern always starts a token at a
    single space, so a text without two spaces in a row is the sum of its words, and words that are not known
    yet are encoded together and cut where a token starts with a space."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = max(ranks.values()) + 1
        self.spaced = np.zeros(self.end, bool)
        self.spaced[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.encode = tiktoken.Encoding("lectern", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.batch: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        return self.batch[word]

    def _learn(self, words: list[str]) -> None:
        """Encodes words; as many as have a place stay, the others serve the batch at hand."""
        ids = np.array(self.encode(" " + " ".join(words)), "<u2")
        at = np.flatnonzero(self.spaced[ids])
        if len(at) == len(words):
            raw, cut = ids.tobytes(), [*(2 * at).tolist(), 2 * len(ids)]
            found = {w: raw[a:z] for w, a, z in zip(words, cut, cut[1:], strict=False)}
        else:
            found = {w: np.array(self.encode(" " + w), "<u2").tobytes() for w in words}
        stay = list(found)[: max(0, CACHE - len(self))]
        self.update((w, found[w]) for w in stay)
        self.batch = found if len(stay) < len(found) else {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """All ids of each text; whole-text encoding where words could differ from it."""
        odd = ["  " in t or t[:1] == " " or t[-1:] == " " for t in texts]
        words = [[] if o else t.split(" ") for o, t in zip(odd, texts, strict=True)]
        fresh: set[str] = set()
        for w in words:
            fresh.update(w[1:])
        if new := [w for w in fresh if w not in self]:
            self._learn(new)
        one = lambda t: np.array(self.encode(t), "<u2").tobytes()
        known = self.__getitem__
        return [one(t) if o else one(w[0]) + b"".join(map(known, w[1:])) for o, t, w in zip(odd, texts, words, strict=True)]


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


def _portions(keys: list, texts: list[str]):
    """(keys, texts) of about AT_ONCE characters, so that the words of a batch fit in memory."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= AT_ONCE:
            yield keys[first : i + 1], texts[first : i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield keys[first:], texts[first:]


def tokenize(docs: DataFrame, tokenizer: str, seq_len: int, id_col: str = "doc_id", text_col: str = "text", bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """part (a bucket), place (0.. in it), doc, seq, n and ids (zstd) of every sequence, as a table in the shared
    folder. Buckets have about bucket_chars characters; rows that agree in id and text are interchangeable."""
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t")).where("t is not null and t <> ''")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_chars))
    dealt = rows.withColumn("h", F.xxhash64("k", "t")).withColumn("part", F.pmod("h", F.lit(buckets)).cast("int"))
    dealt = dealt.repartition(-(-total // TASK_CHARS) or 1, "part").sortWithinPartitions("part", "h", "k", "t").select("part", "k", "t")
    names = ["part", "place", "doc", "seq", "n", "z"]

    def run(batches):
        enc, press = pieces(tokenizer), zstandard.ZstdCompressor(level=1)
        last, next_ = None, 0
        end = np.array([enc.end], "<u2").tobytes()
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            for own, texts in _portions(rows, b.column(2).to_pylist()):
                part, place, doc, seq, n, z = [], [], [], [], [], []
                for (p, k), ids in zip(own, enc.ids(texts), strict=True):
                    if p != last:
                        last, next_ = p, 0
                    ids += end
                    for s, i in enumerate(range(0, len(ids), 2 * seq_len)):
                        piece = ids[i : i + 2 * seq_len]
                        part.append(p)
                        place.append(next_)
                        next_ += 1
                        doc.append(k)
                        seq.append(s)
                        n.append(len(piece) // 2)
                        z.append(press.compress(piece))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((part, place, doc, seq, n, z), kinds, strict=True)], names)

    with common.batches_of(docs.sparkSession, common.TEXTS):
        return common.materialise(dealt.mapInArrow(run, "part int, place long, doc long, seq int, n int, z binary"), "sequences")


def assign(sequences: DataFrame, key: int) -> tuple[DataFrame, int]:
    """sequences with their slot, and their number. Only one number a bucket decides on the order."""
    counts = sequences.groupBy("part").agg((F.max("place") + 1).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each bucket
    parts = common.materialise(counts.select("part", "rows", F.coalesce(before, F.lit(0)).alias("ahead")), "parts")
    total = parts.agg(F.sum("rows")).first()[0] or 0

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(permute(b.column(0).to_numpy(), total, key))], ["doc", "seq", "n", "z", "slot"])

    indexed = sequences.join(parts.select("part", "ahead"), "part").select((F.col("ahead") + F.col("place")).alias("i"), "doc", "seq", "n", "z")
    return indexed.mapInArrow(run, "doc long, seq int, n int, z binary, slot long"), total


def write_shards(docs: DataFrame, path: str, tokenizer: str, seq_len: int = 512, shard_rows: int = 8192, key: int = 20240229, rounds: int = 6, id_col: str = "doc_id", text_col: str = "text", bucket_chars: int = BUCKET_CHARS) -> int:
    """Writes path/round=R/shard=K/part-* with slots K * shard_rows and on; gives the number of sequences.

    A text's ids end with the end id; null and empty texts have no sequence. Long texts are many sequences;
    repeated rows are written each. Columns other than the two named are not read, whatever they are called. An
    empty table writes no shard. The sequences are read in rounds, each for its share of the shards, so that
    only a part of them is between map and reduce at a time. Spark's committed writers write a round into a folder of
    its own, so a lost executor leaves no partial shard. After a failure the same call, over the same rows in whatever
    order and partitions, leaves the rounds that were committed, and writes the others; a folder that
    holds other rounds (another number of sequences or other parameters) is an error.
    """
    spark = docs.sparkSession
    sequences = tokenize(docs, tokenizer, seq_len, id_col, text_col, bucket_chars)
    rows, total = assign(sequences, key)
    kind = record_type(seq_len)
    common.release(spark)

    def record(batches):
        open_, end = zstandard.ZstdDecompressor(), pieces(tokenizer).end
        for b in batches:
            r = np.zeros(b.num_rows, kind)
            r["ids"], r["end"] = end, 10
            r["doc"] = [NULL_ID if k is None else k for k in b.column(1).to_pylist()]
            r["seq"], r["n"] = b.column(2).to_numpy(), b.column(3).to_numpy()
            for i, z in enumerate(b.column(4).to_pylist()):
                ids = np.frombuffer(open_.decompress(z), "<u2")
                r["ids"][i, : len(ids)] = ids
            raw = r.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([raw[i : i + kind.itemsize - 1] for i in range(0, len(raw), kind.itemsize)], pa.binary())], ["shard", "value"])

    shards = -(-total // shard_rows)
    says = {"sequences": total, "seq_len": seq_len, "shard_rows": shard_rows, "key": key, "rounds": rounds, "bucket_chars": bucket_chars, "tokenizer": tokenizer.rsplit("/", 1)[-1]}
    if (there := common.read_text(spark, f"{path}/layout.json")) is None:
        common.write_text(spark, f"{path}/layout.json", json.dumps(says))
    elif json.loads(there) != says:
        raise ValueError(f"{path} holds shards of another layout: {there}")
    dealt = rows.withColumn("shard", F.expr(f"slot div {shard_rows}"))
    for r in range(min(rounds, shards)):
        own_path = f"{path}/round={r}"
        if common.exists(spark, f"{own_path}/_SUCCESS"):
            continue
        first, last = r * shards // min(rounds, shards), (r + 1) * shards // min(rounds, shards)
        n = min(last - first, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
        own = dealt.where((F.col("shard") >= first) & (F.col("shard") < last))
        # ranges of shards by arithmetic: slots are even, so no sample of the rows is needed to cut them
        own = own.repartitionById(n, F.expr(f"cast((shard - {first}) * {n} div {last - first} as int)")).sortWithinPartitions("shard", "slot")
        out = own.select("shard", "doc", "seq", "n", "z").mapInArrow(record, "shard long, value binary")
        with common.batches_of(spark, common.TEXTS):
            out.select("shard", F.col("value").cast("string").alias("value")).write.mode("overwrite").partitionBy("shard").option("lineSep", "\n").text(own_path)
        del own, out
        common.release(spark)
    common.discard(sequences)
    return total


def read_shards(spark: SparkSession, path: str, seq_len: int = 512, shard_rows: int = 8192) -> DataFrame:
    """slot, shard, doc (null restored), seq, n, ids as uint16 bytes, and offset, the record's byte in its shard."""
    kind = record_type(seq_len)

    def parse(batches):
        for b in batches:
            for where, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                shard = int(where.rsplit("shard=", 1)[1].split("/", 1)[0])
                if len(raw) % kind.itemsize:
                    raise ValueError(f"{where}: not a whole number of records")
                r = np.frombuffer(raw, kind)
                if (r["end"] != 10).any():
                    raise ValueError(f"{where}: a record is out of place")
                for i in range(0, len(r), 1024):
                    p = r[i : i + 1024]
                    at = np.arange(i, i + len(p), dtype=np.int64)
                    doc = pa.array(p["doc"].copy(), pa.int64(), mask=p["doc"] == NULL_ID)
                    ids = pa.array([x[:n].tobytes() for x, n in zip(p["ids"], p["n"], strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(at + shard * shard_rows), pa.array(np.full(len(p), shard, np.int64)), doc, pa.array(p["seq"].copy()), pa.array(p["n"].copy()), ids, pa.array(at * kind.itemsize)], ["slot", "shard", "doc", "seq", "n", "ids", "offset"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    schema = "slot long, shard long, doc long, seq int, n int, ids binary, offset long"
    return files.load(path).select("path", "content").mapInArrow(parse, schema)

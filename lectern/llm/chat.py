"""Chat formatting by token-level assembly.

Each turn's role and text are encoded on their own, as ordinary text; reserved ids, which no text can
produce, are spliced between the segments. Positions of segments in a conversation are running sums of
their lengths, and the loss mask is the range of positions of each assistant text.

Template, for each turn: START role "\\n" text END "\\n". The strings of the reserved ids are escaped in
roles and texts: "<", any number of backslashes, "|" gains one backslash. unescape() takes it away.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: The ids of START and END lie this far above the vocabulary.
START_AT, END_AT = 1, 2
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """A byte-level BPE from a rank file; decode() takes ids of the vocabulary only."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("lectern", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.encode = self.encoding.encode_ordinary

    def decode(self, ids) -> str:
        return self.encoding.decode_bytes(list(ids)).decode("utf-8", "surrogatepass")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One for each path and worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def format_chat(turns: DataFrame, tokenizer: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """One row per turn, in order: conv_id, n (0.. in the conversation), ids, first and last (exclusive)
    position in the conversation's token sequence, loss_first and loss_last (equal if nothing is learnt).

    A conversation's sequence is its rows' ids, one after another: no row holds more than one turn, so a
    conversation of any length needs little memory. Texts are encoded before the shuffle; then each
    conversation passes through one task as a stream. Null role or text: empty; a null conversation is a
    conversation; equal turn numbers are ordered by role, then text, both by their UTF-8 bytes; repeated rows are
    repeated turns.
    Null turn numbers come first. Other columns are not read. A conversation without rows has no output.
    """
    kind = turns.schema[conv_col].dataType.simpleString()
    rows = turns.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("t"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("r"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("x"))
    turn_kind = rows.schema["t"].dataType.simpleString()

    def encode(batches):
        cod = codec(tokenizer)
        start, end = cod.size + START_AT, cod.size + END_AT
        nl = cod.encode("\n")
        for b in batches:
            ids, a, z = [], [], []
            for r, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                head = [start, *cod.encode(escape_role(r)), *nl]
                body = cod.encode(escape(x))
                ids.append(array("I", [*head, *body, end, *nl]).tobytes())
                loss = len(body) if r == LOSS_ROLE else 0
                a.append(len(head))
                z.append(len(head) + loss)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary()), pa.array(a, pa.int64()), pa.array(z, pa.int64())], ["c", "t", "r", "x", "ids", "a", "z"])

    coded = rows.mapInArrow(encode, f"c {kind}, t {turn_kind}, r string, x string, ids binary, a long, z long")
    coded = (coded.repartition(partitions, "c") if partitions else coded.repartition("c")).sortWithinPartitions("c", "t", "r", "x").drop("t", "r", "x")

    def place(batches):
        at, n, last = 0, 0, (False, None)
        for b in batches:
            cs = b.column(0).to_pylist()
            raw = b.column(1).to_pylist()
            lens = [len(x) // 4 for x in raw]
            a, z = b.column(2).to_pylist(), b.column(3).to_pylist()
            no, first, stop, lf, ll = [], [], [], [], []
            for i, c in enumerate(cs):
                if (True, c) != last:
                    at, n, last = 0, 0, (True, c)
                no.append(n)
                first.append(at)
                stop.append(at + lens[i])
                lf.append(at + a[i])
                ll.append(at + z[i])
                at, n = at + lens[i], n + 1
            big = pa.int64()
            flat = pa.array(np.frombuffer(b"".join(raw), "<i4"))
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)].astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(no, big), ids, *(pa.array(v, big) for v in (first, stop, lf, ll))], ["c", "n", "ids", "first", "last", "loss_first", "loss_last"])

    out = coded.mapInArrow(place, f"c {kind}, n long, ids array<int>, first long, last long, loss_first long, loss_last long")
    return out.withColumnRenamed("c", conv_col)


def read_back(formatted: DataFrame, tokenizer: str, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the ids and masks alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    formatted must be as format_chat() left it, each conversation in one partition and in order. Digests
    are carried along the stream, so memory doesn't grow with a conversation.
    """
    kind = formatted.schema[conv_col].dataType.simpleString()
    rows = formatted.select(F.col(conv_col).alias("c"), "n", "ids", "first", "loss_first", "loss_last")
    schema = f"c {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        cod = codec(tokenizer)
        start, end = cod.size + START_AT, cod.size + END_AT
        fresh = lambda c: {"c": c, "n": 0, "turns": hashlib.sha256(), "loss": 0, "lost": hashlib.sha256(), "chars": 0}
        names = ["c", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def batch(done):
            cols = list(zip(*[(s["c"], s["n"], s["turns"].hexdigest(), s["loss"], s["lost"].hexdigest(), s["chars"]) for s in done], strict=True))
            kinds = [ctype, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds, strict=True)], names)

        state, ctype = None, None
        for b in batches:
            ctype, done = b.schema.field(0).type, []
            for c, n, ids, first, lf, ll in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if n == 0:
                    if state:
                        done.append(state)
                    state = fresh(c)
                if ids[0] != start or end not in ids:
                    raise ValueError("a turn lacks its reserved ids")
                stop = len(ids) - 1 - ids[::-1].index(end)
                inside, tail = cod.decode(ids[1:stop]), cod.decode(ids[stop + 1 :])
                role, _, text = inside.partition("\n")
                whole = unescape_role(role) + "\n" + unescape(text) + "\n"
                state["turns"].update(whole.encode("utf-8", "surrogatepass"))
                masked = unescape(cod.decode(ids[lf - first : ll - first]))
                state["lost"].update(masked.encode("utf-8", "surrogatepass"))
                state["loss"] += len(masked)
                state["chars"] += len(START) + len(inside) + len(END) + len(tail)
                state["n"] += 1
            if done:
                yield batch(done)
        if state:
            yield batch([state])

    return rows.mapInArrow(run, schema).withColumnRenamed("c", conv_col)

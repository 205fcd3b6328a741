"""Functions that Spark has no expression for, as pandas UDFs over whole columns. Filter before you call them."""

from __future__ import annotations

import bisect
import difflib
import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHUNKS = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("op", "before", "after")]))
_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("pattern", T.StringType()), T.StructField("value", T.StringType())]))


def _fold(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


@F.pandas_udf(T.StringType())
def accent_fold(c: pd.Series) -> pd.Series:
    """NFKD without combining marks."""
    return c.map(_fold, na_action="ignore")


@F.pandas_udf(T.StringType())
def nfc(c: pd.Series) -> pd.Series:
    return c.map(lambda s: unicodedata.normalize("NFC", s).replace("\u00ad", ""), na_action="ignore")


@F.pandas_udf(T.StringType())
def unescape_html(c: pd.Series) -> pd.Series:
    return c.map(html.unescape, na_action="ignore")


def similarity(autojunk: bool = True):
    """Ratcliff-Obershelp ratio; not symmetric, and autojunk matters for long texts."""

    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y, autojunk).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


def diff_chunks(context: int = 80, most: int = 5):
    """The first changes between two texts, each with context."""

    @F.pandas_udf(_CHUNKS)
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a.fillna(""), b.fillna(""), strict=True):
            ops = [o for o in difflib.SequenceMatcher(None, x, y, False).get_opcodes() if o[0] != "equal"][:most]
            out.append([{"op": o, "before": x[max(0, i - context) : j + context], "after": y[max(0, k - context) : n + context]} for o, i, j, k, n in ops])
        return pd.Series(out)

    return run


def clean_caption(s: str) -> str:
    """A caption without tags and cues in brackets, entities decoded, white space as one blank."""
    return " ".join(re.sub(r"\[[^\]]*\]", " ", html.unescape(re.sub(r"<[^>]*>", "", s))).split())


@F.pandas_udf(T.StringType())
def caption_text(c: pd.Series) -> pd.Series:
    return c.map(clean_caption, na_action="ignore")


@F.pandas_udf(T.StringType())
def unhyphenated(c: pd.Series) -> pd.Series:
    """NFC without soft hyphens; words that a line break has cut are put together."""
    return c.map(lambda s: re.sub(r"(?<=\w)-\s*\n\s*(?=[a-z\u00df-\u00ff])", "", unicodedata.normalize("NFC", s).replace("\u00ad", "")), na_action="ignore")


@F.pandas_udf(T.StringType())
def repair_mojibake(c: pd.Series) -> pd.Series:
    """UTF-8 that was read as Windows-1252, where reading it back works and leaves fewer odd characters."""

    def one(s: str) -> str:
        try:
            t = s.encode("cp1252").decode("utf-8")
        except UnicodeError:
            return s
        return t if len(t) < len(s) else s

    return c.map(one, na_action="ignore")


def greedy(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Non-overlapping spans, the longest first; ties by name, then by start."""
    kept: list[tuple[int, int, str]] = []  # in order of position, so that neighbours decide
    for span in sorted(spans, key=lambda s: (s[0] - s[1], s[2], s[0])):
        i = bisect.bisect(kept, span)
        if (i == 0 or kept[i - 1][1] <= span[0]) and (i == len(kept) or kept[i][0] >= span[1]):
            kept.insert(i, span)
    return kept


@F.pandas_udf(_SPANS)
def greedy_spans(found: pd.Series) -> pd.Series:
    """Of a row's occurrences (first, last, pattern, value) those that greedy() keeps, in order of position."""
    out = []
    for row in found:
        value = {s["pattern"]: s["value"] for s in row} if row is not None else {}
        kept = greedy([(s["first"], s["last"], s["pattern"]) for s in row]) if row is not None else []
        out.append([{"first": a, "last": z, "pattern": p, "value": value[p]} for a, z, p in kept])
    return pd.Series(out)


def best_lines(words: list[str], lines: int, most: float = float("inf")) -> list[str]:
    """Words in so many lines of nearly equal length: the least sum of squared differences from the mean, and of
    what lines are longer than most."""
    n, lines = len(words), max(1, min(lines, len(words)))
    size = [len(w) for w in words]
    goal = (sum(size) + n - lines) / lines
    length = lambda i, j: sum(size[i:j]) + j - i - 1
    best = {(0, 0): (0.0, ())}
    for k in range(1, lines + 1):
        for j in range(k, n - (lines - k) + 1):
            found = [(best[k - 1, i][0] + (length(i, j) - goal) ** 2 + max(0.0, length(i, j) - most) ** 2, (*best[k - 1, i][1], i)) for i in range(k - 1, j) if (k - 1, i) in best]
            best[k, j] = min(found)
    cuts = [*best[lines, n][1], n] if n else [0, 0]
    return [" ".join(words[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]


def line_breaks(lines: int = 3):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda s: best_lines((s or "").split(), lines))

    return run


def matched(rows: list[tuple], reach: float) -> list[tuple]:
    """(opener, closer) of rows (order, kind, at) in order. Where at never falls, the first unused closer after an opener
    is the only one in question, and one pass does; else later ones are tried as well."""
    closers = [i for i, (_, k, _) in enumerate(rows) if k == "close"]
    rising = all(a[2] <= b[2] for a, b in zip(rows, rows[1:], strict=False))
    out, used, first = [], set(), 0
    for i, (o, k, v) in enumerate(rows):
        if k != "open":
            continue
        while first < len(closers) and (closers[first] < i or closers[first] in used):
            first += 1
        for c in closers[first : first + 1] if rising else closers[first:]:
            if c not in used and rows[c][2] - v <= reach:
                used.add(c)
                out.append((o, rows[c][0]))
                break
    return out


def one_to_one(df, keys: list[str], order: str, kind: str, at: str, reach: float):
    """Openers matched with the first unused closer after them within reach, in order; a matching, not a join."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        out = matched(list(zip(pdf[order], pdf[kind], pdf[at], strict=True)), reach)
        got = pd.DataFrame(out, columns=["opener", "closer"])
        for c in keys:
            got[c] = pdf[c].iloc[0]
        return got[[*keys, "opener", "closer"]]

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in keys), f"opener {kinds[order]}", f"closer {kinds[order]}"])
    return df.groupBy(*keys).applyInPandas(run, schema)


def tempo_steps(x: float) -> list[float]:
    """A tempo as factors in [0.5, 2]; a factor within 0.001 of one is left out."""
    if x <= 0:
        raise ValueError("a tempo is greater than zero")
    out = []
    while x > 2 or x < 0.5:
        out.append(2.0 if x > 2 else 0.5)
        x /= out[-1]
    return [*out, x] if abs(x - 1.0) > 0.001 else out

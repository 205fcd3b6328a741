"""Curly quotes: a machine over characters, given as a table of transitions.

Its state says, for double and for single marks, whether the next one may open. A mark looks at the characters beside it;
the first row of the table that fits gives the curly mark and the new state. Names of TeX commands are passed over. At the end
of a text any character may follow, for the sentence goes on in the next one.
"""

from __future__ import annotations

import re
from itertools import product

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOUBLE, SINGLE = 1, 2
#: Both kinds may open.
START = DOUBLE | SINGLE
STATES = 4
#: Sides of a mark: w letter or digit, b beginning, e end, s white space, o what opens, h other marks that open, c what closes, r and
#: l curly marks, x anything else.
_KIND = {**dict.fromkeys("([{", "o"), **dict.fromkeys("/<–—-~", "h"), **dict.fromkeys(")]", "c"), "’": "r", **dict.fromkeys("‘“", "l")}
#: mark, before, after, bit that must be set, result, bits set, bits cleared.
TABLE = (
    ("'", "wc", "wre", 0, "’", 0, 0),
    ("'", "", "woe", SINGLE, "‘", 0, SINGLE),
    ("'", "bsoh", "woe", 0, "‘", 0, 0),
    ("'", "", "", 0, "’", SINGLE, 0),
    ('"', "", "", DOUBLE, "“", 0, DOUBLE),
    ('"', "bsoh", "wole", 0, "“", 0, DOUBLE),
    ('"', "", "", 0, "”", DOUBLE, 0),
)
_STEP = {}
for _m, _b, _a, _s in product("'\"", "bwsohcrlx", "ewsohcrlx", range(STATES)):
    _row = next(r for r in TABLE if r[0] == _m and (not r[1] or _b in r[1]) and (not r[2] or _a in r[2]) and _s & r[3] == r[3])
    _STEP[_m, _b, _a, _s] = (_row[4], (_s | _row[5]) & ~_row[6])
_ALL = {k[:3]: [_STEP[(*k[:3], s)][1] for s in range(STATES)] for k in _STEP}
_MARK = re.compile(r"\\[^\W\d_]+|['\"]")
_SKIPPED = re.compile(r"https?://|doi\.org|@")


def kind(c: str, edge: str) -> str:
    return edge if not c else "w" if c.isalnum() else "s" if c.isspace() else _KIND.get(c, "x")


def curled(text: str, state: int = START) -> tuple[str, int]:
    """The text with curly quotes, and the state behind it."""
    out, at = [], 0
    for m in _MARK.finditer(text):
        if m[0][0] == "\\":
            continue
        i = m.start()
        mark, state = _STEP[m[0], kind(text[i - 1 : i], "b"), kind(text[i + 1 : i + 2], "e"), state]
        out += [text[at:i], mark]
        at = i + 1
    return turned("".join([*out, text[at:]])), state


def turned(text: str) -> str:
    """Marks that a text's cut has left the wrong way round: an opening one behind a word and before a stop closes, and a
    closing one at the beginning, before a letter, opens if another closes after it in the same group."""
    if "“" not in text and "’" not in text:
        return text
    out, closes = list(text), False
    for i in range(len(text) - 1, -1, -1):
        c, before, after = text[i], text[i - 1 : i] if i else "", text[i + 1 : i + 2]
        if c == "“" and after and (after in ",.)" or after.isspace()) and before and (before in "])’”.~" or before.isascii() and before.isalnum()):
            out[i] = "”"
        elif c == "’":
            if closes and before in ("", "~") and after.isascii() and after.isalpha():
                out[i] = "‘"
            closes = True
        elif c in "{}":
            closes = False
    return "".join(out)


def skipped(text: str | None) -> bool:
    """Links, addresses and blank texts are left alone, and leave the state alone."""
    return text is None or not text.strip() or _SKIPPED.search(text) is not None


def step(text: str | None) -> list[int]:
    """For each state before a text the state behind it, by one pass for all states."""
    f = list(range(STATES))
    if skipped(text):
        return f
    for m in _MARK.finditer(text):
        if m[0][0] != "\\":
            i = m.start()
            g = _ALL[m[0], kind(text[i - 1 : i], "b"), kind(text[i + 1 : i + 2], "e")]
            f = [g[s] for s in f]
    return f


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def steps(c: pd.Series) -> pd.Series:
    return c.map(step)


@F.pandas_udf(T.StringType())
def curly(c: pd.Series, state: pd.Series) -> pd.Series:
    return pd.Series([s if skipped(s) else curled(s, int(k))[0] for s, k in zip(c, state, strict=True)])

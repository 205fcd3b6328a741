"""Prose for reading aloud: tokens, a tree of brackets, and rules over tokens.

What a reader wouldn't say goes: addresses, links, references to figures and to literature. A bracket is judged by what
it holds once the brackets inside it are settled: a reference goes, other words in round brackets become a clause between commas, and
in square ones part of the sentence. Brackets without a partner are blanks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import mapped

#: Kinds of tokens, tried in this order.
KINDS = {
    "mail": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+",
    "link": r"(?:https?|ttps)://\S+|www\.\S+",
    "short": r"\b(?:e\.g\.|i\.e\.)",
    "word": r"[^\W\d_](?:[\w'’-]*\w)?",
    "number": r"\d+[a-zA-Z]?\b|\d+",
    "open": r"[(\[]",
    "close": r"[)\]]",
    "blank": r"\s+",
    "mark": r"[\s\S]",
}
_TOKEN = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS.items()))
SHORT = {"e.g.": "for example", "i.e.": "that is"}
#: What marks a bracket as a reference wherever it stands, and what does at its beginning.
ANYWHERE = ("doi", "http", "www.", "fig", "table", "et al.")
AT_FIRST = ("for example", "that is", "cf.", "see", "reviewed in", "for a review")
PICTURES = ("fig", "figure", "table")
PAUSES, STOPS = "—–…", ",.;:!?"


@dataclass(slots=True)
class Token:
    kind: str
    text: str
    apart: bool  # white space before it


def tokens(text: str) -> list[Token]:
    out, apart = [], False
    for m in _TOKEN.finditer(text):
        kind, t = m.lastgroup, m[0]
        if kind in ("mail", "link", "blank") or t in "{}":
            apart = True
            continue
        if t in PAUSES:
            kind, t, apart = "mark", ",", False
        elif t == "&":
            kind, t, apart = "word", "and", True
        elif kind == "short":
            kind, t = "word", SHORT[t]
        out.append(Token(kind, t, apart))
        apart = m[0] in PAUSES or m[0] == "&"
    return out


def joined(ts: list[Token]) -> str:
    return "".join(" " * t.apart + t.text for t in ts).strip()


def is_reference(ts: list[Token]) -> bool:
    said = joined(ts).lower()
    if any(m in said for m in ANYWHERE) or said.startswith(AT_FIRST):
        return True
    if any(t.kind == "number" and len(t.text.rstrip("abcdefghijklmnopqrstuvwxyz")) >= 4 for t in ts):
        return True
    return any(a.kind == "word" and len(a.text) > 1 and b.text == "," and not b.apart for a, b in zip(ts, ts[1:], strict=False))


def unbracketed(ts: list[Token]) -> list[Token]:
    """From the inside out, with a stack of what is open."""
    levels: list[tuple[str, bool, list[Token]]] = [("", False, [])]
    for t in ts:
        if t.kind == "open":
            levels.append((t.text, t.apart, []))
        elif t.kind == "close" and len(levels) > 1 and levels[-1][0] + t.text in ("()", "[]"):
            bracket, apart, inner = levels.pop()
            words = [x for x in inner if x.text not in STOPS]
            if not inner or is_reference(inner) or bracket == "[" and not words:
                inner = []
            elif bracket == "(":
                inner = [Token("mark", ",", False), *inner, Token("mark", ",", False)]
                inner[1].apart = True
            else:
                inner[0].apart |= apart
            levels[-1][2].extend([*inner, Token("mark", "", True)])
        elif t.kind == "close":
            levels[-1][2].append(Token("mark", "", True))
        else:
            levels[-1][2].append(t)
    out: list[Token] = []
    for _, _, inner in levels:
        out += [*([Token("mark", "", True)] if out else []), *inner]
    return out


def without_pictures(ts: list[Token]) -> list[Token]:
    """No "see fig. 3a": a picture's name, a number, and "see" before them."""
    out, i = [], 0
    while i < len(ts):
        at = i + (ts[i].text.lower() == "see" and i + 1 < len(ts))
        if ts[at].text.lower() in PICTURES:
            n = at + 1 + (at + 1 < len(ts) and ts[at + 1].text == "." and ts[at].text.lower() == "fig")
            if n < len(ts) and ts[n].kind == "number":
                out.append(Token("mark", "", True))
                i = n + 1
                continue
        out.append(ts[i])
        i += 1
    return out


def _name(ts: list[Token], i: int) -> bool:
    return i < len(ts) and ts[i].kind == "word" and len(ts[i].text) > 1 and "A" <= ts[i].text[0] <= "Z"


def _says(ts: list[Token], i: int, *texts: str) -> bool:
    return [t.text for t in ts[i : i + len(texts)]] == list(texts)


def without_authors(ts: list[Token]) -> list[Token]:
    """No "Name and Name, 1999" and no "Name et al."."""
    ts = [t for i, t in enumerate(ts) if t.text or not (i and not ts[i - 1].text)]
    out, i = [], 0
    while i < len(ts):
        if _name(ts, i):
            j = i + 1
            if _says(ts, j, "and") and _name(ts, j + 1):
                j += 2
            others = _says(ts, j, "et", "al", ".")
            year = j + 3 * others + (_says(ts, j + 3 * others, ",") * 1)
            if year < len(ts) and ts[year].kind == "number" and re.fullmatch(r"\d{4}[a-z]?", ts[year].text):
                out.append(Token("mark", "", True))
                i = year + 1
                continue
            if _says(ts, i + 1, "et", "al", "."):
                out.append(Token("mark", "", True))
                i += 4
                continue
        out.append(ts[i])
        i += 1
    return out


def tidy(ts: list[Token]) -> str:
    """No blank before a stop, no stop twice, no comma before another stop, a pause for a dash between words."""
    out: list[Token] = []
    apart = False
    for i, t in enumerate(ts):
        if not t.text:
            apart = True
            continue
        t = Token(t.kind, t.text, t.apart or apart)
        apart = False
        if t.text == "-" and t.apart and i + 1 < len(ts) and ts[i + 1].apart:
            t = Token("mark", ",", False)
        if t.kind == "mark" and t.text in STOPS:
            last = out[-1].text if out else ""
            if t.text == last and t.text in ",.;:":
                continue
            if last == ",":
                out.pop()
            t.apart = False
        out.append(t)
    return re.sub(r"\s+", " ", joined(out)).strip(" ,;:")


def spoken_text(text: str) -> str:
    return tidy(without_authors(unbracketed(without_pictures(tokens(text)))))


@F.arrow_udf(T.StringType())
def spoken(c: pa.Array) -> pa.Array:
    return mapped(c, spoken_text)

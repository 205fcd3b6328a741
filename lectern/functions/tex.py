"""TeX as plain text, by one pass over its tokens.

A text is cut into tokens, and every brace is paired with its partner (a stack, once). Commands are rewritten by rules that
name their arguments, which are ranges of tokens; what a rule keeps is worked off in its turn, so that nested commands cost no more than
others, at any depth. A command whose arguments are missing or not closed counts as one without a rule.

Variants say what becomes of commands, accents, ties and braces. They aren't interchangeable: each has its own use.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import mapped

_TOKEN = re.compile(r"\\[A-Za-z]+\*?|\\[^A-Za-z]|[{}\[\]~]|[^\\{}\[\]~]+|\\", re.S)
#: TeX's accent marks and the combining characters they stand for.
ACCENTS = {"`": "\u0300", "'": "\u0301", "^": "\u0302", "~": "\u0303", "=": "\u0304", '"': "\u0308"}


@dataclass(frozen=True)
class Variant:
    """rules: command to (number of arguments, what to put: argument numbers and texts); a name that begins with * stands for
    all that end so. texts: what single tokens become; marks: what is replaced in running text; other: what other commands become (None: they stay as they are); optional, first: whether their
    argument in brackets, and their first in braces, go along. accents: "keep", "drop" the mark or "join" it with its letter."""

    rules: dict[str, tuple[int, tuple]] = field(default_factory=dict)
    texts: dict[str, str] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)
    other: str | None = None
    optional: bool = True
    first: bool = False
    accents: str = "keep"
    braces: bool = False
    tie: str = "~"
    collapse: bool = False

    def rule(self, name: str):
        return self.rules.get(name) or next((r for k, r in self.rules.items() if k[0] == "*" and name.endswith(k[1:])), None)


def partners(tokens: list[str]) -> list[int]:
    """For each opening brace the place of its closing one, for each opening bracket that of the next closing one; else -1."""
    out, opened, bracket = [-1] * len(tokens), [], -1
    for i, t in enumerate(tokens):
        if t == "{":
            opened.append(i)
        elif t == "}" and opened:
            out[opened.pop()] = i
    for i in range(len(tokens) - 1, -1, -1):
        if tokens[i] == "]":
            bracket = i
        elif tokens[i] == "[":
            out[i] = bracket
    return out


def arguments(tokens: list[str], pair: list[int], at: int, n: int) -> list[tuple[int, int]] | None:
    """The ranges inside n groups of braces from at on, or None."""
    out = []
    while len(out) < n:
        if at >= len(tokens) or tokens[at] != "{" or pair[at] < 0:
            return None
        out.append((at + 1, pair[at]))
        at = pair[at] + 1
    return out


def rendered(text: str, v: Variant) -> str:
    tokens = _TOKEN.findall(text)
    pair = partners(tokens)
    out: list[str] = []
    silent: set[int] = set()  # braces that an accent has taken with it
    todo: list = [(0, len(tokens))]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        at, end = item
        if at >= end:
            continue
        t, after = tokens[at], at + 1
        if not t:
            pass
        elif t in v.texts:
            out.append(v.texts[t])
        elif t[0] == "\\" and t[1:2].isalpha():
            rule = v.rule(t[1:])
            args = rule and arguments(tokens, pair, after, rule[0])
            if args:
                todo.append((args[-1][1] + 1, end))
                todo += [args[p] if isinstance(p, int) else p for p in reversed(rule[1])]
                continue
            if v.other is None:
                out.append(t)
            else:
                out.append(v.other)
                held = v.braces and arguments(tokens, pair, after, 1)
                if held:  # its braces go with it
                    todo += [(held[0][1] + 1, end), held[0]]
                    continue
                if v.optional and after < end and tokens[after] == "[" and pair[after] > 0:
                    after = pair[after] + 1
                if v.first and after < end and tokens[after] == "{" and pair[after] > 0:
                    after = pair[after] + 1
        elif t[0] == "\\" and t[1:] in ACCENTS and v.accents != "keep":
            letter = after + (after < end and tokens[after] == "{")
            if v.accents == "join" and letter < end and tokens[letter][0].isalpha():
                if letter > after:
                    silent |= {after, pair[after]}
                out.append(unicodedata.normalize("NFC", tokens[letter][0] + ACCENTS[t[1:]]))
                tokens[letter] = tokens[letter][1:]
                todo.append((letter, end))
                continue
        elif t in ("{", "}"):
            holds_accent = v.accents == "join" and t == "{" and pair[at] > 0 and tokens[after][0] == "\\" and tokens[after][1:] in ACCENTS
            if holds_accent:
                silent |= {at, pair[at]}
            out.append(t if v.braces and at not in silent else "")
        else:
            for mark, by in v.marks.items():
                t = t.replace(mark, by)
            out.append(v.tie if t == "~" else t)
        todo.append((after, end))
    s = "".join(out)
    return re.sub(r"[ \t\n\r\f\v]+", " ", s).strip(" ") if v.collapse else s


_SHOWN = {"*CitationLink": (2, (1,)), "href": (2, (1,))}
#: A field of a bibliographic record: accents as letters, other commands replaced by what they hold.
RECORD = Variant(texts={r"\&": "&", r"\_": "_", r"\%": "%", r"\#": "#", r"\$": "$", r"\{": "{", r"\}": "}"}, marks={"``": "“", "''": "”"}, other="", optional=False, accents="join", braces=True)
#: Text to compare with that of a page: links shown, other commands replaced by what they hold.
BODY = Variant(rules=_SHOWN, texts={r"\&": "&", r"\%": "%"}, other="", tie=" ")
#: Text of a span beside others: percent escapes stay.
INLINE = Variant(rules=_SHOWN, texts={r"\&": "&"}, other="", tie=" ")
#: What counts as width: commands go with their argument.
LENGTH = Variant(other="", first=True)
#: Running text: shown arguments of links, colours and emphasis, a blank for any other command.
RUNNING = Variant(rules={**_SHOWN, "textcolor": (2, (1,)), **{c: (1, (0,)) for c in ("mbox", "textit", "emph", "textbf")}}, texts={r"\&": "&", r"\%": "%", r"\#": "#", r"\_": "_", r"\$": "$", r"\{": "", r"\}": "", r"\textquotedblleft": '"', r"\textquotedblright": '"', r"\par": " ", r"\textbackslash": "\\", r"\textasciitilde": "~", r"\textasciicircum": "^"}, other=" ", tie=" ", collapse=True)
#: Text that citations are looked up in: links shown, anchors and accent marks dropped, plain marks for named ones.
CITING = Variant(rules={"*CitationLink": (2, (1,)), "*RefAnchor": (1, ())}, texts={r"\&": "&", r"\textendash": "-", r"\textemdash": "-", r"\textquotedblleft": '"', r"\textquotedblright": '"', r"\textquotesingle": "'"}, other="", optional=False, accents="drop", collapse=True)


def _udf(v: Variant):
    @F.arrow_udf(T.StringType())
    def run(c: pa.Array) -> pa.Array:
        return mapped(c, lambda s: rendered(s, v))

    return run


def without_tex(c: Column, v: Variant) -> Column:
    """tex_text() of texts that are known to hold no backslash and no brace."""
    plain = F.replace(c, F.lit("~"), F.lit(v.tie))
    for mark, by in v.marks.items():
        plain = F.replace(plain, F.lit(mark), F.lit(by))
    return F.trim(F.regexp_replace(plain, r"[ \t\n\r\f\x0B]+", " ")) if v.collapse else plain


def tex_text(c: Column, v: Variant) -> Column:
    """c as the variant has it. Texts without TeX don't go to Python."""
    return F.when(c.rlike(r"[\\{}]"), _udf(v)(F.when(c.rlike(r"[\\{}]"), c))).otherwise(without_tex(c, v))


def rewritten(c: Column, rules: dict[str, tuple[int, tuple]]) -> Column:
    """c with commands replaced by their rules, and all else as it is."""
    return F.when(c.contains("\\"), _udf(Variant(rules=rules, braces=True))(F.when(c.contains("\\"), c))).otherwise(c)


def without_command(c: Column, name: str, keep: bool = False) -> Column:
    """c without \\name{...}; keep leaves the argument."""
    return rewritten(c, {name: (1, (0,) if keep else ())})

"""Expressions that rewrite lines, paths and records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse


def set_argument(line: Column, command: str, n: int, value: Column, digits: int = 3) -> Column:
    """The line with the n-th brace argument (from 1) of its first such command replaced by a number."""
    head = rf"^(.*?\\{command}(?:\{{[^}}]*\}}){{{n - 1}}}\{{)[^}}]+"
    return F.when(line.rlike(head), F.concat(F.regexp_extract(line, head, 1), F.format_string(f"%.{digits}f", value), F.regexp_replace(line, head, ""))).otherwise(line)


def display_lines(text: Column) -> Column:
    """The parts between manual line breaks, blank ones dropped."""
    return F.filter(F.transform(F.split(text, r"\s*\\\\\s*"), lambda x: F.trim(x)), lambda x: x != "")


def unbroken(text: Column) -> Column:
    """Manual line breaks as blanks."""
    return F.trim(F.regexp_replace(text, r"\s*\\\\\s*", " "))


def ensured(text: Column, marker: str, block: str) -> Column:
    """The text with block before it, unless it holds marker."""
    return F.when(F.contains(text, F.lit(marker)), text).otherwise(F.concat(F.lit(block), text))


def without_region(lines: Column, begin: str, end: str) -> Column:
    """An array of lines without those from each begin to the next end, both included; without an end, to the last line."""
    step = lambda s, x: F.struct(
        F.when(s["inside"] | (F.trim(x) == begin), s["kept"]).otherwise(F.concat(s["kept"], F.array(x))).alias("kept"),
        F.when(s["inside"], F.trim(x) != end).otherwise(F.trim(x) == begin).alias("inside"),
    )
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("inside"))
    return F.aggregate(lines, start, step, lambda s: s["kept"])


def pronounced(text: Column, words: dict[str, str]) -> Column:
    """Whole words as they are spoken, in the order given; cues in brackets and parentheses of stage directions go."""
    text = F.regexp_replace(text, r"\[(?:[^\[\]]*)\]|\((?i:laughs?|pause|applause|inaudible)\)", " ")
    for word, spoken in words.items():
        quoted = "".join("\\" + c if not c.isalnum() and c != " " else c for c in word)
        text = F.regexp_replace(text, rf"(?<![A-Za-z0-9]){quoted}(?![A-Za-z0-9])", spoken)
    return collapse(text)


def crop(text: Column, anchor: Column, most: int = 80, tokens: int = 8) -> Column:
    """struct(text, cropped): from where the anchor's first characters stand, else from where its first tokens do with
    any white space between; else the whole text."""
    text, start = collapse(text), F.substring(collapse(anchor), 1, most)
    at = F.instr(text, start)
    words = F.slice(F.regexp_extract_all(start, F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0)), 1, tokens)
    quoted = F.transform(words, lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E")))
    loose = F.concat(F.lit("(?s)^.*?("), F.array_join(quoted, "\\s+"), F.lit(".*)$"))
    tail = F.when(F.size(F.regexp_extract_all(start, F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0))) >= 5, F.nullif(F.call_function("regexp_extract", text, loose, F.lit(1)), F.lit("")))
    found = F.when((at > 0) & (start != ""), F.substring(text, at, F.length(text))).otherwise(tail)
    return F.struct(F.coalesce(found, text).alias("text"), found.isNotNull().alias("cropped"))


# --- keys, paths, nested values


def composite_key(issue: Column, slug: Column) -> Column:
    return F.concat_ws("/", issue, slug)


def issue_number(issue: Column) -> Column:
    return F.right(issue, F.lit(2))


def unit_of_path(path: Column, root: str) -> Column:
    """The folder of a file, relative to root."""
    return F.regexp_replace(F.regexp_replace(path, r"/[^/]*$", ""), "^" + root.rstrip("/") + "/?", "")


def rooted(path: Column, root: str) -> Column:
    """An absolute path as it is, another one under root."""
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def relative(path: Column, root: str) -> Column:
    r = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(r)), F.substring(path, len(r) + 1, 1 << 20)).otherwise(path)


def normalized_path(path: Column) -> Column:
    """Without "." and empty parts; ".." takes the part before it away."""
    step = lambda a, p: F.when((p == "") | (p == "."), a).when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p)))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/"))


def under(path: Column, root: str) -> Column:
    """Whether a path lies under root once it is normalized."""
    return F.startswith(normalized_path(path), F.lit(root.rstrip("/") + "/"))


def first_given(*values: Column) -> Column:
    """The first value that is neither null nor empty; else empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def merged(base: Column, over: Column) -> Column:
    """Two maps; where both have a key, the second wins."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)


def defaulted(base: Column, more: Column) -> Column:
    """Two maps; where both have a key, the first stays."""
    return merged(more, base)

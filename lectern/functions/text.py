"""Text functions as column expressions: no Python on the executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F



def collapse(c: Column) -> Column:
    """White space of any kind, no-break space included, to one space; trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; F.trim() takes blanks only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def fixed(c: Column, digits: int) -> Column:
    """A number with so many digits after the point; ties go to the even digit."""
    return F.format_string(f"%.{digits}f", F.bround(c, digits))


def normalize(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def slug(c: Column, separator: str = "_") -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", separator), f"^{separator}+|{separator}+$", "")


def replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Replacements one after another, in order: a later one sees what an earlier one wrote."""
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def word_count(c: Column, pattern: str = r"[A-Za-z0-9]+") -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def truncate(c: Column, n: int, mark: str = "...") -> Column:
    """At most n characters, cut at the last blank before, with a mark."""
    cut = F.regexp_replace(F.substring(c, 1, n - len(mark)), r"\s+\S*$", "")
    return F.when(F.length(c) <= n, c).otherwise(F.concat(cut, F.lit(mark)))


def split_list(c: Column, separator: str = ";") -> Column:
    return F.filter(F.split(c, separator), lambda x: x != "")


def first_match(c: Column, patterns: list[str]) -> Column:
    """Group 1 of the first pattern that matches; null if none does."""
    found = [F.regexp_extract(c, p, 1) for p in patterns]
    return F.coalesce(*[F.when(f != "", f) for f in found])


def video_id(c: Column) -> Column:
    return first_match(c, [r"[?&]v=([A-Za-z0-9_-]{6,})", r"youtu\.be/([A-Za-z0-9_-]{6,})", r"/(?:shorts|embed|live)/([A-Za-z0-9_-]{6,})"])


def year(c: Column) -> Column:
    """A year in parentheses, else the first of 1800 to 2099."""
    return first_match(c, [r"\((1[89]\d\d|20\d\d)[a-z]?\)", r"\b(1[89]\d\d|20\d\d)[a-z]?\b"])


def seconds(c: Column) -> Column:
    """HH:MM:SS.mmm or MM:SS.mmm in seconds; null if it is neither."""
    h = F.coalesce(F.expr("try_cast(null as double)"), F.when(F.regexp_extract(c, r"^(\d+):\d+:", 1) != "", F.regexp_extract(c, r"^(\d+):\d+:", 1).cast("double")), F.lit(0.0))
    m = F.regexp_extract(c, r"(\d+):[\d.,]+$", 1).try_cast("double")
    s = F.replace(F.regexp_extract(c, r":([\d.,]+)$", 1), F.lit(","), F.lit(".")).try_cast("double")
    return h * 3600 + m * 60 + s


def number(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def id_ranges(c: Column) -> Column:
    """"1,3-5" as [1, 3, 4, 5]."""
    parts = F.filter(F.split(F.regexp_replace(c, r"\s+", ""), ","), lambda p: p != "")
    ends = lambda p: F.sequence(F.substring_index(p, "-", 1).cast("long"), F.substring_index(p, "-", -1).cast("long"))
    return F.array_distinct(F.flatten(F.transform(parts, ends)))


def odd_characters(c: Column, ranges: str = r"\u02B0-\u02FF\u0600-\u09FF") -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(f"[{ranges}]"), F.lit(0))))


def found_patterns(c: Column, patterns: list[str]) -> Column:
    return F.array_sort(F.filter(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(c, p)))


def section(c: Column, heading: str, following: str, strict: bool = True) -> Column:
    """Text between two headings. Without the first: an error if strict, else the whole text."""
    after = F.substring_index(F.substring(c, F.instr(c, heading) + len(heading), 1 << 30), following, 1)
    missing = F.raise_error(F.lit(f"no heading {heading}")) if strict else c
    return strip(F.when(F.instr(c, heading) > 0, after).otherwise(missing))


def sentences(c: Column) -> Column:
    return F.filter(F.split(collapse(c), r"(?<=[.!?])\s+"), lambda s: s != "")


def pack(pieces: Column, most: int) -> Column:
    """Pieces (array of struct(text, alone)) joined by blanks into chunks of at most most characters, greedily; a piece
    that stands alone is a chunk. Each chunk copies the array of those before it: for texts of some thousand chunks."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))
    flushed = lambda s: F.when(s["cur"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["cur"])))

    def step(s, p):
        x = p["text"]
        keep = (s["cur"] == "") | (F.length(s["cur"]) + 1 + F.length(x) <= most)
        joined = F.when(s["cur"] == "", x).otherwise(F.concat(s["cur"], F.lit(" "), x))
        done = F.when(p["alone"], F.concat(flushed(s), F.array(x))).when(keep, s["done"]).otherwise(flushed(s))
        return F.struct(done.alias("done"), F.when(p["alone"], "").when(keep, joined).otherwise(x).alias("cur"))

    return F.aggregate(pieces, empty, step, flushed)


def _pieces(texts: Column, alone: bool) -> Column:
    return F.transform(texts, lambda x: F.struct(x.alias("text"), F.lit(alone).alias("alone")))


def sentence_chunks(c: Column, most: int) -> Column:
    """Sentences packed up to most characters; a longer sentence is cut into slices of most that stand by themselves."""
    cut = lambda s: F.transform(F.sequence(F.lit(0), F.floor((F.length(s) - 1) / most).cast("int")), lambda i: F.trim(F.substring(s, i * most + 1, F.lit(most))))
    parts = lambda s: F.when(F.length(s) <= most, _pieces(F.array(s), False)).otherwise(_pieces(F.filter(cut(s), lambda x: x != ""), True))
    return pack(F.flatten(F.transform(sentences(c), parts)), most)


def word_chunks(c: Column, most: int) -> Column:
    """As sentence_chunks, but a longer sentence is cut between words; a longer word is a chunk."""
    cut = lambda s: pack(_pieces(F.split(s, " "), False), most)
    parts = lambda s: F.when(F.length(s) <= most, _pieces(F.array(s), False)).otherwise(_pieces(cut(s), True))
    return pack(F.flatten(F.transform(sentences(c), parts)), most)


def join_tokens(tokens: Column) -> Column:
    """Tokens joined by blanks, but none before closing punctuation or after an opening bracket."""

    def step(s, x):
        tight = x.rlike(r"^[,.;:!?)\]]") | s.rlike(r"[(\[]$") | (s == "")
        return F.concat(s, F.when(tight, F.lit("")).otherwise(F.lit(" ")), x)

    return F.aggregate(tokens, F.lit(""), step)


def join_lines(lines: Column) -> Column:
    """Lines joined by blanks; a hyphen that ends a line before a lower-case letter becomes a blank, too."""
    step = lambda s, x: F.when(s == "", x).when(s.endswith("-") & x.rlike(r"^\p{Ll}"), F.concat(F.regexp_replace(s, "-$", " "), x)).otherwise(F.concat(s, F.lit(" "), x))
    return F.aggregate(lines, F.lit(""), step)


def escape_tex(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\textbackslash ")), r"([%&_#${}])", r"\\$1")


def escape_html(c: Column) -> Column:
    return replace_all(c, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")])


def escape_ffmetadata(c: Column) -> Column:
    return F.regexp_replace(c, r"([=;#\\\n])", r"\\$1")


def escape_concat(c: Column) -> Column:
    """A path between single quotes."""
    return F.replace(c, F.lit("'"), F.lit("'\\''"))


def escape_quoted(c: Column) -> Column:
    """Text between double quotes in TOML or JSON."""
    return replace_all(c, [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")])


def aliases(name: Column) -> Column:
    """Names by which a speaker may be labelled: as it is, with initials, initials and surname joined."""
    parts = F.regexp_extract_all(name, F.lit(r"\p{L}+"), F.lit(0))
    initials = F.array_join(F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))), lambda p: F.concat(F.substring(p, 1, 1), F.lit("."))), "")
    last = F.element_at(parts, -1)
    return F.array_distinct(F.array(name, F.concat_ws(" ", initials, last), F.concat(initials, last), last))


def speaker_segments(c: Column) -> Column:
    """"A.B. Surname: text" parts as (speaker, text); text before the first label has a null speaker."""
    label = r"((?:[A-Z]\.\s*)+[A-Z][\p{L}'-]+):\s*"
    parts = F.split(c, r"(?=(?:(?<=\s)|^)(?<![A-Z]\.\s)(?:[A-Z]\.\s?)+[A-Z][\p{L}'-]+:)")  # not inside initials
    return F.transform(F.filter(parts, lambda p: F.trim(p) != ""), lambda p: F.struct(F.when(F.regexp_extract(p, "^" + label, 1) != "", F.regexp_extract(p, "^" + label, 1)).alias("speaker"), F.trim(F.regexp_replace(p, "^" + label, "")).alias("text")))

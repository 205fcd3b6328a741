"""HTML extraction with the repeated strings of each host.

A page becomes blocks of text in page order, each with the zone it stands in: page furniture by markup
(menus, headers, footers, sidebars, notices, adverts, forms, reader comments), the page's article, or plain
ground. Where a host has ground, the token streams of its distinct pages are put together, and every string of
MIN_TOKENS tokens is sorted and counted: the host's suffix array, cut at that depth, for longer repeats are covered by
their own parts. Strings on MIN_PAGES distinct pages are repeated, and the tokens that they cover are boilerplate.
Furniture goes, and so does covered ground; the runs of ground that no repeated string covers stay on pages that mark no
article up, and on those whose ground holds more of such text than their articles do. The article of a page that marks one
up is its text whether or not another page repeats it: repetition alone cannot tell a copied article from a menu.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, neardup

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile(r"[<>\"']")
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPACE = re.compile(r"\s+")
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template textarea title svg iframe object select".split())
FURNITURE = frozenset("nav header footer aside form menu dialog button head".split())
MAIN = frozenset(["article", "main"])
#: Elements that do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element that opens here ends an open element of the same name (unclosed in much HTML).
CLOSES_ITSELF = frozenset("p li option tr td th dt dd".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class and id attributes that mark furniture.
HINTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices popup modal newsletter subscribe signup sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead comment comments disqus respond replies related recommended share sharing social toolbar pagination pager widget".split())
GROUND, ARTICLE, AWAY = 0, 1, 2
#: Repeated strings have at least so many tokens and stand on so many pages of a host.
MIN_TOKENS, MIN_PAGES = 8, 3
#: Strings are counted by the bucket that their first bits name, about so many in one; LOW_BYTES more of each travel.
STRINGS_PER_BUCKET, LOW_BYTES = 1 << 21, 5
#: A task sorts so many strings at once.
HELD = 2_000_000
#: Blocks of so many characters are written at once.
AT_ONCE = 4_000_000


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(text)}


def _zone(tag: str, attributes: str, inside: int) -> int:
    if inside == AWAY or tag in FURNITURE and not (tag == "header" and inside == ARTICLE):
        return AWAY
    if attributes and tag not in ("html", "body"):
        a = _attributes(attributes)
        if a.get("role", "").lower() in ROLES or "hidden" in re.findall(r"(?:^|\s)(hidden)(?=\s|$|=)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)) or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
            return AWAY
        if tag not in MAIN and HINTS.intersection(re.split(r"[^a-z]+", (a.get("class", "") + " " + a.get("id", "")).lower())):
            return AWAY
        if a.get("role", "").lower() == "main":
            return ARTICLE
    return ARTICLE if tag in MAIN else inside


class _Tags:
    """The tags of a page, one after another, in time that grows with its length: what can't end is looked for once."""

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ">\"'"}

    def end(self, at: int) -> int:
        """Where the > stands that ends a tag whose attributes begin at at; -1: it is no tag. Quoted text may hold any
        character; an unclosed quote is a character like others; < ends the attempt."""
        html, pos = self.html, at
        while m := _STOP.search(html, pos):
            c = m[0]
            if c == ">":
                return m.start()
            if c == "<":
                return -1
            if m.start() >= self.last[c]:
                pos = m.end()
            else:
                pos = html.index(c, m.end()) + 1
            if pos > self.last[">"]:
                break
        m = re.compile(r"[<>]").search(html, at) if self.last[">"] >= at else None
        return m.start() if m and m[0] == ">" else -1

    def __iter__(self):
        """(text before it, closing, name, attributes) of each tag, without a name at the end of the page."""
        html, at, begun = self.html, 0, 0
        while (k := html.find("<", at)) >= 0:
            if html.startswith("<!--", k):
                end = html.find("-->", k + 4)
                end = len(html) if end < 0 else end + 3
                yield html[begun:k], False, "", ""
                at = begun = end
                continue
            if k > self.last[">"]:
                after = html.find("<!--", k)
                if after < 0:
                    break
                at = after
                continue
            if html.startswith(("<!", "<?"), k):
                yield html[begun:k], False, "", ""
                at = begun = html.index(">", k) + 1
                continue
            m = _NAME.match(html, k + 1)
            end = self.end(m.end()) if m else -1
            if end < 0:
                at = k + 1
                continue
            at = end + 1
            skip = yield html[begun:k], m[1] == "/", m[2].lower(), html[m.end() : end]
            if skip:  # the element's content is no text
                found = re.compile(rf"</{re.escape(m[2])}\s*>", re.I).search(html, at)
                at = found.end() if found else len(html)
                yield None
            begun = at
        yield html[begun:], False, None, ""


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(zone, text) of each block in page order; white space is one space, references are decoded."""
    out: list[tuple[int, str]] = []
    piece: list[str] = []
    stack: list[tuple[str, int]] = []  # name, "" if it was closed out of turn, and the zone around it
    open_: dict[str, list[int]] = {}  # where in the stack the elements of a name are
    walls: list[int] = []  # and those that an element that closes itself doesn't reach through
    zone = GROUND

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(piece))).strip()
        piece.clear()
        if text:
            out.append((zone, text))

    def cut(k: int) -> None:
        while len(stack) > k:
            name, _ = stack.pop()
            if name:
                open_[name].pop()
            if walls and walls[-1] == len(stack):
                walls.pop()

    tags = iter(_Tags(html or ""))
    step = next(tags)
    while step is not None:
        text, close, tag, attributes = step
        piece.append(text)
        if tag is None:
            break
        skip = None
        if tag in RAW:
            skip = not close and not attributes.endswith("/") or None
        elif tag and close:
            if open_.get(tag):
                k = open_[tag][-1]
                new = stack[k][1]
                if tag in INLINE and new == zone:
                    if k == len(stack) - 1:
                        cut(k)
                    else:
                        open_[tag].pop()
                        stack[k] = ("", zone)
                else:
                    flush()
                    cut(k)
                    zone = new
            elif tag not in INLINE:
                flush()
        elif tag:
            if tag in VOID or attributes.endswith("/"):
                if tag not in INLINE:
                    flush()
            else:
                if tag in CLOSES_ITSELF and open_.get(tag) and (not walls or open_[tag][-1] > walls[-1]):
                    flush()
                    zone = stack[open_[tag][-1]][1]
                    cut(open_[tag][-1])
                new = _zone(tag, attributes, zone)
                if tag not in INLINE or new != zone:
                    flush()
                open_.setdefault(tag, []).append(len(stack))
                if tag not in INLINE and tag not in CLOSES_ITSELF:
                    walls.append(len(stack))
                stack.append((tag, zone))
                zone = new
        if skip:
            tags.send(True)
        step = next(tags)
    flush()
    return out


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        h = xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        if len(self) < neardup.CACHE:
            self[token] = h
        return h


def strings(host: str, tokens: list[str], hashes: dict, length: int = MIN_TOKENS) -> np.ndarray:
    """A 64-bit hash of host and string for each position at which a string of length tokens starts."""
    if len(tokens) < length:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    x = np.full(len(h) - length + 1, xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass")), np.uint64)
    for i in range(length):
        x = x * neardup._P + h[i : i + len(x)]
    return neardup._mix(x)


def _covered(n: int, hit: np.ndarray, length: int = MIN_TOKENS) -> np.ndarray:
    """Which of n positions lie in a string that starts where hit says."""
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(hit)
    edge[at] += 1
    edge[at + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _words(texts: list[str]) -> list[str]:
    return [t for b in texts for t in b.split(" ")]


def main_text(page: list[tuple[int, str]], covered: np.ndarray) -> str:
    """The main text of a page, from its blocks and the tokens that repeated strings cover."""
    article, ground, at = [], [], 0
    own = {ARTICLE: 0, GROUND: 0}
    both = []
    for zone, text in page:
        w = text.split(" ")
        mask = covered[at : at + len(w)]
        at += len(w)
        if zone == AWAY:
            continue
        own[zone] += int((~mask).sum())
        if zone == ARTICLE:
            article.append(text)
            both.append(text)
        elif run := " ".join(t for t, c in zip(w, mask, strict=True) if not c):
            ground.append(run)
            both.append(run)
    if not article:
        return " ".join(ground)
    return " ".join(both if own[GROUND] > own[ARTICLE] else article)


def _repeated_strings(pages: DataFrame, b: int) -> DataFrame:
    """h: the strings that stand on MIN_PAGES pages (host, texts) of a host or more, by the first b + 8 * LOW_BYTES bits of
    their hashes. A task sorts the strings of its pages, one of a kind for each page, and sends MIN_PAGES of a kind at
    most, for more decide nothing; so no string of a large host is frequent where it is counted."""
    keep = np.uint64(8 * LOW_BYTES)

    def spread(batches):
        hashes, parts, held = _Hashes(), [], 0

        def blobs():
            x = np.sort(np.concatenate(parts)) >> (np.uint64(64 - b) - keep)
            more = np.r_[np.zeros(MIN_PAGES, bool), x[MIN_PAGES:] == x[:-MIN_PAGES]] if len(x) > MIN_PAGES else np.zeros(len(x), bool)
            x = x[~more]
            cut = np.searchsorted(x, np.arange(1, 1 << b, dtype=np.uint64) << keep)
            low = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW_BYTES]
            found = [(i, p.tobytes()) for i, p in enumerate(np.split(low, cut)) if len(p)]
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())], ["b", "z"])

        for batch in batches:
            for host, texts in zip(batch.column(0), batch.column(1), strict=True):
                parts.append(np.unique(strings(host.as_py(), _words(texts.as_py()), hashes)))
                held += len(parts[-1])
                if held >= HELD:
                    yield blobs()
                    parts, held = [], 0
        if held:
            yield blobs()

    def count(table: pa.Table) -> pa.Table:
        low = np.frombuffer(b"".join(table.column("z").to_pylist()), np.uint8).reshape(-1, LOW_BYTES)
        x = np.zeros((len(low), 8), np.uint8)
        x[:, :LOW_BYTES] = low
        x = np.sort(x.view("<u8").ravel())
        edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        x = x[edge][np.diff(np.r_[edge, len(x)]) >= MIN_PAGES]
        return pa.table({"h": pa.array((x | np.uint64(table.column("b")[0].as_py()) << keep).view(np.int64))})

    return pages.select("host", "texts").mapInArrow(spread, "b int, z binary").groupBy("b").applyInArrow(count, "h long")


def _sketched(bits: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which of v the sketch names."""
    at = neardup._mix(v) >> np.uint64(64 - neardup.WANTED_BITS.bit_length() + 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _parsed(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Every page once, as a table: its blocks, a number of its own, a digest of its blocks, and whether it has ground."""

    def run(batches):
        for batch in batches:
            ids, urls, hosts = batch.column(0), batch.column(1), batch.column(3)
            found, first, held = [], 0, 0
            for i, h in enumerate(batch.column(2)):
                found.append(blocks(h.as_py()))
                held += sum(len(t) for _, t in found[-1])
                if held >= AT_ONCE or i == batch.num_rows - 1:
                    z = pa.array([[z for z, _ in f] for f in found], pa.list_(pa.int8()))
                    t = pa.array([[t for _, t in f] for f in found], pa.list_(pa.string()))
                    yield pa.RecordBatch.from_arrays([*[c.slice(first, len(found)) for c in (ids, urls, hosts)], z, t], ["id", "url", "host", "zones", "texts"])
                    found, first, held = [], i + 1, 0

    out = rows.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, host string, zones array<tinyint>, texts array<string>")
    out = out.withColumns({"page": F.monotonically_increasing_id(), "digest": F.md5(F.to_json("texts").cast("binary")), "open": F.array_contains("zones", F.lit(GROUND).cast("tinyint"))})
    return common.materialise(out, "pages", compression="zstd")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url and text of every row, "" if none.

    Pages are parsed once, into a table of their blocks. Strings are counted over all distinct pages of every host
    on which some page has ground, however many; pages of equal blocks are one page, so that repeated rows and mirrored
    pages don't take each other for boilerplate. Only pages with ground look their strings up: those that a sketch of fixed size
    names are joined with the repeated ones. Rows without a url share the empty host. Null or empty
    html has no text. Other columns are not read. Parsing takes time in proportion to the html, however it is broken.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    rows = rows.withColumn("host", host)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    parsed = _parsed(rows, kinds)
    schema = f"id {kinds['id']}, url {kinds['url']}, text string"

    def marked(batches):
        for batch in batches:
            texts = [" ".join(t for z, t in zip(zones, parts, strict=True) if z == ARTICLE) for zones, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    out = parsed.where("not open").select("id", "url", "zones", "texts").mapInArrow(marked, schema)
    ground = parsed.where("open")
    if not ground.isEmpty():
        out = out.unionByName(_with_ground(parsed, ground, schema))
    return out.withColumnsRenamed({"id": id_col, "url": url_col})


def _with_ground(parsed: DataFrame, ground: DataFrame, schema: str) -> DataFrame:
    """id, url and text of the pages that have ground, after the repeated strings of their hosts."""
    spark = parsed.sparkSession
    key = F.xxhash64("host")
    hosts = spark.sparkContext.broadcast(neardup._wanted(ground.select(key.alias("v")).distinct()))  # of fixed size
    one = parsed.groupBy("host", "digest").agg(F.min("page").alias("page"))
    own = parsed.select("host", "texts", "page", key.alias("key"))

    def of_hosts(batches):
        for batch in batches:
            yield batch.filter(pa.array(_sketched(hosts.value, batch.column(3).to_numpy().view(np.uint64)))).drop_columns(["key"])

    counted = own.mapInArrow(of_hosts, "host string, texts array<string>, page long").join(one.select("page"), "page", "left_semi")
    total = ground.agg(F.sum(F.length(F.array_join("texts", " ")))).first()[0] or 0
    b = max(8, min(20, (total // neardup.BYTES_PER_WORD // STRINGS_PER_BUCKET).bit_length()))
    shift = np.uint64(64 - b - 8 * LOW_BYTES)
    often = common.materialise(_repeated_strings(counted, b), "strings")
    common.release(spark)
    sketch = spark.sparkContext.broadcast(neardup._wanted(often.select(F.col("h").alias("v"))))  # of fixed size

    def look_up(batches):
        hashes = _Hashes()
        for batch in batches:
            for page, host, texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.unique(strings(host, _words(texts), hashes) >> shift)
                x = x[_sketched(sketch.value, x)]
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), page)), pa.array(x.view(np.int64))], ["page", "h"])

    hits = ground.select("page", "host", "texts").mapInArrow(look_up, "page long, h long").join(often, "h").groupBy("page").agg(F.collect_list("h").alias("hits"))
    hits = common.materialise(hits, "hits")
    common.release(spark)

    def clean(batches):
        hashes = _Hashes()
        for batch in batches:
            texts = []
            for host, zones, parts, found in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                page = list(zip(zones, parts, strict=True))
                tokens = _words(parts)
                repeats = np.sort(np.array(found or [], np.int64).view(np.uint64))
                texts.append(main_text(page, _covered(len(tokens), np.isin(strings(host, tokens, hashes) >> shift, repeats))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])

    return ground.join(hits, "page", "left").select("id", "url", "host", "zones", "texts", "hits").mapInArrow(clean, schema)

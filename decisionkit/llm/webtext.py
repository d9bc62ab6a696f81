"""HTML extraction by nearest-URL page differencing.

A page becomes text lines, one per block. Pages are ordered by (host, path, id); each is compared with the neighbour on either side that
shares the longer path with it, the one before in a tie. A longest common subsequence aligns the lines of the two pages, and the shared ones are
deleted as furniture of the site. Before that, menus, headers, footers, sidebars, notices, adverts,
forms and reader comments go whatever their text (by class or id only if the whole token names them, and never what holds an article). An article in a
sidebar, menu or footer that is closed goes with it. Where article lines hold at least half of the words, unmarked lines go, and the article's own lines go where the neighbour shares them,
unless those hold at least half of its words: near-equal articles are text too. On other pages article lines stay and the other lines go where they are shared.
A page whose lines are all shared keeps them: it is a copy. Lines are aligned by digests of 128 bits.

Nulls and odd rows: null or empty html gives the empty text; a null url is the host and path ""; broken markup is read as far as it goes; repeated
rows are neighbours and copies of each other; rows that share url and id go by a digest of their html; the partitions do not show in the result; an empty table gives an empty result; other
columns are not looked at. Long pages are aligned in linear memory.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import filled, sliced, staged, target_partitions

_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_BARE = re.compile(r"[^\"'>]*")
_LONG_NUMBER = re.compile(r"&#([0-9]{20,})")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math object audio video canvas xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = set("head nav header footer aside form menu dialog button select fieldset datalist".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: A class or id names furniture or remarks if all parts of it are such words or tell a place, so "no-sidebar", "has-banner" and "comments-open" name nothing.
NAMES = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|cookies?|notices?|consent|popup|modal|newsletter|subscribe|share|social|related|widget")
REMARKS = re.compile(r"comments?|replies|respond|disqus|commentlist")
PLACES = set("site page top bottom left right main primary secondary global mobile box list item links bar block area section wrap wrapper container".split())
REMARK_PLACES = PLACES | set("post article user reader thread body content text meta form".split())
SKIPPED = set("furniture named form remarks".split())
DIGEST = 16  # bytes of a line's digest
CLOSES_ITSELF = set("p li dt dd tr td th option thead tbody tfoot".split())


def has_main(lines: list[str], inside: list[bool]) -> bool:
    """Article lines hold at least half of the words; teasers beside a story do not."""
    words = [len(line.split()) for line in lines]
    return any(inside) and 2 * sum(n for n, keep in zip(words, inside) if keep) >= sum(words)


def _named(given: dict[str, str], words: re.Pattern, places: set[str]) -> bool:
    for token in f"{given.get('class', '')} {given.get('id', '')}".lower().replace("side-bar", "sidebar").split():
        parts = [p for p in re.split("[_-]+", token) if p and not p.isdigit()]
        named = [bool(words.fullmatch(p)) for p in parts]
        if any(named) and all(yes or p in places for yes, p in zip(named, parts)):
            return True
    return False


def _kind(name: str, attributes: str, within: bool) -> str:
    """'' for content, 'main', 'furniture' (by element, role or style), 'named' (furniture by class or id), 'form' or 'remarks'. Names do not
    make remarks of an article, unless it stands ``within`` another."""
    given = {}
    if attributes:
        given = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    role = given.get("role", "").lower()
    if "hidden" in given or given.get("aria-hidden") == "true" or role in ROLES or "display:none" in given.get("style", "").replace(" ", "").lower():
        return "furniture"
    main = name in ("article", "main") or role in ("main", "article") or given.get("itemprop", "") == "articleBody"
    if (within or not main) and name not in ("body", "html") and _named(given, REMARKS, REMARK_PLACES):
        return "remarks"
    if main:
        return "main"
    if name in FURNITURE:
        return "form" if name == "form" else "furniture"
    return "named" if name not in ("body", "html") and _named(given, NAMES, PLACES) else ""


class Tags:
    """Tags of a page in one pass forwards: (start, end, closing, name, attributes); the name is "" for comments and declarations.

    A tag ends at the first > outside quotes, or, where quotes never close, at the first >; without one, < is text. What a scan
    has learnt is kept: where the next > is, and which opening quotes lead to no end. So each stretch is read a bounded number of times, whatever is broken.
    """

    def __init__(self, source: str):
        self.source = source
        self.next_end = -1  # the first > at or after the place last asked for; len(source) if there is none
        self.lost: set[int] = set()  # quotes that, opening a value, lead to no >
        self.endless: set[str] = set()  # raw elements without a further closing tag

    def _end(self, at: int) -> int:
        if self.next_end < at:
            found = self.source.find(">", at)
            self.next_end = len(self.source) if found < 0 else found
        return self.next_end

    def _quoted_end(self, at: int) -> int:
        """The first > outside quotes, or -1."""
        source, tried = self.source, []
        while True:
            at = _BARE.match(source, at).end()
            if at == len(source):
                break
            if source[at] == ">":
                return at
            if at in self.lost:
                break
            tried.append(at)
            at = source.find(source[at], at + 1) + 1
            if not at:
                break
        self.lost.update(tried)
        return -1

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        source, n = self.source, len(self.source)
        while True:
            at = source.find("<", at)
            if at < 0:
                return None
            if source.startswith("<!--", at):
                found = source.find("-->", at + 4)
                return at, n if found < 0 else found + 3, False, "", ""
            if source.startswith(("<!", "<?"), at):
                end = self._end(at + 2)
                if end < n:
                    return at, end + 1, False, "", ""
            elif m := _NAME.match(source, at):
                first = end = self._end(m.end())
                if first < n:
                    if source[m.end()] == "/" or source[m.end()].isspace():
                        found = self._quoted_end(m.end())
                        end = first if found < 0 else found
                    return at, end + 1, source[at + 1] == "/", m.group(1).lower(), source[m.end() : end]
                at = m.end() - 1
            at += 1

    def past_raw(self, name: str, at: int) -> int:
        """Where the content of a raw element ends: after its closing tag, or at the end of the page."""
        stop = None if name in self.endless else re.compile(rf"</{name}\s*>", re.I).search(self.source, at)
        if stop:
            return stop.end()
        self.endless.add(name)
        return len(self.source)


def _tags(source: str) -> Iterator[tuple[int, bool, str, str]]:
    """(end, closing, name, attributes) of the tags outside raw text."""
    tags, at = Tags(source), 0
    while tag := tags.after(at):
        _, at, closing, name, attributes = tag
        if not name:
            continue
        if not closing and name in RAW and not attributes.endswith("/"):
            at = tags.past_raw(name, at)
            continue
        yield at, closing, name, attributes


def _decoded(text: str) -> str:
    """Character references as characters; a number of any length is one, and beyond Unicode it is U+FFFD."""
    return html.unescape(_LONG_NUMBER.sub(lambda m: "&#" + (m.group(1).lstrip("0")[:9] or "0"), text) if "&#" in text else text)


class Shape:
    """Which start tags of a page (by where they end) have a closing tag of their own, and where articles begin."""

    def __init__(self, source: str):
        self.closed: dict[int, int] = {}
        self.mains: list[int] = []
        opened: dict[str, list[int]] = {}
        for at, closing, name, attributes in _tags(source):
            if closing:
                if opened.get(name):
                    self.closed[opened[name].pop()] = at
            elif name not in VOID:
                opened.setdefault(name, []).append(at)
                if name in ("article", "main") or "article" in attributes.lower() or "main" in attributes.lower():
                    if _kind(name, attributes, False) == "main":
                        self.mains.append(at)

    def holds_main(self, at: int) -> bool:
        k = bisect.bisect_right(self.mains, at)
        return at in self.closed and k < len(self.mains) and self.mains[k] < self.closed[at]


class Stack:
    """Open elements, with the counts that make each question about them one step: how many of a name, which are skipped, and which of
    those an article may not leave (remarks, and elements with a closing tag of their own)."""

    def __init__(self, source: str):
        self.source = source
        self.open: list[tuple[str, str, int]] = []  # (element, kind, end of its tag)
        self.places: dict[str, list[int]] = {}  # where the elements of a name stand
        self.skipped: list[int] = []
        self.main = 0
        self._shape: Shape | None = None
        self._unclosed: Counter[str] = Counter()
        self._firm: list[int] = []  # skipped elements that hold what is in them

    @property
    def shape(self) -> Shape:
        if self._shape is None:
            self._shape = Shape(self.source)
            for k in range(len(self.open)):
                self._judge(k)
        return self._shape

    def _judge(self, k: int) -> None:
        """An element without a closing tag, or one that may have taken that of one around it, is left open."""
        name, kind, at = self.open[k]
        self._unclosed[name] += at not in self._shape.closed
        if kind in SKIPPED and (kind == "remarks" or not self._unclosed[name]):
            self._firm.append(k)

    def push(self, name: str, kind: str, at: int) -> None:
        k = len(self.open)
        self.open.append((name, kind, at))
        self.places.setdefault(name, []).append(k)
        self.main += kind == "main"
        if kind in SKIPPED:
            self.skipped.append(k)
        if self._shape:
            self._judge(k)

    def close(self, to: int) -> None:
        while len(self.open) > to:
            name, kind, at = self.open.pop()
            self.places[name].pop()
            self.main -= kind == "main"
            if self._shape:
                self._unclosed[name] -= at not in self._shape.closed
        for places in (self.skipped, self._firm):
            while places and places[-1] >= to:
                places.pop()

    def close_name(self, name: str) -> None:
        if self.places.get(name):
            self.close(self.places[name][-1])

    def on_top(self, name: str) -> bool:
        return bool(self.open) and self.open[-1][0] == name

    def can_leave(self) -> bool:
        """Whether all skipped elements around are ones that were never closed."""
        return bool(self.shape) and not self._firm


def blocks(source: str) -> tuple[list[str], list[bool]]:
    """Text lines of a page in order, without furniture, and whether each lies in the main element. The time grows with the page's length, whatever its markup."""
    lines: list[str] = []
    inside: list[bool] = []
    words: list[str] = []
    tags, stack = Tags(source), Stack(source)
    seen = False  # an article

    def flush() -> None:
        if words:
            line = _SPACE.sub(" ", "".join(words)).strip()
            words.clear()
            if line:
                lines.append(line)
                inside.append(stack.main > 0)

    at = 0
    while at < len(source):
        tag = tags.after(at)
        end = tag[0] if tag else len(source)
        if end > at and not stack.skipped:
            words.append(_decoded(source[at:end]))
        if not tag:
            break
        _, at, closing, name, attributes = tag
        if not name:
            continue
        if name not in INLINE:
            flush()
        elif name == "br":
            words.append(" ")
        if closing:
            stack.close_name(name)
            continue
        if name in RAW and not attributes.endswith("/"):
            at = tags.past_raw(name, at)
            continue
        if name in VOID or attributes.endswith("/") and name not in ("p", "div", "a"):
            continue
        if name not in INLINE and stack.on_top("p"):
            stack.close(len(stack.open) - 1)
        if name in CLOSES_ITSELF and stack.on_top(name):
            stack.close(len(stack.open) - 1)
        kind = _kind(name, attributes, stack.main > 0)
        if (kind in ("named", "form") or kind == "remarks" and not seen) and stack.shape.holds_main(at):
            kind = ""  # no name drops what is around an article
        if kind == "main" and stack.skipped and not stack.main:
            if stack.can_leave():
                stack.close(stack.skipped[0])  # an unclosed menu does not swallow the article
            else:
                kind = ""  # a teaser in a sidebar
        if name == "header" and stack.main and kind == "furniture":
            kind = ""  # the head of an article is text
        stack.push(name, kind, at)
        seen = seen or kind == "main"
    flush()
    return lines, inside


def _row(before: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Next row of the LCS table: the running maximum stands in for the dependence on the left neighbour."""
    out = np.zeros_like(before)
    np.maximum.accumulate(np.maximum(before[1:], before[:-1] + equal), out=out[1:])
    return out


def common_lines(a: np.ndarray, b: np.ndarray, cells: int = 1 << 22) -> list[tuple[int, int]]:
    """Pairs (i, j) of one longest common subsequence of two arrays; halves the first where the table would be too large."""
    if not len(a) or not len(b):
        return []
    if (len(a) + 1) * (len(b) + 1) <= cells or len(a) == 1:
        table = [np.zeros(len(b) + 1, np.int32)]
        for x in a:
            table.append(_row(table[-1], b == x))
        pairs, i, j = [], len(a), len(b)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((i, j))
        return pairs[::-1]
    half = len(a) // 2
    front = back = np.zeros(len(b) + 1, np.int32)
    for x in a[:half]:
        front = _row(front, b == x)
    for x in a[half:][::-1]:
        back = _row(back, b[::-1] == x)
    cut = int((front + back[::-1]).argmax())
    return common_lines(a[:half], b[:cut], cells) + [(i + half, j + cut) for i, j in common_lines(a[half:], b[cut:], cells)]


def digests_of(lines: list[str]) -> bytes:
    return b"".join(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=DIGEST).digest() for line in lines)


def shared_lines(page: bytes, near: bytes) -> set[int]:
    """Lines of a page that its neighbour shares, by their digests. Lines that stand in one of the two only change nothing in the alignment."""
    a, b = ([x[at : at + DIGEST] for at in range(0, len(x), DIGEST)] for x in (page, near))
    names = {line: k for k, line in enumerate(set(a) & set(b))}
    if not names:
        return set()
    places = [i for i, line in enumerate(a) if line in names]
    pairs = common_lines(np.array([names[a[i]] for i in places]), np.array([names[line] for line in b if line in names]))
    return {places[i] for i, _ in pairs}


def kept_lines(inside: list[bool], words: list[int], settled: bool, shared: set[int]) -> list[bool]:
    """Which lines of a page are its own, given those that its nearest neighbour shares."""
    if settled:
        article = sum(n for n, own in zip(words, inside) if own)
        if 2 * sum(words[i] for i in shared if inside[i]) >= article:
            return inside
        return [own and i not in shared for i, own in enumerate(inside)]
    if len(shared) == len(inside):
        return [True] * len(inside)
    return [own or i not in shared for i, own in enumerate(inside)]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in sliced(whole, "html"):
            found = [blocks(source) for source in batch.column("html").to_pylist()]
            columns = {name: batch.column(name) for name in batch.schema.names if name != "html"}
            columns["lines"] = pa.array([lines for lines, _ in found], pa.list_(pa.string()))
            columns["inside"] = pa.array([inside for _, inside in found], pa.list_(pa.bool_()))
            columns["settled"] = pa.array([has_main(*page) for page in found], pa.bool_())
            columns["words"] = pa.array([[len(line.split()) for line in lines] for lines, _ in found], pa.list_(pa.int32()))
            columns["digests"] = pa.array([digests_of(lines) for lines, _ in found], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, kept) of the pages that lose a line to their neighbour."""
    for batch in batches:
        rows, kept = [], []
        for row, inside, words, settled, page, near in zip(*(batch.column(c).to_pylist() for c in ("row", "inside", "words", "settled", "digests", "near_digests"))):
            shared = shared_lines(page, near)
            own = kept_lines(inside, words, settled, shared) if shared else None
            if own is not None and own != (inside if settled else [True] * len(inside)):
                rows.append(row)
                kept.append(own)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(kept, pa.list_(pa.bool_()))], names=["row", "kept"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(filled(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(filled(url), r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def _shared_path(other: str) -> Column:
    """Leading path parts in common with a neighbour; -1 on another host, or where there is no neighbour."""
    same = F.zip_with(F.split("path", "/"), F.split(F.col(f"{other}.path"), "/"), lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(F.col(f"{other}.host") == F.col("host"), F.when(first > 0, first - 1).otherwise(F.size(same))).otherwise(-1)


def nearest(parsed: DataFrame, rows_a_range: int = 1_000_000) -> DataFrame:
    """(row, near): for each page the page before or after it by (host, path, id, digest) that shares the longer path.

    Keys only. They are cut into ranges, and a range's first and last page look at the ranges beside it, which takes one row per range; so hosts of any size are
    split, and the ranges do not show in the result.
    """
    order = ["host", "path", "page_id", "digest", "row"]
    ranges = max(target_partitions(parsed.sparkSession), -(-parsed.count() // rows_a_range))
    keys = parsed.select(*order).repartitionByRange(ranges, *order)
    keys = staged(keys.withColumn("part", F.spark_partition_id()), "page-order")
    one, within, across = F.struct(*order), Window.partitionBy("part").orderBy(*order), Window.orderBy("part")
    edges = keys.groupBy("part").agg(F.min(one).alias("first"), F.max(one).alias("last"))
    edges = edges.select("part", F.lag("last").over(across).alias("left"), F.lead("first").over(across).alias("right"))
    beside = keys.withColumns({"before": F.lag(one).over(within), "after": F.lead(one).over(within)}).join(edges, "part")
    beside = beside.withColumns({"before": F.coalesce("before", "left"), "after": F.coalesce("after", "right")})
    beside = beside.withColumns({"n_before": _shared_path("before"), "n_after": _shared_path("after")})
    near = F.when(F.col("n_after") > F.col("n_before"), F.col("after.row")).when(F.col("n_before") >= 0, F.col("before.row"))
    return beside.select("row", near.alias("near"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars. Pages are parsed where they are read, and their lines written once. Every page is aligned with its nearest
    neighbour, by digests of its lines, so no text is shuffled for that; which lines stay is then joined to the pages that lose some."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), filled(F.col(html_col)).alias("html"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "digest": F.xxhash64("html"), "row": F.monotonically_increasing_id()})
    kind = rows.schema["page_id"].dataType.simpleString()
    read = f"page_id {kind}, url string, host string, path string, digest long, row long, lines array<string>, inside array<boolean>, settled boolean, words array<int>, digests binary"
    parsed = staged(rows.mapInArrow(_parse, read), "page-lines")
    near = nearest(parsed).filter("near IS NOT NULL")
    asked = parsed.select(F.col("row").alias("near"), F.col("digests").alias("near_digests")).join(near, "near").drop("near")
    pairs = parsed.select("row", "inside", "words", "settled", "digests").join(asked, "row")
    changed = staged(pairs.mapInArrow(_difference, "row long, kept array<boolean>"), "page-kept")  # a written table has a known size, so lines are shuffled only if many pages lose some
    own = F.filter("lines", lambda line, k: F.coalesce(F.get("kept", k), ~F.col("settled") | F.get("inside", k)))
    texts = parsed.join(changed, "row", "left").select("page_id", "url", F.array_join(own, "\n").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))

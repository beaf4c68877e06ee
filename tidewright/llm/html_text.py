"""The main text of web pages, with the lines that a site repeats taken out.

A page is read into lines, one a block element, without what its markup says is not
content. Pages of a host are paired with the one whose path (and query) is nearest, their
lines are aligned by longest common subsequence, and lines that both have are not the page's
own. Its own lines say what is its text: the marked articles that hold one, whole, or else
they themselves.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from itertools import takewhile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.names import column
from tidewright.work import stage

# Elements by what they mean for the text (fixed values).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
LEFT_OUT = frozenset(
    "nav header footer aside form button select option input menu dialog svg math canvas object embed head audio "
    "video map".split()
) | RAW
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
ROLES_LEFT_OUT = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form status".split()
)
NAMES_LEFT_OUT = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside widget widgets header masthead footer colophon comment comments commentlist respond replies "
    "disqus share sharing social related recommended newsletter subscribe subscription signup login search "
    "pagination pager skip toolbar".split()
)
# Parts of longer names, as in "comments-area" or "adSlot", and parts that make a name say something else.
PARTS_LEFT_OUT = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo cookie cookies consent gdpr popup navbar breadcrumb "
    "breadcrumbs sidebar comment comments commentlist disqus share sharing social newsletter subscribe subscription "
    "pagination".split()
)
PARTS_ELSE = frozenset("no not has with without open closed enabled disabled on off free".split())
COMMENT_PARTS = frozenset("comment comments commentlist disqus respond replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_COMMENTS = frozenset(("comment", "comments", "comment-body"))
_PART = re.compile(r"[A-Z]*[^A-Z\s]+|[A-Z]+")
_SPACES = re.compile(r"\s+")
_STEP = re.compile(r"[/\x01]")


@dataclass(frozen=True)
class Line:
    text: str
    part: int  # number of the outermost article or main part that it is in, or -1

    @property
    def is_main(self) -> bool:
        return self.part >= 0


def _is_left_out(tag: str, attributes: str) -> bool:
    if tag in LEFT_OUT:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    wanted = ("class", "id") if tag in MAIN else ("role", "hidden", "aria-hidden", "style")
    for match in _ATTRIBUTE.finditer(attributes) if wanted else ():
        name = match[1].lower()
        if name not in wanted:
            continue
        value = unescape(match[2] or match[3] or match[4] or "").lower()
        if name in ("class", "id"):
            if not _COMMENTS.isdisjoint(value.split()):
                return True
        elif (
            name == "hidden"
            or (name == "role" and value in ROLES_LEFT_OUT)
            or (name == "aria-hidden" and value == "true")
            or (name == "style" and re.search(r"display\s*:\s*none", value))
        ):
            return True
    return False


def _named(tag: str, attributes: str) -> str:
    """``comments`` or ``other`` if a class name or the id says that the element is not content, else empty.

    Of a block also a part of a longer name does, but for names like ``no-comments``.
    """
    if not attributes or tag in MAIN or tag in ("html", "body"):
        return ""
    found = ""
    for match in _ATTRIBUTE.finditer(attributes):
        if match[1].lower() not in ("class", "id"):
            continue
        for name in unescape(match[2] or match[3] or match[4] or "").split():
            whole = name.lower()
            parts = {whole}
            if whole not in NAMES_LEFT_OUT and tag not in INLINE:
                parts = set(_PART.findall(name.replace("-", " ").replace("_", " ")))
                parts = {part.lower() for part in parts}
                if parts & PARTS_ELSE or not parts & PARTS_LEFT_OUT:
                    continue
            elif whole not in NAMES_LEFT_OUT:
                continue
            if parts & COMMENT_PARTS:
                return "comments"
            found = "other"
    return found


def read_lines(html: str) -> list[Line]:
    """The text of every block, in page order, without what the markup leaves out.

    An element left out for its name alone stays if it holds more than half of the text and is
    not named for comments, or an article (or main part) where all articles of the page are in
    such elements. Of a header inside an article its headings stay, as they are its title.
    Character references are decoded; white space in a block becomes one space. An end tag
    closes the elements opened since its start tag, one without a start tag nothing.
    """
    # Pieces of text, each with the innermost named element it is in (or -1).
    lines: list[tuple[list[tuple[str, int]], int]] = []
    held: list[tuple[str, int]] = []
    # (tag, whether it is left out (-1: back in), whether it is an article, whether it is named)
    open_tags: list[tuple[str, int, bool, bool]] = []
    left_out = main = parts = 0
    # Of each named element: the one around it, its text's length, whether it has an article.
    around: list[int] = []
    sizes: list[int] = []
    marked: list[bool] = []
    names: list[str] = []
    inside, marked_outside = -1, False

    def is_title(tag: str) -> bool:
        """Whether nothing but a header of the article hides this heading."""
        if left_out != 1 or not main or tag not in HEADINGS:
            return False
        outer = next(i for i, entry in enumerate(open_tags) if entry[1] == 1)
        return open_tags[outer][0] == "header" and any(entry[2] for entry in open_tags[:outer])

    def end_line() -> None:
        nonlocal held
        if held:
            lines.append((held, parts - 1 if main else -1))
            held = []

    at = 0
    while match := _TOKEN.match(html, at):
        at = match.end()
        token = match[0]
        if match[2] is None:
            if not token.startswith(("<!", "<?")) and not left_out:
                held.append((unescape(token), inside))
            continue
        tag, attributes = match[2].lower(), match[3]
        if tag == "br":
            held.append((" ", inside))
            continue
        if tag not in INLINE:
            end_line()
        if match[1]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == tag:
                    for _, was_out, was_main, was_named in reversed(open_tags[i:]):
                        left_out -= was_out
                        main -= was_main
                        if was_named:
                            inside = around[inside]
                    del open_tags[i:]
                    break
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID:
            is_out = int(_is_left_out(tag, attributes))
            is_main = not left_out and not is_out and (tag in MAIN or 'role="main"' in attributes)
            name = "" if left_out or is_out else _named(tag, attributes)
            is_named = name != ""
            if not is_out and is_title(tag):
                is_out = -1
            if is_named:
                names.append(name)
                around.append(inside)
                sizes.append(0)
                marked.append(False)
                inside = len(around) - 1
            if is_main and inside < 0:
                marked_outside = True
            elif is_main:
                marked[inside] = True
            parts += is_main and not main
            open_tags.append((tag, is_out, is_main, is_named))
            left_out += is_out
            main += is_main
    end_line()
    total = 0
    for pieces, _ in lines:
        for text, element in pieces:
            total += len(text.strip())
            if element >= 0:
                sizes[element] += len(text.strip())
    for i in range(len(around) - 1, -1, -1):
        if around[i] >= 0:
            sizes[around[i]] += sizes[i]
            marked[around[i]] |= marked[i]
    kept: list[bool] = []
    for element, size, has_main, name in zip(around, sizes, marked, names):
        stays = (2 * size > total and name != "comments") or (has_main and not marked_outside)
        kept.append(stays and (element < 0 or kept[element]))
    out = []
    for pieces, part in lines:
        text = _SPACES.sub(" ", "".join(text for text, element in pieces if element < 0 or kept[element])).strip()
        if text:
            out.append(Line(text, part))
    return out


def common_lines(mine: list[int], other: list[int]) -> list[int]:
    """Places of my lines that are in the longest common subsequence with the other's.

    The longest increasing run of matches; of equally long ones, any.
    """
    places: dict[int, list[int]] = {}
    for j, line in enumerate(other):
        places.setdefault(line, []).append(j)
    ends: list[int] = []
    nodes: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(mine):
        for j in reversed(places.get(line, ())):
            at = bisect_left(ends, j)
            node = (i, nodes[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                nodes.append(node)
            else:
                ends[at], nodes[at] = j, node
    found, node = [], nodes[-1] if nodes else None
    while node:
        found.append(node[0])
        node = node[1]
    return found[::-1]


def own_lines(parts: list[int], sizes: list[int], shared: list[bool]) -> list[int]:
    """Places of the lines of a page's text, by their parts, lengths, and whether the nearest page has them too.

    Articles and main parts that hold a line of the page's own are whole: what two articles share is no
    site's line. If there is none, the marked parts (a copy of the nearest page's) or, if they are
    longer, the own lines outside.
    """
    chosen = {part for part, known in zip(parts, shared) if part >= 0 and not known}
    if chosen:
        return [i for i, part in enumerate(parts) if part in chosen]
    marked = [i for i, part in enumerate(parts) if part >= 0]
    rest = [i for i, known in enumerate(shared) if not known]
    return rest if sum(sizes[i] for i in rest) > sum(sizes[i] for i in marked) else marked


def _hashes(lines: list[Line]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(line.text.encode()) for line in lines), np.uint64, len(lines)).view(np.int64)


_ADDRESS = r"(?s)\A[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)\??([^#]*)"


def _rows(df: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """``id, url, html, host, address, page``: the address is the path and, behind a sign that sorts first, the query."""
    url = column(url_column).cast("string")
    host, path, query = (F.coalesce(F.regexp_extract(url, _ADDRESS, i), F.lit("")) for i in (1, 2, 3))
    html = F.coalesce(column(html_column).cast("string"), F.lit(""))
    return df.select(
        column(id_column).alias("id"),
        url.alias("url"),
        html.alias("html"),
        F.lower(host).alias("host"),
        F.when(query == "", path).otherwise(F.concat(path, F.lit("\x01"), query)).alias("address"),
        F.xxhash64(html).alias("page"),
    )


def site_lines(rows: DataFrame) -> DataFrame:
    """``host, address, page, name, lines, parts, sizes``: hashes of the lines of each page with an address.

    ``name`` is the hash of all of them; ``parts`` and ``sizes`` are the parts and lengths of the lines.
    """
    names = ["host", "address", "page", "name", "lines", "parts", "sizes"]
    ints = pa.list_(pa.int32())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_lines(html.as_py()) for html in batch.column(3)]
            lines = [_hashes(of_page) for of_page in found]
            made = [
                pa.array([xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63) for own in lines], pa.int64()),
                pa.array(lines, pa.list_(pa.int64())),
                pa.array([[line.part for line in own] for own in found], ints),
                pa.array([[len(line.text) for line in own] for own in found], ints),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names)

    return rows.where("host <> ''").select("host", "address", "page", "html").mapInArrow(
        hashed, "host string, address string, page long, name long, lines array<long>, parts array<int>, sizes array<int>"
    )


def nearer(mine: str, before: str | None, after: str | None) -> bool:
    """Whether ``after`` begins like ``mine`` for as many steps, then characters, as ``before``."""

    def alike(other: str | None) -> tuple[int, int]:
        if other is None:
            return (-1, -1)
        steps = takewhile(lambda pair: pair[0] == pair[1], zip(_STEP.split(mine), _STEP.split(other)))
        return (sum(1 for _ in steps), len(os.path.commonprefix([mine, other])))

    return alike(after) >= alike(before)


def shared_lines(found: DataFrame) -> DataFrame:
    """``host, name, shared``: hashes of the lines that a page has in common with the nearest one.

    Nearest is the neighbour, in the order of paths and then queries, with the longest common beginning, in
    steps and then characters; the one after it wins a tie. Pages of a host with equal lines
    are one, at the first of their addresses, as comparing them would leave nothing. Pages without
    lines are nobody's neighbours. Addresses
    of a host are sorted in range buckets with the first one of the next as a guard, so no host is one task's.
    """
    key = ["host", "address", "name"]
    pages = stage(
        found.where("size(lines) > 0").groupBy("host", "name").agg(
            F.min("address").alias("address"), F.any_value("lines").alias("lines")
        )
    )
    spark = found.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = stage(pages.select(*key).repartitionByRange(parts, *key).withColumn("part", F.spark_partition_id()))
    edge = F.struct(*key)
    bounds = sorted_rows.groupBy("part").agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
    # A row for each range bucket: which buckets are next to each other.
    beside = Window.orderBy("part")
    near = bounds.select("part", F.lag("last").over(beside).alias("before"), F.lead("first").over(beside).alias("after"))
    guards = near.select("part", F.explode(F.array("before", "after")).alias("edge")).where("edge IS NOT NULL")
    rows = sorted_rows.select(*key, "part", F.lit(False).alias("guard")).unionByName(
        guards.select(*[f"edge.{c}" for c in key], "part", F.lit(True).alias("guard"))
    )
    order = Window.partitionBy("part").orderBy(*key)

    def beside_it(shift) -> Column:
        there = shift(edge)
        return F.when(there["host"] == F.col("host"), there)

    neighbours = rows.select(
        *key, "guard",
        beside_it(lambda c: F.lag(c).over(order)).alias("before"),
        beside_it(lambda c: F.lead(c).over(order)).alias("after"),
    ).where("NOT guard AND coalesce(before, after) IS NOT NULL").select(
        "host", "name", "address", "before.address", "after.address", "before.name", "after.name"
    ).toDF("host", "name", "address", "before", "after", "name_before", "name_after")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(*(batch.column(i).to_pylist() for i in range(2, 7)))
            nearest = [b if nearer(mine, before, after) else a for mine, before, after, a, b in sides]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nearest, pa.int64())], ["host", "name", "nearest"])

    pairs = neighbours.mapInArrow(chosen, "host string, name long, nearest long")
    mine = pages.select("host", "name", "lines").join(pairs, ["host", "name"])
    other = pages.select("host", F.col("name").alias("nearest"), F.col("lines").alias("theirs"))
    both = mine.join(other, ["host", "nearest"]).select("host", "name", "lines", "theirs")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = [
                [own[i] for i in common_lines(own, theirs)]
                for own, theirs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.list_(pa.int64()))], ["host", "name", "shared"]
            )

    return both.mapInArrow(aligned, "host string, name long, shared array<long>").where("size(shared) > 0")


def decided(found: DataFrame, shared: DataFrame) -> DataFrame:
    """``host, page, places``: the lines of a page's text, where the lines shared with the nearest page decide.

    Pages whose text would be the same if nothing were shared are left out, as most are that mark their article.
    """
    pages = found.dropDuplicates(["host", "page"]).join(shared, ["host", "name"])

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for lines, parts, sizes, known in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                known = set(known)
                own = own_lines(parts, sizes, [line in known for line in lines])
                places.append(own if own != own_lines(parts, sizes, [False] * len(parts)) else None)
            out = [batch.column(0), batch.column(1), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(out, ["host", "page", "places"])

    of_lines = pages.select("host", "page", "lines", "parts", "sizes", "shared")
    return of_lines.mapInArrow(chosen, "host string, page long, places array<int>").where("places IS NOT NULL")


def main_text(
    df: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """The identifier, the URL, ``text`` and ``n_chars`` of every page.

    Every page is aligned with the nearest page of its host; lines that both have are not its own. The
    articles (or main parts) it marks that hold a line of its own are its text, whole; if it marks
    none, its own lines are. If the nearest page has all of its articles too, they stay, unless its own lines
    outside are longer. Lines are joined by a space. A null or empty
    page gives an empty text; a page without a host in its URL, or alone on its
    host, is compared with none. Pages of a host with equal lines count as one when paired. Other columns don't matter.
    An empty table gives no rows. Memory follows the longest page.
    """
    rows = _rows(df, id_column, url_column, html_column)
    found = stage(site_lines(rows))
    joined = rows.join(stage(decided(found, shared_lines(found))), ["host", "page"], "left")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html, places in zip(batch.column(2), batch.column(3).to_pylist()):
                lines = read_lines(html.as_py())
                if places is None:
                    sizes = [len(line.text) for line in lines]
                    places = own_lines([line.part for line in lines], sizes, [False] * len(lines))
                out.append(" ".join(lines[i].text for i in places))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["id", "url", "text"])

    kind = rows.schema["id"].dataType.simpleString()
    found = joined.select("id", "url", "html", "places").mapInArrow(texts, f"id {kind}, url string, text string")
    return found.select(
        F.col("id").alias(id_column), F.col("url").alias(url_column), "text", F.char_length("text").cast("long").alias("n_chars")
    )

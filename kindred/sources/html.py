"""HTML pages to rows, as a job over a table of pages.

A page becomes a tree from which its tables, headings and marked sections are read: cut at its
angle brackets where all its tags are plain ones, by the standard library's parser otherwise.  Selecting, cleaning and typing is left to Spark.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.columns import clean_name
from kindred.functions.constants import COUNTRY_CODES, SKIPPED_HEADINGS, SQUAD_POSITIONS
from kindred.functions.text import country_code, parse_money, squad_position, strip_markers

_VOID = {"br", "img", "hr", "meta", "link", "input", "col", "wbr", "area", "base", "source"}


#: Elements whose content the standard parser reads by other rules.
_RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "noscript", "textarea", "title", "plaintext"}
#: What stands between the angle brackets of tags on which a pattern and the standard parser agree, and of a document type.
_TAG = re.compile(r"""(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z_][a-zA-Z0-9_-]*(?:="[^"<>&]*"(?=[ \t\n/]|\Z))?)*+)[ \t\n]*(/?)""").fullmatch
_DOCTYPE = re.compile(r"![dD][oO][cC][tT][yY][pP][eE][ ][a-zA-Z ]*").fullmatch
_COMMENTS = re.compile(r"<!--(?!-?>)[^-]*+(?:-[^-]+)*+-->").split
_ATTRIBUTES = re.compile(r"""([a-zA-Z_][a-zA-Z0-9_-]*)(?:="([^"]*)")?""").findall
#: Tags longer than this are not remembered.
_TAG_LETTERS = 200
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "map": pa.map_(pa.string(), pa.string())}
#: Pages whose rows are packed together.
PAGES = 1000
_CLOSED_BY = {"td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}}


class _Tag(NamedTuple):
    """A tag as written; ``attrs`` belongs to all elements that it opens and is never changed."""

    name: str
    attrs: dict[str, str]
    opens: bool
    stays_open: bool


@lru_cache(4096)
def _tag(written: str) -> _Tag | None:
    """The tag that is written between angle brackets; None where the standard parser has to decide."""
    found = _TAG(written)
    if found is None:
        return _Tag("!doctype", {}, False, False) if _DOCTYPE(written) else None
    closing, name, given, closed = found.groups()
    name = name.lower()
    if name in _RAW or closing and (given or closed):
        return None
    return _Tag(name, {k.lower(): v for k, v in _ATTRIBUTES(given)}, not closing, not (closing or closed or name in _VOID))


class _Tree:
    """Elements and text parts of a page in document order, built by its tags.

    Element ``i`` has a tag and attributes; its descendants are the elements up to ``stops[i]``, its
    text parts those from ``firsts[i]`` up to ``lasts[i]``.  Element 0 is the root, above all others.
    """

    def __init__(self):
        self.tags, self.attrs, self.stops = [""], [{}], [1]
        self.firsts, self.lasts, self.parts = [0], [0], []
        self.open = [0]

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in _CLOSED_BY:
            self.close_before(tag)
        at, part = len(self.tags), len(self.parts)
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.stops.append(at + 1)
        self.firsts.append(part)
        self.lasts.append(part)
        if tag not in _VOID:
            self.open.append(at)

    def close_before(self, tag: str) -> None:
        """Ends the cells and rows that a new cell or row ends."""
        while self.tags[self.open[-1]] in _CLOSED_BY[tag]:
            self._close(len(self.open) - 1)

    def end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[depth]] == tag:
                self._close(depth)
                return

    def _close(self, depth: int) -> None:
        for at in self.open[depth:]:
            self.stops[at], self.lasts[at] = len(self.tags), len(self.parts)
        del self.open[depth:]

    def walk(self, above: int, *tags: str) -> list[int]:
        """Elements below ``above`` that have one of the tags."""
        own = self.tags
        return [i for i in range(above + 1, self.stops[above]) if own[i] in tags]

    def text(self, at: int) -> str:
        return "".join(self.parts[self.firsts[at] : self.lasts[at]]).strip()

    def tight_text(self, at: int) -> str:
        return "".join([p.strip() for p in self.parts[self.firsts[at] : self.lasts[at]]])

    def texts(self, above: int, *tags: str) -> list[str]:
        """Texts of the elements below ``above`` that have one of the tags."""
        firsts, lasts, parts = self.firsts, self.lasts, self.parts
        return ["".join(parts[firsts[i] : lasts[i]]).strip() for i in self.walk(above, *tags)]

    def tight_texts(self, above: int, *tags: str) -> list[str]:
        return [self.tight_text(i) for i in self.walk(above, *tags)]

    def classes(self, at: int) -> list[str]:
        return self.attrs[at].get("class", "").split()

    @property
    def nodes(self) -> list[_Node]:
        """Every element as an object, for looking at a page."""
        return [_Node(self, at) for at in range(len(self.tags))]


class _Node(NamedTuple):
    """An element of a page."""

    page: _Tree
    at: int

    tag = property(lambda self: self.page.tags[self.at])
    attrs = property(lambda self: self.page.attrs[self.at])
    stop = property(lambda self: self.page.stops[self.at])

    def text(self) -> str:
        return self.page.text(self.at)

    def tight_text(self) -> str:
        return self.page.tight_text(self.at)


class _Parser(HTMLParser):
    def __init__(self, tree: _Tree):
        super().__init__(convert_charrefs=True)
        self.tree = tree

    def handle_starttag(self, tag, attrs):
        self.tree.start(tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag):
        self.tree.end(tag)

    def handle_data(self, data):
        self.tree.parts.append(data)


def _plain_tree(html: str) -> _Tree | None:
    """The tree of a page of plain tags; None where the standard parser has to decide.

    The tree's ``start`` and ``end`` are written out: calls would take as long as all the rest.
    """
    tree = _Tree()
    tags, attrs, stops, firsts, lasts, parts, open_ = tree.tags, tree.attrs, tree.stops, tree.firsts, tree.lasts, tree.parts, tree.open
    for stretch in _COMMENTS(html) if "<!--" in html else [html]:
        text, *pieces = stretch.split("<")
        if text:
            parts.append(unescape(text) if "&" in text else text)
        for piece in pieces:
            written, bracket, text = piece.partition(">")
            if not bracket:
                return None
            tag = _tag(written) if len(written) <= _TAG_LETTERS else _tag.__wrapped__(written)
            if tag is None:
                return None
            name, given, opens, stays_open = tag
            if opens:
                if name in _CLOSED_BY:
                    tree.close_before(name)
                at, part = len(tags), len(parts)
                tags.append(name)
                attrs.append(given)
                stops.append(at + 1)
                firsts.append(part)
                lasts.append(part)
                if stays_open:
                    open_.append(at)
            elif tags[open_[-1]] == name:
                at = open_.pop()
                stops[at], lasts[at] = len(tags), len(parts)
            else:
                tree.end(name)
            if text:
                parts.append(unescape(text) if "&" in text else text)
    return tree


def _page(html: str) -> _Tree:
    """The tree of a page."""
    tree = _plain_tree(html)
    if tree is None:
        tree = _Tree()
        parser = _Parser(tree)
        parser.feed(html)
        parser.close()
    tree._close(0)
    return tree


def _array(values: Sequence, kind: pa.DataType) -> pa.Array:
    """Values as Arrow; a map is given as its keys and its values."""
    if not pa.types.is_map(kind):
        return pa.array(values, kind)
    ends = list(accumulate((len(keys) for keys, _ in values), initial=0))
    keys, items = (pa.array([x for pair in values for x in pair[i]], pa.string()) for i in (0, 1))
    return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), keys, items)


def _parsed(pages: DataFrame, columns: list[str], rows: Callable[..., Iterable[tuple]], kinds: list[str], schema: str) -> DataFrame:
    """Rows that ``rows(*values of columns, html)`` gives for every page; ``kinds`` are the types of ``schema``."""
    names = [part.split()[0] for part in schema.split(", ")]
    types = [_KINDS[kind] for kind in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES):
                part = batch.slice(start, PAGES)
                out = [row for page in zip(*(c.to_pylist() for c in part.columns)) for row in rows(*page[:-1], page[-1] or "")]
                made = list(zip(*out)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([_array(c, t) for c, t in zip(made, types)], names=names)

    return pages.select(*columns, "html").mapInArrow(run, schema)


@lru_cache(4096)
def _clean(name: str) -> str:
    return clean_name(name)


def _spanned(page: _Tree, row: int) -> list[str]:
    """Cell texts of a header row, repeated over their column span."""
    out: list[str] = []
    for cell in page.walk(row, "th", "td"):
        out += [page.text(cell)] * int(page.attrs[cell].get("colspan") or 1)
    return out


def _statistics_rows(html: str, id_part: str) -> Iterator[tuple[int, list[str], list[str]]]:
    """Number, cleaned column names and texts of every row that is no repeated header."""
    page = _page(html)
    table = next((t for t in page.walk(0, "table") if id_part in page.attrs[t].get("id", "")), None)
    rows = page.walk(table, "tr") if table else []
    if len(rows) < 2:
        return
    top, low = _spanned(page, rows[0]), _spanned(page, rows[1])
    names = [f"{top[i] if i < len(top) and top[i] else f'Unnamed: {i}_level_0'}_{name}".strip() for i, name in enumerate(low)]
    by_width: dict[int, tuple[int | None, list[str], list[int]]] = {}  # of rows with so many named cells
    for n, row in enumerate(rows[2:]):
        texts = page.texts(row, "td", "th")
        width = min(len(texts), len(names))
        if width not in by_width:
            last = {name: i for i, name in enumerate(names[:width])}  # of columns with one name the last counts
            cleaned = {_clean(name): i for name, i in last.items()}
            by_width[width] = last.get("Unnamed: 0_level_0_Rk", last.get("Rk")), list(cleaned), list(cleaned.values())
        rank, keys, places = by_width[width]
        if rank is None or texts[rank] != "Rk":
            yield n, keys, [texts[i] for i in places]


def statistics_tables(pages: DataFrame, id_part: str = "stats_standard") -> DataFrame:
    """``(page_id, league, row_no, stats)`` of the first table whose id holds ``id_part``.

    Two header levels are joined and cleaned; repeated header rows are dropped.
    ``pages(page_id, league, html)``.
    """

    def parse(page_id, league, html) -> Iterator[tuple]:
        return ((page_id, league, n, (keys, texts)) for n, keys, texts in _statistics_rows(html, id_part))

    return _parsed(pages, ["page_id", "league"], parse, ["long", "string", "int", "map"], "page_id long, league string, row_no int, stats map<string,string>")


def _listing_rows(html: str) -> Iterator[tuple]:
    """Number, name, position, age and value of the marked rows of five cells and more; unnamed rows only count."""
    page = _page(html)
    table = next((t for t in page.walk(0, "table") if "items" in page.classes(t)), None)
    marked = [row for row in page.walk(table, "tr") if not {"odd", "even"}.isdisjoint(page.classes(row))] if table else []
    full = ((row, cells) for row in marked if len(cells := page.walk(row, "td")) >= 5)
    for n, (row, cells) in enumerate(full):
        name = next((page.text(a) for a in page.walk(row, "a") if "spielprofil_tooltip" in page.classes(a)), None)
        if not name:
            continue
        pos = age = value = None
        for cell in cells:
            written = page.attrs[cell].get("class", "")
            classes = written.split()
            if pos is None and "posrela" in classes:
                pos = page.text(cell)
            if age is None and classes == ["zentriert"]:
                age = page.text(cell)
            if value is None and written == "rechts hauptlink":
                value = page.text(cell)
        yield n, name, pos, age, value


def value_listings(pages: DataFrame) -> DataFrame:
    """Rows of the value listing of each page, with the value read as money; unnamed rows drop out."""

    def parse(page_id, league, html) -> Iterator[tuple]:
        return ((page_id, league, *row) for row in _listing_rows(html))

    rows = _parsed(
        pages, ["page_id", "league"], parse, ["long", "string", "int", *["string"] * 4],
        "page_id long, league_tm string, row_no int, player string, position_detail string, age_tm string, market_value_raw string",
    )
    named = rows.where(F.col("player").isNotNull() & (F.col("player") != ""))
    return named.withColumn("market_value_eur", parse_money(F.coalesce("market_value_raw", F.lit(""))))


def link_texts(pages: DataFrame, section_class: str | None = None, keep: int = 10) -> DataFrame:
    """``(page_id, tm_rank, similar_player)``: first link texts longer than two letters.

    With ``section_class`` only the part after that marked section's opening
    tag is read.
    """
    html = F.col("html")
    if section_class is not None:
        html = F.regexp_extract(html, rf'(?s)<div[^>]*class="[^"]*\b{section_class}\b[^"]*"[^>]*>(.*?)</div>', 1)
    anchors = F.regexp_extract_all(html, F.lit(r"(?s)<a\b[^>]*>(.*?)</a>"), F.lit(1))
    texts = F.transform(anchors, lambda a: F.trim(F.regexp_replace(a, r"<[^>]*>", "")))
    kept = F.slice(F.filter(texts, lambda t: F.length(t) > 2), 1, keep)
    return pages.select("page_id", F.posexplode(kept).alias("nth", "similar_player")).select(
        "page_id", (F.col("nth") + 1).alias("tm_rank"), "similar_player"
    )


def _section_rows(html: str) -> Iterator[tuple]:
    """Heading of a country with a code, row number, position, name and club."""
    page = _page(html)
    tables = [t for t in page.walk(0, "table") if "wikitable" in page.classes(t)]
    squads: dict[int, list[tuple]] = {}  # several headings may stand before one table
    for heading in page.walk(0, "h2", "h3"):
        title = page.tight_text(heading)
        if title in SKIPPED_HEADINGS or title.startswith("Group ") or title not in COUNTRY_CODES:
            continue
        following = bisect_right(tables, heading)
        if following == len(tables):
            continue
        table = tables[following]
        if table not in squads:
            squads[table] = _squad_rows(page, table)
        for row in squads[table]:
            yield title, *row


def _squad_rows(page: _Tree, table: int) -> list[tuple]:
    """Row number, position, name and club of the rows that have a position."""
    out = []
    for n, row in enumerate(page.walk(table, "tr")[1:]):
        cells = page.tight_texts(row, "td", "th")
        anchor = next((i for i, c in enumerate(cells) if c in SQUAD_POSITIONS), None)
        if len(cells) < 3 or anchor is None:
            continue
        after = cells[anchor:] + [None] * 4
        out.append((n, cells[anchor], after[1], after[3] or ""))
    return out


def squad_sections(pages: DataFrame) -> DataFrame:
    """Squad rows under country headings: name, position code, country code, club.

    Headings without a country code and rows without a name are dropped.
    """

    def parse(page_id, html) -> Iterator[tuple]:
        return ((page_id, *row) for row in _section_rows(html))

    rows = _parsed(
        pages, ["page_id"], parse, ["long", "string", "int", *["string"] * 3],
        "page_id long, heading string, row_no int, pos_raw string, name_raw string, squad string",
    )
    named = rows.select(
        "page_id", "row_no", strip_markers(F.col("name_raw")).alias("player"), squad_position(F.col("pos_raw")).alias("pos"),
        country_code(F.col("heading")).alias("nation"), "squad", F.col("heading").alias("nationality_tm"), F.lit(1).alias("is_world_cup"),
    )
    return named.where(F.col("nation").isNotNull() & (F.length("player") > 1))

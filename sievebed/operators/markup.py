"""Text out of stored web pages.

Pages that may hold what is asked for go to Python in Arrow batches.  There one regular expression goes over a
page once, from tag to tag, and a small state machine keeps the depth; no list of a page's tokens is made.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from sievebed.fixed_values import LISTING_HEADER, RANK_SCOPE_CLASS, RANK_SCOPE_TAG, VOID_ELEMENTS
from sievebed.functions.checks import pass_or_raise
from sievebed.functions.text import nonblank_lines
from sievebed.operators.flatten import quoted

# Behind a tag's name come names, each with a value or not: quotes open a value only right behind "=".
# All quantified groups are possessive, so that a long tag is read in one go.
_TAG_REST = r"[^\s/>]*+(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\x22[^\x22]*+\x22|\x27[^\x27]*+\x27|[^\s\x22\x27>][^\s>]*+))?+|=)*+>"
_MARKUP = re.compile(
    rf"""(?is)<!--.*?-->
    |(?P<raw><(?:script|style)(?=[\s/>]){_TAG_REST}(?P<body>.*?)(?:</(?:script|style)\s*+>|\Z))
    |(?P<open><[a-z]{_TAG_REST})|(?P<close></[a-z][^>]*+>)
    |<[!?][^>]*+>|</[^a-z>][^>]*+>""".replace("\n    ", "").encode()
)
_VOID = re.compile(rf"(?i)</?(?:{'|'.join(VOID_ELEMENTS)})(?=[\s/>])".encode())
_ATTRIBUTE = r"""[\s/]*+[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+"""


# Marked non-deterministic below, so that no filter on a result is pushed beneath it: the optimizer
# would copy the whole extraction into that filter and run it twice.
@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


_unescape = _unescape.asNondeterministic()


def decode_entities(text: Column) -> Column:
    """Decode HTML entities; texts without an ``&`` never leave the JVM."""
    encoded = F.contains(text, F.lit("&"))
    return F.when(encoded, _unescape(F.when(encoded, text))).otherwise(text)


def _text(raw: bytes) -> str:
    text = raw.decode("utf-8", "replace")
    return html.unescape(text) if "&" in text else text


def _parts(page: bytes) -> Iterator[tuple[str | None, bytes, bytes]]:
    """A page's tags in order, each with the text before it; at the end the text behind the last one.

    The kind is ``open``, ``close`` or ``raw`` (a script or style, whose body is given), None for what
    neither opens nor closes anything.
    """
    last = 0
    for found in _MARKUP.finditer(page):
        kind, start = found.lastgroup, found.start()
        yield kind, page[last:start], found["body"] if kind == "raw" else found[0]
        last = found.end()
    yield None, page[last:], b""


def _scope_text(tag: str, css_class: str) -> Callable[[bytes], str]:
    """The text inside every ``<tag class="css_class">`` of a page, a line break behind each."""
    # A start tag with the class among its attributes, whatever stands before it.
    value = re.escape(css_class)
    wanted = rf"""[\s/]*+(?i:class)\s*+=\s*+(?:"{value}"|'{value}'|{value}(?=[\s>]))"""
    opens = re.compile(rf"\A<(?i:{re.escape(tag)})(?=[\s/])(?:(?!{wanted}){_ATTRIBUTE})*+{wanted}".encode())
    named = css_class.encode()

    def read(page: bytes) -> str:
        out, depth = [], 0
        for kind, before, token in _parts(page):
            if depth and before:
                out.append(_text(before))
            if kind == "open":
                if token.endswith(b"/>") or _VOID.match(token):
                    continue
                if depth:
                    depth += 1
                elif named in token and opens.match(token):
                    depth = 1
            elif not depth:
                continue
            elif kind == "raw":
                out.append(token.decode("utf-8", "replace"))
            elif kind == "close" and not _VOID.match(token):
                depth -= 1
                if not depth:
                    out.append("\n")
        return "".join(out)  # a scope the page never closes runs to its end

    return read


def _over_pages(read: Callable[[bytes], object], kind: pa.DataType, result: StringType | ArrayType):
    """An Arrow function over pages; non-deterministic, so that no filter on a result is pushed beneath it."""

    @F.arrow_udf(result)
    def run(pages: pa.Array) -> pa.Array:
        views = pages.cast(pa.binary())
        return pa.array([read(page.as_buffer().to_pybytes()) if page.is_valid else None for page in views], kind)

    return run.asNondeterministic()


def scoped_lines(
    df: DataFrame,
    page: str,
    into: str = "lines",
    tag: str = RANK_SCOPE_TAG,
    css_class: str = RANK_SCOPE_CLASS,
) -> DataFrame:
    """Add the stripped, non-blank text lines found inside every ``<tag class="css_class">``.

    Inside a scope any start tag goes one level down and any end tag one level up; a scope ends with
    a line break at level zero.  Void elements (``<br>``) do neither.  Pages that do not name the
    class skip the work; a null page gives null.
    """
    source = F.col(quoted(page))
    names = F.contains(source, F.lit(css_class))
    read = _over_pages(_scope_text(tag, css_class), pa.string(), StringType())
    text = df.withColumn("_text", read(F.when(names, source)))
    lines = F.when(names, nonblank_lines(F.col("_text"))).when(source.isNotNull(), F.array().cast("array<string>"))
    return text.withColumn(into, lines).drop("_text")


# What makes a table: rows, cells, and groups of rows.
_TABLE_TAG = re.compile(rb"</?(table|thead|tbody|tfoot|tr|td|th)(?=[\s/>])", re.IGNORECASE)
_SPAN = re.compile(
    rb"""[\s/]*+(?:(rowspan|colspan)\s*+=\s*+["']?\s*+([0-9]++)|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+)""",
    re.IGNORECASE,
)
#: How far a cell may span, by the HTML standard.
_MOST_COLUMNS, _MOST_ROWS = 1000, 65534


class _Cell:
    """A cell as it is read: its text, and how many rows and columns it spans."""

    __slots__ = ("across", "down", "parts")

    def __init__(self, tag: bytes) -> None:
        self.parts: list[bytes] = []
        spans = {}
        if b"span" in tag.lower():
            for name, size in _SPAN.findall(tag, 3):
                if name:
                    spans.setdefault(name.lower(), int(size[:6]))
        self.across = min(spans.get(b"colspan", 1) or 1, _MOST_COLUMNS)
        self.down = min(spans.get(b"rowspan", 1), _MOST_ROWS)

    @property
    def text(self) -> str:
        return _text(b"".join(self.parts)).strip()


def _grid(rows: list[list[_Cell]]) -> list[list[str | None]]:
    """The rows of one group, a text per column: a cell stands in every row and column that it spans.

    A cell goes to the first free column.  One that spans zero rows spans all rows left; none spans more than
    the group has.  A column that no cell reaches has null.
    """
    filled: list[list[str | None]] = []
    hanging: dict[int, list[tuple[int, str]]] = {}  # column -> cells from above: row they end before, and text
    for number, row in enumerate(rows):
        hanging = {x: left for x, cells in hanging.items() if (left := [cell for cell in cells if cell[0] > number])}
        out, below = [], []
        for cell in row:
            while len(out) in hanging:
                out.append(hanging[len(out)][-1][1])
            text, end = cell.text, min(number + cell.down, len(rows)) if cell.down else len(rows)
            for _ in range(cell.across):  # where two cells meet the later one counts
                below.append((len(out), (end, text)))
                out.append(text)
        while further := [x for x in hanging if x >= len(out)]:
            nearest = min(further)
            out += [None] * (nearest - len(out)) + [hanging[nearest][-1][1]]
        for x, cell in below:
            hanging.setdefault(x, []).append(cell)
        filled.append(out)
    return filled


def first_table(page: bytes) -> tuple[list[list[str | None]], list[list[str | None]]] | None:
    """Head and body rows of decoded, stripped cell texts of the first table; null without one.

    The head is what stands in a ``thead``, else the first row.  End tags of rows and cells may be missing.
    Comments and scripts give nothing.  A table inside a cell is text of that cell.  Cells that span rows or
    columns stand in each of them; none spans beyond its group of rows.
    """
    groups: list[tuple[bool, list[list[_Cell]]]] = []
    depth, in_cell, in_head = 0, False, False
    for kind, before, token in _parts(page):
        if in_cell and before:
            groups[-1][1][-1][-1].parts.append(before)
        found = _TABLE_TAG.match(token) if kind in ("open", "close") else None
        if found is None:
            continue
        name, ends = found[1].lower(), kind == "close"
        if name == b"table":
            depth += -1 if ends else 1
            if depth <= 0:
                break
        elif depth == 1:
            in_cell = False
            if name in (b"thead", b"tbody", b"tfoot"):
                in_head = name == b"thead" and not ends
                groups.append((in_head, []))
            elif not ends:
                if not groups:
                    groups.append((False, []))
                rows = groups[-1][1]
                if name == b"tr":
                    rows.append([])
                else:
                    if not rows:
                        rows.append([])
                    in_cell = True
                    rows[-1].append(_Cell(token))
    else:
        if not depth:
            return None
    grids = [(is_head, _grid(rows)) for is_head, rows in groups]
    head = [row for is_head, rows in grids if is_head for row in rows]
    body = [row for is_head, rows in grids if not is_head for row in rows]
    return (head, body) if head else (body[:1], body[1:])


def _column_under(header: str) -> Callable[[bytes], list[str | None] | None]:
    def read(page: bytes) -> list[str | None] | None:
        head, body = first_table(page) or ([], [])
        for row in head:
            if header in row:
                at = row.index(header)
                return [cells[at] if at < len(cells) else None for cells in body]
        return None

    return read


def table_column(
    df: DataFrame, page: str, header: str = LISTING_HEADER, into: str = "symbol", on_missing: str = "raise"
) -> DataFrame:
    """One row per body row of the page's first HTML table: the text under one header.

    Without the table or the header the query fails (``raise``) or the page gives no rows (``skip``).
    Texts are compared after decoding.  A cell that spans rows or columns stands in each of them.
    """
    if on_missing not in ("raise", "skip"):
        raise ValueError(f"on_missing must be 'raise' or 'skip', not {on_missing!r}")
    source = F.col(quoted(page))
    kept = [quoted(name) for name in df.columns]
    read = _over_pages(_column_under(header), pa.list_(pa.string()), ArrayType(StringType()))
    has_table = F.regexp_like(source, F.lit("(?i)<table"))
    found = df.withColumn("_column", read(F.when(has_table, source)))
    there = F.col("_column").isNotNull()
    if on_missing == "raise":
        there = pass_or_raise(there, F.lit(f"no table with the column {header}"))
    cells = F.when(F.size("_column") >= 0, F.col("_column"))
    return found.where(there).select(*kept, F.explode(cells).alias(into))

"""Main text of an article page by a stack of open elements.

One pass over a page's tags keeps the elements that are open, so that text is
judged by everything it stands in: an inner table that ends does not end the
outer one, an end tag closes what was left open inside its element, an end tag
without an element is passed over, and void elements are never open. Pages go
through Arrow batches; what a page needs is its own length of memory.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values ------------------------------------------------------------
# Elements whose text is never article text.
INVISIBLE = frozenset(("script", "style", "noscript", "template"))
BOILERPLATE = frozenset(("nav", "header", "footer", "aside", "form", "table", "figure"))
# Elements that hold raw text up to their own end tag.
RAW = frozenset(("script", "style", "textarea", "title"))
# Elements that have no end tag.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
# Elements that stand on lines of their own.
BLOCKS = frozenset(("p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "br", "section", "blockquote", "pre", "tr", "ul", "ol",
                    "article", "main"))
# An end tag of another element does not reach past these; their own parts may.
CELLS = frozenset(("td", "th", "caption", "table", "template"))
TABLE_PARTS = frozenset(("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"))
# Where the main text is looked for, in this order; the whole page comes last.
REGIONS = ("article", "main", "body", None)
# -----------------------------------------------------------------------------

HIDDEN = INVISIBLE | BOILERPLATE
LINES = BLOCKS | BOILERPLATE

# a comment (to the end of the page if it is never closed), a tag with quoted
# attribute values, a declaration, text, or a '<' that begins nothing
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)|<[!?/][^>]*+>|(?P<text>[^<]++|<)""",
    re.S,
)


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """(kind, value): ("text", text), ("open", name), ("close", name), ("void", name); comments and declarations are left out."""
    at = 0
    while found := TOKEN.match(page, at):
        at = found.end()
        if text := found["text"]:
            yield "text", text
        elif name := found["name"]:
            name = name.lower()
            if found["end"]:
                yield "close", name
            elif name in VOID or found["rest"].endswith("/>"):
                yield "void", name
            else:
                yield "open", name
                if name in RAW:
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                    stop = end.start() if end else len(page)
                    if stop > at:
                        yield "text", page[at:stop]
                    at = stop


def closes(stack: list[str], name: str) -> int | None:
    """Place in the stack of the element that an end tag closes, None if it closes none."""
    for place in range(len(stack) - 1, -1, -1):
        if stack[place] == name:
            return place
        if stack[place] in CELLS and name not in TABLE_PARTS:
            return None
    return None


def region_text(page: str, region: str | None) -> str:
    """Text of the outermost ``region`` elements (None: the page), a line per block, hidden elements left out."""
    stack: list[str] = []
    parts: list[str] = []
    inside = 0 if region is None else -1  # depth at which the region begins, -1 outside of it
    hidden = -1  # depth of the outermost hidden element within the region
    for kind, value in tokens(page):
        shown = inside >= 0 and hidden < 0
        if kind == "text":
            if shown:
                parts.append(html.unescape(value))
            continue
        if shown and value in LINES:
            parts.append("\n")
        if kind == "open":
            if value == region and inside < 0:
                inside = len(stack)
            elif value in HIDDEN and shown:
                hidden = len(stack)
            stack.append(value)
        elif kind == "close" and (place := closes(stack, value)) is not None:
            del stack[place:]
            hidden = -1 if place <= hidden else hidden
            if region is not None and place <= inside:
                inside, hidden = -1, -1
                parts.append("\n")
    text = "".join(parts).replace("\xa0", " ")
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def main_text(page: str | None) -> str | None:
    """Text of the first of REGIONS that has any; None for a page without text."""
    lowered = page.lower() if page else ""
    for region in REGIONS if page else ():
        if region is None or f"<{region}" in lowered:
            if text := region_text(page, region):
                return text
    return None


@F.arrow_udf(StringType())
def _main_texts(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())


def extract_body(page: Column, max_chars: int | None = None) -> Column:
    """Main text of a page, whole unless ``max_chars`` is given; NULL when nothing is left."""
    text = _main_texts(page)
    return F.substring(text, 1, max_chars) if max_chars else text

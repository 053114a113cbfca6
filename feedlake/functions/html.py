"""The two steps with no built-in expression, as Arrow UDFs: HTML text and NFKC."""

from __future__ import annotations

import re
import sys
from html import unescape
from html.parser import HTMLParser
from unicodedata import normalize

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The parser travels with the UDF, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values (HTML): elements that never have content, and elements whose text is not
# part of the text of what is around them.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
HIDDEN = frozenset("rp rt script style template".split())

# Elements whose content is not ordinary markup.
RAW = HIDDEN | frozenset(
    "iframe noembed noframes noscript plaintext textarea title xmp".split()
)

# A plain tag (known letters only, attributes in double quotes) or a plain comment; and a
# tag's class attribute.
TAG = re.compile(
    r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9-]*="[^"<>]*")*)[ \t\n\r\f]*(/?)>'
    r"|<!--(?!-?>)(?:[^-]|-(?!-))*-->"
)
CLASS = re.compile(r'[ \t\n\r\f]class="([^"]*)"', re.IGNORECASE)


class _Done(Exception):
    """The wanted element has ended; the rest of the page is not needed."""


class _ClassText(HTMLParser):
    """Collects the text nodes of the first element that carries a class."""

    def __init__(self, wanted: str):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.open: list[str] = []
        self.start: int | None = None
        self.node: list[str] = []
        self.texts: list[str] = []

    def _end_node(self) -> None:
        text = "".join(self.node).strip()
        self.node.clear()
        if text:
            self.texts.append(text)

    def handle_starttag(self, tag, attrs):
        self._end_node()
        if self.start is None and self.wanted in (dict(attrs).get("class") or "").split():
            self.start = len(self.open)
            if tag in VOID:
                raise _Done
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_node()
        if tag in self.open:
            # An end tag also ends everything left open inside its element.
            while self.open.pop() != tag:
                pass
            if self.start is not None and len(self.open) <= self.start:
                raise _Done

    def handle_data(self, data):
        if self.start is not None and HIDDEN.isdisjoint(self.open[self.start + 1 :]):
            self.node.append(data)

    def handle_comment(self, data):
        self._end_node()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self._end_node()
        if data.startswith("CDATA["):
            self.handle_data(data[len("CDATA[") :])
            self._end_node()


def plain_text_of_class(html: str, wanted: str) -> str | None:
    """``text_of_class`` for plain markup at a fraction of the cost; None where the markup
    has anything else in it before the wanted element ends.
    """
    open_tags: list[str] = []
    start, end, texts = None, 0, []
    for tag in TAG.finditer(html):
        text, end = html[end : tag.start()], tag.end()
        if "<" in text:
            return None
        if start is not None and (text := unescape(text).strip()):
            texts.append(text)
        closing, name, attributes, self_closing = tag.groups()
        if name is None:
            continue
        name = name.lower()
        if name in RAW:
            return None
        if closing:
            if attributes or self_closing:
                return None
            if name in open_tags:
                while open_tags.pop() != name:
                    pass
                if start is not None and len(open_tags) <= start:
                    return " ".join(texts)
            continue
        if start is None and attributes:
            classes = CLASS.findall(attributes)
            if classes and wanted in unescape(classes[-1]).split():
                if name in VOID:
                    return ""
                start = len(open_tags)
        if name not in VOID:
            if self_closing:
                return None
            open_tags.append(name)
    return "" if start is None and "<" not in html[end:] else None


def parsed_text_of_class(html: str, wanted: str) -> str:
    """``text_of_class`` by the full parser."""
    parser = _ClassText(wanted)
    try:
        parser.feed(html)
        parser.close()
        parser._end_node()
    except _Done:
        pass
    except Exception:
        return ""
    return " ".join(parser.texts)


def text_of_class(html: str | None, wanted: str) -> str:
    """Text of the first element with class ``wanted``: every text node stripped, empty ones
    dropped, joined by one space. ``""`` if there is none or the parser gives up.
    """
    if not html or (wanted not in html and "&" not in html):
        return ""
    text = plain_text_of_class(html, wanted)
    return parsed_text_of_class(html, wanted) if text is None else text


def nfkc(text: str | None) -> str | None:
    return text if text is None else normalize("NFKC", text)


def class_text(html: Column, wanted: str, fold: bool = False) -> Column:
    """``text_of_class`` over Arrow batches; ``fold`` puts NFKC on top in the same pass."""

    @F.arrow_udf("string")
    def extract(batch: pa.Array) -> pa.Array:
        texts = (text_of_class(page, wanted) for page in batch.to_pylist())
        return pa.array([nfkc(t) if fold else t for t in texts], pa.string())

    return extract(html)


def nfkc_text(text: Column) -> Column:
    """Unicode NFKC over Arrow batches. (Arrow's own kernel leaves accents decomposed.)"""

    @F.arrow_udf("string")
    def fold(batch: pa.Array) -> pa.Array:
        return pa.array([nfkc(t) for t in batch.to_pylist()], pa.string())

    return fold(text)

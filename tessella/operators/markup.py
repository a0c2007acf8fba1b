"""Checks and rewritings of XML parts and HTML pages.

Parsing is a kernel over Arrow batches, one part at a time; what follows are column expressions over the element table
(part, pos, name, attrs, text, path): pos is the document order, name is `{namespace}local`, path holds the ancestors' names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.dom import minidom
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X
from ._shared import large, map_rows

ELEMENTS = "pos long, name string, attrs map<string,string>, text string, path array<string>"
XML_SPACE = "{http://www.w3.org/XML/1998/namespace}space"


def xml_elements(parts: DataFrame, key: str = "part", xml: str = "xml") -> DataFrame:
    """The element table of parts (key, xml); a part that is no XML has no elements."""
    def rows(k, text: str) -> Iterator[tuple]:
        try:
            root = ElementTree.fromstring(text)
        except (ElementTree.ParseError, TypeError):
            return
        stack, pos = [(root, [])], 0
        while stack:
            e, path = stack.pop()
            yield k, pos, e.tag, list(e.attrib.items()), e.text, path
            pos += 1
            if len(e):
                inner = [*path, e.tag]
                stack += [(c, inner) for c in reversed(e) if isinstance(c.tag, str)]

    kind = parts.schema[key].dataType.simpleString()
    return map_rows(parts.select(key, xml), rows, f"{key} {kind}, {ELEMENTS}")


def _is(name: Column, local: str) -> Column:
    return F.substring_index(name, "}", -1) == local


def _inside(local: str) -> Column:
    return F.exists("path", lambda p: _is(p, local))


def lost_whitespace(elements: DataFrame) -> DataFrame:
    """Text elements whose text begins or ends with white space without being told to preserve it."""
    edge = F.col("text").rlike(r"(?s)^\s") | F.col("text").rlike(r"(?s)\s\z")
    kept = F.try_element_at("attrs", F.lit(XML_SPACE)).eqNullSafe(F.lit("preserve"))
    return elements.filter(_is(F.col("name"), "t") & edge & ~kept)


def misplaced_text(elements: DataFrame) -> DataFrame:
    """Tracked-change faults: plain text inside a deletion, deleted text inside an insertion but in no deletion; with `fault`."""
    plain = _is(F.col("name"), "t") & _inside("del") & (F.length("text") > 0)
    gone = _is(F.col("name"), "delText") & _inside("ins") & ~_inside("del")
    return elements.withColumn("fault", F.when(plain, "text_in_deletion").when(gone, "deleted_text_in_insertion")).filter("fault is not null")


def paragraph_change(before: DataFrame, after: DataFrame, key: str = "part") -> DataFrame:
    """(key, before, after, delta): paragraphs of the two element tables, part by part."""
    count = lambda df, name: df.groupBy(key).agg(F.count_if(_is(F.col("name"), "p")).alias(name))
    both = count(before, "before").join(large(count(after, "after")), key, "full")
    return both.fillna(0, ["before", "after"]).withColumn("delta", F.col("after") - F.col("before"))


def known_namespaces_only(elements: DataFrame, namespaces: list[str]) -> DataFrame:
    """elements without those of other namespaces and all that is in them, and without other namespaces' attributes (plain names stay)."""
    space = lambda n: F.when(n.startswith("{") & n.contains("}"), F.substring_index(F.substring(n, 2, 1 << 30), "}", 1)).otherwise("")
    known = lambda n: (space(n) == "") | space(n).isin(namespaces)
    pure = elements.filter(known(F.col("name")) & F.forall("path", known))
    return pure.withColumn("attrs", F.map_filter("attrs", lambda k, _: known(k)))


def _part_map(df: DataFrame, column: str, name: str, kernel) -> DataFrame:
    """df with a text column made from another by a Python kernel, batch by batch; null where the part cannot be parsed."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else kernel(t))

    return df.withColumn(name, run(F.col(column)))


def plain_text(parts: DataFrame, author: str | None = None, xml: str = "xml", name: str = "content") -> DataFrame:
    """parts with the text of their paragraphs, one a line, empty ones left out; with an author, as it was before that author's tracked changes."""
    local = lambda e: e.tag.rsplit("}", 1)[-1] if isinstance(e.tag, str) else ""

    def text_of(paragraph, deleted: bool = False, undone: bool = False) -> str:
        out = ""
        for e in paragraph:
            kind = local(e)
            by = author is not None and any(k.rsplit("}", 1)[-1] == "author" and v == author for k, v in e.attrib.items())
            if kind == "ins" and by:
                continue
            if kind == "t" or (kind == "delText" and undone):
                out += e.text or ""
            # A paragraph inside another one's text box is listed by itself as well.
            out += text_of(e, deleted, undone or (kind == "del" and by))
        return out

    def paragraphs(e, undone: bool = False) -> Iterator[str]:
        for c in e:
            kind = local(c)
            by = author is not None and any(k.rsplit("}", 1)[-1] == "author" and v == author for k, v in c.attrib.items())
            if kind == "ins" and by:
                continue
            here = undone or (kind == "del" and by)
            if kind == "p":
                yield text_of(c, undone=here)
            yield from paragraphs(c, here)

    def kernel(text: str) -> str | None:
        try:
            root = ElementTree.fromstring(text)
        except ElementTree.ParseError:
            return None
        return "\n".join(p for p in paragraphs(root) if p)

    return _part_map(parts, xml, name, kernel)


def untracked_changes(before: DataFrame, after: DataFrame, author: str, key: str = "part") -> DataFrame:
    """(key, same): whether a part without the author's tracked changes reads as it did before."""
    x = plain_text(before, author).select(key, F.col("content").alias("was"))
    y = plain_text(after, author).select(key, F.col("content").alias("now"))
    return x.join(y, key).select(key, F.col("was").eqNullSafe(F.col("now")).alias("same"))


def condensed(parts: DataFrame, xml: str = "xml") -> DataFrame:
    """parts with their XML without comments and white space between elements; texts (`:t` elements) are left as they are."""
    def clean(node) -> None:
        for child in list(node.childNodes):
            if child.nodeType == child.COMMENT_NODE or (child.nodeType == child.TEXT_NODE and not child.data.strip()):
                node.removeChild(child)
            elif child.nodeType == child.ELEMENT_NODE and not child.tagName.endswith(":t"):
                clean(child)

    def kernel(text: str) -> str | None:
        if "<!DOCTYPE" in text or "<!ENTITY" in text:  # no entity is ever expanded
            return None
        try:
            tree = minidom.parseString(text.encode())
        except Exception:  # expat raises several kinds
            return None
        if not tree.documentElement.tagName.endswith(":t"):
            clean(tree.documentElement)
        return tree.documentElement.toxml()

    return _part_map(parts, xml, xml, kernel)


def without_templates(elements: DataFrame) -> DataFrame:
    """elements with {{...}} taken out of their text, except in text elements, and how many were there."""
    free = ~_is(F.col("name"), "t")
    n = F.when(free, F.coalesce(F.size(F.regexp_extract_all("text", F.lit(r"(\{\{[^}]*\}\})"), F.lit(1))), F.lit(0))).otherwise(0)
    return elements.withColumns({"templates": F.greatest(n, F.lit(0)), "text": F.when(free, X.strip_templates(F.col("text"))).otherwise(F.col("text"))})


class _Runs(HTMLParser):
    """Blocks of text with the inline formatting of each run."""

    BLOCKS = frozenset({"p", "h1", "h2", "h3", "h4", "h5", "h6", "li"})
    STYLES = {"b": "bold", "strong": "bold", "i": "italic", "em": "italic", "u": "underline"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, list]] = []
        self.open: list[tuple[str, set]] = []
        self.last = False

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.blocks.append((tag, []))
            self.open = []
        elif tag == "br":
            self.add("\n")
            return
        elif self.blocks and tag in (*self.STYLES, "span"):
            style = dict(attrs).get("style") or ""
            own = {self.STYLES[tag]} if tag in self.STYLES else set()
            own |= {name for name, pattern in (("bold", r"font-weight:\s*(bold|[6-9]00)"), ("italic", r"font-style:\s*italic"), ("underline", r"underline")) if re.search(pattern, style)}
            self.open.append((tag, own))
        self.last = False

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.open = [("", set())] if self.blocks else []
            self.blocks.append(("", []))
        else:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    del self.open[k]
                    break
        self.last = False

    def handle_data(self, data):
        self.add(re.sub(r"\s+", " ", data))

    def add(self, text):
        if self.blocks and self.blocks[-1][0]:
            runs, style = self.blocks[-1][1], frozenset().union(*(s for _, s in self.open)) if self.open else frozenset()
            if self.last and runs and runs[-1][1] == style:
                runs[-1][0] += text
            else:
                runs.append([text, style])
            self.last = True


def html_runs(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, block, tag, run, text, bold, italic, underline): the text blocks of pages, flattened to runs of one formatting.

    White space is one space, none at a block's ends; runs and blocks without text are left out.
    """
    def rows(k, text):
        parser = _Runs()
        parser.feed(text or "")
        blocks = 0
        for tag, runs in parser.blocks:
            if runs:
                runs[0][0], runs[-1][0] = runs[0][0].lstrip(), runs[-1][0] if len(runs) > 1 else runs[0][0].lstrip()
                runs[-1][0] = runs[-1][0].rstrip()
            kept = [r for r in runs if r[0]]
            for n, (run, style) in enumerate(kept):
                yield k, blocks, tag, n, run, "bold" in style, "italic" in style, "underline" in style
            blocks += bool(kept)

    kind = pages.schema[key].dataType.simpleString()
    return map_rows(pages.select(key, html), rows, f"{key} {kind}, block int, tag string, run int, text string, bold boolean, italic boolean, underline boolean")


def layout_faults(pages: DataFrame) -> DataFrame:
    """pages (width, height, scroll_width, scroll_height in pixels; layout_width, layout_height in EMU) with the points by which their
    content overflows (a pixel is let pass) and whether their size is not the layout's (by over 0.1 inch)."""
    over = lambda a, b: G.pixels_to_points(F.greatest(F.lit(0), F.col(a) - F.col(b) - 1))
    off = lambda a: F.abs(G.emu_to_inches(F.col(f"layout_{a}")) - G.pixels_to_inches(F.col(a))) > 0.1
    return pages.withColumns({"over_wide": over("scroll_width", "width"), "over_high": over("scroll_height", "height"), "wrong_size": F.coalesce(off("width") | off("height"), F.lit(False))})


def too_low(texts: DataFrame, margin: float = 0.5, least_font: float = 12) -> DataFrame:
    """texts (type, font_size, y, h in inches, page_height in pixels) of larger print that end too near to the bottom edge, with their distance."""
    text = F.col("type").isin("p", "h1", "h2", "h3", "h4", "h5", "h6", "list")
    away = G.pixels_to_inches(F.col("page_height")) - (F.col("y") + F.col("h"))
    return texts.withColumn("distance", F.round(away, 2)).filter(text & (F.coalesce("font_size", F.lit(0)) > least_font) & (away < margin))


def layout_ids(uses: DataFrame, rels: DataFrame) -> DataFrame:
    """uses (part, id, rid) of slide masters whose relation is missing or leads to no slide layout; rels are (part, id, type)."""
    layouts = rels.filter(F.col("type").contains("slideLayout")).select("part", F.col("id").alias("rid"))
    masters = rels.select("part").distinct().withColumn("has_rels", F.lit(True))
    bad = uses.filter(F.length("rid") > 0).join(layouts, ["part", "rid"], "left_anti").join(masters, "part", "left")
    return bad.withColumn("problem", F.when(F.col("has_rels").isNull(), "no relations").otherwise("no such layout")).drop("has_rels")

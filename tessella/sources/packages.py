"""Zipped XML packages as part, relationship and element tables, through an Arrow kernel over binaryFile."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators._shared import map_rows


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """(package, name, xml): every XML part; one that is no XML, or a file that is no zip, gives no row."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for package, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        names = [n for n in z.namelist() if n.endswith((".xml", ".rels"))]
                        yield pd.DataFrame({"package": package, "name": names, "xml": [z.read(n).decode("utf-8", "replace") for n in names]})
                except zipfile.BadZipFile:
                    continue

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content").mapInPandas(unpack, "package string, name string, xml string")


def read_folder_parts(spark: SparkSession, path: str, most_bytes: int = 64 << 20) -> DataFrame:
    """(name, xml) of one unpacked package: every *.xml and *.rels file below its folder, by its path from there.

    Spark's readers pass over names like _rels/.rels, so the files of the one package are read through its file system on the
    driver; a folder of more than most_bytes is refused (zip it and use `read_parts`).
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    base, found, rows, total = fs.makeQualified(root).toUri(), fs.listFiles(root, True), [], 0
    while found.hasNext():
        status = found.next()
        name = base.relativize(status.getPath().toUri()).getPath()
        if not name.endswith((".xml", ".rels")):
            continue
        total += status.getLen()
        if total > most_bytes:
            raise ValueError(f"{path} holds more than {most_bytes} bytes of parts")
        stream = fs.open(status.getPath())
        rows.append((name.rsplit(path.rstrip("/") + "/", 1)[-1], bytes(stream.readAllBytes()).decode("utf-8", "replace")))
        stream.close()
    return spark.createDataFrame(rows, "name string, xml string")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, width, height) of the images below a path; sizes are read from PNG heads and null for other formats."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    png = F.hex(F.substring("content", 1, 8)) == "89504E470D0A1A0A"
    size = lambda at: F.when(png, F.conv(F.hex(F.substring("content", at, 4)), 16, 10).cast("int"))
    return rows.withColumns({"width": size(17), "height": size(21)})


#: Names of placeholder types by their attribute, alignments that are told, and the default type.
PLACEHOLDERS = {"title": "TITLE", "ctrTitle": "CENTER_TITLE", "subTitle": "SUBTITLE", "body": "BODY", "dt": "DATE", "ftr": "FOOTER", "sldNum": "SLIDE_NUMBER", "pic": "PICTURE", "chart": "CHART", "tbl": "TABLE", "obj": "OBJECT"}
ALIGNMENTS = {"ctr": "CENTER", "r": "RIGHT", "just": "JUSTIFY"}
_PARAGRAPH = "struct<pos:int,text:string,bullet:boolean,level:int,alignment:string,space_before:double,space_after:double,line_spacing:double,font_name:string,font_size:double,bold:boolean,italic:boolean,underline:boolean,color:string,theme_color:string>"
SHAPES = f"slide int, id long, parent long, left_emu long, top_emu long, width_emu long, height_emu long, placeholder string, text string, paragraphs array<{_PARAGRAPH}>"


def _child(node: ET.Element | None, *names: str) -> ET.Element | None:
    """The first descendant along a path of local names."""
    for name in names:
        node = None if node is None else next((c for c in node if c.tag.rsplit("}", 1)[-1] == name), None)
    return node


def _all(node: ET.Element | None, name: str) -> list[ET.Element]:
    return [] if node is None else [c for c in node if c.tag.rsplit("}", 1)[-1] == name]


def _points(node: ET.Element | None, font: float | None, whole_lines: bool = False) -> float | None:
    """A spacing in points: given in hundredths, or for lines in thousandths of a percent of the font (12 without one)."""
    exact, share = _child(node, "spcPts"), _child(node, "spcPct")
    if exact is not None:
        return int(exact.get("val", 0)) / 100
    return round(int(share.get("val", 0)) / 100_000 * (font or 12.0), 2) if whole_lines and share is not None else None


def _flag(props: ET.Element | None, name: str) -> bool | None:
    value = None if props is None else props.get(name)
    return None if value is None else value not in ("0", "false", "none")


def _paragraph(pos: int, p: ET.Element) -> tuple:
    runs = [r for r in p if r.tag.rsplit("}", 1)[-1] in ("r", "fld", "br")]
    text = "".join("\v" if r.tag.endswith("}br") else (_child(r, "t").text or "" if _child(r, "t") is not None else "") for r in runs)
    own, first = _child(p, "pPr"), next((r for r in runs if r.tag.endswith("}r")), None)
    font = _child(first, "rPr")
    size = None if font is None or font.get("sz") is None else int(font.get("sz")) / 100
    bullet = _child(own, "buChar") is not None or _child(own, "buAutoNum") is not None
    face, fill = _child(font, "latin"), _child(font, "solidFill")
    rgb, theme = _child(fill, "srgbClr"), _child(fill, "schemeClr")
    get = lambda node, name: None if node is None else node.get(name)
    return (
        pos, text.strip(), bullet, int(get(own, "lvl") or 0) if bullet else None, ALIGNMENTS.get(get(own, "algn")), _points(_child(own, "spcBef"), size), _points(_child(own, "spcAft"), size), _points(_child(own, "lnSpc"), size, True),
        get(face, "typeface"), size, _flag(font, "b"), _flag(font, "i"), _flag(font, "u"), get(rgb, "val"), get(theme, "val"),
    )


def slide_shapes(parts: DataFrame) -> DataFrame:
    """(package, slide, id, parent, offsets and sizes in EMU, placeholder, text, paragraphs) of the slides among parts (package, name, xml).

    Shapes in groups name their group as parent and stand by their offset from it; groups are rows without text. A slide that
    is no XML has no shapes.
    """
    def walk(slide: int, root: ET.Element) -> Iterator[tuple]:
        tree = _child(root, "cSld", "spTree")
        todo, n = [(e, None, 0, 0) for e in reversed(tree if tree is not None else [])], 0
        while todo:
            node, parent, dx, dy = todo.pop()
            kind = node.tag.rsplit("}", 1)[-1]
            if kind not in ("sp", "grpSp"):
                continue
            props = _child(node, "grpSpPr" if kind == "grpSp" else "spPr", "xfrm")
            off, ext, inner = (_child(props, x) for x in ("off", "ext", "chOff"))
            place = [int(e.get(a, 0)) if e is not None else 0 for e, a in ((off, "x"), (off, "y"), (ext, "cx"), (ext, "cy"))]
            ident, n = n, n + 1
            holder = next((ph for e in node for ph in _all(_child(e, "nvPr"), "ph")), None) if kind == "sp" else None
            paragraphs = [_paragraph(k, p) for k, p in enumerate(_all(_child(node, "txBody"), "p"))]
            text = "\n".join(p[1] for p in paragraphs) if paragraphs else None
            yield slide, ident, parent, place[0] - dx, place[1] - dy, place[2], place[3], None if holder is None else PLACEHOLDERS.get(holder.get("type", "obj"), "OBJECT"), text, paragraphs
            if kind == "grpSp":
                base = (int(inner.get("x", 0)), int(inner.get("y", 0))) if inner is not None else (place[0], place[1])
                todo += [(c, ident, *base) for c in reversed(node)]

    def rows(package: str, name: str, xml: str) -> list[tuple]:
        try:
            return [(package, *r) for r in walk(int(name.rsplit("slide", 1)[-1].split(".")[0]) - 1, ET.fromstring(xml))]
        except ET.ParseError:
            return []

    slides = parts.filter(F.col("name").rlike(r"(^|/)ppt/slides/slide[0-9]+\.xml$"))
    return map_rows(slides.select("package", "name", "xml"), rows, f"package string, {SHAPES}")


def elements(parts: DataFrame) -> DataFrame:
    """(package, part, name, attrs, line, ancestors): elements in document order with their path of names."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for package, part, xml in zip(batch["package"], batch["name"], batch["xml"], strict=True):
                try:
                    root = ET.fromstring(xml)
                except ET.ParseError:
                    continue
                rows, todo = [], [(root, "")]
                while todo:
                    node, above = todo.pop()
                    rows.append((package, part, node.tag, {k.rsplit("}", 1)[-1].lower(): v for k, v in node.attrib.items()}, len(rows) + 1, above, node.text))
                    own = f"{above}/{node.tag.rsplit('}', 1)[-1]}"
                    todo += [(child, own) for child in reversed(node)]
                yield pd.DataFrame(rows, columns=["package", "part", "name", "attrs", "line", "ancestors", "text"])

    return parts.mapInPandas(walk, "package string, part string, name string, attrs map<string,string>, line int, ancestors string, text string")

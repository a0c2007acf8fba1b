"""Tile extractions, OCR files, tile tables and question sets as DataFrames; nested JSON at the sinks."""

from __future__ import annotations

import importlib.util
import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

NODE = (
    "struct<id:string,tag:string,class:string,subtype:string,bbox:array<int>,connections:struct<inlet_from:array<string>,outlet_to:array<string>>,interlocks:array<string>,"
    "connected_to:string,upstream:string,downstream:string,controlled_by:string,description:string,confidence:double>"
)
_END = "struct<node_id:string,instrument_id:string,anchor:string,type:string>"
EDGE = (
    f"struct<id:string,tag:string,source:{_END},target:{_END},line_type:string,specifications:struct<line_number:string,full_spec_string:string>,loop_id:string,"
    "route_waypoints:array<array<int>>,inline_components:array<string>,confidence:double>"
)
UTILITY = "struct<id:string,tag:string,type:string,position:struct<x:int,y:int>,connected_to:string,confidence:double>"
LEGEND = "struct<symbols:array<struct<symbol_id:string,description:string>>,line_types:array<struct<line_type:string,description:string>>,abbreviations:array<struct<abbreviation:string,meaning:string>>>"
LOGIC = (
    "struct<flow_sequences:array<struct<sequence_id:string,nodes:array<string>>>,control_relationships:array<struct<loop_id:string,sensor:string,controller:string,final_element:string>>,"
    "interlocks:array<struct<interlock_id:string,trigger_instrument:string,affected_equipment:array<string>>>>"
)
EXTRACTION = (
    f"source_image string, metadata struct<source_image:string,title:string>, nodes struct<equipment:array<{NODE}>,instruments:array<{NODE}>,valves:array<{NODE}>>, "
    f"edges struct<process_lines:array<{EDGE}>,signal_lines:array<{EDGE}>>, utilities array<{UTILITY}>, legend {LEGEND}, process_logic {LOGIC}, "
    "control_loops array<struct<loop_id:string,instruments:array<string>>>"
)
TILES = "source_image string, tiles array<struct<tile_id:int,filename:string,normalized_bbox:struct<x1:int,y1:int,x2:int,y2:int>>>"
DETECTION = "struct<text:string,bbox:array<int>,type:string,confidence:double>"
OCR = f"tile_id string, all_extractions array<{DETECTION}>, extractions array<{DETECTION}>"


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that are there, as the file system names them; looked up by Spark's own file systems."""
    conf, out = spark._jsc.hadoopConfiguration(), []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        out.append(fs.makeQualified(path).toUri().toString() if fs.exists(path) else None)
    return out


def read_extractions(spark: SparkSession, paths: list[str], drawing: str = "drawing") -> DataFrame:
    """One row a file with drawing, file and file_ord: the order of the paths, on which all later ties rest. Missing files are skipped."""
    found = existing(spark, paths)
    plain = lambda uri: re.sub(r"^file:/+", "/", uri)
    rows = [(plain(u), p.rsplit("/", 1)[-1], k) for k, (u, p) in enumerate(zip(found, paths, strict=True)) if u]
    order = spark.createDataFrame(rows, "uri string, file string, file_ord int")
    if not rows:
        return spark.createDataFrame([], EXTRACTION).select("*", F.lit(drawing).alias("drawing"), F.lit("").alias("file"), F.lit(0).alias("file_ord"))
    read = spark.read.schema(EXTRACTION).option("multiLine", True).json([u for u in found if u])
    uri = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    return read.select("*", uri.alias("uri")).join(F.broadcast(order), "uri").drop("uri").withColumn("drawing", F.lit(drawing))


def read_tiles(spark: SparkSession, path: str, drawing: str = "drawing") -> DataFrame:
    """(drawing, file, x1, y1, x2, y2): the place of each extraction file's tile, by the tile's file name."""
    tiles = spark.read.schema(TILES).option("multiLine", True).json(path).select(F.explode("tiles").alias("t"))
    return tiles.select(F.lit(drawing).alias("drawing"), F.regexp_replace("t.filename", r"\.png$", ".json").alias("file"), "t.normalized_bbox.*")


def read_ocr(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, tile_id, ord, text, bbox, type, confidence) from either layout."""
    rows = spark.read.schema(OCR).option("multiLine", True).json(paths)
    return rows.select(F.col("_metadata.file_name").alias("file"), "tile_id", F.posexplode(F.coalesce("all_extractions", "extractions", F.array().cast(f"array<{DETECTION}>"))).alias("ord", "d")).select("file", "tile_id", "ord", "d.*")


def read_ocr_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(text): the distinct OCR texts, for grounding checks."""
    return read_ocr(spark, paths).select("text").filter("text is not null").distinct()


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """(question, answer), stripped; pairs without either part are skipped."""
    pairs = spark.read.format("xml").option("rowTag", "qa_pair").schema("question string, answer string").load(path)
    return pairs.dropna().select(strip(F.col("question")).alias("question"), strip(F.col("answer")).alias("answer"))


def read_front_matter(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, keys, name, description) of Markdown files with the top-level keys of the block at their head.

    The block is parsed as YAML; where no YAML parser is installed, lines of plain values are read. keys is null for a
    block that is no mapping.
    """
    from ..functions.text import front_matter

    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), front_matter(F.col("value")).alias("block"))
    if importlib.util.find_spec("yaml"):
        @F.pandas_udf("keys array<string>, name string, description string")
        def parse(blocks: pd.Series) -> pd.DataFrame:
            import yaml

            def one(block):
                try:
                    own = yaml.safe_load(block) if block else None
                except yaml.YAMLError:
                    own = None
                if not isinstance(own, dict):
                    return None, None, None
                text = lambda v: None if v is None else str(v).strip()
                return [str(k) for k in own], text(own.get("name")), text(own.get("description"))

            return pd.DataFrame([one(b) for b in blocks], columns=["keys", "name", "description"])

        return texts.withColumn("p", parse("block")).select("path", "block", "p.*")
    lines = F.filter(F.split("block", "\n"), lambda x: x.rlike(r"^[A-Za-z_-]+:"))
    value = lambda key: F.nullif(strip(F.regexp_extract("block", rf"(?m)^{key}:(.*)$", 1)), F.lit(""))
    return texts.select("path", "block", F.transform(lines, lambda x: F.substring_index(x, ":", 1)).alias("keys"), value("name").alias("name"), value("description").alias("description"))


def unique_key_json(text: str) -> dict:
    """JSON that rejects an object with a repeated key."""

    def check(pairs: list) -> dict:
        seen = [k for k, _ in pairs]
        if len(set(seen)) < len(seen):
            raise ValueError(f"repeated keys: {sorted({k for k in seen if seen.count(k) > 1})}")
        return dict(pairs)

    return json.loads(text, object_pairs_hook=check)


def read_replacements(spark: SparkSession, path: str) -> DataFrame:
    """(path, slide, shape_id, text) of replacement files {slide: {shape: {"paragraphs": [...]} or null}}; a repeated key fails the job.

    Paragraphs are texts or objects with a text; text is null where a shape is to be cleared.
    """
    def entries(text: str) -> list:
        out = []
        for slide, shapes in unique_key_json(text).items():
            for shape, value in (shapes or {}).items() if slide.startswith("slide-") else ():
                own = (value or {}).get("paragraphs")
                out.append({"slide": int(slide[6:]), "shape_id": shape, "text": None if own is None else "\n".join(p if isinstance(p, str) else p.get("text", "") for p in own)})
        return out

    @F.pandas_udf("array<struct<slide:int,shape_id:string,text:string>>")
    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(entries)

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), parse("value").alias("r"))
    return files.select("path", F.explode("r").alias("r")).select("path", "r.*")


def write_nested(df: DataFrame, keys: list[str], path: str, by: str | None = None) -> None:
    """A JSON sink: the other columns of each key group, in order of ord, as one array."""
    rest = [c for c in df.columns if c not in keys]
    nested = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*sorted(rest, key=lambda c: c != "ord")))).alias("items"))
    writer = nested.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)

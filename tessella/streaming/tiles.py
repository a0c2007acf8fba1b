"""Extension: tiles that arrive over time (the batch operators have no streaming counterpart to match)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.extractions import OCR


def stream_detections(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """OCR detections of new tile files: (file, at, ord, text, bbox, type, confidence)."""
    files = spark.readStream.schema(OCR).option("multiLine", True).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    rows = files.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_modification_time").alias("at"), F.posexplode(F.coalesce("all_extractions", "extractions")).alias("ord", "d"))
    return rows.select("file", "at", "ord", "d.*")


def first_sightings(detections: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each file's detection once, though a file may be delivered again within the allowed lateness."""
    return detections.withWatermark("at", late).dropDuplicatesWithinWatermark(["file", "ord"])


def counts_by_type(detections: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    return detections.withWatermark("at", late).groupBy(F.window("at", window), "type").count()

"""Raw inputs of the manifest builder: JSON arrays, plain or zipped."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixsieve import schema as S
from pixsieve.sources.manifest import number_parts, number_splits
from pixsieve.sources.zipped import FILE_FIELD, ITEM_FIELD, read_zipped_arrays


def _read_array(spark: SparkSession, path: str, layout: T.StructType, lines: bool) -> DataFrame:
    """The items of JSON arrays, with ``pos``: dense from 1, by file name, then order in the file.

    By default a file is one array over any number of lines, which is a single JSON value and
    so a single task. With ``lines`` every line is an item or an array of its own and files are
    split freely; use that form for anything large.
    """
    options = {"multiLine": not lines, "mode": "FAILFAST"}
    items = spark.read.schema(layout).options(**options).json(path).select(
        *layout.fieldNames(), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_offset"), F.monotonically_increasing_id().alias("_id"),
    )
    return number_splits(items, "pos")


def _read_zipped(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The same from zip files. Items know their place, so only the files' sizes are counted before."""
    items = read_zipped_arrays(spark, path, layout).withColumnRenamed(ITEM_FIELD, "_id")
    return number_parts(items, [FILE_FIELD], "pos").drop(FILE_FIELD).select(*layout.fieldNames(), "pos")


def read_image_metadata(spark: SparkSession, path: str, lines: bool = False, zipped: bool = False) -> DataFrame:
    return _read_zipped(spark, path, S.IMAGE_METADATA_SCHEMA) if zipped else _read_array(spark, path, S.IMAGE_METADATA_SCHEMA, lines)


def read_regions(spark: SparkSession, path: str, lines: bool = False, zipped: bool = False) -> DataFrame:
    return _read_zipped(spark, path, S.REGION_SCHEMA) if zipped else _read_array(spark, path, S.REGION_SCHEMA, lines)

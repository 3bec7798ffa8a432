"""Readers, looked up by the name a spec gives."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pixsieve.sources.images import image_features, list_images, measure_listed, read_images
from pixsieve.sources.manifest import dense_index, index_lines, manifest_from_lines, read_manifest
from pixsieve.sources.regions import read_image_metadata, read_regions
from pixsieve.sources.zipped import read_zipped_arrays

_READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "visual_genome": read_manifest,
}


def register_source(name: str, reader: Callable[[SparkSession, str], DataFrame]) -> None:
    _READERS[name.lower()] = reader


def load_samples(spark: SparkSession, spec: dict) -> DataFrame:
    """The samples of ``spec["input"]``; the source name is not case sensitive."""
    given = spec["input"]
    source = given.get("source", "visual_genome").lower()
    path = given["path"]
    if source not in _READERS:
        raise ValueError(f"Unknown input source: {source}")
    return _READERS[source](spark, path)


__all__ = [
    "dense_index", "image_features", "index_lines", "list_images", "load_samples", "manifest_from_lines",
    "measure_listed", "read_image_metadata", "read_images", "read_manifest", "read_regions", "read_zipped_arrays",
    "register_source",
]
